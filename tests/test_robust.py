"""Damaged input, other session zones, names in odd folders."""

import json
import os

import pytest
from pyspark.sql import functions as F

from voltlake.functions.times import utc_day, utc_text, utc_time
from voltlake.functions.values import calendar_fields, status_key
from voltlake.operators import status
from voltlake.operators.flatten import station_rows
from voltlake.operators.master import station_master
from voltlake.schemas import table
from voltlake.sinks.files import archive_snapshots, read_archive, write_table
from voltlake.sources import snapshots
from voltlake.sources.delimited import read_delimited
from voltlake.streaming.intake import take_in, taken_in

T1 = "2021-10-01 10:00:00"


def city(time, *stations):
    return {"timestamp": time, "data": list(stations)}


def station(number, *points):
    return {"id": number, "evses": [{"id": p, "status": "AVAILABLE"} for p in points]}


def documents(spark, *docs):
    texts = [(f"doc{i}", d if isinstance(d, str) else json.dumps(d)) for i, d in enumerate(docs)]
    return spark.createDataFrame(texts, "path string, content string")


DAMAGED = [
    {"koeln": 5, "bonn": city(T1, station(1, "a"))},
    {"koeln": {"timestamp": T1, "data": "oops"}, "bonn": city(T1, station(2, "b"))},
    {"koeln": city(T1, {"id": 9, "evses": "no"}, station(8, "c")), "bonn": city(T1, station(3, "d"))},
    {"koeln": city(T1, "text", station(7, "e"), 7), "bonn": city(T1, station(4, "f"))},
    {"koeln": city("never", station(6, "g")), "bonn": city(T1, station(5, "h")), "kiel": None, "hof": {"data": []}},
    "<html>busy</html>",
    {"koeln": city(T1, station(10)), "bonn": {"timestamp": T1}},
]


def test_one_odd_part_costs_no_other(spark):
    docs = documents(spark, *DAMAGED)
    points = {r["id"] for r in status.cp_status(docs).collect()}
    assert points == set("abcdefh")
    assert {r["id"] for r in status.status_rows(docs).collect()} == points
    assert status.connector_status(docs).count() == 0
    assert {r["id"] for r in station_master(docs).collect()} == {"1", "2", "9", "8", "3", "7", "4", "5", "10"}
    parts = snapshots.quarantine_parts(docs).collect()
    assert {(r["path"], r["city"], r["station"], r["reason"]) for r in parts} == {
        ("doc0", "koeln", None, "city"), ("doc1", "koeln", None, "stations"), ("doc2", "koeln", 0, "points"),
        ("doc3", "koeln", 0, "station"), ("doc3", "koeln", 2, "station"), ("doc4", "koeln", None, "time"),
        ("doc4", "kiel", None, "city"), ("doc4", "hof", None, "time"), ("doc5", None, None, "document"),
        ("doc6", "bonn", None, "stations"),
    }


def test_cities_in_are_kept_or_quarantined(spark):
    docs = documents(spark, *DAMAGED)
    listed = {(f"doc{i}", c) for i, d in enumerate(DAMAGED) if isinstance(d, dict) for c in d}
    whole = ("city", "time", "stations")
    out = {(r["path"], r["city"]) for r in snapshots.quarantine_parts(docs).collect() if r["reason"] in whole}
    kept = {(r["path"], r["city_key"]) for r in station_rows(docs).select("path", "city_key").collect()}
    assert kept | out == listed and not kept & out


def test_intake_quarantines_parts_and_is_idempotent(spark, tmp_path):
    raw = tmp_path / "raw"
    raw.mkdir()
    for i, doc in enumerate(DAMAGED):
        text = doc if isinstance(doc, str) else json.dumps(doc)
        (raw / f"2021100{i + 1}_100000_cp_data_cities.json").write_text(text)
    target = str(tmp_path / "out")
    for _ in range(2):
        take_in(spark, str(raw), target, str(tmp_path / "progress"))
        assert {r["id"] for r in taken_in(spark, target)[0].collect()} == set("abcdefh")
        assert taken_in(spark, target)[0].count() == 7
        assert spark.read.parquet(f"{target}/quarantine").count() == 10


@pytest.fixture
def zones(spark):
    """Runs a function under two session zones and gives both results."""
    name = "spark.sql.session.timeZone"
    before = spark.conf.get(name)

    def run(work):
        out = []
        for zone in ("UTC", "America/New_York"):
            spark.conf.set(name, zone)
            out.append(work())
        return out

    yield run
    spark.conf.set(name, before)


def test_results_do_not_depend_on_the_session_zone(spark, zones):
    docs = documents(spark, {"koeln": city("2021-11-07 05:30:00", station(1, "a")), "bonn": city("2021-03-14T02:30:00+02:00", station(2, "b"))})

    def work():
        rows = status.cp_status(docs)
        time = F.col("timestamp")
        polled = snapshots.snapshot_time(F.lit("x/20210314_023000_cp_data_cities.json"))
        columns = [status_key(F.col("id"), time).alias("key"), *calendar_fields(time), utc_text(time).alias("t"), utc_day(time).alias("d"), F.unix_micros(time).alias("n"), F.unix_micros(polled).alias("p")]
        return sorted(map(tuple, rows.select("id", *columns).collect()))

    utc, other = zones(work)
    assert utc == other and len(utc) == 2
    assert utc[0][2:9] == (5, 7, 44, 11, 2021, 0, "2021-11-07 05:30:00.000000")
    assert utc[1][8] == "2021-03-14 00:30:00.000000"


def test_times_of_text(spark, zones):
    texts = ["2021-03-14 02:30:00", "2021-03-14T02:30:00.5Z", "2021-03-14 02:30:00+01:00", "2021-03-14", "no", None, "2021-03-14 02:30:00 Europe/Berlin"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = zones(lambda: [r[0] for r in df.select(utc_text(utc_time(F.col("t")))).collect()])
    assert got[0] == got[1] == [
        "2021-03-14 02:30:00.000000", "2021-03-14 02:30:00.500000", "2021-03-14 01:30:00.000000",
        "2021-03-14 00:00:00.000000", None, None, "2021-03-14 01:30:00.000000",
    ]


def test_latest_goes_by_name_and_subfolders_are_asked_for(spark, tmp_path):
    for folder, year, point in (("b", "2021", "old"), ("a", "2022", "new")):
        (tmp_path / folder).mkdir()
        doc = {"koeln": city(T1, station(1, point))}
        (tmp_path / folder / f"{year}0101_000000_cp_data_cities.json").write_text(json.dumps(doc))
    assert "2022" in snapshots.newest_path(spark, str(tmp_path), recursive=True)
    every = snapshots.scan_snapshots(spark, str(tmp_path), recursive=True)
    assert [r["id"] for r in status.cp_status(snapshots.latest_document(every)).collect()] == ["new"]
    assert snapshots.scan_snapshots(spark, str(tmp_path)).count() == 0
    with pytest.raises(FileNotFoundError):
        snapshots.newest_path(spark, str(tmp_path))


def test_line_breaks_survive_and_ragged_lines_fail(spark, tmp_path):
    schema = table("id int", "address string", "name string")
    rows = [(1, "Street 1\nback; yard", "a"), (2, 'say "x"\r\ny', "b"), (3, "\n", "c")]
    path = str(tmp_path / "t")
    write_table(spark.createDataFrame(rows, schema), path)
    back = read_delimited(spark, path, schema, multi_line=True)
    assert sorted(map(tuple, back.collect())) == rows
    for line in ("1;x", "1;x;y;z"):
        ragged = tmp_path / f"r{len(line)}.csv"
        ragged.write_text(f"id;address;name\n7;ok;ok\n{line}\n")
        for wanted in (schema, table("id int")):
            with pytest.raises(Exception, match="MALFORMED|FAILED_READ_FILE"):
                read_delimited(spark, str(ragged), wanted).collect()


def test_archive_gains_new_days_only(spark, tmp_path):
    raw = tmp_path / "raw"
    raw.mkdir()

    def snapshot(time, point):
        doc = {"koeln": city(f"{time[:4]}-{time[4:6]}-{time[6:8]} 10:00:00", station(1, point))}
        (raw / f"{time}_cp_data_cities.json").write_text(json.dumps(doc))

    snapshot("20211001_100000", "a")
    snapshot("20211002_100000", "b")
    path = archive_snapshots(spark, str(raw), str(tmp_path), name="all")
    first = f"{path}/snapshot_date=2021-10-01"
    written = sorted(os.listdir(first))
    snapshot("20211002_110000", "c")
    snapshot("20211003_100000", "d")
    assert archive_snapshots(spark, str(raw), str(tmp_path), name="all") == path
    assert sorted(os.listdir(first)) == written
    assert sorted(r["id"] for r in status.cp_status(read_archive(spark, path)).collect()) == list("abcd")


@pytest.mark.parametrize("folder", ["raw", "raw 1%20+é"])
def test_archive_gains_late_files(spark, tmp_path, folder):
    raw = tmp_path / folder
    raw.mkdir()

    def snapshot(time, point):
        doc = {"koeln": city(f"{time[:4]}-{time[4:6]}-{time[6:8]} 10:00:00", station(1, point))}
        (raw / f"{time}_cp_data_cities.json").write_text(json.dumps(doc))
        return raw / f"{time}_cp_data_cities.json"

    def archived():
        return sorted(r["id"] for r in status.cp_status(read_archive(spark, path)).collect())

    gone = snapshot("20211002_100000", "a")
    snapshot("20211003_100000", "b")
    snapshot("20211004_100000", "c")
    path = archive_snapshots(spark, str(raw), str(tmp_path), name="all")
    kept = {day: sorted(os.listdir(f"{path}/snapshot_date={day}")) for day in ("2021-10-02", "2021-10-03")}
    gone.unlink()  # what the archive has stays, also where the source has it no more
    snapshot("20211002_110000", "d")
    snapshot("20211001_100000", "e")
    for _ in range(2):
        archive_snapshots(spark, str(raw), str(tmp_path), name="all")
        assert archived() == list("abcde")
    assert sorted(os.listdir(f"{path}/snapshot_date=2021-10-03")) == kept["2021-10-03"]
    assert set(kept["2021-10-02"]) < set(os.listdir(f"{path}/snapshot_date=2021-10-02"))


def test_both_levels_take_one_scan_and_one_parse(spark):
    plan = status.status_rows(documents(spark, *DAMAGED))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json(") == 1 and plan.count("LogicalRDD") == 1
