"""Snapshots to rows: hand-made documents with every odd case."""

import json

import pytest
from pyspark.sql import functions as F

from voltlake.functions.nested import default_for, is_last_of_key, truthy
from voltlake.operators import flatten, master, status
from voltlake.sources import snapshots


def rows(df, *columns):
    return sorted(
        (tuple(r[c] for c in columns) for r in df.collect()), key=lambda t: [str(v) for v in t]
    )


def documents(spark, *contents):
    data = [
        (f"f{i}", c if isinstance(c, str) else json.dumps(c)) for i, c in enumerate(contents)
    ]
    return spark.createDataFrame(data, "path string, content string")


def station(id, evses=None, **more):
    return {"id": id, **({} if evses is None else {"evses": evses}), **more}


def point(id, **more):
    return {"id": id, **more}


def city(time, *stations):
    return {"timestamp": time, "data": list(stations)}


T1, T2 = "2021-10-01T10:00:00", "2021-10-01 10:00:07.5"


def test_empty_snapshot_has_no_rows(spark):
    docs = documents(spark, {}, {"koeln": city(T1)})
    cps, connectors = status.extract_status(docs)
    assert cps.count() == connectors.count() == 0
    assert master.station_master(docs).count() == 0


def test_bad_payloads_do_not_stop_the_rest(spark):
    good = {"koeln": city(T1, station(1, [point("a", status="AVAILABLE")]))}
    docs = documents(
        spark, good, json.dumps(good)[:-9], "<html>busy</html>", "[]", "", {"x": {"detail": "no"}}
    )
    assert rows(status.cp_status(docs), "id", "status") == [("a", "AVAILABLE")]
    split = {r["path"]: r["readable"] for r in snapshots.split_payloads(docs).collect()}
    assert split == {"f0": True, "f1": False, "f2": False, "f3": False, "f4": False, "f5": True}


def test_absent_key_and_null_stay_different(spark):
    points = [point("a"), point("b", parkingsensor_status=None, status="CHARGING")]
    docs = documents(spark, {"koeln": city(T1, station(1, points))})
    assert rows(status.cp_status(docs), "id", "status", "parkingsensor_status") == [
        ("a", "-", "-"), ("b", "CHARGING", None),
    ]


def test_parents_without_children_vanish(spark):
    docs = documents(
        spark,
        {
            "koeln": city(
                T1, station(1, []), station(2), station(3, None), station(4, [point("p"), None]),
                station(5, [point("q", connectors=[]), point("r", connectors=[{"id": "c"}, None])]),
            )
        },
    )
    assert rows(status.cp_status(docs), "id") == [("p",), ("q",), ("r",)]
    assert rows(status.connector_status(docs), "id", "status") == [("c", "-")]
    assert rows(master.station_master(docs), "id") == [("1",), ("2",), ("3",), ("4",), ("5",)]


def test_each_city_has_its_own_time(spark):
    docs = documents(
        spark,
        {"a": city(T1, station(1, [point("p")])), "b": city(T2, station(2, [point("q")]))},
    )
    times = {r["id"]: str(r["timestamp"]) for r in status.cp_status(docs).collect()}
    assert times == {"p": "2021-10-01 10:00:00", "q": "2021-10-01 10:00:07.500000"}


def test_last_listing_of_a_station_wins(spark):
    docs = documents(
        spark,
        {
            "a": city(T1, station(1, [point("old")]), station(2, [point("x")])),
            "b": city(T2, station(1, [point("new"), point("newer")])),
        },
        {"a": city(T1, station(1, [point("other file")]))},
    )
    got = rows(flatten.point_rows(docs, ["status"]), "path", "id_cs", "id")
    assert got == [
        ("f0", "1", "new"), ("f0", "1", "newer"), ("f0", "2", "x"), ("f1", "1", "other file"),
    ]
    # The last listing's time comes along, and nothing is multiplied.
    times = {r["id"]: str(r["timestamp"]) for r in status.cp_status(docs).collect()}
    assert times["new"] == "2021-10-01 10:00:07.500000"


def test_last_listing_without_children_hides_the_first(spark):
    docs = documents(spark, {"a": city(T1, station(1, [point("p")]), station(1, []))})
    assert status.cp_status(docs).count() == 0


def test_connectors_hang_on_the_last_point(spark):
    twice = [
        point("p", connectors=[{"id": "c1"}]),
        point("p", connectors=[{"id": "c2", "status": "RESERVED"}]),
    ]
    docs = documents(spark, {"a": city(T1, station(1, twice))})
    assert status.cp_status(docs).count() == 2
    assert rows(status.connector_status(docs), "id", "status") == [("c2", "RESERVED")]


def test_status_table_gives_both_series(spark):
    mixed = [
        point("p", status="A", connectors=[{"id": "c1"}, None]),
        point("q", parkingsensor_status=None),
        point("p", status=None, connectors=[{"id": "c2", "status": "RESERVED"}, {"status": None}]),
    ]
    docs = documents(
        spark, {"a": city(T1, station(1, mixed)), "b": city(T2, station(2, [point("r", connectors=[])]))},
        {"a": city(T1, station(1, [point("p", connectors=[{"id": "c3"}])]))}, {}, "<html>",
    )
    points, connectors = status.split_status(status.status_table(docs))
    columns = ("id", "status", "parkingsensor_status", "timestamp")
    assert rows(points, *columns) == rows(status.cp_status(docs), *columns)
    columns = ("id", "status", "timestamp")
    assert rows(connectors, *columns) == rows(status.connector_status(docs), *columns)
    assert rows(connectors, "id", "status") == [("-", None), ("c2", "RESERVED"), ("c3", "-")]


def test_is_last_of_key_equals_brute_force(spark):
    cases = [[], ["a"], ["a", "a"], ["a", "b", "a", "c", "b"], [None, "x", None], list("abcabcddd")]
    df = spark.createDataFrame([(i, c) for i, c in enumerate(cases)], "i int, k array<string>")
    got = {r["i"]: r["f"] for r in df.select("i", is_last_of_key(F.col("k")).alias("f")).collect()}
    for i, keys in enumerate(cases):
        assert got[i] == [k not in keys[j + 1 :] for j, k in enumerate(keys)]


def test_document_and_table_form_agree(spark):
    listing = [(0, 1, "a"), (1, 2, "b"), (2, 1, "c"), (3, 3, "d"), (4, 2, "e")]
    docs = documents(spark, {"x": city(T1, *[station(s, [point(p)]) for _, s, p in listing])})
    table = spark.createDataFrame(listing, "pos int, id int, child string")
    kept = flatten.keep_last_parent(table, ["id"], F.col("pos"))
    assert rows(flatten.point_rows(docs, ["status"]), "id") == rows(kept.select(F.col("child").alias("id")), "id")


def test_station_master_fields(spark):
    full = station(
        7, [], name="N", coordinates={"latitude": "50.5", "longitude": 7},
        operator={"name": "Op"}, opening_times={"twentyfourseven": True, "regular_hours": [1]},
    )
    bare = station(8, [], operator={"name": None, "hotline": "1"}, coordinates={}, opening_times={})
    docs = documents(spark, {"a": city(T1, full, bare)})
    got = rows(
        master.station_master(docs), "id", "name", "latitude", "longitude", "operator_name",
        "operator_hotline", "open_24_7",
    )
    assert got == [
        ("7", "N", 50.5, 7.0, "Op", "-", True), ("8", None, None, None, None, "1", False),
    ]
    nested = master.station_master(docs, flatten=False)
    assert {"opening_times_expanded", "directions", "evses"} <= set(nested.columns)
    assert rows(nested, "id", "opening_times_expanded") == [("7", "[1]"), ("8", "-")]


def test_master_flags(spark):
    docs = documents(
        spark, {"a": city(T1, station(1, [point("p", status="S", connectors=[{"id": "c"}])]))}
    )
    _, points, connectors = master.master_data(docs, flatten=False, drop_status=False)
    assert rows(points, "id_cs", "id", "status", "connectors", "capabilities") == [
        ("1", "p", "S", '[{"id":"c"}]', "-")
    ]
    assert rows(connectors, "id_cp", "id", "status") == [("p", "c", "-")]


def test_return_type_is_checked(spark):
    docs = documents(spark, {})
    assert status.extract_status(docs, "status_cps").columns[:2] == ["id", "status"]
    assert "parkingsensor_status" not in status.extract_status(docs, "status_connectors").columns
    with pytest.raises(ValueError):
        status.extract_status(docs, "neither")


def test_truthiness(spark):
    """By the value's kind: any text but the empty one is true, also ``false`` and ``0``."""
    cases = {
        "true": True, "false": False, "0": False, "0.0": False, "-1": True, "0.5": True,
        '""': False, '"false"': True, '"0"': True, '" "': True, "null": False,
        "[]": False, "[0]": True, "{}": False, '{"a":0}': True, None: False,
    }
    df = spark.createDataFrame([(c,) for c in cases], "t string")
    got = [r[0] for r in df.select(truthy(F.parse_json("t"))).collect()]
    assert got == list(cases.values())


def test_spread_records(spark):
    df = spark.createDataFrame(
        [(1, {"a": "x", "status": "s"}), (2, {"b": None, "a": "y"})], "id int, r map<string,string>"
    )
    assert flatten.discover_keys(df, "r") == ["a", "b", "status"]
    spread = flatten.spread_records(df, "r")
    assert spread.columns == ["id", "a", "b"]
    assert rows(spread, "id", "a", "b") == [(1, "x", "-"), (2, "y", None)]
    kept = flatten.spread_records(df, "r", drop_record=False, drop_status=False)
    assert kept.columns == ["id", "r", "a", "b", "status"]
    assert flatten.spread_records(df, "r", columns=["b"]).columns == ["b"]
    with pytest.raises(KeyError):
        flatten.spread_records(df, "r", fill={"a": "-"})
    assert default_for("a", {"a": "0"}) == "0"


def test_explode_then_nest_is_identity(spark):
    flat = [(c, s, f"p{s}-{k}", "OK") for c in "ab" for s in (1, 2) for k in range(3)]
    flat = [(c, s + 10 * (c == "b"), p + c, v) for c, s, p, v in flat]
    nested = {}
    for c, s, p, v in flat:
        listed = nested.setdefault(c, {}).setdefault(s, [])
        listed.append(point(p, status=v))
    docs = documents(
        spark, {c: city(T1, *[station(s, e) for s, e in by.items()]) for c, by in nested.items()}
    )
    got = rows(
        flatten.point_rows(docs, ["status"]).select("id_cs", "id", F.col("point.status").cast("string").alias("status")),
        "id_cs", "id", "status",
    )
    assert got == sorted((str(s), p, v) for _, s, p, v in flat)


def test_texts_are_parsed_once(spark):
    """The plan must not parse a document a second time for a derived filter."""
    docs = documents(spark, {})
    flat = [status.cp_status(docs), status.connector_status(docs), status.status_table(docs)]
    for df in (*flat, *master.master_data(docs)):
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("from_json(") == 1
        assert "Exchange" not in df._jdf.queryExecution().executedPlan().toString()


def test_scan_files_and_latest(spark, tmp_path):
    for name, p in (("20211001_100000", "old"), ("20211001_101000", "new")):
        doc = {"koeln": city(T1, station(1, [point(p)]))}
        (tmp_path / f"{name}_cp_data_cities.json").write_text(json.dumps(doc, indent=1))
    (tmp_path / "notes.txt").write_text("no snapshot")
    every = snapshots.scan_snapshots(spark, str(tmp_path))
    assert rows(status.cp_status(every), "id") == [("new",), ("old",)]
    latest = snapshots.latest_snapshot(spark, str(tmp_path))
    assert rows(status.cp_status(latest), "id") == [("new",)]
    assert rows(status.cp_status(snapshots.latest_document(every)), "id") == [("new",)]
    names = every.select(
        snapshots.snapshot_name(F.col("path")).alias("n"),
        snapshots.snapshot_time(F.col("path")).cast("string").alias("t"),
    )
    assert ("20211001_101000_cp_data_cities", "2021-10-01 10:10:00") in rows(names, "n", "t")
    with pytest.raises(FileNotFoundError):
        snapshots.latest_snapshot(spark, str(tmp_path), "*.none")


def test_station_columns(spark):
    docs = documents(spark, {"koeln": city(T1, station(1, [point("a")]), {"id": 2, "name": "x"})})
    assert flatten.station_columns(docs).columns == ["path", "id", "timestamp", "evses"]
    every = flatten.station_columns(docs, None)
    assert every.columns[-1] == "timestamp" and {"id", "evses", "name"} <= set(every.columns)
    assert rows(flatten.station_columns(docs, ["id", "name"]), "id", "name") == [("1", None), ("2", "x")]
