"""Publication by one manifest, growing facts, the ledger of the intake, look-ups by id."""

import datetime as dt
import json
import shutil
import threading

import pytest
from pyspark.sql import functions as F

from test_warehouse import SPECS, sources
from voltlake.operators.quality import QualityError, QualityRule
from voltlake.operators.utilization import of_id
from voltlake.plans import jobs, manifest, warehouse
from voltlake.schemas import MAIN, table
from voltlake.streaming import intake


def contents(tables):
    return {n: sorted(map(str, df.collect())) for n, df in tables.items()}


def spec(name, columns="k int, v string", **options):
    fields = table(*columns.split(", "))
    return warehouse.TableSpec(name, fields, lambda t: t[f"raw_{name}"], **options)


def rows(spark, pairs):
    return spark.createDataFrame(pairs, "k int, v string")


def test_a_load_that_fails_late_publishes_nothing(spark, tmp_path):
    database = "pub_late"
    load = lambda s, **o: warehouse.load_warehouse(spark, database, s, SPECS, str(tmp_path / "wh"), **o)
    load(sources(spark))
    main = [s for s in SPECS if s.stored]
    before = contents(warehouse.open_warehouse(spark, database, main))
    listed = sorted(t.name for t in spark.catalog.listTables(database))
    sixth = sources(spark)
    first = sixth["raw_staging_status_cp"]
    column = "ts" if "ts" in first.columns else "timestamp"
    sixth["raw_staging_status_cp"] = first.unionByName(first.withColumn(column, F.col(column) + F.expr("interval 1 day")))
    sixth["staging_poi"] = sixth["staging_poi"].withColumn("longitude", F.lit(None).cast("double"))
    for options in ({}, {"extend": True}, {"extend": True, "side_by_side": 3}):
        with pytest.raises(Exception, match="longitude is null"):
            load(sixth, **options)
        assert contents(warehouse.open_warehouse(spark, database, main)) == before
        assert sorted(t.name for t in spark.catalog.listTables(database)) == listed
    assert spark.table(f"{database}.status_chargingpoints").count() == 1


def test_a_load_that_dies_before_the_manifest_repeats_nothing(spark, tmp_path, monkeypatch):
    database, place = "pub_dies", str(tmp_path / "wh")
    grown = spec("facts", grows=True, key=("k",))
    load = lambda pairs: warehouse.load_warehouse(spark, database, {"raw_facts": rows(spark, pairs)}, [grown], place, extend=True)
    load([(1, "a")])

    class Killed(BaseException):
        """Not an error that the load could tidy up after."""

    def dies(*_):
        raise Killed

    monkeypatch.setattr(warehouse, "publish", dies)
    with pytest.raises(Killed):
        load([(1, "a"), (2, "b")])
    monkeypatch.undo()
    assert spark.table(f"{database}.facts").count() == 1
    assert load([(1, "a"), (2, "b")])["facts"].count() == spark.table(f"{database}.facts").count() == 2
    assert len(manifest.vacuum(spark, database)) == 1 and manifest.vacuum(spark, database) == []
    assert warehouse.open_warehouse(spark, database, [grown])["facts"].count() == 2


def test_two_loads_from_one_manifest_cannot_both_publish(spark, tmp_path):
    database = "pub_race"
    warehouse.load_warehouse(spark, database, {"raw_t": rows(spark, [(1, "a")])}, [spec("t")], str(tmp_path / "wh"))
    stale = manifest.Manifest(0, {}, {})
    with pytest.raises(Exception, match="(?i)already exists"):
        manifest.publish(spark, database, stale.successor({"t": ["x"]}, {}))


def test_readers_keep_the_load_they_opened(spark, tmp_path):
    database = "pub_readers"
    load = lambda v, **o: warehouse.load_warehouse(spark, database, {"raw_t": rows(spark, [(1, v)]), "raw_u": rows(spark, [(1, v)])}, [spec("t"), spec("u")], str(tmp_path / "wh"), **o)
    load("old")
    opened = warehouse.open_warehouse(spark, database, [spec("t"), spec("u")])
    load("new")
    assert {df.first()["v"] for df in opened.values()} == {"old"}
    assert {df.first()["v"] for df in warehouse.open_warehouse(spark, database, [spec("t"), spec("u")]).values()} == {"new"}
    assert warehouse.open_warehouse(spark, database, [spec("t")], number=1)["t"].first()["v"] == "old"
    load("newer")
    assert manifest.numbers(spark, database) == [2, 3]


def test_repeated_keys_stop_a_growing_load(spark, tmp_path):
    database = "pub_keys"
    grown = spec("facts", grows=True, key=("k",))
    load = lambda pairs, **o: warehouse.load_warehouse(
        spark, database, {"raw_facts": rows(spark, pairs)}, [grown], str(tmp_path / "wh"), extend=True, check_keys=True, **o
    )
    load([(1, "a")])
    with pytest.raises(QualityError, match="more than once"):
        load([(2, "b"), (2, "c")])
    assert load([(1, "a"), (2, "b")])["facts"].count() == 2


def test_tables_without_rules_grow(spark, tmp_path):
    grown = spec("plain", grows=True, key=("k",))
    for pairs, n in (([(1, "a")], 1), ([(1, "a"), (2, "b")], 2)):
        loaded = warehouse.load_warehouse(
            spark, "pub_plain", {"raw_plain": rows(spark, pairs)}, [grown], str(tmp_path / "wh"), extend=True
        )
        assert loaded["plain"].count() == n


def test_a_failed_rule_stops_a_growing_load(spark, tmp_path):
    grown = spec("ruled", grows=True, key=("k",), rules=[QualityRule("small", "k < 5")])
    load = lambda pairs: warehouse.load_warehouse(spark, "pub_ruled", {"raw_ruled": rows(spark, pairs)}, [grown], str(tmp_path / "wh"), extend=True)
    load([(1, "a")])
    with pytest.raises(QualityError, match="small"):
        load([(2, "b"), (7, "c")])
    assert spark.table("pub_ruled.ruled").count() == 1


def test_names_that_begin_alike_are_tables_of_their_own(spark, tmp_path):
    database, place = "pub_alike", str(tmp_path / "wh")
    both = [spec("poi__old"), spec("poi")]
    raw = {"raw_poi": rows(spark, [(1, "new")]), "raw_poi__old": rows(spark, [(1, "old")])}
    warehouse.load_warehouse(spark, database, raw, both, place)
    for _ in range(3):
        warehouse.load_warehouse(spark, database, raw, both[1:], place)
    assert manifest.vacuum(spark, database) == []
    assert spark.table(f"{database}.poi__old").first()["v"] == "old"
    assert spark.table(f"{database}.poi").first()["v"] == "new"


def test_many_small_parts_are_merged(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(warehouse, "MOST_PARTS", 3)
    grown = spec("facts", grows=True, key=("k",))
    for n in range(1, 7):
        pairs = [(k, "v") for k in range(n)]
        loaded = warehouse.load_warehouse(spark, "pub_parts", {"raw_facts": rows(spark, pairs)}, [grown], str(tmp_path / "wh"), extend=True)
        assert loaded["facts"].count() == spark.table("pub_parts.facts").count() == n
        assert len(manifest.read_manifest(spark, "pub_parts").parts["facts"]) <= 3


def test_a_later_load_adds_a_column(spark, tmp_path):
    database, place = "pub_wider", str(tmp_path / "wh")
    narrow = spec("facts", grows=True, key=("k",))
    wide = spec("facts", "k int, v string, w int", grows=True, key=("k",))
    warehouse.load_warehouse(spark, database, {"raw_facts": rows(spark, [(1, "a")])}, [narrow], place, extend=True)
    more = spark.createDataFrame([(1, "a", 5), (2, "b", 6)], "k int, v string, w int")
    loaded = warehouse.load_warehouse(spark, database, {"raw_facts": more}, [wide], place, extend=True)
    expected = [(1, "a", None), (2, "b", 6)]
    assert sorted(map(tuple, loaded["facts"].collect())) == expected
    assert sorted(map(tuple, spark.table(f"{database}.facts").collect())) == expected
    again = warehouse.load_warehouse(spark, database, {"raw_facts": more}, [wide], place, extend=True)
    assert again["facts"].count() == 2


def fact_rows(days, ids):
    return [
        (f"{d}-{i}", f"p{i:05d}", dt.datetime(2021, 10, d, 12, 0, 0), "AVAILABLE", None) for d in days for i in ids(d)
    ]


def loaded_facts(spark, tmp_path, data, name, find_by):
    base = next(s for s in SPECS if s.name == "status_chargingpoints")
    facts = warehouse.TableSpec(
        base.name, base.schema, lambda t: t["rows"], [], base.day_of, base.sort_by, base.key, find_by, grows=True
    )
    warehouse.load_warehouse(
        spark, name, {"rows": spark.createDataFrame(data, MAIN["status_chargingpoints"])}, [facts], str(tmp_path / name), extend=True
    )
    return facts


def scanned_rows(df):
    """Rows that the scan of an executed query gave."""
    execution = df._jdf.queryExecution()
    execution.executedPlan().executeCollect()
    leaves = execution.executedPlan().collectLeaves()
    return sum(leaves.apply(i).metrics().apply("numOutputRows").value() for i in range(leaves.size()))


def test_an_id_is_found_without_reading_the_days_that_lack_it(spark, tmp_path):
    """30 days of 200 ids each; one id was polled on two of them only, but lies between the others everywhere."""
    data = fact_rows(range(1, 31), lambda d: [i for i in range(201) if i != 100 or d in (7, 23)])
    read = {}
    for name, columns in (("pub_bloom", ("id_chargingpoint",)), ("pub_plainly", ())):
        loaded_facts(spark, tmp_path, data, name, columns)
        found = of_id(spark.table(f"{name}.status_chargingpoints"), "id_chargingpoint", "p00100")
        read[name] = scanned_rows(found)
        assert found.count() == 2
    assert read["pub_bloom"] * 10 <= read["pub_plainly"]
    sizes = {n: sum(f.stat().st_size for f in (tmp_path / n).rglob("*.parquet")) for n in read}
    assert sizes["pub_bloom"] < 2 * sizes["pub_plainly"]


def test_a_growing_load_reads_the_days_it_touches(spark, tmp_path):
    facts = loaded_facts(spark, tmp_path, fact_rows(range(1, 11), lambda d: range(3)), "pub_days", ())
    known = manifest.read_parts(spark, "pub_days", manifest.read_manifest(spark, "pub_days").parts[facts.name])
    batch = spark.createDataFrame(fact_rows([4, 5], lambda d: range(2, 4)), MAIN["status_chargingpoints"])
    touched = warehouse.touched_days(known, batch.withColumn(warehouse.DAY, F.to_date("query_time")), facts)
    assert scanned_rows(touched.select("id_status_cp")) == 6
    grown = loaded_facts(spark, tmp_path, fact_rows([4, 5], lambda d: range(2, 4)), "pub_days", ())
    assert warehouse.open_warehouse(spark, "pub_days", [grown])[grown.name].count() == 32


# ---- intake ------------------------------------------------------------------------------


def snapshot(hour, status="CHARGING", connectors=True):
    point = {"id": "p1", "uid": 1, "status": status}
    if connectors:
        point["connectors"] = [{"id": "c1", "status": status}]
    station = {"id": 7, "name": "N", "evses": [point]}
    return json.dumps({"bonn": {"timestamp": f"2021-10-01T{hour:02d}:00:00Z", "data": [station]}})


def poll(folder, hour, **options):
    folder.mkdir(exist_ok=True)
    (folder / f"20211001_{hour:02d}0000_cp_data_cities.json").write_text(snapshot(hour, **options))


def test_loads_take_new_batches_only(spark, tmp_path, monkeypatch):
    files, taken, place = tmp_path / "files", str(tmp_path / "taken"), str(tmp_path / "wh")
    run = lambda: intake.take_in(spark, str(files), taken, str(tmp_path / "progress"), files_per_trigger=1)
    load = lambda: jobs.load_intake(spark, "pub_intake", taken, location=place)
    assert load() == {}
    for hour in (8, 9):
        poll(files, hour)
    run()
    assert load()["status_chargingpoints"].count() == 2
    poll(files, 10, connectors=False)
    run()
    seen = []
    monkeypatch.setattr(jobs, "taken_in", lambda *a: seen.append(intake.status_taken_in(*a).inputFiles()) or intake.taken_in(*a))
    tables = load()
    assert seen and all("/batch=2/" in f for f in seen[0]) and len(seen) == 1
    assert tables["status_chargingpoints"].count() == tables["time"].count() == 3
    assert tables["status_connectors"].count() == 2
    number = manifest.read_manifest(spark, "pub_intake").number
    assert load()["status_chargingpoints"].count() == 3 and len(seen) == 1
    assert manifest.read_manifest(spark, "pub_intake").number == number
    assert manifest.read_manifest(spark, "pub_intake").marks == {taken: 2}


def test_rows_and_mark_take_effect_together(spark, tmp_path, monkeypatch):
    files, taken, place = tmp_path / "files", str(tmp_path / "taken"), str(tmp_path / "wh")
    poll(files, 8)
    intake.take_in(spark, str(files), taken, str(tmp_path / "progress"))
    load = lambda: jobs.load_intake(spark, "pub_mark", taken, location=place)

    def dies(*_):
        raise KeyboardInterrupt

    monkeypatch.setattr(warehouse, "publish", dies)
    with pytest.raises(KeyboardInterrupt):
        load()
    monkeypatch.undo()
    assert manifest.read_manifest(spark, "pub_mark").marks == {}
    assert load()["status_chargingpoints"].count() == 1


def test_merged_batches_keep_their_rows(spark, tmp_path):
    files, taken = tmp_path / "files", str(tmp_path / "taken")
    run = lambda: intake.take_in(spark, str(files), taken, str(tmp_path / "progress"), files_per_trigger=1)
    read = lambda: [sorted(map(str, df.collect())) for df in intake.taken_in(spark, taken)]
    for hour in range(6):
        poll(files, hour)
    run()
    before = read()
    intake.compact_intake(spark, taken, upto=3)
    assert read() == before and intake.batches_of(spark, taken) == [4, 5]
    assert intake.consumable(spark, taken) == list(range(6))
    # Ended before its segment was complete: the batches still count.
    intake.compact_intake(spark, taken, upto=5)
    segment = tmp_path / "taken" / "segments" / "first=4_last=5"
    for n in (4, 5):
        day = next(segment.glob("query_date=*"))
        shutil.copytree(day, tmp_path / "taken" / "status" / f"batch={n}" / day.name)
        (tmp_path / "taken" / "status" / f"batch={n}" / "_SUCCESS").touch()
    (segment / "_SUCCESS").unlink()
    assert len(read()[0]) == 8  # both copies hold both batches' rows
    shutil.rmtree(tmp_path / "taken" / "status" / "batch=5")
    (tmp_path / "taken" / "status" / "batch=5").mkdir()
    (tmp_path / "taken" / "status" / "batch=5" / "_SUCCESS").touch()
    assert read() == before
    intake.compact_intake(spark, taken, upto=5)
    assert read() == before and intake.batches_of(spark, taken) == []
    # Ended between the segment and the removal of its batches: they no longer count.
    shutil.copytree(next(segment.glob("query_date=*")), tmp_path / "taken" / "status" / "batch=4" / "query_date=2021-10-01")
    (tmp_path / "taken" / "status" / "batch=4" / "_SUCCESS").touch()
    assert read() == before
    intake.compact_intake(spark, taken, upto=5)
    assert read() == before and intake.batches_of(spark, taken) == []


def test_batch_writes_both_tables_at_once(spark, tmp_path, monkeypatch):
    """Status and quarantine of a batch wait for each other here; one after the other they would never meet."""
    both = threading.Barrier(2, timeout=60)

    def meeting(function):
        def waits(files):
            both.wait()
            return function(files)

        return waits

    monkeypatch.setattr(intake, "status_table", meeting(intake.status_table))
    monkeypatch.setattr(intake, "quarantine_parts", meeting(intake.quarantine_parts))
    text = '{"a":{"timestamp":"2024-01-01 00:00:00","data":[{"id":"1","evses":[{"id":"P","status":"AVAILABLE"}]}]},"b":5}'
    files = spark.createDataFrame([("20240101_000000_cp_data_cities", text)], "path string, content string")
    intake.write_batch(files, 0, str(tmp_path))
    assert [r["id"] for r in intake.status_taken_in(spark, str(tmp_path)).collect()] == ["P"]
    assert [r["city"] for r in spark.read.parquet(f"{tmp_path}/quarantine/batch=0").collect()] == ["b"]
