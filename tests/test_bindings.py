"""The derived snapshots: what is shuffled to build them, and by how many tasks."""

import datetime
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from voltlake.functions.times import utc_instant
from voltlake.plans import bindings
from voltlake.plans.bindings import Inputs


@pytest.fixture(scope="module")
def inputs(spark, tmp_path_factory):
    """5,000 events of five snapshots, 7 suppliers of which one is listed twice."""
    folder = tmp_path_factory.mktemp("tables")
    start = datetime.datetime(2024, 1, 1)
    events = [
        (n, start + datetime.timedelta(seconds=n), n % 40, ("view", "error", "signup")[n % 3], 1.0, f'{{"k": {n % 9}}}')
        for n in range(5000)
    ]
    suppliers = [(n, f"S{n}", n % 2, 1.5) for n in [0, 1, 2, 3, 4, 5, 5]]
    tables = {
        "events": (events, "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"),
        "supplier": (suppliers, "s_suppkey long, s_name string, s_nationkey int, s_acctbal double"),
        "nation": ([(0, "A"), (1, "B")], "n_nationkey int, n_name string"),
    }
    for name, (rows, schema) in tables.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{folder}/{name}.parquet")
    return Inputs(spark, str(folder))


def test_no_text_is_shuffled(inputs, monkeypatch):
    """Events are dealt by snapshot once, before they become text, over tasks that grow with them."""
    monkeypatch.setattr(bindings, "EVENTS_PER_SNAPSHOT", 100)
    monkeypatch.setattr(bindings, "SNAPSHOTS_PER_TASK", 2)
    documents = inputs.snapshot_documents()
    execution = documents._jdf.queryExecution()
    above, below = execution.optimizedPlan().toString().split("RepartitionByExpression [snapshot_no", 1)
    assert "StructsToJson" in above and "StructsToJson" not in below
    assert "], 25" in below.splitlines()[0]
    assert execution.executedPlan().toString().count("Exchange hashpartitioning(snapshot_no") == 1


def test_documents_hold_every_event_and_listing(inputs):
    rows = {r["path"]: r["content"] for r in inputs.snapshot_documents().collect()}
    assert sorted(rows)[0] == "20240101_000000_cp_data_cities" and len(rows) == 5
    # Users are 40 and suppliers 7 by count, six by key: what falls on key 6 has no station; key 5 is listed twice.
    for n, content in enumerate(content for _, content in sorted(rows.items())):
        stations = [event % 40 % 7 for event in range(1000 * n, 1000 * n + 1000)]
        listed = sum(1 + (s == 5) for s in stations if s != 6)
        assert content.count('"uid":') == listed
        assert content.count('"evses":[') == 7


def test_pairs_are_matched_once(spark, inputs, tmp_path):
    """What a load reads of the mapping, to check and to write it, are the pairs and not their match."""
    parts = [(n, "x", "b", "t", n % 50, 1.0) for n in range(200)]
    schema = "p_partkey long, p_name string, p_brand string, p_type string, p_size int, p_retailprice double"
    spark.createDataFrame(parts, schema).write.parquet(f"{tmp_path}/part.parquet")
    own = Inputs(spark, str(tmp_path))
    own._tables = {"supplier": inputs.table("supplier"), "nation": inputs.table("nation")}
    pairs = own.warehouse_sources()["staging_mapping_poi_cs"]
    assert pairs.count() > 0
    assert "Join" not in pairs._jdf.queryExecution().optimizedPlan().toString()


def test_pois_are_prepared_once_for_match_and_loads(spark, tmp_path):
    """What the match and every load read are written POIs, not the parts' geometry computed anew."""
    spark.createDataFrame([(n, n) for n in range(40)], "p_partkey long, p_size int").write.parquet(f"{tmp_path}/part.parquet")
    spark.createDataFrame([(0, "S0", 0, 1.5)], "s_suppkey long, s_name string, s_nationkey int, s_acctbal double").write.parquet(f"{tmp_path}/supplier.parquet")
    own = Inputs(spark, str(tmp_path))
    sources = own.warehouse_sources()
    with ThreadPoolExecutor(4) as pool:
        files = {tuple(sorted(pois.inputFiles())) for pois in pool.map(lambda _: sources["staging_poi"], range(4))}
    assert len(files) == 1 and not any("part.parquet" in path for path in files.pop())
    wanted = own.planar_pois.where("poi_cat is not null").select("id_poi", "geometry", "longitude")
    found = sources["staging_poi"].select("id_poi", "geometry", "longitude")
    assert wanted.count() and not wanted.exceptAll(found).count() and not found.exceptAll(wanted).count()


def test_instant_of_a_wall_time_needs_no_text(spark):
    walls = ["2024-01-01 00:00:11.172425", "1969-12-31 23:59:59.999999", "0001-01-01 00:00:00", "2024-03-31 02:30:00.5", None]
    rows = spark.createDataFrame([(w,) for w in walls], "text string").select(F.col("text").cast("timestamp_ntz").alias("wall"), "text")
    instants = rows.select(utc_instant(F.col("wall")).alias("got"), F.concat("text", F.lit("Z")).cast("timestamp").alias("want"))
    assert instants.where("got <=> want").count() == len(walls)
    assert "string" not in instants.select("got")._jdf.queryExecution().optimizedPlan().expressions().toString()
