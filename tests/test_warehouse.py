"""Star schema, checks and utilization questions on hand-made tables."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from voltlake.functions.values import calendar_fields, status_key, two_digit_share
from voltlake.operators import quality, utilization
from voltlake.operators.master import master_data
from voltlake.operators.quality import QualityError, QualityRule
from voltlake.operators.status import extract_status
from voltlake.plans import warehouse
from voltlake.schemas import MAIN, STAGING, table

POSTAL = quality.has_length("postal", "c", 5)
POWER = quality.in_open_range("power", "c", 2, 400)


def outcome(df, *rules):
    return {r["rule"]: (r["n_rows"], r["n_passed"], r["passed"])
            for r in quality.evaluate(df, list(rules)).collect()}


def test_rules(spark):
    codes = spark.createDataFrame([("50667",), ("1234",), (None,)], "c string")
    assert outcome(codes, POSTAL) == {"postal": (3, 1, False)}
    power = spark.createDataFrame([(2,), (3,), (399,), (400,), (None,)], "c int")
    assert outcome(power, POWER) == {"power": (5, 2, False)}
    assert outcome(power.where("c in (3, 399)"), POWER) == {"power": (2, 2, True)}
    any_rule = QualityRule("any", "c = 3", "any")
    assert outcome(power, any_rule)["any"][2] is True
    with pytest.raises(ValueError):
        QualityRule("x", "true", "some")


def test_empty_table_fails_every_rule(spark):
    empty = spark.createDataFrame([], "c string")
    rules = [POSTAL, quality.not_empty("t"), QualityRule("any", "true", "any")]
    assert all(not r[2] for r in outcome(empty, *rules).values())


def test_failed_rule_names_itself(spark):
    codes = spark.createDataFrame([("1",)], "c string")
    quality.require(codes, [quality.not_empty("t")], "t")
    with pytest.raises(ValueError, match="postal"):
        quality.require(codes, [quality.not_empty("t"), POSTAL], "t")


def test_unique_null_orphan(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (2, None), (None, "c")], "k int, v string")
    got = quality.key_uniqueness(df, ["k"], "t").first()
    assert (got["n_rows"], got["n_keys"], got["n_repeated_keys"]) == (4, 3, 1)
    with pytest.raises(QualityError):
        quality.require_unique(df, ["k"], "t")
    assert quality.require_unique(df, ["v"], "t") is df
    nulls = quality.count_nulls(df, table("k int!", "v string"), "t").collect()
    assert [(r["column_name"], r["n_null"]) for r in nulls] == [("k", 1)]
    parent = spark.createDataFrame([(2,)], "id int")
    lost = quality.orphans(df, "k", parent, "id", {"child": "t"}).first()
    assert (lost["n_orphan_keys"], lost["n_orphan_rows"]) == (1, 2)


def test_shape_is_seen_without_another_pass(spark):
    observed, seen = quality.with_shape(spark.range(7), "shape")
    observed.write.format("noop").mode("overwrite").save()
    assert seen.get == {"rows": 7, "columns": 1}


def test_calendar(spark):
    df = spark.createDataFrame([(dt.datetime(2021, 1, 3, 23, 5),)], "t timestamp")
    got = df.select(*calendar_fields(F.col("t"))).first().asDict()
    assert got == {"hour": 23, "day": 3, "week": 53, "month": 1, "year": 2021, "weekday": 0}


def test_status_key_is_the_hash_of_id_and_time(spark):
    import hashlib

    df = spark.createDataFrame([("p1", dt.datetime(2021, 10, 1, 10, 0, 0, 5))], "i string, t timestamp")
    expected = hashlib.md5(b"p12021-10-01 10:00:00.000005").hexdigest()
    assert df.select(status_key(F.col("i"), F.col("t"))).first()[0] == expected


def test_share_rounds_half_to_even(spark):
    import numpy as np

    pairs = [(n, whole) for whole in (3, 7, 8, 40, 200, 1000) for n in range(1, whole)]
    df = spark.createDataFrame(pairs, "n bigint, t bigint")
    got = [r[0] for r in df.select(two_digit_share(F.col("n"), F.col("t"))).collect()]
    assert got == [float(np.round(n / t * 100) / 100) for n, t in pairs]


FACTS = [
    ("p1", "2021-10-01 10:00:00", "AVAILABLE"), ("p1", "2021-10-01 10:10:00", "CHARGING"),
    ("p1", "2021-10-02 10:00:00", "CHARGING"), ("p2", "2021-10-02 10:00:00", "BROKEN"),
    ("p2", "2021-10-02 10:10:00", None),
]


def facts(spark):
    return spark.createDataFrame(
        FACTS, "id_chargingpoint string, query_time string, status_cp string"
    ).withColumn("query_time", F.col("query_time").cast("timestamp"))


def test_series_and_share(spark):
    series = utilization.point_series(facts(spark), "p1")
    assert sorted(r["status_num"] for r in series.collect()) == [0.0, 1.0, 1.0]
    both = {(r["id_chargingpoint"], r["status"]): r["status_num"]
            for r in utilization.point_series(facts(spark)).collect()}
    assert both[("p2", "BROKEN")] is None and both[("p2", None)] is None
    shares = utilization.most_frequent_first(
        utilization.status_share(facts(spark), "id_chargingpoint", "status_cp"), "id_chargingpoint"
    )
    assert [tuple(r) for r in shares.collect()] == [
        ("p1", "CHARGING", 2, 0.67), ("p1", "AVAILABLE", 1, 0.33), ("p2", "BROKEN", 1, 1.0),
    ]


def test_single_station(spark):
    stations = spark.createDataFrame(
        [(1, "Op", "Street 1", "50667", "Bonn", 50.0, 7.0), (2, "Op", "Street 2", "1", "Hof", 1.0, 2.0)],
        "id_cs int, operator_name string, address string, postal_code string, city string, "
        "latitude double, longitude double",
    )
    assert utilization.station_header(stations, 2).first()["city"] == "Hof"
    assert utilization.station_positions(stations, 1).count() == 1
    connectors = spark.createDataFrame([("c", "p"), ("d", "q")], "id_connector string, id_cp string")
    assert utilization.connectors_of_point(connectors, "q").first()["id_connector"] == "d"


DOCUMENT = """{"bonn": {"timestamp": "2021-10-01T10:00:00Z", "data": [
 {"id": 7, "name": "N", "postal_code": " 53111 ", "coordinates": {"latitude": 50.7, "longitude": 7.1},
  "operator": {"name": "Op"}, "opening_times": {"twentyfourseven": true}, "roaming": true,
  "evses": [{"id": "p1", "uid": 1, "status": "CHARGING", "connectors":
    [{"id": "c1", "status": "CHARGING", "max_power": %s, "ampere": null}]}]}]}}"""


def sources(spark, power=22):
    docs = spark.createDataFrame([("f", DOCUMENT % power)], "path string, content string")
    raw = warehouse.staging_from_documents(master_data(docs), extract_status(docs))
    poi = spark.createDataFrame(
        [("node/1", "fuel", 7.1, 50.7, [[[(1.0, 2.0)]]])],
        table("id_poi string", "poi_cat string", "longitude double", "latitude double", "geometry geometry"),
    )
    mapping = spark.createDataFrame([("node/1", 7)], MAIN["mapping_poi_cs"])
    return raw | {"staging_poi": poi, "staging_mapping_poi_cs": mapping}


SPECS = warehouse.STAGING_SPECS + warehouse.MAIN_SPECS


def test_lazy_star_schema(spark):
    tables = warehouse.build_tables(sources(spark), SPECS)
    assert list(tables) == [*STAGING, *MAIN]
    for name, df in tables.items():
        declared = {**STAGING, **MAIN}[name]
        assert df.dtypes == [(f.name, f.dataType.simpleString()) for f in declared]
        assert df.count() == 1
    assert tables["charging_station"].first()["postal_code"] == "53111"
    connector = tables["connector"].first()
    assert (connector["max_power"], connector["ampere"], connector["voltage"]) == (22, None, None)


def test_load_publishes_checked_tables(spark, tmp_path):
    database = "wh_load"
    loaded = warehouse.load_warehouse(spark, database, sources(spark), SPECS, str(tmp_path / "wh"))
    assert {n: df.count() for n, df in loaded.items()} == {n: 1 for n in [*STAGING, *MAIN]}
    # A failed check leaves what was published, and no half-made version behind.
    with pytest.raises(QualityError, match="power_limits"):
        warehouse.load_warehouse(spark, database, sources(spark, power=400), SPECS)
    assert spark.table(f"{database}.connector").first()["max_power"] == 22
    # A good refresh replaces the rows; the version before stays for one more load.
    for _ in range(2):
        warehouse.load_warehouse(spark, database, sources(spark, power=50), SPECS, check_keys=True)
    assert spark.table(f"{database}.connector").first()["max_power"] == 50
    names = [t.name for t in spark.catalog.listTables(database) if t.name.startswith("connector__")]
    assert len(names) == 2


def test_null_in_a_not_null_column_stops_the_load(spark, tmp_path):
    database = "wh_null"
    warehouse.load_warehouse(spark, database, sources(spark), SPECS, str(tmp_path / "wh"))
    broken = sources(spark)
    broken["staging_mapping_poi_cs"] = spark.createDataFrame([("node/1", None)], "id_poi string, id_cs int")
    with pytest.raises(Exception, match="mapping_poi_cs.id_cs is null"):
        warehouse.load_warehouse(spark, database, broken, SPECS)
    assert spark.table(f"{database}.mapping_poi_cs").first()["id_cs"] == 7


def test_jobs_from_files_to_tables(spark, tmp_path):
    from voltlake.plans import jobs

    raw = tmp_path / "raw"
    raw.mkdir()
    for hour, power in (("10", 400), ("11", 22)):
        (raw / f"20211001_{hour}0000_cp_data_cities.json").write_text(DOCUMENT % power)
    base = str(tmp_path)
    flat = jobs.process_snapshots(spark, str(raw), f"{base}/flat", archive=f"{base}/archive")
    assert (tmp_path / "archive" / "archive_cp_data_cities_20211001_110000").is_dir()
    features = spark.createDataFrame(
        [("node", 1, "fuel", None, "point", [[[(7.1, 50.7)]]], "Bonn"),
         ("node", 2, "bench", None, "point", [[[(7.1, 50.7)]]], "Bonn")],
        "element_type string, osmid bigint, amenity string, shop string, geom_type string, "
        "geometry array<array<array<struct<x:double,y:double>>>>, city string",
    )
    jobs.prepare_poi_files(features, f"{base}/poi")
    jobs.match_files(spark, flat["staging_charging_stations"], f"{base}/poi", f"{base}/map")
    tables = jobs.load_files(
        spark, "wh_jobs", flat, f"{base}/poi", f"{base}/map", location=f"{base}/tables"
    )
    counts = {name: df.count() for name, df in tables.items()}
    # Both snapshots carry the same city time, the status rows stay two.
    assert counts["status_chargingpoints"] == counts["status_connectors"] == 2
    assert all(n == 1 for name, n in counts.items() if "status" not in name)
    assert tables["mapping_poi_cs"].first().asDict() == {"id_poi": "node/1", "id_cs": 7}
    assert tables["connector"].first()["max_power"] == 22  # of the last snapshot
    with pytest.raises(QualityError):
        jobs.prepare_poi_files(features.union(features), f"{base}/poi2")
    again = features.union(features.withColumn("city", F.lit("Koeln")))
    jobs.prepare_poi_files(again, f"{base}/poi3")  # two cities may share a POI


def test_reads_by_time_skip_days(spark, tmp_path):
    rows = [(f"k{d}{h}", f"p{h}", dt.datetime(2021, 10, d, h), "AVAILABLE", None)
            for d in range(1, 6) for h in range(4)]
    df = spark.createDataFrame(rows, MAIN["status_chargingpoints"])
    spec = next(s for s in SPECS if s.name == "status_chargingpoints")
    spec = warehouse.TableSpec(
        spec.name, spec.schema, lambda t: t["rows"], spec.rules, spec.day_of, spec.sort_by
    )
    warehouse.load_warehouse(spark, "wh_days", {"rows": df}, [spec], str(tmp_path / "days"))
    name = "wh_days.status_chargingpoints"
    part = warehouse.facts_between(spark, name, "2021-10-02 01:00:00", "2021-10-03 00:00:00")
    assert sorted(r["id_status_cp"] for r in part.collect()) == ["k21", "k22", "k23"]
    plan = part._jdf.queryExecution().executedPlan().toString()
    filters = plan[plan.index("PartitionFilters"):]
    assert "query_date" in filters[: filters.index("]")]
    one = utilization.point_series(spark.table(name), "p1")
    assert "EqualTo(id_chargingpoint,p1)" in one._jdf.queryExecution().executedPlan().toString()


def test_staging_from_files(spark, tmp_path):
    from voltlake.sinks.files import write_table

    docs = spark.createDataFrame([("f", DOCUMENT % 22)], "path string, content string")
    stations, points, connectors = master_data(docs)
    cps, conns = extract_status(docs)
    paths = {}
    for name, df in {
        "staging_charging_stations": stations, "staging_charging_points": points,
        "staging_connectors": connectors, "staging_status_cp": cps,
        "staging_status_connectors": conns,
    }.items():
        paths[name] = str(tmp_path / name)
        write_table(df, paths[name])
    from_files = warehouse.staging_from_files(spark, paths)
    direct = warehouse.staging_from_documents((stations, points, connectors), (cps, conns))
    assert set(from_files) == set(direct)
    for name in direct:
        assert from_files[name].schema.simpleString() == direct[name].schema.simpleString()
    assert [tuple(r) for r in from_files["raw_staging_status_cp"].collect()] == [
        tuple(r) for r in direct["raw_staging_status_cp"].collect()
    ]


def test_own_table_is_one_more_spec(spark):
    extra = warehouse.TableSpec(
        "stations_per_city", table("city string", "n int"),
        lambda t: t["charging_station"].groupBy("city").agg(F.count("*").alias("n")),
        [QualityRule("some", "n > 0")],
    )
    tables = warehouse.build_tables(sources(spark), [*SPECS, extra])
    assert tables["stations_per_city"].first()["n"] == 1


def test_parameters_are_bound_not_pasted(spark):
    spark.createDataFrame([("a'b", 1)], "k string, v int").createOrReplaceTempView("params_t")
    got = warehouse.run_sql(
        spark, "select v from IDENTIFIER(:t) where k = :k", {"t": "params_t"}, k="a'b"
    )
    assert got.first()["v"] == 1


def test_facts_grow_and_odd_names_work(spark, tmp_path):
    """A second load adds new keys only, a repeated one nothing; dimensions are replaced."""
    database, place = "wh_odd", str(tmp_path / "it's here")
    first = sources(spark)
    more = dict(first)
    column = "ts" if "ts" in first["raw_staging_status_cp"].columns else "timestamp"
    later = first["raw_staging_status_cp"].withColumn(column, F.col(column) + F.expr("interval 1 day"))
    more["raw_staging_status_cp"] = first["raw_staging_status_cp"].unionByName(later)
    load = lambda s, **o: warehouse.load_warehouse(spark, database, s, SPECS, place, **o)
    load(first)
    files = lambda: {f for f in (tmp_path / "it's here").rglob("status_chargingpoints__*/*/*.parquet")}
    before = files()
    for _ in range(2):
        tables = load(more, extend=True, side_by_side=3)
        assert tables["status_chargingpoints"].count() == tables["time"].count() == 2
        assert tables["status_connectors"].count() == tables["connector"].count() == 1
    assert before < files()


def test_references_are_checked(spark):
    from voltlake.operators.quality import require_references

    tables = {"a": spark.range(3).toDF("x"), "b": spark.range(2).toDF("y")}
    require_references(tables, [("b", "y", "a", "x")])
    with pytest.raises(QualityError, match="a.x"):
        require_references(tables, [("a", "x", "b", "y")])


def test_parquet_files_load_like_delimited_ones(spark, tmp_path):
    from voltlake.plans import jobs

    raw = tmp_path / "raw"
    raw.mkdir()
    (raw / "20211001_100000_cp_data_cities.json").write_text(DOCUMENT % 22)
    rows = {}
    for kind in ("csv", "parquet"):
        flat = jobs.process_snapshots(spark, str(raw), str(tmp_path / kind), output_format=kind)
        staged = warehouse.staging_from_files(spark, flat, kind)
        rows[kind] = {n: sorted(map(str, df.collect())) for n, df in staged.items()}
    assert rows["csv"] == rows["parquet"]
