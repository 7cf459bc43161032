"""Registered queries: each takes (spark, sf_dir) and reads the given tables whole."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from voltlake.functions.geo import to_utm32, vertices
from voltlake.functions.times import utc_day, utc_time, utc_wall
from voltlake.functions.values import buffer_metres, poi_city_name, status_number
from voltlake.operators import flatten, history, master, polls, quality, utilization
from voltlake.operators import poi as pois
from voltlake.operators import status as status_ops
from voltlake.operators.spatial import match_pois, write_shapes
from voltlake.plans import jobs, manifest, warehouse
from voltlake.plans.bindings import SNAPSHOT_PATTERN, Inputs, city_code, inputs_of
from voltlake.runtime import scratch_path
from voltlake.schemas import MAIN, PRIMARY_KEYS, REFERENCES, STAGING, table
from voltlake.sinks.files import archive_snapshots, read_archive, write_table
from voltlake.sources import snapshots
from voltlake.sources.delimited import bind_by_name, read_delimited
from voltlake.sources.poi import read_features
from voltlake.streaming.intake import compact_intake, take_in, taken_in

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(function: Callable[[Inputs], DataFrame]) -> Callable[[Inputs], DataFrame]:
    """Registers a function of the inputs under its own name."""
    QUERIES[function.__name__] = lambda spark, sf_dir: function(inputs_of(spark, sf_dir))
    return function


def ntz(column: str) -> Column:
    """UTC wall time, the form the given tables use."""
    return utc_wall(F.col(column)).alias(column)


def with_ntz(df: DataFrame) -> DataFrame:
    return df.select(*[ntz(n) if t == "timestamp" else F.col(n) for n, t in df.dtypes])


def _row_count(df: DataFrame, table: str) -> DataFrame:
    return df.agg(F.lit(table).alias("table_name"), F.count(F.lit(1)).alias("n_rows"))


def _both_levels(points: DataFrame, connectors: DataFrame) -> DataFrame:
    both = points.withColumn("level", F.lit("point")).unionByName(
        connectors.withColumn("level", F.lit("connector")), allowMissingColumns=True
    )
    return with_ntz(both)


def snapshot() -> Column:
    return snapshots.snapshot_name(F.col("path")).alias("snapshot")


# ---- raw snapshots -----------------------------------------------------------------------


@query
def raw_snapshot_scan(i: Inputs) -> DataFrame:
    doc = F.from_json("content", "map<string,string>")
    return i.files().select(snapshot(), F.size(doc).alias("n_cities"))


@query
def snapshot_time(i: Inputs) -> DataFrame:
    time = snapshots.snapshot_time(F.col("path")).cast("timestamp_ntz")
    listed = snapshots.list_snapshots(i.spark, i.snapshot_folder(), SNAPSHOT_PATTERN, recursive=True)
    return listed.select(snapshot(), time.alias("polled_at"))


@query
def station_rows(i: Inputs) -> DataFrame:
    station = F.col("station")
    return flatten.station_rows(i.documents()).select(
        snapshot(), "city_key", station["id"].cast("int").alias("id"), station["name"].alias("name")
    )


@query
def station_columns(i: Inputs) -> DataFrame:
    rows = flatten.station_columns(i.documents(), ["id", "country", "timestamp"])
    return rows.select(snapshot(), "id", "country", ntz("timestamp"))


@query
def station_rows_ts(i: Inputs) -> DataFrame:
    return flatten.station_rows_ts(i.documents()).select(
        snapshot(), F.col("id").cast("int").alias("id"), ntz("timestamp"),
        F.size("evses").alias("n_evses"),
    )


@query
def latest_snapshot(i: Inputs) -> DataFrame:
    latest = snapshots.latest_snapshot(i.spark, i.snapshot_folder(), SNAPSHOT_PATTERN, recursive=True)
    points = master.charging_point_master(latest)
    return bind_by_name(points, STAGING["staging_charging_points"]).select("id_cs", "id", "uid")


@query
def raw_archive(i: Inputs) -> DataFrame:
    path = archive_snapshots(
        i.spark, i.snapshot_folder(), scratch_path(i.spark, "archive"), SNAPSHOT_PATTERN,
        recursive=True,
    )
    day = F.col("snapshot_date").cast("string").alias("snapshot_date")
    doc = F.from_json("content", "map<string,string>")
    return read_archive(i.spark, path).select(snapshot(), day, F.size(doc).alias("n_cities"))


@query
def quarantine(i: Inputs) -> DataFrame:
    pages = i.table("pages").select(
        F.concat(F.lit("page "), "page_id").alias("path"), F.col("html").alias("content")
    )
    answers = i.documents().select(snapshot().alias("path"), "content").unionByName(pages)
    return snapshots.split_payloads(answers).select("path", "readable")


@query
def quarantine_parts(i: Inputs) -> DataFrame:
    """Snapshots that hold a broken city, one without a time and one with odd stations."""
    odd = (
        '{"broken":5,"late":{"timestamp":"never","data":[{"id":"1"}]},'
        '"odd":{"timestamp":"2024-01-01 00:00:00","data":["x",{"id":"1","evses":"none"}]},'
    )
    damaged = F.concat(F.lit(odd), F.substring("content", F.lit(2), F.length("content")))
    answers = i.documents().select(snapshot().alias("path"), damaged.alias("content"))
    pages = i.table("pages").select(
        F.concat(F.lit("page "), "page_id").alias("path"), F.col("html").alias("content")
    )
    parts = snapshots.quarantine_parts(answers.unionByName(pages))
    return parts.select("path", "city", "station", "reason")


@query
def stream_intake(i: Inputs) -> DataFrame:
    target, checkpoint = scratch_path(i.spark, "intake"), scratch_path(i.spark, "progress")
    take_in(i.spark, i.snapshot_folder(), target, checkpoint, pattern=SNAPSHOT_PATTERN, recursive=True)
    return _both_levels(*taken_in(i.spark, target))


def _halves(i: Inputs, folder: str):
    """Writes about half of the snapshots to a folder of files, then the others."""
    documents = i.documents().withColumnRenamed("path", "snapshot")
    for half in (0, 1):
        some = documents.where(F.pmod(F.crc32(F.col("snapshot").cast("binary")), F.lit(2)) == half)
        some.write.mode("append").partitionBy("snapshot").text(folder)
        yield half


@query
def intake_load(i: Inputs) -> DataFrame:
    """Two runs of the intake, a load after each and one load more: the facts of all snapshots."""
    base = scratch_path(i.spark, "intake")
    database = "voltlake_" + base.rsplit("-", 1)[1]
    for _ in _halves(i, f"{base}/files"):
        take_in(i.spark, f"{base}/files", f"{base}/taken", f"{base}/progress", pattern=SNAPSHOT_PATTERN, recursive=True)
        tables = jobs.load_intake(i.spark, database, f"{base}/taken", location=f"{base}/tables")
    tables = jobs.load_intake(i.spark, database, f"{base}/taken", location=f"{base}/tables")
    points = tables["status_chargingpoints"].select(
        F.lit("point").alias("level"), F.col("id_chargingpoint").alias("id"), "query_time", F.col("status_cp").alias("status")
    )
    connectors = tables["status_connectors"].select(
        F.lit("connector").alias("level"), F.col("id_connector").alias("id"), "query_time", F.col("status_connector").alias("status")
    )
    return with_ntz(points.unionByName(connectors))


@query
def intake_compacted(i: Inputs) -> DataFrame:
    """The intake in many batches, merged into one segment, and some batches more."""
    base = scratch_path(i.spark, "intake")
    for half in _halves(i, f"{base}/files"):
        take_in(
            i.spark, f"{base}/files", f"{base}/taken", f"{base}/progress",
            pattern=SNAPSHOT_PATTERN, recursive=True, files_per_trigger=25,
        )
        if half == 0:
            compact_intake(i.spark, f"{base}/taken", upto=1 << 30)
    return _both_levels(*taken_in(i.spark, f"{base}/taken"))


# ---- nested records ----------------------------------------------------------------------


def _children(i: Inputs, carry: tuple[str, ...] = ()) -> DataFrame:
    return flatten.explode_children(
        flatten.station_rows_ts(i.documents()),
        index_col="id", index_new="id_cs", col_records="evses", carry=["path", *carry],
    )


@query
def explode_children(i: Inputs) -> DataFrame:
    return _children(i).select(
        snapshot(), F.col("id_cs").cast("int").alias("id_cs"),
        F.col("record")["uid"].cast("bigint").alias("uid"),
    )


@query
def dynamic_columns(i: Inputs) -> DataFrame:
    return flatten.spread_records(_children(i), "record").drop("path", "connectors")


@query
def discovered_schema(i: Inputs) -> DataFrame:
    """Keys of the points' records with the type that holds all their values."""
    return flatten.discover_schema(flatten.station_rows_ts(i.documents(), flatten.VARIANTS), "evses")


@query
def fill_missing_scalar(i: Inputs) -> DataFrame:
    return flatten.spread_records(
        _children(i), "record",
        keys=["uid", "status", "parkingsensor_status", "physical_reference"],
        columns=["uid", "parkingsensor_status", "physical_reference"],
    )


@query
def fill_missing_per_column(i: Inputs) -> DataFrame:
    fill = {
        "uid": "0", "charging_station_position": "unknown", "floor_level": "ground",
        "physical_reference": None,
    }
    return flatten.spread_records(
        _children(i), "record", keys=list(fill), fill=fill, columns=list(fill)
    )


@query
def attach_parent_ts(i: Inputs) -> DataFrame:
    return _children(i, ("timestamp",)).select(
        F.col("id_cs").cast("int").alias("id_cs"),
        F.col("record")["uid"].cast("bigint").alias("uid"), ntz("timestamp"),
    )


@query
def last_wins_parent(i: Inputs) -> DataFrame:
    points = flatten.point_rows(i.documents(split_listing=True), ["uid"])
    return points.select(
        snapshot(), F.col("id_cs").cast("int").alias("id_cs"),
        F.col("point.uid").cast("bigint").alias("uid"),
    )


@query
def last_wins_table(i: Inputs) -> DataFrame:
    events = i.table("events").select("event_id", "user_id", "event_type", "ts")
    return flatten.keep_last_parent(events, ["user_id"], F.col("event_id"))


# ---- master and status -------------------------------------------------------------------


@query
def station_master(i: Inputs) -> DataFrame:
    return bind_by_name(
        master.station_master(i.documents()), STAGING["staging_charging_stations"]
    )


@query
def charging_point_master(i: Inputs) -> DataFrame:
    return bind_by_name(
        master.charging_point_master(i.documents()), STAGING["staging_charging_points"]
    )


@query
def connector_master(i: Inputs) -> DataFrame:
    return bind_by_name(master.connector_master(i.documents()), STAGING["staging_connectors"])


@query
def cp_status(i: Inputs) -> DataFrame:
    return with_ntz(status_ops.cp_status(i.documents()))


@query
def connector_status(i: Inputs) -> DataFrame:
    return with_ntz(status_ops.connector_status(i.documents()))


@query
def status_all_snapshots(i: Inputs) -> DataFrame:
    return with_ntz(status_ops.status_rows(i.documents()))


# ---- delimited files ---------------------------------------------------------------------


def _round_trip(
    i: Inputs, df: DataFrame, schema, names: dict[str, str] | None = None, **options
) -> DataFrame:
    path = scratch_path(i.spark, "csv")
    write_table(df, path)
    return read_delimited(i.spark, path, schema, names=names, **options)


@query
def csv_scan(i: Inputs) -> DataFrame:
    return _round_trip(
        i, i.raw_charging_stations(), STAGING["staging_charging_stations"], empty_as_null=True
    )


@query
def empty_as_null(i: Inputs) -> DataFrame:
    return _round_trip(
        i, i.raw_charging_points(), STAGING["staging_charging_points"], empty_as_null=True
    )


@query
def csv_round_trip(i: Inputs) -> DataFrame:
    name = "staging_status_cp"
    flat = status_ops.cp_status(i.documents())
    return with_ntz(_round_trip(i, flat, STAGING[name], warehouse.FLAT_NAMES[name]))


@query
def text_round_trip(i: Inputs) -> DataFrame:
    """Texts with separators, quotes, line breaks and backslashes through delimited files whose lines are rows."""
    odd = F.concat("text", F.lit('\n"quoted"; \r\nlast\\n'))
    turns = i.table("conversations").select(
        F.col("conv_id").cast("int"), F.col("turn").cast("int"), "role", odd.alias("text")
    )
    path = scratch_path(i.spark, "csv")
    write_table(turns, path, escaped=True)
    schema = table("conv_id int", "turn int", "role string", "text string")
    return read_delimited(i.spark, path, schema, escaped=True)


@query
def staging_cast(i: Inputs) -> DataFrame:
    name = "staging_connectors"
    return _round_trip(i, master.connector_master(i.documents()), STAGING[name])


# ---- POIs --------------------------------------------------------------------------------


@query
def poi_tag_filter(i: Inputs) -> DataFrame:
    return pois.tag_filter(i.poi_features).select("osmid", "amenity", "shop")


@query
def poi_id(i: Inputs) -> DataFrame:
    return pois.with_poi_id(i.poi_features).select("id_poi", "osmid")


@query
def poi_category(i: Inputs) -> DataFrame:
    return pois.with_category(pois.with_poi_id(i.poi_features)).select("id_poi", "poi_cat")


@query
def poi_point(i: Inputs) -> DataFrame:
    return pois.with_position(i.poi_features).select(
        "osmid", F.round("longitude", 9).alias("longitude"),
        F.round("latitude", 9).alias("latitude"),
    )


@query
def project_utm32(i: Inputs) -> DataFrame:
    planar = i.poi_features.select("osmid", to_utm32(F.col("lon"), F.col("lat")).alias("p"))
    return planar.select("osmid", F.round("p.x", 3).alias("x"), F.round("p.y", 3).alias("y"))


@query
def poi_by_geom_type(i: Inputs) -> DataFrame:
    return i.spark.read.parquet(_write_pois(i)).select("id_poi", "poi_cat", "geom_type")


@query
def poi_scan_union(i: Inputs) -> DataFrame:
    path = _write_pois(i)
    kinds = ["point", "polygon", "multipolygon"]
    everything = read_features(i.spark, [f"{path}/geom_type={kind}" for kind in kinds])
    return everything.select(
        "id_poi", "poi_cat", F.size(vertices(F.col("geometry"))).alias("n_vertices")
    )


def _city_features(i: Inputs) -> DataFrame:
    """Features as found per city; every tenth lies in two cities and is found twice."""
    p = F.col("osmid")
    home, other = city_code(p % 25), city_code(p % 25 + 1)
    cities = F.when(p % 10 == 0, F.array(home, other)).otherwise(F.array(home))
    return pois.with_poi_id(i.poi_features).select(
        "id_poi", "geom_type", F.explode(cities).alias("city_code")
    ).withColumn("city", poi_city_name(F.col("city_code"))).drop("city_code")


@query
def poi_all_cities(i: Inputs) -> DataFrame:
    path = scratch_path(i.spark, "poi-cities")
    _city_features(i).write.partitionBy("city").parquet(path)
    return i.spark.read.parquet(path).select("city", "id_poi")


@query
def city_lookup(i: Inputs) -> DataFrame:
    code = city_code(F.col("s_nationkey"))
    return i.table("supplier").select(
        "s_suppkey", code.alias("city"), poi_city_name(code).alias("city_poi")
    )


@query
def buffer_distance(i: Inputs) -> DataFrame:
    named = pois.with_category(pois.with_poi_id(i.poi_features))
    return named.select("id_poi", "poi_cat", buffer_metres(F.col("poi_cat")).alias("radius"))


def _write_pois(i: Inputs) -> str:
    path = scratch_path(i.spark, "poi")
    prepared = pois.prepare_pois(i.poi_features, columns=pois.POI_COLUMNS)
    pois.write_by_geometry_kind(prepared, path)
    return path


def _stations(i: Inputs) -> DataFrame:
    return i.raw_charging_stations().withColumnRenamed("id", "id_cs")


@query
def poi_station_match(i: Inputs) -> DataFrame:
    shapes = write_shapes(i.planar_pois, scratch_path(i.spark, "shapes"))
    return match_pois(i.planar_pois, _stations(i), shapes=shapes)


@query
def poi_station_pipeline(i: Inputs) -> DataFrame:
    """The same from files to pairs, with the wanted columns of both sides beside the ids."""
    stations = scratch_path(i.spark, "csv")
    write_table(i.raw_charging_stations(), stations)
    table = read_delimited(
        i.spark, stations, STAGING["staging_charging_stations"], empty_as_null=True, multi_line=True
    )
    planar = i.spark.read.parquet(_write_pois(i))
    return match_pois(
        planar, table.withColumnRenamed("id", "id_cs"), columns=["id_poi", "id_cs", "poi_cat", "city"]
    )


@query
def poi_station_files(i: Inputs) -> DataFrame:
    """Files in, mapping file out: stations and POIs are read, matched, written, read back."""
    stations, mapping = scratch_path(i.spark, "csv"), scratch_path(i.spark, "mapping")
    write_table(i.raw_charging_stations(), stations, escaped=True)
    jobs.match_files(i.spark, stations, _write_pois(i), mapping)
    return read_delimited(i.spark, mapping, MAIN["mapping_poi_cs"])


@query
def load_from_files(i: Inputs) -> DataFrame:
    """Snapshot files to flat files to the checked star schema: rows per table."""
    base = scratch_path(i.spark, "load")
    flat = jobs.process_snapshots(
        i.spark, i.snapshot_folder(), f"{base}/flat", pattern=SNAPSHOT_PATTERN, recursive=True
    )
    jobs.prepare_poi_files(i.poi_features, f"{base}/poi")
    jobs.match_files(
        i.spark, flat["staging_charging_stations"], f"{base}/poi", f"{base}/mapping"
    )
    database = "voltlake_" + base.rsplit("-", 1)[1]
    tables = jobs.load_files(
        i.spark, database, flat, f"{base}/poi", f"{base}/mapping", location=f"{base}/tables"
    )
    return quality.union_all([_row_count(df, name) for name, df in tables.items()])


# ---- star schema -------------------------------------------------------------------------


def _table_query(table: str) -> Callable[[Inputs], DataFrame]:
    return lambda i: with_ntz(i.star_schema[table])


for _name, _table in {
    "fact_status_cp": "status_chargingpoints",
    "fact_status_connector": "status_connectors",
    "dim_station": "charging_station",
    "dim_charging_point": "charging_point",
    "dim_connector": "connector",
    "dim_time": "time",
}.items():
    _function = _table_query(_table)
    _function.__name__ = _name
    query(_function)


@query
def mapping_load(i: Inputs) -> DataFrame:
    return _round_trip(i, i.star_schema["mapping_poi_cs"], MAIN["mapping_poi_cs"])


@query
def dim_poi(i: Inputs) -> DataFrame:
    return i.star_schema["poi"].select(
        "id_poi", "poi_category", F.round("longitude", 9).alias("longitude"),
        F.round("latitude", 9).alias("latitude"),
        F.size(vertices(F.col("geom"))).alias("n_vertices"),
    )


@query
def star_schema_rowcounts(i: Inputs) -> DataFrame:
    return quality.union_all([_row_count(df, name) for name, df in i.star_schema.items()])


def _published(i: Inputs, table: str) -> DataFrame:
    return i.spark.table(f"{i.warehouse}.{table}")


@query
def warehouse_load(i: Inputs) -> DataFrame:
    """The whole load, then the rows of each table."""
    base = scratch_path(i.spark, "load")
    database = "voltlake_" + base.rsplit("-", 1)[1]
    specs = warehouse.STAGING_SPECS + warehouse.MAIN_SPECS
    tables = warehouse.load_warehouse(i.spark, database, i.warehouse_sources(), specs, base, side_by_side=4)
    return quality.union_all([_row_count(df, name) for name, df in tables.items()])


@query
def incremental_load(i: Inputs) -> DataFrame:
    """Every other day first, then everything, twice: the facts end up as a full load's."""
    base = scratch_path(i.spark, "load")
    database = "voltlake_" + base.rsplit("-", 1)[1]
    specs = warehouse.STAGING_SPECS + warehouse.MAIN_SPECS
    every = i.warehouse_sources()
    facts = ("raw_staging_status_cp", "raw_staging_status_connectors")
    even = F.unix_date(utc_day(F.col("ts"))) % 2 == 0
    half = {t: every[t].where(even) if t in facts else every[t] for t in every}
    for sources in (half, every, every):
        tables = warehouse.load_warehouse(
            i.spark, database, sources, specs, base, extend=True, side_by_side=4
        )
    return quality.union_all([_row_count(tables[t], t) for t in MAIN])


@query
def published_tables(i: Inputs) -> DataFrame:
    """Rows of each table as the manifest in force names them, after a load, a growing one and a failed one."""
    base = scratch_path(i.spark, "load")
    database = "voltlake_" + base.rsplit("-", 1)[1]
    specs = warehouse.STAGING_SPECS + warehouse.MAIN_SPECS
    every = i.warehouse_sources()
    facts = ("raw_staging_status_cp", "raw_staging_status_connectors")
    early = F.col("ts") < utc_time(F.lit("2024-01-16"))
    warehouse.load_warehouse(
        i.spark, database, {t: every[t].where(early) if t in facts else every[t] for t in every}, specs, base, side_by_side=4
    )
    warehouse.load_warehouse(i.spark, database, every, specs, base, extend=True, side_by_side=4)
    broken = {t: every[t] for t in every} | {"raw_staging_connectors": every["raw_staging_connectors"].withColumn("max_power", F.lit(400))}
    try:
        warehouse.load_warehouse(i.spark, database, broken, specs, base, extend=True, side_by_side=4)
    except quality.QualityError:
        number = manifest.read_manifest(i.spark, database).number
    tables = warehouse.open_warehouse(i.spark, database, specs)
    counts = quality.union_all([_row_count(df, name) for name, df in tables.items()])
    return counts.withColumn("manifest", F.lit(number))


@query
def dim_scan(i: Inputs) -> DataFrame:
    return _published(i, "charging_station")


@query
def parameterised_sql(i: Inputs) -> DataFrame:
    i.star_schema["charging_station"].createOrReplaceTempView("voltlake_station")
    return warehouse.run_sql(
        i.spark,
        "select city, count(*) as n_stations from IDENTIFIER(:table) "
        "where roaming = :roaming group by city",
        {"table": "voltlake_station"},
        roaming=True,
    )


# ---- data quality ------------------------------------------------------------------------


def _loaded(i: Inputs) -> dict[str, DataFrame]:
    """The published main tables and the staging plans."""
    return {t: i.star_schema[t] for t in STAGING} | {t: _published(i, t) for t in MAIN}


@query
def dq_row_count(i: Inputs) -> DataFrame:
    return quality.union_all(
        [quality.evaluate(df, [quality.not_empty(t)]) for t, df in _loaded(i).items()]
    )


@query
def dq_length(i: Inputs) -> DataFrame:
    tables = _loaded(i)
    trimmed = quality.has_length("postal_code_length", "postal_code", 5)
    raw = quality.has_length("raw_postal_code_length", "postal_code", 5)
    return quality.evaluate(tables["charging_station"], [trimmed]).unionByName(
        quality.evaluate(tables["staging_charging_stations"], [raw])
    )


@query
def dq_range(i: Inputs) -> DataFrame:
    rule = quality.in_open_range("power_limits_connectors", "max_power", 2, 400)
    ampere = quality.in_open_range("ampere_limits_connectors", "ampere", 2, 400)
    return quality.evaluate(_loaded(i)["connector"], [rule, ampere])


@query
def dq_quantifier(i: Inputs) -> DataFrame:
    charging = "status_cp = 'CHARGING'"
    sensor = "try_cast(status_parkingsensor as int) >= 0"
    rules = [
        quality.QualityRule("all_charging", charging),
        quality.QualityRule("any_charging", charging, "any"),
        quality.QualityRule("all_sensors", sensor),
        quality.QualityRule("any_null", "cast(null as boolean)", "any"),
    ]
    return quality.evaluate(_loaded(i)["status_chargingpoints"], rules)


@query
def dq_not_null(i: Inputs) -> DataFrame:
    schemas = {**STAGING, **MAIN}
    return quality.union_all(
        [
            quality.count_nulls(df, schemas[name], name)
            for name, df in _loaded(i).items()
            if any(not f.nullable for f in schemas[name])
        ]
    )


@query
def dq_unique_key(i: Inputs) -> DataFrame:
    tables = _loaded(i)
    return quality.union_all(
        [quality.key_uniqueness(tables[t], keys, t) for t, keys in PRIMARY_KEYS.items()]
    )


@query
def dq_orphans(i: Inputs) -> DataFrame:
    tables = _loaded(i)
    return quality.union_all(
        [
            quality.orphans(
                tables[child], column, tables[parent], parent_column,
                {"child": child, "child_column": column, "parent": parent},
            )
            for child, column, parent, parent_column in REFERENCES
        ]
    )


@query
def dq_one_to_one(i: Inputs) -> DataFrame:
    features = pois.with_poi_id(i.poi_features)
    return quality.key_uniqueness(features, ["id_poi"], "features").unionByName(
        quality.key_uniqueness(_city_features(i), ["id_poi"], "features of all cities")
    )


# ---- utilization -------------------------------------------------------------------------


@query
def status_series_cp(i: Inputs) -> DataFrame:
    return with_ntz(utilization.point_series(i.star_schema["status_chargingpoints"]))


@query
def status_series_connector(i: Inputs) -> DataFrame:
    return with_ntz(utilization.connector_series(i.star_schema["status_connectors"]))


@query
def status_numeric(i: Inputs) -> DataFrame:
    facts = i.star_schema["status_chargingpoints"]
    number = status_number(F.col("status_cp"))
    return facts.groupBy("status_cp", number.alias("status_num")).agg(
        F.count(F.lit(1)).alias("n")
    )


@query
def status_share(i: Inputs) -> DataFrame:
    facts = i.star_schema["status_chargingpoints"]
    shares = utilization.status_share(facts, "id_chargingpoint", "status_cp")
    return utilization.most_frequent_first(shares, "id_chargingpoint")


@query
def status_share_connector(i: Inputs) -> DataFrame:
    facts = i.star_schema["status_connectors"]
    return utilization.status_share(facts, "id_connector", "status_connector")


@query
def points_of_station(i: Inputs) -> DataFrame:
    t = i.star_schema
    return utilization.points_of_station(t["charging_point"], t["charging_station"])


@query
def connectors_of_point(i: Inputs) -> DataFrame:
    """Connectors by the point they belong to; the points themselves, not one of them."""
    connectors = utilization.connectors_of_point(i.star_schema["connector"])
    return connectors.select("id_cp", "id_connector", "format", "max_power")


@query
def drilldown(i: Inputs) -> DataFrame:
    t = i.star_schema
    return with_ntz(
        utilization.drilldown(
            t["charging_station"], t["charging_point"], t["connector"], t["status_connectors"]
        )
    )


@query
def charging_events(i: Inputs) -> DataFrame:
    facts = i.star_schema["status_chargingpoints"]
    return with_ntz(polls.charging_events(facts, "id_chargingpoint", "status_cp"))


@query
def charging_events_connector(i: Inputs) -> DataFrame:
    facts = i.star_schema["status_connectors"]
    return with_ntz(polls.charging_events(facts, "id_connector", "status_connector"))


@query
def utilization_rollup(i: Inputs) -> DataFrame:
    t = i.star_schema
    return polls.utilization_rollup(
        t["status_chargingpoints"], t["charging_point"], t["charging_station"],
        "2024-01-05 06:00:00", "2024-01-20 18:30:00",
    )


@query
def utilization_by_poi(i: Inputs) -> DataFrame:
    t = i.star_schema
    return polls.utilization_by_poi(
        t["status_chargingpoints"], t["charging_point"], t["mapping_poi_cs"], t["poi"],
        "2024-01-05 06:00:00", "2024-01-20 18:30:00",
    )


def _station_states(i: Inputs) -> DataFrame:
    """What each snapshot says of a station: its city and how many points it has."""
    rows = flatten.station_rows_ts(i.documents())
    states = rows.select(F.col("id").cast("int").alias("id_cs"), "timestamp", F.size("evses").alias("n_points"))
    cities = i.raw_charging_stations().select(F.col("id").alias("id_cs"), "city")
    return states.join(cities, "id_cs")


def _history(df: DataFrame) -> DataFrame:
    return with_ntz(df.drop("attribute_hash"))


@query
def station_history(i: Inputs) -> DataFrame:
    return _history(history.intervals(_station_states(i), "id_cs", "timestamp", ["city", "n_points"]))


@query
def station_history_grown(i: Inputs) -> DataFrame:
    """The same in two loads, the second of which ends open intervals of a written first one."""
    states, attributes = _station_states(i), ["city", "n_points"]
    early = F.col("timestamp") < utc_time(F.lit("2024-01-14 12:00:00"))
    path = scratch_path(i.spark, "history")
    history.intervals(states.where(early), "id_cs", "timestamp", attributes).write.parquet(path)
    known = i.spark.read.parquet(path)
    return _history(history.extend_history(known, states.where(~early), "id_cs", "timestamp", attributes))


@query
def station_header(i: Inputs) -> DataFrame:
    return utilization.station_header(i.star_schema["charging_station"])


@query
def station_positions(i: Inputs) -> DataFrame:
    return utilization.station_positions(i.star_schema["charging_station"])
