"""The star schema: declared tables, their build, checks and publication.

A table is added by adding a ``TableSpec`` to a list.
"""

from __future__ import annotations

import time as clock
import uuid
from collections.abc import Callable, Iterator, Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from voltlake.functions.times import utc_day, utc_time
from voltlake.functions.values import calendar_fields, status_key
from voltlake.operators.quality import (
    QualityRule,
    has_length,
    in_open_range,
    not_empty,
    require,
    require_unique,
    watched,
)
from voltlake.plans.manifest import Manifest, publish, quoted, read_manifest, read_parts
from voltlake.runtime import drop_scratch, scratch_path
from voltlake.schemas import MAIN, PRIMARY_KEYS, STAGING
from voltlake.sources.delimited import bind_by_name, empty_text, read_delimited

Tables = Mapping[str, DataFrame]


@dataclass(frozen=True)
class TableSpec:
    """``build`` gets all tables made so far, by name."""

    name: str
    schema: T.StructType
    build: Callable[[Tables], DataFrame]
    rules: list[QualityRule] = field(default_factory=list)
    # Facts are stored by day and sorted, so reads by time skip days and reads by id skip
    # row groups.
    day_of: str | None = None
    sort_by: tuple[str, ...] = ()
    # Columns that tell rows apart; checked on request, and needed to add rows.
    key: tuple[str, ...] = ()
    # Ids that rows are looked up by.
    find_by: tuple[str, ...] = ()
    # Facts grow by later loads; other tables are replaced.
    grows: bool = False
    # Staging tables are plans that the main tables are built from; they are not written.
    stored: bool = True


class LazyTables(Mapping):
    """Tables by name, each made when first asked for, so a question about one table plans
    nothing for the others."""

    def __init__(self, makers: Mapping[str, Callable[[], DataFrame]]):
        self._makers = dict(makers)
        self._made: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._made:
            self._made[name] = self._makers[name]()
        return self._made[name]

    def __iter__(self) -> Iterator[str]:
        return iter(self._makers)

    def __len__(self) -> int:
        return len(self._makers)


def typed(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Columns by name, in the declared order and type."""
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema])


def enforced(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Stops the write at the first null in a NOT NULL column; no pass of its own."""

    def checked(f: T.StructField) -> Column:
        if f.nullable:
            return F.col(f.name)
        message = F.lit(f"{spec.name}.{f.name} is null")
        return F.coalesce(F.col(f.name), F.raise_error(message).cast(f.dataType)).alias(f.name)

    return df.select(*[checked(f) for f in spec.schema])


def status_chargingpoints(t: Tables) -> DataFrame:
    return t["staging_status_cp"].select(
        status_key(F.col("id_cp"), F.col("ts")).alias("id_status_cp"),
        F.col("id_cp").alias("id_chargingpoint"),
        F.col("ts").alias("query_time"),
        "status_cp",
        F.col("parkingsensor_status").alias("status_parkingsensor"),
    )


def status_connectors(t: Tables) -> DataFrame:
    return t["staging_status_connectors"].select(
        status_key(F.col("id_connector"), F.col("ts")).alias("id_status_connector"),
        "id_connector",
        F.col("ts").alias("query_time"),
        "status_connector",
    )


def charging_station(t: Tables) -> DataFrame:
    renamed = t["staging_charging_stations"].withColumnRenamed("id", "id_cs")
    return renamed.withColumn("postal_code", F.trim("postal_code")).drop("distance_in_m")


def charging_point(t: Tables) -> DataFrame:
    renamed = t["staging_charging_points"].withColumnRenamed("id", "id_cp")
    return renamed.drop("cp_public_comment", "uid")


def connector(t: Tables) -> DataFrame:
    return t["staging_connectors"].withColumnRenamed("id", "id_connector").drop("tariff_id")


def time(t: Tables) -> DataFrame:
    """One row per query time of the point status; its calendar fields follow from it."""
    times = t["staging_status_cp"].select(F.col("ts").alias("query_time")).distinct()
    return times.select("query_time", *calendar_fields(F.col("query_time")))


def poi(t: Tables) -> DataFrame:
    return t["staging_poi"].withColumnsRenamed({"geometry": "geom", "poi_cat": "poi_category"})


def _main(name: str, build, *rules: QualityRule, **layout) -> TableSpec:
    key = tuple(PRIMARY_KEYS.get(name, ()))
    return TableSpec(name, MAIN[name], build, [not_empty(name), *rules], key=key, **layout)


def _staging(name: str) -> TableSpec:
    schema = STAGING[name]
    return TableSpec(name, schema, lambda t: t[f"raw_{name}"], [not_empty(name)], stored=False)


STAGING_SPECS = [_staging(name) for name in STAGING]

MAIN_SPECS = [
    _main(
        "status_chargingpoints", status_chargingpoints,
        day_of="query_time", sort_by=("id_chargingpoint", "query_time"),
        find_by=("id_chargingpoint",), grows=True,
    ),
    _main(
        "status_connectors", status_connectors,
        day_of="query_time", sort_by=("id_connector", "query_time"),
        find_by=("id_connector",), grows=True,
    ),
    _main(
        "charging_station", charging_station,
        has_length("postal_code_length", "postal_code", 5),
    ),
    _main("charging_point", charging_point),
    _main("connector", connector, in_open_range("power_limits_connectors", "max_power", 2, 400)),
    _main("time", time, grows=True),
    _main("mapping_poi_cs", lambda t: t["staging_mapping_poi_cs"]),
    _main("poi", poi),
]


def build_tables(sources: Tables, specs: list[TableSpec]) -> Tables:
    """All tables of ``specs``, lazily, each seeing the sources and the other tables."""
    makers = {name: lambda name=name: sources[name] for name in sources}
    for spec in specs:
        makers[spec.name] = lambda spec=spec: typed(spec.build(everything), spec.schema)
    everything = LazyTables(makers)
    return LazyTables({s.name: lambda s=s: everything[s.name] for s in specs})


DAY = "query_date"

#: Parts of a growing table beyond which a load merges those that loads have added.
MOST_PARTS = 16


def _laid_out(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Facts gathered by day in one shuffle, which splits a heavy day over several tasks, and sorted
    by id and time within each file."""
    if spec.day_of is None:
        return df
    dated = df if DAY in df.columns else df.withColumn(DAY, utc_day(F.col(spec.day_of)))
    return dated.hint("rebalance", DAY).sortWithinPartitions(DAY, *spec.sort_by)


def _write(spark: SparkSession, df: DataFrame, spec: TableSpec, database: str) -> str:
    """A new part of the table. Columns to find rows by get Bloom filters, so that files without an id are left unread."""
    part = f"{spec.name}__{clock.time_ns():020d}_{uuid.uuid4().hex[:6]}"
    writer = _laid_out(df, spec).write.mode("error").format("parquet")
    if spec.find_by:  # as large as a row group's ids need; the fixed size is a megabyte
        writer = writer.option("parquet.bloom.filter.adaptive.enabled", "true")
    for column in spec.find_by:
        writer = writer.option(f"parquet.bloom.filter.enabled#{column}", "true")
        # Sizes that are tried, each half of the one before.
        writer = writer.option(f"parquet.bloom.filter.candidates.number#{column}", "12")
    if spec.day_of is not None:
        writer = writer.partitionBy(DAY)
    try:
        writer.saveAsTable(quoted(database, part))
    except Exception:
        _drop(spark, database, [part])
        raise
    return part


def _drop(spark: SparkSession, database: str, parts: list[str]) -> None:
    for part in parts:
        spark.sql(f"DROP TABLE IF EXISTS {quoted(database, part)}")


def load_table(
    spark: SparkSession, database: str, spec: TableSpec, tables: Tables, check_keys: bool = False
) -> list[str]:
    """Writes the table anew and checks it; returns its one part, which nobody reads yet.

    Rules are counted while the part is written.
    """
    rows, check = watched(enforced(typed(spec.build(tables), spec.schema), spec), spec.rules, spec.name)
    part = _write(spark, rows, spec, database)
    try:
        check()
        if check_keys and spec.key:
            require_unique(spark.table(quoted(database, part)), list(spec.key), spec.name)
    except Exception:
        _drop(spark, database, [part])
        raise
    return [part]


def touched_days(known: DataFrame, rows: DataFrame, spec: TableSpec) -> DataFrame:
    """Rows of ``known`` on the days of ``rows``; other days are not read."""
    if spec.day_of is None:
        return known
    days = [r[0] for r in rows.select(DAY).distinct().collect()]  # as many as the load has days
    return known.where(F.col(DAY).isin(days)) if days else known.where(F.lit(False))


def extend_table(
    spark: SparkSession, database: str, spec: TableSpec, tables: Tables, parts: list[str], check_keys: bool = False
) -> list[str]:
    """Parts of the table with one more for the rows whose keys the ``parts`` lack.

    The source is evaluated once, into a scratch table that is checked and then held against the
    days it touches. A load that is run again adds nothing. With ``check_keys`` a key that the source
    has twice stops the load; without it such rows are all added.
    """
    path = scratch_path(spark, spec.name)
    source = enforced(typed(spec.build(tables), spec.schema), spec)
    if spec.day_of is not None:
        source = source.withColumn(DAY, utc_day(F.col(spec.day_of)))
    watch, check = watched(source, spec.rules, spec.name)
    added: list[str] = []
    try:
        watch.write.parquet(path)
        check()
        rows, keys = spark.read.schema(source.schema).parquet(path), list(spec.key)
        if check_keys:
            require_unique(rows, keys, spec.name)
        known = touched_days(read_parts(spark, database, parts), rows, spec)
        new = rows.join(known.select(*keys), keys, "left_anti")
        added.append(_write(spark, new, spec, database))
        if spark.table(quoted(database, added[0])).isEmpty():  # told by the files, without the join once more
            _drop(spark, database, added)
            added.clear()
        if len(parts) + len(added) > MOST_PARTS:
            merged = _write(spark, read_parts(spark, database, [*parts[1:], *added]), spec, database)
            _drop(spark, database, added)
            return [parts[0], merged]
    except Exception:
        _drop(spark, database, added)
        raise
    finally:
        drop_scratch(spark, path)
    return [*parts, *added]


def point_views(spark: SparkSession, database: str, specs: list[TableSpec], manifest: Manifest) -> None:
    """Views by the tables' names, for SQL. Each shows the manifest's parts; the tables together are read
    by ``open_warehouse``."""
    for spec in specs:
        if spec.name not in manifest.parts:
            continue
        columns = ", ".join(quoted(f.name) for f in spec.schema)
        views = {spec.name: columns}
        if spec.day_of is not None:
            views[f"{spec.name}_by_day"] = f"{columns}, {DAY}"
        for view, listed in views.items():
            selects = []
            for part in manifest.parts[spec.name]:
                own = set(spark.table(quoted(database, part)).columns)
                lacking = {f.name: f"CAST(NULL AS {f.dataType.simpleString()}) AS {quoted(f.name)}" for f in spec.schema if f.name not in own}
                shown = ", ".join(lacking.get(f.name, quoted(f.name)) for f in spec.schema) + listed.removeprefix(columns)
                selects.append(f"SELECT {shown} FROM {quoted(database, part)}")
            spark.sql(f"CREATE OR REPLACE VIEW {quoted(database, view)} AS {' UNION ALL '.join(selects)}")


def open_warehouse(spark: SparkSession, database: str, specs: list[TableSpec], number: int | None = None) -> dict[str, DataFrame]:
    """All published tables as one load left them: the last one, or the kept one of a number."""
    manifest = read_manifest(spark, database, number)
    return {
        s.name: read_parts(spark, database, manifest.parts[s.name]).select(*[f.name for f in s.schema])
        for s in specs
        if s.name in manifest.parts
    }


def load_warehouse(
    spark: SparkSession,
    database: str,
    sources: Tables,
    specs: list[TableSpec],
    location: str | None = None,
    *,
    extend: bool = False,
    check_keys: bool = False,
    side_by_side: int = 1,
    marks: Mapping[str, int] = {},
) -> dict[str, DataFrame]:
    """Loads all tables in order and publishes them together; later builds read the new rows.

    Staging tables are checked and stay plans. With ``extend`` facts gain the new rows and the other
    tables are replaced; without it all are. Nothing is published before every table is written
    and checked, and then everything by one manifest, with ``marks``. ``side_by_side`` main tables are written at
    a time; above one they must not be built from each other.
    """
    escaped = (location or "").replace("\\", "\\\\").replace("'", "\\'")
    place = f" LOCATION '{escaped}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {quoted(database)}{place}")
    before = read_manifest(spark, database)
    ready: dict[str, DataFrame] = {}
    parts: dict[str, list[str]] = {}

    def known() -> LazyTables:
        makers = {name: lambda name=name: sources[name] for name in sources}
        return LazyTables(makers | {name: lambda df=df: df for name, df in ready.items()})

    def stored(spec: TableSpec, tables: LazyTables) -> DataFrame:
        if extend and spec.grows and spec.name in before.parts:
            parts[spec.name] = extend_table(spark, database, spec, tables, before.parts[spec.name], check_keys)
        else:
            parts[spec.name] = load_table(spark, database, spec, tables, check_keys)
        return read_parts(spark, database, parts[spec.name]).select(*[f.name for f in spec.schema])

    staging, main = [s for s in specs if not s.stored], [s for s in specs if s.stored]
    for spec in staging:
        ready[spec.name] = enforced(typed(spec.build(known()), spec.schema), spec)
    with ThreadPoolExecutor(side_by_side) as pool:  # a failed check stops the load before anything is written
        list(pool.map(lambda s: require(ready[s.name], s.rules, s.name), staging))
    manifest = before
    try:
        if side_by_side > 1:
            with ThreadPoolExecutor(side_by_side) as pool:
                tables = known()
                ready |= dict(zip([s.name for s in main], pool.map(lambda s: stored(s, tables), main)))
        else:
            for spec in main:
                ready[spec.name] = stored(spec, known())
        manifest = before.successor(parts, dict(marks))
        publish(spark, database, manifest)
    except Exception:
        published = {p for listed in read_manifest(spark, database).parts.values() for p in listed}
        _drop(spark, database, [p for listed in parts.values() for p in listed if p not in published])
        raise
    point_views(spark, database, main, manifest)
    return ready


def facts_between(spark: SparkSession, table: str, start: str, end: str) -> DataFrame:
    """Rows of a published fact with start <= query_time < end (UTC), other days unread."""
    first, last = utc_time(F.lit(start)), utc_time(F.lit(end))
    return spark.table(f"{table}_by_day").where(
        (F.col("query_time") >= first)
        & (F.col("query_time") < last)
        & F.col(DAY).between(utc_day(first), utc_day(last))
    ).drop(DAY)


# Column names of the flattened files -> staging names, where they differ.
FLAT_NAMES = {
    "staging_status_cp": {"id": "id_cp", "status": "status_cp", "timestamp": "ts"},
    "staging_status_connectors": {
        "id": "id_connector", "status": "status_connector", "timestamp": "ts",
    },
}


# Tables with texts that may hold line breaks. The others are ids and numbers, their files are
# split over tasks, and a line break there stops the read.
FREE_TEXT = {"staging_charging_stations", "staging_charging_points", "staging_connectors"}


def staging_from_files(
    spark: SparkSession, paths: Mapping[str, str | list[str]], file_format: str = "csv", escaped: bool = False
) -> dict[str, DataFrame]:
    """``raw_<staging table>`` from delimited or Parquet files. Only stations and points read empty
    text as null."""
    empty = {"staging_charging_stations", "staging_charging_points"}
    if file_format == "parquet":
        return {
            f"raw_{name}": bind_by_name(
                empty_text(
                    spark.read.parquet(paths[name]).withColumnsRenamed(FLAT_NAMES.get(name, {})),
                    as_null=name in empty,
                ),
                STAGING[name],
            )
            for name in STAGING
        }
    return {
        f"raw_{name}": read_delimited(
            spark, paths[name], STAGING[name],
            names=FLAT_NAMES.get(name), empty_as_null=name in empty, multi_line=name in FREE_TEXT and not escaped, escaped=escaped,
        )
        for name in STAGING
    }


def staging_from_documents(
    master: tuple[DataFrame, DataFrame, DataFrame], status: tuple[DataFrame, DataFrame]
) -> dict[str, DataFrame]:
    """``raw_<staging table>`` straight from flattened snapshots, without files between."""
    flat = dict(
        zip(
            [
                "staging_charging_stations", "staging_charging_points", "staging_connectors",
                "staging_status_cp", "staging_status_connectors",
            ],
            [*master, *status],
        )
    )
    return {
        f"raw_{name}": bind_by_name(
            df.withColumnsRenamed(FLAT_NAMES.get(name, {})), STAGING[name]
        )
        for name, df in flat.items()
    }


def run_sql(
    spark: SparkSession, text: str, names: Mapping[str, str] = {}, **values: object
) -> DataFrame:
    """SQL text with ``IDENTIFIER(:name)`` for tables and ``:value`` for values; both are bound
    as parameters, never pasted into the text."""
    args: dict[str, object] = {**names, **values}
    return spark.sql(text, args=args)
