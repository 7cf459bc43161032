"""Whole jobs from files to files or tables, in the order they are run."""

from __future__ import annotations

import logging

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession

from voltlake.constants import BUFFER_METRES, DEFAULT_BUFFER_METRES, POI_TAGS
from voltlake.operators.master import master_data
from voltlake.operators.poi import (
    POI_COLUMNS,
    prepare_pois,
    tag_filter,
    with_poi_id,
    write_by_geometry_kind,
)
from voltlake.operators.quality import require_unique, with_shape
from voltlake.operators.spatial import match_pois, write_shapes
from voltlake.operators.status import split_status, status_table
from voltlake.plans.manifest import read_manifest
from voltlake.plans.warehouse import (
    FLAT_NAMES,
    MAIN_SPECS,
    STAGING_SPECS,
    TableSpec,
    load_warehouse,
    open_warehouse,
    staging_from_files,
)
from voltlake.runtime import drop_scratch, scratch_path
from voltlake.schemas import MAIN, STAGING
from voltlake.sinks.files import archive_snapshots, write_table
from voltlake.sources.delimited import bind_by_name, read_delimited
from voltlake.sources.snapshots import latest_snapshot, scan_snapshots
from voltlake.streaming.intake import consumable, taken_in

log = logging.getLogger(__name__)

# Folder of each flattened table below the target, by staging table.
FLAT_FOLDERS = {
    "staging_charging_stations": "charging_stations",
    "staging_charging_points": "charging_points",
    "staging_connectors": "connectors",
    "staging_status_cp": "status_cps",
    "staging_status_connectors": "status_connectors",
}


def flat_paths(folder: str) -> dict[str, str]:
    return {table: f"{folder}/{name}" for table, name in FLAT_FOLDERS.items()}


def process_snapshots(
    spark: SparkSession,
    source: str,
    target: str,
    *,
    archive: str | None = None,
    archive_name: str | None = None,
    pattern: str = "*.json",
    recursive: bool = False,
    output_format: str = "csv",
    escaped: bool = True,
) -> dict[str, str]:
    """Master data of the last snapshot and the status of all of them; optionally the archive.

    Every snapshot is parsed once for both status levels, by way of a written status table in
    the shared folder. Returns the written paths by staging table. Without ``escaped`` delimited texts
    keep their line breaks, in quotes, for other readers.
    """
    parsed = scratch_path(spark, "status")
    status_table(scan_snapshots(spark, source, pattern, recursive)).write.parquet(parsed)
    flat = dict(
        zip(
            FLAT_FOLDERS,
            [
                *master_data(latest_snapshot(spark, source, pattern, recursive)),
                *split_status(spark.read.parquet(parsed)),
            ],
        )
    )
    paths = flat_paths(target)
    for table, df in flat.items():
        observed, shape = with_shape(df, table)
        write_table(observed, paths[table], output_format, escaped=escaped)
        log.info("%s: %s", table, shape.get)
    drop_scratch(spark, parsed)
    if archive is not None:
        archive_snapshots(
            spark, source, archive, pattern, name=archive_name, recursive=recursive
        )
    return paths


def prepare_poi_files(
    features: DataFrame, target: str, tags: dict[str, list[str]] = POI_TAGS
) -> None:
    """Wanted features to POIs with category, position and planar geometry, one folder per
    geometry kind. An id found twice in one city is an error; the check reads the ids only."""
    wanted = tag_filter(features, tags)
    keys = [k for k in ("city", "id_poi") if k == "id_poi" or k in features.columns]
    require_unique(with_poi_id(wanted), keys, "POI features")
    write_by_geometry_kind(prepare_pois(wanted, tags, POI_COLUMNS), target)


def match_files(
    spark: SparkSession,
    stations: str,
    pois: str,
    target: str,
    distances: dict[str, float] = BUFFER_METRES,
    default: float = DEFAULT_BUFFER_METRES,
    *,
    escaped: bool = True,
) -> None:
    """Station and POI files to the mapping file; ``escaped`` as in ``load_files``."""
    table = read_delimited(
        spark, stations, STAGING["staging_charging_stations"], empty_as_null=True,
        multi_line=not escaped, escaped=escaped,
    )
    planar, kept = spark.read.parquet(pois), scratch_path(spark, "shapes")
    shapes = write_shapes(planar, kept, distances, default)
    pairs = match_pois(planar, table.withColumnRenamed("id", "id_cs"), distances, default, shapes=shapes)
    write_table(pairs, target)
    drop_scratch(spark, kept)


def load_files(
    spark: SparkSession,
    database: str,
    flat: dict[str, str],
    pois: str,
    mapping: str,
    *,
    specs: list[TableSpec] | None = None,
    location: str | None = None,
    file_format: str = "csv",
    extend: bool = False,
    escaped: bool = True,
) -> dict[str, DataFrame]:
    """The written files into the star schema, whose main tables are written side by side.

    Files that ``process_snapshots`` has written are ``escaped``; those of others may have line breaks in quotes.
    """
    sources = staging_from_files(spark, flat, file_format, escaped)
    sources["staging_poi"] = spark.read.parquet(pois)
    sources["staging_mapping_poi_cs"] = read_delimited(spark, mapping, MAIN["mapping_poi_cs"])
    return load_warehouse(
        spark, database, sources, specs or STAGING_SPECS + MAIN_SPECS, location,
        extend=extend, side_by_side=4,
    )


# Tables that the intake's status rows go to.
FROM_INTAKE = {
    "staging_status_cp", "staging_status_connectors", "status_chargingpoints", "status_connectors", "time",
}


def intake_specs(specs: list[TableSpec]) -> list[TableSpec]:
    """Those fed by the intake. A batch may have no connector, so an empty table is no error here."""
    return [
        replace(s, rules=[r for r in s.rules if r.name != f"row_count_{s.name}"]) for s in specs if s.name in FROM_INTAKE
    ]


def load_intake(
    spark: SparkSession,
    database: str,
    target: str,
    *,
    specs: list[TableSpec] | None = None,
    location: str | None = None,
    check_keys: bool = False,
) -> dict[str, DataFrame]:
    """The batches of an intake that the facts don't have yet, and nothing else, into the facts.

    The manifest that publishes the rows holds the number of the last batch, so both take effect
    together: a load that dies before it leaves no row behind, and one that runs again after it finds
    no batch left.
    """
    target, wanted = target.rstrip("/"), specs or STAGING_SPECS + MAIN_SPECS
    exists = spark.catalog.databaseExists(database)
    mark = read_manifest(spark, database).marks.get(target, -1) if exists else -1
    found = [n for n in consumable(spark, target) if n > mark]
    if not found:
        return open_warehouse(spark, database, wanted) if exists else {}
    flat = dict(zip(("staging_status_cp", "staging_status_connectors"), taken_in(spark, target, mark, found[-1])))
    sources = {f"raw_{t}": bind_by_name(df.withColumnsRenamed(FLAT_NAMES[t]), STAGING[t]) for t, df in flat.items()}
    return load_warehouse(
        spark, database, sources, intake_specs(wanted), location,
        extend=True, check_keys=check_keys, side_by_side=3, marks={target: found[-1]},
    )
