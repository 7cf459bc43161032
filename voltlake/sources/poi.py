"""POI features: Parquet with the geometry column, or GeoJSON with one feature per line."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from voltlake.functions.geo import point_geometry
from voltlake.functions.nested import RECORD

AREA_KINDS = ["polygon", "multipolygon"]


def union_features(parts: list[DataFrame]) -> DataFrame:
    """All rows of all parts; a column absent from a part is null there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def read_features(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Every Parquet path given, concatenated."""
    return union_features([spark.read.parquet(path) for path in paths])


def _vertex(pair: Column) -> Column:
    return F.struct(pair[0].alias("x"), pair[1].alias("y"))


def _rings(part: Column) -> Column:
    return F.transform(part, lambda ring: F.transform(ring, _vertex))


def geojson_geometry(kind: Column, coordinates: Column) -> Column:
    """GeoJSON coordinates (as text) to the geometry column; other kinds give null."""
    pair = F.from_json(coordinates, "array<double>")
    line = F.from_json(coordinates, "array<array<double>>")
    area = F.from_json(coordinates, "array<array<array<double>>>")
    areas = F.from_json(coordinates, "array<array<array<array<double>>>>")
    return (
        F.when(kind == "point", point_geometry(pair[0], pair[1]))
        .when(kind == "linestring", F.array(_rings(F.array(line))))
        .when(kind == "multilinestring", F.array(_rings(area)))
        .when(kind == "polygon", F.array(_rings(area)))
        .when(kind == "multipolygon", F.transform(areas, _rings))
    )


def read_geojson(
    spark: SparkSession, path: str | list[str], properties: list[str]
) -> DataFrame:
    """Columns ``properties`` plus ``geom_type`` and ``geometry``."""
    record = F.from_json(
        "value", f"struct<properties:{RECORD},geometry:struct<type:string,coordinates:string>>"
    )
    parsed = spark.read.text(path).select(record.alias("f"))
    kind = F.lower("f.geometry.type")
    return parsed.select(
        *[F.try_element_at("f.properties", F.lit(p)).alias(p) for p in properties],
        kind.alias("geom_type"),
        geojson_geometry(kind, F.col("f.geometry.coordinates")).alias("geometry"),
    )
