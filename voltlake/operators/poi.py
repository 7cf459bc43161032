"""POI preparation: tag filter, id, category, position, planar geometry."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voltlake.constants import POI_TAGS
from voltlake.functions.geo import geometry_to_utm32, representative_point

POI_COLUMNS = ["geometry", "id_poi", "poi_cat", "longitude", "latitude"]


def with_tag_columns(features: DataFrame, tags: dict[str, list[str]] = POI_TAGS) -> DataFrame:
    """Adds tag columns a source lacks, as null."""
    absent = {k: F.lit(None).cast("string") for k in tags if k not in features.columns}
    return features.withColumns(absent) if absent else features


def tag_filter(features: DataFrame, tags: dict[str, list[str]] = POI_TAGS) -> DataFrame:
    """Features with a wanted value in any tag column."""
    wanted = [F.col(key).isin(values) for key, values in tags.items()]
    return with_tag_columns(features, tags).where(reduce(Column.__or__, wanted))


def with_poi_id(features: DataFrame) -> DataFrame:
    return features.withColumn(
        "id_poi", F.concat_ws("/", "element_type", F.col("osmid").cast("string"))
    )


def with_category(features: DataFrame, tags: dict[str, list[str]] = POI_TAGS) -> DataFrame:
    """``poi_cat``: the first tag column that holds any wanted value of any tag."""
    allowed = [value for values in tags.values() for value in values]
    category = F.coalesce(*[F.when(F.col(k).isin(allowed), F.col(k)) for k in tags])
    return with_tag_columns(features, tags).withColumn("poi_cat", category)


def with_position(features: DataFrame) -> DataFrame:
    """``longitude`` and ``latitude`` of a representative point of the geometry in degrees."""
    inner = features.withColumn(
        "inner_point", representative_point(F.col("geometry"), F.col("geom_type"))
    )
    return inner.withColumns(
        {"longitude": F.col("inner_point.x"), "latitude": F.col("inner_point.y")}
    ).drop("inner_point")


def prepare_pois(
    features: DataFrame,
    tags: dict[str, list[str]] = POI_TAGS,
    columns: list[str] | None = None,
) -> DataFrame:
    """Raw features in degrees to POIs with id, category, position and geometry in metres."""
    named = with_category(with_poi_id(features.drop("ways", "nodes")), tags)
    planar = with_position(named).withColumn("geometry", geometry_to_utm32(F.col("geometry")))
    return planar if columns is None else planar.select(*columns, "geom_type")


def write_by_geometry_kind(pois: DataFrame, path: str) -> None:
    """One folder per geometry kind."""
    pois.write.mode("overwrite").partitionBy("geom_type").parquet(path)
