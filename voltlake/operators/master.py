"""Master data of stations, charging points and connectors."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voltlake.constants import MISSING
from voltlake.functions.nested import record_type, text_of, texts, truthy
from voltlake.operators.flatten import connector_rows, point_rows, station_rows
from voltlake.schemas import (
    CONNECTOR_KEYS,
    POINT_KEYS,
    POINT_NESTED_KEYS,
    STATION_KEYS,
    STATION_NESTED_KEYS,
)


def station_master(documents: DataFrame, flatten: bool = True) -> DataFrame:
    """Station scalars (null where absent), position, operator and opening flag."""
    keys = STATION_KEYS + ([] if flatten else STATION_NESTED_KEYS)
    station_type = record_type(
        keys,
        coordinates=record_type(["latitude", "longitude"]),
        operator=record_type(["name", "hotline"]),
        opening_times=record_type(["twentyfourseven"] + ([] if flatten else ["regular_hours"])),
    )
    station = F.col("station")
    place, operator = station["coordinates"], station["operator"]
    opening = station["opening_times"]
    columns = [
        *texts(station, keys, None),
        text_of(place["latitude"]).try_cast("double").alias("latitude"),
        text_of(place["longitude"]).try_cast("double").alias("longitude"),
        text_of(operator["name"], MISSING).alias("operator_name"),
        text_of(operator["hotline"], MISSING).alias("operator_hotline"),
        truthy(opening["twentyfourseven"]).alias("open_24_7"),
    ]
    if not flatten:
        columns.append(text_of(opening["regular_hours"], MISSING).alias("opening_times_expanded"))
    return station_rows(documents, station_type).select(*columns)


def charging_point_master(
    documents: DataFrame, flatten: bool = True, drop_status: bool = True
) -> DataFrame:
    """id_cs and the scalars of each point; absent keys become '-'."""
    keys = POINT_KEYS + ([] if drop_status else ["status"])
    keys += [] if flatten else POINT_NESTED_KEYS
    return point_rows(documents, keys).select("id_cs", *texts(F.col("point"), keys))


def connector_master(documents: DataFrame, drop_status: bool = True) -> DataFrame:
    """id_cp and the scalars of each connector; absent keys become '-'."""
    keys = CONNECTOR_KEYS + ([] if drop_status else ["status"])
    return connector_rows(documents, keys).select("id_cp", *texts(F.col("connector"), keys))


def master_data(
    documents: DataFrame, flatten: bool = True, drop_status: bool = True
) -> tuple[DataFrame, DataFrame, DataFrame]:
    return (
        station_master(documents, flatten),
        charging_point_master(documents, flatten, drop_status),
        connector_master(documents, drop_status),
    )
