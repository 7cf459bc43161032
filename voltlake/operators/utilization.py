"""Questions of the utilization view, for all ids at once or for one."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from voltlake.functions.values import status_number, two_digit_share


def of_id(df: DataFrame, column: str, value) -> DataFrame:
    """Rows of one id; a literal filter that Parquet scans push down."""
    return df.where(F.col(column) == F.lit(value))


def status_series(facts: DataFrame, id_column: str, status_column: str) -> DataFrame:
    """id, query_time, status and its number."""
    return facts.select(
        id_column,
        "query_time",
        F.col(status_column).alias("status"),
        status_number(F.col(status_column)).alias("status_num"),
    )


def point_series(facts: DataFrame, id_cp: str | None = None) -> DataFrame:
    chosen = facts if id_cp is None else of_id(facts, "id_chargingpoint", id_cp)
    return status_series(chosen, "id_chargingpoint", "status_cp")


def connector_series(facts: DataFrame, id_connector: str | None = None) -> DataFrame:
    chosen = facts if id_connector is None else of_id(facts, "id_connector", id_connector)
    return status_series(chosen, "id_connector", "status_connector")


def status_share(facts: DataFrame, id_column: str, status_column: str) -> DataFrame:
    """id, status, n, share; rows without a status are not counted.

    Counts are reduced before the shuffle. The window then runs over one row per id and
    status, already partitioned by id.
    """
    counts = (
        facts.where(F.col(status_column).isNotNull())
        .groupBy(id_column, F.col(status_column).alias("status"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    whole = F.sum("n").over(Window.partitionBy(id_column))
    return counts.withColumn("share", two_digit_share(F.col("n"), whole))


def most_frequent_first(shares: DataFrame, id_column: str) -> DataFrame:
    return shares.orderBy(id_column, F.desc("n"), "status")


def station_header(stations: DataFrame, id_cs: int | None = None) -> DataFrame:
    """Heading of each station; of one station the first row."""
    columns = ["id_cs", "operator_name", "address", "postal_code", "city"]
    if id_cs is None:
        return stations.select(*columns)
    return of_id(stations, "id_cs", id_cs).select(*columns).limit(1)


def station_positions(stations: DataFrame, id_cs: int | None = None) -> DataFrame:
    chosen = stations if id_cs is None else of_id(stations, "id_cs", id_cs)
    return chosen.select("id_cs", "latitude", "longitude")


def points_of_station(points: DataFrame, stations: DataFrame) -> DataFrame:
    """Charging points with the station they belong to."""
    return points.join(stations.select("id_cs", "name"), "id_cs").select(
        "id_cs", "name", "id_cp", "vehicle_type"
    )


def connectors_of_point(connectors: DataFrame, id_cp: str | None = None) -> DataFrame:
    return connectors if id_cp is None else of_id(connectors, "id_cp", id_cp)


def drilldown(
    stations: DataFrame, points: DataFrame, connectors: DataFrame, facts: DataFrame
) -> DataFrame:
    """station -> point -> connector -> status.

    The dimensions are joined first. Their ids are unique, so a hot connector repeats on the
    fact side only, which a broadcast or an adaptive skew split takes.
    """
    dims = (
        connectors.select("id_connector", "id_cp", "max_power")
        .join(points.select("id_cp", "id_cs"), "id_cp")
        .join(stations.select("id_cs", "city"), "id_cs")
    )
    return facts.select("id_connector", "query_time", "status_connector").join(
        dims, "id_connector"
    )
