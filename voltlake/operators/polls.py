"""Runs and durations over irregular polls of points or connectors.

Polls of an id are put in order day by day: a window holds one id and one day, never an id's whole history.
Days are joined at their borders by a summary of one row for each id and day. Rows of one id and time are
one poll; it counts as active if any of them is.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from voltlake.functions.times import utc_day, utc_time
from voltlake.functions.values import two_digit_share


def polls(facts: DataFrame, id_column: str, active: Column, time: str = "query_time") -> DataFrame:
    """id, day, time, active and, from the id's polls before and after, ``was``, ``will`` and ``until``.

    ``was`` and ``will`` tell if the id was active at the poll before and is at the next one, ``until`` is
    the next one's time; they are null where there is none. One shuffle by id and day serves the
    grouping and the windows.
    """
    single = (
        facts.where(F.col(id_column).isNotNull() & F.col(time).isNotNull())
        .select(F.col(id_column).alias("id"), utc_day(F.col(time)).alias("day"), F.col(time).alias("time"), F.coalesce(active, F.lit(False)).alias("active"))
        .repartition("id", "day")
        .groupBy("id", "day", "time")
        .agg(F.bool_or("active").alias("active"))
    )
    per_day = single.groupBy("id", "day").agg(
        F.min(F.struct("time", "active")).alias("first"), F.max(F.struct("time", "active")).alias("last")
    )
    days = Window.partitionBy("id").orderBy("day")  # a row for each day of the id
    borders = per_day.select(
        F.col("id").alias("of"), F.col("day").alias("on"),
        F.lag("last.active").over(days).alias("was_before"),
        F.lead("first.active").over(days).alias("will_after"),
        F.lead("first.time").over(days).alias("next_day"),
    )
    own = Window.partitionBy("id", "day").orderBy("time")
    inside = single.select(
        "*",
        F.lag("active").over(own).alias("was"),
        F.lead("active").over(own).alias("will"),
        F.lead("time").over(own).alias("until"),
    )
    # Only a day's first and last poll look beyond it.
    edges = inside.where(F.col("was").isNull() | F.col("until").isNull())
    rest = inside.where(F.col("was").isNotNull() & F.col("until").isNotNull())
    joined = edges.join(borders, (F.col("id") == F.col("of")) & (F.col("day") == F.col("on"))).select(
        "id", "day", "time", "active",
        F.coalesce("was", "was_before").alias("was"),
        F.coalesce("will", "will_after").alias("will"),
        F.coalesce("until", "next_day").alias("until"),
    )
    return rest.select(joined.columns).unionByName(joined)


def charging_events(facts: DataFrame, id_column: str, status_column: str, status: str = "CHARGING") -> DataFrame:
    """id, event_start, event_end (its last poll), ended (the poll that found it over, or null) and n_polls of every run of a status.

    Polls are numbered into runs within a day. A run that reaches a day's border is joined with the next
    day's; that window holds an id's border runs only, at most two for each day.
    """
    marked = polls(facts, id_column, F.col(status_column) == status).where("active")
    own = Window.partitionBy("id", "day").orderBy("time")
    begins = F.coalesce(~F.col("was"), F.lit(True))
    runs = (
        marked.withColumn("run", F.sum(begins.cast("int")).over(own))
        .groupBy("id", "day", "run")
        .agg(
            F.min("time").alias("event_start"), F.max("time").alias("event_end"), F.count(F.lit(1)).alias("n_polls"),
            F.max_by(F.when(~F.col("will"), F.col("until")), "time").alias("ended"),
            F.coalesce(F.min_by("was", "time"), F.lit(False)).alias("joined"),
            F.coalesce(F.max_by("will", "time"), F.lit(False)).alias("goes_on"),
        )
    )
    columns = ["id", "event_start", "event_end", "ended", "n_polls"]
    within = runs.where(~F.col("joined") & ~F.col("goes_on")).select(columns)
    border = runs.where(F.col("joined") | F.col("goes_on"))
    in_order = Window.partitionBy("id").orderBy("event_start")
    across = (
        border.withColumn("event", F.sum((~F.col("joined")).cast("int")).over(in_order))
        .groupBy("id", "event")
        .agg(
            F.min("event_start").alias("event_start"), F.max("event_end").alias("event_end"),
            F.max("ended").alias("ended"), F.sum("n_polls").alias("n_polls"),
        )
        .select(columns)
    )
    return within.unionByName(across).withColumnRenamed("id", id_column)


def active_time(
    facts: DataFrame, id_column: str, active: Column, start: str, end: str,
    longest_seconds: int | None = None, look_back_days: int | None = None,
) -> DataFrame:
    """id, active_micros and observed_micros between two times (UTC text).

    A poll's status holds until the id's next poll, the last one's to the end of the period;
    both are clipped to the period. With ``longest_seconds`` no poll counts longer, so that an outage is
    not observed time. Days after the period are not read; the ones before are, for the poll that reaches into
    it, or with ``look_back_days`` only so many of them.
    """
    first, last = F.unix_micros(utc_time(F.lit(start))), F.unix_micros(utc_time(F.lit(end)))
    seen = facts.where(F.col("query_time") < utc_time(F.lit(end)))
    if look_back_days is not None:
        seen = seen.where(F.col("query_time") >= utc_time(F.lit(start)) - F.make_dt_interval(F.lit(look_back_days)))
    began = F.unix_micros("time")
    until = F.coalesce(F.unix_micros("until"), last)
    if longest_seconds is not None:
        until = F.least(until, began + longest_seconds * 1_000_000)
    counted = F.greatest(F.lit(0).cast("long"), F.least(until, last) - F.greatest(began, first))
    return (
        polls(seen, id_column, active)
        .select("id", "active", counted.alias("micros"))
        .groupBy("id")
        .agg(
            F.sum(F.when(F.col("active"), F.col("micros")).otherwise(F.lit(0).cast("long"))).alias("active_micros"),
            F.sum("micros").alias("observed_micros"),
        )
        .withColumnRenamed("id", id_column)
    )


def _shares(observed_by: list[Column]) -> list[Column]:
    """n_points and the times of a group, with their share."""
    active, observed = F.sum("active_micros"), F.sum("observed_micros")
    return [
        *observed_by,
        F.count(F.lit(1)).alias("n_points"),
        (active / 1e6).alias("active_seconds"),
        (observed / 1e6).alias("observed_seconds"),
        F.when(observed > 0, two_digit_share(active.cast("double"), observed.cast("double"))).alias("utilization"),
    ]


def utilization_rollup(
    facts: DataFrame, points: DataFrame, stations: DataFrame, start: str, end: str, status: str = "CHARGING", **bounds: int | None
) -> DataFrame:
    """Share of the observed time in a status, by station, by city of an operator, by operator and in all.

    operator_name, city, id_cs, level (0 a station, 1 a city, 3 an operator, 7 all), n_points, active_seconds,
    observed_seconds and utilization. Time is added up by point before the dimensions are joined, so a hot
    point is one row there. Points without a station count under null names.
    """
    times = active_time(facts, "id_chargingpoint", F.col("status_cp") == status, start, end, **bounds)
    dims = points.select("id_cp", "id_cs").join(stations.select("id_cs", "city", "operator_name"), "id_cs", "left")
    placed = times.join(dims, F.col("id_chargingpoint") == F.col("id_cp"), "left")
    level = F.grouping_id().cast("int").alias("level")
    return placed.rollup("operator_name", "city", "id_cs").agg(*_shares([level]))


def utilization_by_poi(
    facts: DataFrame, points: DataFrame, mapping: DataFrame, poi: DataFrame, start: str, end: str, status: str = "CHARGING", **bounds: int | None
) -> DataFrame:
    """Share of the observed time in a status by what is nearby: poi_category (null: nothing), n_stations, n_points,
    active_seconds, observed_seconds and utilization.

    A station counts once under each category it has a POI of, however many there are.
    """
    times = active_time(facts, "id_chargingpoint", F.col("status_cp") == status, start, end, **bounds)
    near = mapping.join(poi.select("id_poi", "poi_category"), "id_poi").select("id_cs", "poi_category").distinct()
    placed = times.join(points.select("id_cp", "id_cs"), F.col("id_chargingpoint") == F.col("id_cp"), "left")
    return placed.join(near, "id_cs", "left").groupBy("poi_category").agg(
        *_shares([F.count_distinct("id_cs").alias("n_stations")])
    )
