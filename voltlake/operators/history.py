"""History of master data: intervals in which a record's attributes stayed the same."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from voltlake.functions.times import utc_day

#: What a history has beside the id and the attributes.
INTERVAL = ["valid_from", "valid_to", "last_seen", "attribute_hash"]


def attribute_hash(attributes: list[str]):
    """Tells states apart; null is a value of its own."""
    return F.sha2(F.to_json(F.struct(*attributes), {"ignoreNullFields": "false"}).cast("binary"), 256)


def _changes(states: DataFrame, id_column: str, partition: list[str]) -> DataFrame:
    """Neighbouring rows of one state become one, from its first time to its last."""
    own = Window.partitionBy(*partition).orderBy("time")
    before = F.lag("attribute_hash").over(own)
    numbered = states.withColumn("changed", ~before.eqNullSafe(F.col("attribute_hash"))).withColumn(
        "state", F.sum(F.col("changed").cast("int")).over(own)
    )
    return numbered.groupBy(*partition, "state").agg(
        F.min("time").alias("time"), F.max("seen").alias("seen"),
        F.first("attribute_hash").alias("attribute_hash"), F.first("attributes").alias("attributes"),
    ).drop("state")


def intervals(rows: DataFrame, id_column: str, time: str, attributes: list[str]) -> DataFrame:
    """id, attributes and INTERVAL: one row for each stretch in which an id's attributes stayed the same.

    An interval runs from the first time a state was seen to the first time the next one was; the open one has
    no end. Rows of one id and time that differ: the one with the largest hash counts. Days are
    reduced to their changes first, so a window over an id's history has a row for each day and change only.
    """
    named = F.struct(*attributes)
    single = (
        rows.where(F.col(id_column).isNotNull() & F.col(time).isNotNull())
        .select(
            F.col(id_column).alias("id"), utc_day(F.col(time)).alias("day"), F.col(time).alias("time"),
            F.struct(attribute_hash(attributes).alias("hash"), named.alias("attributes")).alias("state"),
        )
        .repartition("id", "day")
        .groupBy("id", "day", "time")
        .agg(F.max_by("state", "state.hash").alias("state"))
        .select("id", "day", "time", F.col("time").alias("seen"), F.col("state.hash").alias("attribute_hash"), F.col("state.attributes").alias("attributes"))
    )
    return _intervals(_changes(single, "id", ["id", "day"]).drop("day"), id_column)


def _intervals(states: DataFrame, id_column: str) -> DataFrame:
    merged = _changes(states, "id", ["id"])
    following = F.lead("time").over(Window.partitionBy("id").orderBy("time"))
    return merged.select(
        F.col("id").alias(id_column), "attributes.*", F.col("time").alias("valid_from"),
        following.alias("valid_to"), F.col("seen").alias("last_seen"), "attribute_hash",
    )


def extend_history(known: DataFrame, rows: DataFrame, id_column: str, time: str, attributes: list[str]) -> DataFrame:
    """``known`` with later rows: an unchanged state stays open, a changed one ends the open interval and begins the next.

    Only ids among the new rows are merged; the intervals of others are handed on. A row that comes late, for
    a time before the open interval, splits what was known there: a known interval stands for its
    first and its last sighting.
    """
    fresh = intervals(rows, id_column, time, attributes)
    touched = fresh.select(id_column).distinct()
    same = known.join(touched, id_column, "left_anti")
    named = F.struct(*attributes).alias("attributes")
    states = known.join(touched, id_column, "left_semi").unionByName(fresh).select(
        F.col(id_column).alias("id"), "attribute_hash", named, F.explode(F.array_distinct(F.array("valid_from", "last_seen"))).alias("time")
    )
    single = states.groupBy("id", "time").agg(F.max(F.struct("attribute_hash", "attributes")).alias("s"))
    moved = single.select("id", "time", F.col("time").alias("seen"), "s.attribute_hash", "s.attributes")
    return same.unionByName(_intervals(moved, id_column).select(same.columns))
