"""Bounded, repeatable training samples."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def crc_bucket(id_col: str, n: int) -> Column:
    """crc32 of the id as text, modulo ``n``; null for a null id."""
    return F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(n))


def bounded_sample(rows: DataFrame, group: str, key: Column, most: int) -> DataFrame:
    """At most ``most`` rows of each value of ``group``, chosen by the key's hash.

    Groups are counted first and thinned to about twice the bound where they stand, so the
    ranking that makes the bound exact sees few rows, however large a group is.
    """
    ticks = 1 << 40
    counts = rows.groupBy(group).agg(F.count("*").alias("__n")).withColumnRenamed(group, "__group")
    tick = F.pmod(F.xxhash64(key, F.lit("sample")), F.lit(ticks))
    thinned = (
        rows.withColumn("__tick", tick)
        # A row for each group, of which each gets a model: broadcast, so that the rows of a large
        # group are thinned where they stand and not dealt by group first.
        .join(F.broadcast(counts), F.col(group) == F.col("__group"))
        .where(F.col("__tick") < F.lit(2.0 * most * ticks) / F.col("__n"))
    )
    order = Window.partitionBy(group).orderBy("__tick", key)
    return (
        thinned.withColumn("__rank", F.row_number().over(order))
        .where(F.col("__rank") <= most)
        .drop("__n", "__group", "__tick", "__rank")
    )
