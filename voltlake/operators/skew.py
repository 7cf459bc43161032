"""Equi-join that survives hot keys on either side."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Pairs that one task is meant to test.
PAIRS_PER_TASK = 5_000_000


def key_pieces(left: DataFrame, right: DataFrame, keys: list[str], pairs: int) -> DataFrame:
    """*keys, n_left, n_right: into how many pieces each side of a key is cut.

    Only keys with more than ``pairs`` pairs of rows are listed, so that every combination of a
    left with a right piece has about that many. Both sides are counted in one partial aggregate,
    and the side with more rows gets more pieces, which keeps the copies few.
    """
    sides = left.select(*keys, F.lit(1).alias("l"), F.lit(0).alias("r")).unionByName(
        right.select(*keys, F.lit(0).alias("l"), F.lit(1).alias("r"))
    )
    counts = sides.groupBy(*keys).agg(F.sum("l").alias("l"), F.sum("r").alias("r"))
    needed = F.ceil(F.col("l").cast("double") * F.col("r") / pairs)
    n_left = F.least(F.col("l"), F.greatest(F.lit(1), F.ceil(F.sqrt(F.col("needed") * F.col("l") / F.col("r")))))
    n_right = F.least(F.col("r"), F.ceil(F.col("needed") / F.col("n_left")))
    return (
        counts.where((F.col("l") > 0) & (F.col("r") > 0))
        .withColumn("needed", needed)
        .where("needed > 1")
        .withColumn("n_left", n_left.cast("int"))
        .withColumn("n_right", n_right.cast("int"))
        .select(*keys, "n_left", "n_right")
    )


def skew_join(
    left: DataFrame,
    right: DataFrame,
    keys: list[str],
    condition: Column,
    *,
    left_id: str,
    right_id: str,
    pairs_per_task: int = PAIRS_PER_TASK,
) -> DataFrame:
    """Inner join on ``keys`` and ``condition``, hot keys cut into pieces on both sides.

    A row of a hot key gets one of its own side's salts by its id and is copied to every salt of
    the other side, so each pair of rows meets exactly once. Rows of other keys get salt 0 and no
    copy. Keys are hot by the pairs they make, not by their rows. Nothing runs before an action, and
    which side is broadcast, if any, is left to Spark's size checks. The condition is tested
    inside the join; no candidate pair is written out.
    """
    hot = key_pieces(left, right, keys, pairs_per_task)

    def salted(df: DataFrame, own: str, other: str, row_id: str, own_salt: str, other_salt: str):
        spread = df.join(hot, keys, "left")
        n_own, n_other = (F.coalesce(F.col(c), F.lit(1)) for c in (own, other))
        return (
            spread.withColumn(own_salt, F.pmod(F.xxhash64(row_id), n_own).cast("int"))
            .withColumn(other_salt, F.explode(F.sequence(F.lit(0), n_other - 1)))
            .drop("n_left", "n_right")
        )

    a = salted(left, "n_left", "n_right", left_id, "salt_left", "salt_right").alias("a")
    b = salted(right, "n_right", "n_left", right_id, "salt_right", "salt_left").alias("b")
    on = [F.col(f"a.{k}") == F.col(f"b.{k}") for k in [*keys, "salt_left", "salt_right"]]
    rest = [F.col(f"b.{c}") for c in right.columns if c not in keys]
    columns = [*[F.col(f"a.{c}") for c in left.columns], *rest]
    return a.join(b, [*on, condition]).select(*columns)
