"""What several operators of this subpackage share."""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from voltlake.runtime import scratch_path

#: White space of the contracts: blank, tab, line feed, vertical tab, form feed, return.
SPACES = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def staged(df: DataFrame, name: str, partition_by: list[str] | None = None) -> DataFrame:
    """``df`` written once to the shared folder and read again.

    Later jobs read the files, so a lost executor costs retries only, and expressions that
    number rows keep their values.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    writer = df.write.partitionBy(*partition_by) if partition_by else df.write
    writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def ascii_lower(text: Column) -> Column:
    """A-Z lower-cased, all other characters kept."""
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def null_safe(left: DataFrame, right: DataFrame, names: list[str]) -> Column:
    """Equality of the named columns in which null equals null."""
    on = F.lit(True)
    for name in names:
        on = on & left[name].eqNullSafe(right[name])
    return on


def text_digest(text: Column) -> Column:
    return F.sha2(F.encode(F.coalesce(text, F.lit("")), "UTF-8"), 256)


def kept_rows(docs: DataFrame, verdicts: DataFrame, id_col: str, digest: Column) -> DataFrame:
    """Rows of ``docs`` that stay, by verdicts of __id, __digest and __stays, one for each row.

    The rows travel in one struct, so their own columns may have any names. Rows are found again by id and digest, wherever they are read; only keys that are dropped or
    that repeat are looked up. Of rows with one key, at most one stays. The texts are shuffled once at
    every size of the input: the keys to look up grow with it, so they are not broadcast.
    """
    special = (
        verdicts.groupBy("__id", "__digest")
        .agg(F.count("*").alias("__n"), F.max("__stays").alias("__stays"))
        .where("__n > 1 or not __stays")
    )
    special = staged(special, "special")
    keyed = docs.select(F.struct("*").alias("row"), F.col(id_col).alias("__id"), digest.alias("__digest"))
    marked = keyed.join(special.hint("merge"), null_safe(keyed, special, ["__id", "__digest"]), "left").select(
        "row", keyed["__id"], keyed["__digest"], "__n", "__stays"
    )
    once = marked.where(F.col("__n").isNull())
    repeated = marked.where("__stays").dropDuplicates(["__id", "__digest"])
    return once.unionByName(repeated).select("row.*")
