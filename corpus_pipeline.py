"""Five stages from raw documents to a training mix. Each is written as Parquet and read again."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voltlake.llm.common import read_table, staged
from voltlake.llm.decontaminate import without_contaminated
from voltlake.llm.exact_dedup import without_exact_duplicates
from voltlake.llm.mixing import mixed_rows
from voltlake.llm.quality import fit_quality, held_out, score_quality
from voltlake.llm.simhash import without_near_duplicates

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

#: Least probability of good quality that a document needs to stay.
THRESHOLD = 0.7


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go."""
    learnable = ~held_out() & F.col("doc_id").isNotNull()
    network = fit_quality(docs, read_table(spark, sf_dir, "labels"), learnable)
    if network is None:
        return docs
    # The rows travel in a struct, so their columns may have any names.
    scored = score_quality(docs.select(F.struct("*").alias("row"), "text"), network, score_col="quality")
    return scored.where(F.col("quality") >= THRESHOLD).select("row.*")


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the one with the smallest id stays."""
    return without_exact_duplicates(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates the document with the smallest id stays."""
    return without_near_duplicates(docs, shingle=3, max_bits=2)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a passage of the benchmark go."""
    return without_contaminated(docs, read_table(spark, sf_dir, "benchmark"), window=10)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the mix takes, with how often (mix_times) and their words (mix_words)."""
    return mixed_rows(docs)


STAGES: list[tuple[str, Stage]] = [
    ("quality classifier", good_quality),
    ("exact dedup", exact_dedup),
    ("SimHash near-dedup", near_dedup),
    ("benchmark decontamination", decontaminate),
    ("mixing sources", mix_sources),
]

#: The classifier and the draw are beyond SQL; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
