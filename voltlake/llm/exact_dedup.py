"""Exact deduplication by recipes of content-defined chunks, in DataFrame functions only.

A normalised text is cut where its own characters say so. Its recipe is the ordered list of
its chunks' identifiers. Texts whose recipes of chunk hashes differ are different, so only
documents that share a recipe have their chunks compared: each distinct chunk of those travels
once, map-side duplicates removed first, and an identifier that stands for two different chunks
is split. Then equal lists mean equal texts, and documents are grouped by short lists, however
long their texts are.

Defined cases: a null text counts as empty, empty texts equal each other; a null id comes after
all others; of repeated rows with one id exactly one stays; other columns, whatever their
names, are left alone; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from voltlake.llm.common import SPACES, kept_rows, null_safe, staged

#: Shortest and longest chunk, in characters.
CHUNK_MIN, CHUNK_MAX = 1024, 8192


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), SPACES, " ")


def chunks_of(text: Column, least: int = CHUNK_MIN, most: int = CHUNK_MAX) -> Column:
    """Pieces that make up the text, cut after a blank that follows one of eight letters.

    A cut depends on the text around it alone. Without such a place the longest piece is taken.
    """
    pattern = rf"(?s).{{{least},{most}}}?(?<=[a-h]\x20)|.{{1,{most}}}"
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(0))


def chunk_hash(chunk: Column, bits: int) -> Column:
    hashed = F.xxhash64(chunk)
    return hashed if bits >= 64 else F.pmod(hashed, F.lit(1 << bits))


def _with_recipe(docs: DataFrame, text: str, least: int, most: int, bits: int) -> DataFrame:
    return (
        docs.withColumn("__text", normalised(F.col(text)))
        .withColumn("__chunks", chunks_of(F.col("__text"), least, most))
        .withColumn("__recipe", F.transform("__chunks", lambda c: chunk_hash(c, bits)))
    )


def _split_identifiers(recipes: DataFrame, chunks: DataFrame, parts: DataFrame) -> DataFrame:
    """Recipes in which a hash shared by different chunks is followed by the chunk's number.

    Runs only where hashes clash. ``parts`` has the chunks of documents that share a recipe.
    """
    clashing = chunks.groupBy("hash").agg(F.count("*").alias("n")).where("n > 1").select("hash")
    numbered = chunks.join(clashing, "hash", "left_semi").withColumn(
        "number", F.row_number().over(Window.partitionBy("hash").orderBy("chunk")).cast("long")
    )
    lists = (
        parts.join(numbered, ["hash", "chunk"], "left")
        .groupBy("__id", "__sha")
        .agg(F.sort_array(F.collect_set(F.struct("pos", "hash", F.coalesce("number", F.lit(0))))).alias("p"))
        .select("__id", "__sha", F.expr("flatten(transform(p, x -> array(x.hash, x.col3)))").alias("exact"))
    )
    return recipes.join(lists, null_safe(recipes, lists, ["__id", "__sha"]), "left").select(
        recipes["__id"], recipes["__sha"], "__row",
        # Lists of the two kinds never mix: those that share a recipe are all of one kind.
        F.coalesce("exact", "__recipe").alias("__recipe"),
    )


def _shared(recipes: DataFrame) -> DataFrame:
    """__recipe, n, first of every recipe that documents share.

    A written table, so that a join with it is one of two shuffles, whose hot keys Spark can split.
    """
    first = F.min(F.struct(F.col("__id").isNull(), "__id", "__row"))
    groups = recipes.groupBy("__recipe").agg(F.count("*").alias("n"), first.alias("first"))
    return staged(groups.where("n > 1"), "groups")


def _verdicts(
    docs: DataFrame, id_col: str, text_col: str, chunk_min: int, chunk_max: int, hash_bits: int
) -> DataFrame:
    """__id, __sha, __row of every document with n and first of its group (null if alone)."""
    source = docs.select(F.col(id_col).alias("__id"), F.col(text_col).alias("__source"))
    cut = _with_recipe(source, "__source", chunk_min, chunk_max, hash_bits).withColumn(
        "__sha", F.sha2(F.encode("__text", "UTF-8"), 256)
    )
    recipes = staged(
        cut.select("__id", "__sha", F.monotonically_increasing_id().alias("__row"), "__recipe"),
        "recipes",
    )
    groups = _shared(recipes)
    parts = (
        cut.join(groups, "__recipe", "left_semi")
        .select("__id", "__sha", F.posexplode("__chunks").alias("pos", "chunk"))
        .withColumn("hash", chunk_hash(F.col("chunk"), hash_bits))
    )
    chunks = parts.select("hash", "chunk").distinct()
    clash = chunks.groupBy("hash").agg(F.count("*").alias("n")).where("n > 1")
    if not clash.isEmpty():
        recipes = staged(_split_identifiers(recipes, staged(chunks, "chunks"), parts), "identified")
        groups = _shared(recipes)
    alone = F.col("n").isNull()
    stays = alone | (F.col("first.__row") == F.col("__row"))
    return recipes.join(groups, "__recipe", "left").withColumn("__stays", stays)


def exact_duplicates(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    chunk_min: int = CHUNK_MIN,
    chunk_max: int = CHUNK_MAX,
    hash_bits: int = 64,
) -> DataFrame:
    """One row per document: id, keep_id, group_size, kept, text_sha256."""
    return _verdicts(docs, id_col, text_col, chunk_min, chunk_max, hash_bits).select(
        F.col("__id").alias(id_col),
        F.when(F.col("n").isNull(), F.col("__id")).otherwise(F.col("first.__id")).alias("keep_id"),
        F.coalesce("n", F.lit(1)).cast("long").alias("group_size"),
        F.col("__stays").alias("kept"),
        F.col("__sha").alias("text_sha256"),
    )


def without_exact_duplicates(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns."""
    verdicts = _verdicts(docs, id_col, text_col, CHUNK_MIN, CHUNK_MAX, 64).select(
        "__id", F.col("__sha").alias("__digest"), "__stays"
    )
    digest = F.sha2(F.encode(normalised(F.col(text_col)), "UTF-8"), 256)
    return kept_rows(docs, verdicts, id_col, digest)
