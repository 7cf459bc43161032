"""Near-duplicates by SimHash with an inverted index over byte positions.

Fingerprints of 64 bits are eight positional bytes. Two that differ in at most d bits differ in
at most d bytes, so at least 8 - d positional bytes are shared: the guaranteed minimum. Postings
of single bytes would hold a 256th of the corpus each, so the index is kept for every set of
8 - d positions: a list holds the distinct fingerprints with the same bytes there, and being in
one list is the minimum count: a pair that shares s bytes is in C(s, 8 - d) of these lists, so its
tally reaches 1 when and only when s reaches the minimum. Each pair is kept once, however many lists
tally it, and verified by its differing bits.

A list of more than ``LIST_MAX`` fingerprints isn't paired. Its members agree outside 8d bits,
so each is filed under its bits with every d of those blanked; what then meets differs in no
more than those d bits, at most 2^d fingerprints. This loses no link and emits no square.

Defined cases: a null or wordless text has fingerprint zero and links like any other; texts
shorter than a shingle are one shingle; a null id never names a component unless all are null;
repeated rows are rows of their own; extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voltlake.llm.common import kept_rows, staged, text_digest
from voltlake.llm.components import smallest_reachable

#: Longest list whose members are paired.
LIST_MAX = 64
#: Shingles hashed and tallied at once.
BLOCK = 1 << 16


def fingerprint(text: str | None, shingle: int, seed: int) -> int:
    """Bit i is set if it is set in over half of the shingles' hashes."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(sizes + 1) - 1
    starts = ends - sizes
    n = max(1, len(words) - shingle + 1)
    first, last = starts[:n], ends[-n:]
    ones, digest = np.zeros(64, np.int64), xxhash.xxh64_intdigest
    for at in range(0, n, BLOCK):
        spans = zip(first[at : at + BLOCK].tolist(), last[at : at + BLOCK].tolist(), strict=True)
        hashes = np.array([digest(joined[a:b], seed) for a, b in spans], "<u8")
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > n, bitorder="little").view("<i8")[0])


def fingerprints(
    docs: DataFrame, id_col: str, text_col: str, shingle: int, seed: int, digests: bool
) -> DataFrame:
    """__id, __digest (null unless asked for) and __fp (signed) of every document."""
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [fingerprint(t.as_py(), shingle, seed) for t in batch["__text"]]
            yield pa.RecordBatch.from_arrays(
                [batch["__id"], batch["__digest"], pa.array(found, pa.int64())], ["__id", "__digest", "__fp"]
            )

    text = F.col(text_col)
    digest = text_digest(text) if digests else F.lit(None).cast("string")
    return docs.select(
        F.col(id_col).alias("__id"), digest.alias("__digest"), text.alias("__text")
    ).mapInArrow(run, f"__id {id_type}, __digest string, __fp long")


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def position_sets(max_bits: int) -> list[int]:
    """Masks of the sets of 8 - max_bits byte positions."""
    return [
        sum(255 << (8 * i) for i in range(8) if i not in free)
        for free in combinations(range(8), max_bits)
    ]


def near_pairs(distinct: DataFrame, max_bits: int, list_max: int = LIST_MAX) -> DataFrame:
    """Links (a, b) that connect all distinct fingerprints within ``max_bits`` of each other.

    Lists up to ``list_max`` give every such pair. Of the fingerprints of a longer list that
    differ in the same few bits alone, the smallest is linked to the others.
    """
    spark = distinct.sparkSession
    masks = position_sets(max_bits)
    entries = F.array(
        *[F.struct(F.lit(i).cast("byte").alias("c"), F.col("fp").bitwiseAND(F.lit(_signed(m))).alias("key")) for i, m in enumerate(masks)]
    )
    postings = distinct.select(F.inline(entries), "fp")
    lists = (
        postings.groupBy("c", "key")
        .agg(F.count("*").alias("n"), F.min("fp").alias("a"), F.max("fp").alias("b"))
        .where("n > 1")
    )
    lists = staged(lists, "lists")
    members = staged(postings.join(lists.where("n > 2").select("c", "key", "n"), ["c", "key"]), "members")

    short = members.where(F.col("n") <= list_max)
    paired = (
        short.alias("x").join(short.alias("y"), ["c", "key"])
        .where("x.fp < y.fp").select(F.col("x.fp").alias("a"), F.col("y.fp").alias("b"))
    )
    differing = F.bit_count(F.col("a").bitwiseXOR(F.col("b")))
    pairs = (
        lists.where("n = 2").select("a", "b").unionByName(paired)
        # A tally of 1 is the guaranteed minimum. The verification may come before it, as it is cheap.
        .where(differing <= max_bits)
        .distinct()
    )
    if not max_bits:
        return pairs

    # A fixed table: C(8, d) position sets times C(8d, d) choices of bits.
    blanks = [
        (c, j, _signed(~sum(1 << b for b in bits) & (1 << 64) - 1))
        for c, m in enumerate(masks)
        for j, bits in enumerate(combinations([b for b in range(64) if not m >> b & 1], max_bits))
    ]
    assert len(blanks) == comb(8, max_bits) * comb(8 * max_bits, max_bits)
    table = F.broadcast(spark.createDataFrame(blanks, "c byte, j int, blank long"))
    met = (
        members.where(F.col("n") > list_max)
        .join(table, "c")
        .groupBy("c", "j", F.col("fp").bitwiseAND(F.col("blank")).alias("rest"))
        .agg(F.collect_set("fp").alias("group"))  # at most 2^d members by construction
        .where(F.size("group") > 1)
        .select(F.array_min("group").alias("a"), F.explode("group").alias("b"))
        .where("a < b")
        .distinct()
    )
    return pairs.unionByName(met)


def _components(found: DataFrame, max_bits: int, list_max: int) -> DataFrame:
    """fp, first (the struct of the component's smallest row) of every distinct fingerprint."""
    per_print = staged(
        found.groupBy(F.col("__fp").alias("fp")).agg(
            F.min(F.struct(F.col("__id").isNull(), "__id", "__row")).alias("first")
        ),
        "prints",
    )
    linked = smallest_reachable(near_pairs(per_print.select("fp"), max_bits, list_max))
    rooted = per_print.join(linked, per_print["fp"] == linked["node"], "left").select(
        "fp", F.coalesce("root", "fp").alias("root"), F.col("root").isNotNull().alias("linked"), "first"
    )
    rooted = staged(rooted, "rooted")
    # Written, so that the join is one of two plain shuffles, of which a large component can be split.
    firsts = staged(rooted.where("linked").groupBy("root").agg(F.min("first").alias("least")), "firsts")
    return rooted.join(firsts.hint("merge"), "root", "left").select("fp", F.coalesce("least", "first").alias("first"))


def _grouped(docs, id_col, text_col, shingle, max_bits, seed, list_max, digests) -> DataFrame:
    found = fingerprints(docs, id_col, text_col, shingle, seed, digests)
    found = staged(found.withColumn("__row", F.monotonically_increasing_id()), "fingerprints")
    groups = _components(found, max_bits, list_max)
    return found.join(groups, found["__fp"] == groups["fp"])


def simhash_groups(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle: int = 3,
    max_bits: int = 2,
    seed: int = 42,
    list_max: int = LIST_MAX,
) -> DataFrame:
    """One row per document: id, fingerprint (16 hex digits), component_id."""
    return _grouped(docs, id_col, text_col, shingle, max_bits, seed, list_max, False).select(
        F.col("__id").alias(id_col),
        F.lower(F.lpad(F.hex("__fp"), 16, "0")).alias("fingerprint"),
        F.col("first.__id").alias("component_id"),
    )


def without_near_duplicates(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle: int = 3,
    max_bits: int = 2,
    seed: int = 42,
) -> DataFrame:
    """The rows of ``docs``, all columns, of which one stays for each component."""
    grouped = _grouped(docs, id_col, text_col, shingle, max_bits, seed, LIST_MAX, True)
    stays = F.col("first.__row") == F.col("__row")
    verdicts = grouped.select("__id", "__digest", stays.alias("__stays"))
    return kept_rows(docs, verdicts, id_col, text_digest(F.col(text_col)))
