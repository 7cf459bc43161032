"""Ranked lexical search: the best documents of each query by exact integer scores.

A document is a vector of impacts, one coordinate for each term that a query has; a query is the set of
its terms; the score is their inner product. Vectors are ordered by length and cut into buckets of
similar length. For a query and a bucket, with the score that the query's k-th best document has so far:

- the bucket is left out if the longest vector cannot reach that score (Cauchy-Schwarz), nor the sum
  of the largest values its coordinates have;
- inside, the coordinates that matter most are added up for each document, the others are bounded by
  their largest values in the bucket and by the length that is left (Cauchy-Schwarz again);
- the documents whose bound reaches the score are scored anew from all their coordinates, in integers.

No bound cuts a document that belongs to the result, so the result is exact.

Two layers of buckets follow each other: the longest vectors of the whole table first, for
scores to start from, then all others. Within a layer each task has its own buckets, longest first, and hands on
its best ``k`` documents a query, so vectors are neither shuffled nor brought together, whatever
documents are equal. Queries are read in blocks of a bounded number of terms; every block meets all
documents.

Defined cases: a null or empty text has no terms and is no document of the corpus; a query
without terms, or without a document that has one of them, gives no rows; each row of the queries is a
query, also if its id repeats or is null; each row of the documents is a document; equal scores
rank by id, null ids last; texts are read whole, in slices; extra columns are ignored, whatever their names.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from voltlake.llm.common import ascii_lower, staged

#: A term: digits, letters and everything beyond ASCII.
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
#: The same of lower-cased UTF-8.
TERM_BYTES = re.compile(rb"[0-9a-z\x80-\xff]+")
GAP = re.compile(rb"[^0-9a-z\x80-\xff]")
SLICE = 1 << 20
#: Terms of queries that are looked for at once, on average.
BLOCK_TERMS = 200_000
#: Vectors in a bucket, and how much shorter than its longest one the others may be.
BUCKET, SHORTER = 2048, 0.5
#: Share of the documents in the layer of the longest vectors.
FIRST = 0.02
#: Bounds are floats; they are taken a little larger than they come out.
SLACK = 1 + 1e-9


class Query(NamedTuple):
    number: int
    terms: np.ndarray  # numbers of the block's terms
    floor: int  # score that a document needs; 0 if none is known


class Bucket:
    """Impact vectors by row and by coordinate."""

    def __init__(self, starts: np.ndarray, terms: np.ndarray, impacts: np.ndarray, lengths: np.ndarray, n_terms: int):
        self.starts, self.terms, self.impacts, self.lengths = starts, terms, impacts, lengths
        rows = np.repeat(np.arange(len(lengths)), np.diff(starts))
        order = np.argsort(terms, kind="stable")
        self.rows, self.values = rows[order], impacts[order].astype(np.float64)
        counts = np.bincount(terms, minlength=n_terms)
        self.ends = np.cumsum(counts)
        self.begins = self.ends - counts
        self.most = np.zeros(n_terms)
        met = counts > 0
        if met.any():
            self.most[met] = np.maximum.reduceat(self.values, self.begins[met])
        self.longest = float(lengths.max(initial=0.0))

    def candidates(self, terms: np.ndarray, floor: int) -> np.ndarray:
        """Rows that may reach ``floor``, or any score above 0 if it is 0."""
        present = terms[self.most[terms] > 0]
        if not len(present):
            return present
        most = self.most[present]
        if min(self.longest * len(present) ** 0.5, most.sum()) * SLACK < floor:
            return present[:0]
        order = np.argsort(-most, kind="stable")
        # What the coordinates from a place on can add at most. As many are added up as it takes to
        # leave less than half of the floor open.
        open_ = np.append(np.cumsum(most[order][::-1])[::-1], 0.0)
        n = int(np.argmax(open_ <= 0.5 * floor)) if floor else len(order)
        focus = present[order[:n]]
        spans = [slice(self.begins[t], self.ends[t]) for t in focus]
        rows = np.concatenate([self.rows[s] for s in spans]) if spans else np.empty(0, np.int64)
        values = np.concatenate([self.values[s] for s in spans]) if spans else np.empty(0)
        size = len(self.lengths)
        added = np.bincount(rows, values, size)
        left = np.sqrt(np.maximum(self.lengths**2 * SLACK - np.bincount(rows, values**2, size), 0.0))
        bound = added + np.minimum(left * (len(order) - n) ** 0.5, open_[n])
        return np.flatnonzero((bound * SLACK >= floor) & (bound > 0))

    def scores(self, rows: np.ndarray, wanted: np.ndarray) -> np.ndarray:
        """Exact scores of rows; ``wanted`` tells the query's terms."""
        sizes = self.starts[rows + 1] - self.starts[rows]
        ends = np.cumsum(sizes)
        at = np.arange(ends[-1]) + np.repeat(self.starts[rows] - (ends - sizes), sizes)
        sums = np.concatenate([[0], np.cumsum(np.where(wanted[self.terms[at]], self.impacts[at], 0))])
        return sums[ends] - sums[ends - sizes]


class Best:
    """The best ``k`` documents of a query so far."""

    def __init__(self, k: int, floor: int):
        self.k, self.floor, self.found = k, floor, []

    def take(self, scores: np.ndarray, rows: np.ndarray, ids: list) -> None:
        good = scores >= max(self.floor, 1)
        scores, rows = scores[good], rows[good]
        if len(scores) > self.k:
            last = np.partition(scores, -self.k)[-self.k]
            scores, rows = scores[scores >= last], rows[scores >= last]
        if not len(scores):
            return
        self.found += [(-int(s), ids[r] is None, ids[r]) for s, r in zip(scores, rows, strict=True)]
        self.found = sorted(self.found, key=lambda f: f[:2] if f[1] else f)[: self.k]
        if len(self.found) == self.k:
            self.floor = max(self.floor, -self.found[-1][0])


def terms_in(text: bytes, known: dict[bytes, int]) -> tuple[int, Counter]:
    """Number of all terms, and how often each known one occurs."""
    n, counts, at, lowered = 0, Counter(), 0, text.lower()  # of bytes, lower() changes A-Z alone
    while at < len(lowered):
        gap = GAP.search(lowered, at + SLICE) if at + SLICE < len(lowered) else None
        end = gap.start() if gap else len(lowered)
        found = TERM_BYTES.findall(lowered, at, end)
        n += len(found)
        counts.update(filter(known.__contains__, found))
        at = end
    return n, counts


def count_terms(docs: DataFrame, known: dict[bytes, int], id_col: str, text_col: str) -> DataFrame:
    """id, n, terms, tfs of every document with a term; the terms are those of ``known``."""
    rows = docs.select(F.col(id_col).alias("id"), F.encode(F.coalesce(text_col, F.lit("")), "UTF-8").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept, sizes, terms, tfs = [], [], [], []
            for row, text in enumerate(batch["text"]):
                n, counts = terms_in(text.as_py(), known)
                if n:
                    kept.append(row)
                    sizes.append(n)
                    terms.append([known[t] for t in counts])
                    tfs.append(list(counts.values()))
            columns = [batch["id"].take(pa.array(kept, pa.int64())), pa.array(sizes, pa.int64())]
            columns += [pa.array(terms, pa.list_(pa.int32())), pa.array(tfs, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(columns, ["id", "n", "terms", "tfs"])

    id_type = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(run, f"id {id_type}, n long, terms array<int>, tfs array<long>")


def impact_vectors(counted: DataFrame, weights: np.ndarray, n_docs: int, n_all: int) -> DataFrame:
    """id, terms, impacts, length of the documents with a known term."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            starts, terms = offsets_of(batch["terms"])
            tf = batch["tfs"].flatten().to_numpy()
            # Python's integers do not run over, however large the corpus is.
            m = [10 + 90 * n * n_docs // n_all for n in batch["n"].to_pylist()]
            per_term = np.repeat(np.array(m, np.int64), np.diff(starts))
            impacts = weights[terms] * (1_000_000_000 * tf // (1000 * tf + 8 * per_term))
            squares = impacts.astype(np.float64) ** 2
            # Each row has a term. Sums of their own, as differences of running sums lose digits.
            lengths = np.sqrt(np.add.reduceat(squares, starts[:-1])) if len(squares) else np.empty(0)
            yield pa.RecordBatch.from_arrays(
                [
                    batch["id"],
                    batch["terms"],
                    pa.ListArray.from_arrays(pa.array(starts, pa.int32()), pa.array(impacts, pa.int64())),
                    pa.array(lengths, pa.float64()),
                ],
                ["id", "terms", "impacts", "length"],
            )

    id_type = counted.schema["id"].dataType.simpleString()
    return counted.where("size(terms) > 0").mapInArrow(run, f"id {id_type}, terms array<int>, impacts array<long>, length double")


def offsets_of(lists: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
    """Where each list starts, from 0, and all values."""
    sizes = lists.value_lengths().to_numpy(zero_copy_only=False)
    return np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64), lists.flatten().to_numpy(zero_copy_only=False)


def buckets_of(batch: pa.RecordBatch, n_terms: int) -> Iterator[tuple[Bucket, list]]:
    """Buckets of the batch's vectors, with their ids, longest first."""
    starts, terms = offsets_of(batch["terms"])
    impacts, lengths = batch["impacts"].flatten().to_numpy(), batch["length"].to_numpy()
    at = 0
    while at < len(lengths):
        shorter = np.flatnonzero(lengths[at : at + BUCKET] < SHORTER * lengths[at])
        end = min(at + BUCKET, len(lengths))
        if len(shorter) and shorter[0] >= BUCKET // 16:
            end = at + int(shorter[0])
        a, b = starts[at], starts[end]
        bucket = Bucket(starts[at : end + 1] - a, terms[a:b], impacts[a:b], lengths[at:end], n_terms)
        yield bucket, batch["id"].slice(at, end - at).to_pylist()
        at = end


def search_layer(vectors: DataFrame, queries: list[Query], n_terms: int, k: int) -> DataFrame:
    """query, id, score: of each task the best ``k`` documents of each query."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = [Best(k, q.floor) for q in queries]
        id_type, wanted = None, np.zeros(n_terms, bool)
        for batch in batches:
            id_type = batch.schema.field("id").type
            for bucket, ids in buckets_of(batch, n_terms):
                for query, own in zip(queries, best, strict=True):
                    rows = bucket.candidates(query.terms, own.floor)
                    if len(rows):
                        wanted[query.terms] = True
                        own.take(bucket.scores(rows, wanted), rows, ids)
                        wanted[query.terms] = False
        out = [(q.number, f[2], -f[0]) for q, own in zip(queries, best, strict=True) for f in own.found]
        if out:
            numbers, ids, scores = zip(*out)
            yield pa.RecordBatch.from_arrays(
                [pa.array(numbers, pa.int64()), pa.array(ids, id_type), pa.array(scores, pa.int64())], ["query", "id", "score"]
            )

    id_type = vectors.schema["id"].dataType.simpleString()
    ordered = vectors.sortWithinPartitions(F.desc("length"))
    return ordered.mapInArrow(run, f"query long, id {id_type}, score long")


def best_of(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("id"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def first_layer(vectors: DataFrame, share: float) -> float:
    """Length from which on about ``share`` of the vectors are, by a histogram of the lengths' logarithms."""
    step = 16.0
    bins = vectors.groupBy(F.floor(F.log2(F.greatest("length", F.lit(1.0))) * step).alias("bin")).agg(F.count("*").alias("n"))
    counted = sorted(((r["bin"], r["n"]) for r in bins.collect()), reverse=True)  # a row for each bin: some hundreds
    most, so_far = share * sum(n for _, n in counted), 0
    for bin_, n in counted:
        so_far += n
        if so_far >= most:
            return 2.0 ** (bin_ / step)
    return 0.0


def search_block(docs: DataFrame, block: list, *, k: int, id_col: str, text_col: str) -> DataFrame:
    """query, id, score, rank for the queries (number, terms) of a block."""
    names = sorted({t for _, terms in block for t in terms})
    known = {t.encode("utf-8", "surrogatepass"): i for i, t in enumerate(names)}
    place = {t: i for i, t in enumerate(names)}
    counted = staged(count_terms(docs, known, id_col, text_col), "term_counts")
    n_docs, n_all = counted.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    df = F.col("df").cast("double")
    weighed = (
        counted.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count("*").alias("df"))
        .select("term", F.floor(F.lit(1000.0) * F.log(F.lit(2.0 * n_docs + 2) / (2 * df + 1))).alias("weight"))
    )
    weights = np.zeros(max(1, len(names)), np.int64)
    for row in weighed.collect():  # terms of the block's queries only
        weights[row["term"]] = row["weight"]
    vectors = staged(impact_vectors(counted, weights, n_docs, n_all), "impacts")
    queries = [Query(number, np.array([place[t] for t in terms], np.int64), 0) for number, terms in block]
    cut = first_layer(vectors, FIRST)
    long = staged(best_of(search_layer(vectors.where(F.col("length") >= cut), queries, len(weights), k), k), "long")
    floors = {r["query"]: r["score"] for r in long.where(F.col("rank") == k).select("query", "score").collect()}
    queries = [q._replace(floor=floors.get(q.number, 0)) for q in queries]
    others = search_layer(vectors.where(F.col("length") < cut), queries, len(weights), k)
    return best_of(long.drop("rank").unionByName(others), k)


def search(
    docs: DataFrame,
    items: DataFrame,
    *,
    k: int = 10,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    block_terms: int = BLOCK_TERMS,
) -> DataFrame:
    """item, rank (from 1), id and score of each item's ``k`` best documents with a score above 0."""
    lowered = ascii_lower(F.coalesce(item_text_col, F.lit("")))
    queries = staged(
        items.select(
            F.monotonically_increasing_id().alias("query"),
            F.col(item_col).alias("item"),
            F.array_distinct(F.regexp_extract_all(lowered, F.lit(TERM), F.lit(0))).alias("terms"),
        ).where("size(terms) > 0"),
        "queries",
    )
    n_terms = queries.agg(F.coalesce(F.sum(F.size("terms")), F.lit(0))).first()[0]
    n_blocks = max(1, -(-n_terms // block_terms))
    found = None
    for number in range(n_blocks):
        own = queries.where(F.pmod(F.xxhash64("query"), F.lit(n_blocks)) == number)
        block = sorted((r["query"], r["terms"]) for r in own.select("query", "terms").collect())
        part = search_block(docs, block, k=k, id_col=id_col, text_col=text_col)
        found = part if found is None else found.unionByName(part)
    return found.join(queries.select("query", "item"), "query").select(
        F.col("item").alias(item_col), F.col("rank").cast("int").alias("rank"), F.col("id").alias(id_col), "score"
    )
