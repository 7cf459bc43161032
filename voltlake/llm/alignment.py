"""Cross-tokenizer alignment: which tokens of two tokenizers cover the same bytes, and how common that is.

A text is encoded by a byte-level vocabulary (A) and a piece vocabulary (B), both over a space and the
text. Where tokens of both end, the text is cut into groups; an A token and a B token with
overlapping bytes are linked. Each link is judged by how many documents of the corpus hold its pair
of ids.

The counts are found in two passes over the texts:

1. Each task aligns its documents and writes the distinct pairs with its own counts of documents. Of
   the distinct pairs of all tasks a minimal perfect hash is built, in buckets. With it
   each task's counts become dense vectors, one for each bucket, which are summed up a tree, ``FAN``
   vectors at a time. A pair's number in the hash is its place in the sum; the keys in that
   order verify every lookup.
2. The documents are aligned again and their links' counts looked up in the vector, which goes to the
   tasks while it has up to ``most_pairs`` entries. Beyond, the documents' pairs are
   joined with the counts, with the same result.

Texts are encoded in chunks. A chunk ends before a space that follows a character which is no white
space. No token of either vocabulary crosses such a place: A's pre-tokens begin with their space, and B
has no piece with a space after another character (both are checked: the first by holding chunk
ends against token ends, the second on the vocabulary). Each distinct chunk is encoded and aligned once as
long as a worker remembers it, many of them in one call.

Defined cases: a null or empty text, or one whose tokens' bytes are not its own, has no tokens: all
counts are 0 and the digest is ''. Null ids stay null; repeated rows are documents of their own; texts are
read whole, in slices; extra columns are ignored, whatever their names; an empty table gives no rows.
"""

from __future__ import annotations

import functools
import hashlib
import json
import os
import re
import uuid
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voltlake.llm import perfect_hash as ph
from voltlake.llm.common import staged
from voltlake.llm.token_count import byte_characters

#: A space at which chunks part, and places that need a closer look than a split at every space.
CUT = re.compile(r"(?<=\S) (?=[\s\S])")
ODD_SPACE = re.compile(r"\s |^ | \Z")
#: Characters of a text that are chunked at once, and of chunks that are encoded in one call.
SLICE, CALL = 1 << 20, 1 << 15
#: Chunks that a worker remembers.
REMEMBERED = 1 << 19
#: Bytes of count vectors that a task holds before it writes them, and vectors that are summed at once.
VECTOR_BYTES, FAN = 1 << 27, 32
#: Pairs up to which the counts are sent to the tasks: 17 bytes each.
MOST_PAIRS = 1 << 22

#: The pre-tokenizer that A must have, and its pattern (fixed values).
BYTE_LEVEL = {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True}
PRE_TOKEN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

COUNTS = ["n_a", "n_b", "n_groups", "n_links"]
SUMS = ["n_best", "count_sum"]


def described(path: str) -> dict:
    with open(path, encoding="utf-8") as file:
        return json.load(file)


def token_bytes(vocabulary: dict) -> dict[bytes, int]:
    own = {c: b for b, c in byte_characters().items()}
    return {bytes(own[c] for c in entry): i for entry, i in vocabulary["model"]["vocab"].items()}


def merges_by_rank(vocabulary: dict) -> bool:
    """Is it the same to merge listed pairs and to merge any pair that makes a token, by the tokens' ids?

    It is if the merges make the tokens in the order of their ids and every token, cut into bytes, is made again by the
    listed merges. For where two tokens stand side by side that make a third one, the bytes below them were
    merged as they are alone; alone they end as the third one, so theirs is the listed pair.
    """
    ids, own = token_bytes(vocabulary), {c: b for b, c in byte_characters().items()}
    pairs = [m.split(" ") if isinstance(m, str) else m for m in vocabulary["model"]["merges"]]
    listed = [tuple(bytes(own[c] for c in part) for part in pair) for pair in pairs]
    ranks = {pair: rank for rank, pair in enumerate(listed)}
    if [ids.get(a + b) for a, b in listed] != list(range(256, 256 + len(listed))) or len(ids) != 256 + len(listed):
        return False
    for token in ids:
        parts = [bytes([b]) for b in token]
        while len(parts) > 1:
            rank, at = min((ranks.get(pair, len(ranks)), i) for i, pair in enumerate(zip(parts, parts[1:])))
            if rank == len(ranks):
                return False
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
    return True


class Tokenizers:
    """Both vocabularies and the bytes of their tokens.

    With ``by_rank`` A's pairs are merged by the ids of the tokens that they make, which is faster.
    """

    def __init__(self, path_a: str, path_b: str, by_rank: bool):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from sentencepiece import SentencePieceProcessor
        from tiktoken import Encoding
        from tokenizers import Tokenizer

        vocabulary = described(path_a)
        ids = token_bytes(vocabulary)
        if by_rank:
            self.encode_a = Encoding("a", pat_str=PRE_TOKEN, mergeable_ranks=ids, special_tokens={}).encode_ordinary
        else:
            library = Tokenizer.from_file(path_a)
            library.encode_special_tokens = True  # their strings are plain text
            self.encode_a = lambda text: library.encode(text, add_special_tokens=False).ids
        self.b = SentencePieceProcessor(model_file=path_b)
        self.bytes_a = [b""] * (1 + max(ids.values()))
        for token, i in ids.items():
            self.bytes_a[i] = token
        pieces = [self.b.id_to_piece(i) for i in range(self.b.vocab_size())]
        self.bytes_b = [
            bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)
        ]
        if vocabulary["pre_tokenizer"] != BYTE_LEVEL or any(re.search("[^▁]▁", p) for p in pieces):
            raise ValueError("texts cannot be cut at spaces for these vocabularies")
        self.sizes_a = np.array([len(b) for b in self.bytes_a], np.int64)
        self.sizes_b = np.array([len(b) for b in self.bytes_b], np.int64)

    def encode(self, text: str) -> tuple[np.ndarray, np.ndarray] | None:
        """Ids of a space and ``text`` in both vocabularies; None if their bytes differ from it."""
        whole = " " + text
        ids_a, ids_b = self.encode_a(whole), self.b.encode(text)
        data = whole.encode("utf-8", "surrogatepass")
        if b"".join([self.bytes_a[i] for i in ids_a]) != data or b"".join([self.bytes_b[i] for i in ids_b]) != data:
            return None
        return np.array(ids_a, np.int64), np.array(ids_b, np.int64)


class Alignment(NamedTuple):
    """Chunks, one after the other: counts of each, and its links as pairs of ids."""

    counts: np.ndarray  # chunk, COUNTS
    links: np.ndarray
    link_ends: np.ndarray  # of each chunk
    groups: list[str]


def pair_of(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (a << 32) | b


def align(t: Tokenizers, ids_a: np.ndarray, ids_b: np.ndarray, sizes: np.ndarray, texts: bool) -> Alignment:
    """``sizes`` are the bytes of the chunks that the ids make up together."""
    ends_a, ends_b, ends = np.cumsum(t.sizes_a[ids_a]), np.cumsum(t.sizes_b[ids_b]), np.cumsum(sizes)
    cuts = np.intersect1d(ends_a, ends_b, assume_unique=True)
    if not np.isin(ends, cuts, assume_unique=True).all():
        raise ValueError("a token crosses the end of a chunk")
    group_a, group_b = np.searchsorted(cuts, ends_a), np.searchsorted(cuts, ends_b)
    chunk = np.searchsorted(ends, cuts)  # of each group
    first = np.searchsorted(ends_b, ends_a - t.sizes_a[ids_a], "right")
    last = np.searchsorted(ends_b - t.sizes_b[ids_b], ends_a)
    n = last - first
    ends_n = np.cumsum(n)
    at = np.arange(ends_n[-1]) - np.repeat(ends_n - n - first, n)
    links = pair_of(np.repeat(ids_a, n), ids_b[at])
    link_counts = np.bincount(chunk[group_a], n, len(sizes)).astype(np.int64)
    counts = np.stack(
        [np.bincount(chunk[group_a], minlength=len(sizes)), np.bincount(chunk[group_b], minlength=len(sizes)),
         np.bincount(chunk, minlength=len(sizes)), link_counts], axis=1,
    )
    groups = group_texts(ids_a, ids_b, group_a, group_b, chunk, len(sizes)) if texts else []
    return Alignment(counts, links, np.cumsum(link_counts), groups)


def group_texts(ids_a, ids_b, group_a, group_b, chunk, n_chunks) -> list[str]:
    """``a1,a2|b1;a3|b2`` of each chunk."""
    n = len(chunk)
    parts = []
    for ids, group in ((ids_a, group_a), (ids_b, group_b)):
        starts = np.searchsorted(group, np.arange(n + 1)).tolist()
        names = list(map(str, ids.tolist()))
        parts.append([names[s] if e == s + 1 else ",".join(names[s:e]) for s, e in zip(starts, starts[1:])])
    both = list(map("|".join, zip(*parts)))
    starts = np.searchsorted(chunk, np.arange(n_chunks + 1)).tolist()
    return [both[s] if e == s + 1 else ";".join(both[s:e]) for s, e in zip(starts, starts[1:])]


class Lookup(NamedTuple):
    """Counts of pairs by their numbers in a perfect hash."""

    numbers: ph.PerfectHash
    keys: np.ndarray
    counts: np.ndarray
    best: np.ndarray  # is the count its A id's highest

    def of(self, links: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = self.numbers.numbers(links)
        if (at < 0).any() or (self.keys[at] != links).any():
            raise ValueError("a pair was not counted")
        return self.best[at], self.counts[at]


class Grown:
    """An array that rows are put behind."""

    def __init__(self, width: int | None, dtype: type):
        self.rows = np.zeros((1 << 12,) if width is None else (1 << 12, width), dtype)
        self.n = 0

    def put(self, rows: np.ndarray) -> None:
        while self.n + len(rows) > len(self.rows):
            self.rows = np.concatenate([self.rows, np.zeros_like(self.rows)])
        self.rows[self.n : self.n + len(rows)] = rows
        self.n += len(rows)


class Chunks:
    """Remembered alignments of chunks, known without the space they begin with.

    Pairs of ids are numbered as they come, so that a text's links are told apart without sorting.
    """

    def __init__(self, t: Tokenizers, texts: bool, lookup: Lookup | None = None):
        self.t, self.texts, self.lookup = t, texts, lookup
        self.clear()

    def clear(self) -> None:
        self.codes: dict[str, int] = {}
        self.differ: set[int] = set()  # codes of chunks whose tokens have other bytes
        self.counts = Grown(len(COUNTS) + len(SUMS), np.int64)
        self.groups: list[str] = []
        self.links, self.link_ends = Grown(None, np.int32), Grown(None, np.int64)
        self.numbers: dict[int, int] = {}  # of pairs
        self.pairs = Grown(None, np.int64)
        self.documents = Grown(None, np.int64)  # that hold the pair
        self.mark = Grown(None, np.int64)

    def numbered(self, links: np.ndarray) -> np.ndarray:
        """Numbers of pairs, new ones among them."""
        own, at = np.unique(links, return_inverse=True)
        fresh = [p for p in own.tolist() if p not in self.numbers]
        self.numbers.update(zip(fresh, range(len(self.numbers), len(self.numbers) + len(fresh))))
        self.pairs.put(np.array(fresh, np.int64))
        for column in (self.documents, self.mark):
            column.put(np.zeros(len(fresh), np.int64))
        return np.array([self.numbers[p] for p in own.tolist()], np.int32)[at]

    def add(self, keys: list[str], aligned: Alignment | None) -> None:
        at = len(self.codes)
        self.codes.update(zip(keys, range(at, at + len(keys)), strict=True))
        counts = np.zeros((len(keys), len(COUNTS) + len(SUMS)), np.int64)
        if aligned is None:
            self.differ.update(range(at, at + len(keys)))
            self.groups += [""] * len(keys)
            self.link_ends.put(np.full(len(keys), self.links.n))
        else:
            self.groups += aligned.groups
            counts[:, : len(COUNTS)] = aligned.counts
            self.link_ends.put(aligned.link_ends + self.links.n)
            if self.lookup:
                begins = np.concatenate([[0], aligned.link_ends[:-1]])  # each chunk has a link
                for column, found in enumerate(self.lookup.of(aligned.links), len(COUNTS)):
                    counts[:, column] = np.add.reduceat(found.astype(np.int64), begins)
            else:
                self.links.put(self.numbered(aligned.links))
        self.counts.put(counts)

    def learn(self, keys: list[str]) -> None:
        """Chunks that end in white space could run into the next one, so they are encoded alone."""
        alone, together, size = [], [], 0
        for key in keys:
            if key[-1].isspace() or "▁" in key:
                alone.append(key)
                continue
            together.append(key)
            size += len(key) + 1
            if size > CALL:
                self.learn_together(together)
                together, size = [], 0
        if together:
            self.learn_together(together)
        for key in alone:
            self.learn_together([key])

    def learn_together(self, keys: list[str]) -> None:
        found = self.t.encode(" ".join(keys))
        if found is None and len(keys) > 1:
            for key in keys:
                self.learn_together([key])
            return
        sizes = np.array([1 + len(k.encode("utf-8", "surrogatepass")) for k in keys], np.int64)
        self.add(keys, found and align(self.t, *found, sizes, self.texts))

    def of(self, parts: list[str]) -> list[list[int]]:
        """Codes of the parts' chunks, in order; they hold until ``clear``."""
        split = [keys_of(part) for part in parts]
        fresh = set().union(*split).difference(self.codes)
        if fresh:
            self.learn(list(fresh))
        return [list(map(self.codes.__getitem__, keys)) for keys in split]

    def links_of(self, codes: list[int]) -> np.ndarray:
        """Numbers of the pairs that the chunks link, with repeats."""
        at = np.array(codes, np.int64)
        ends = self.link_ends.rows[at]
        sizes = ends - np.where(at > 0, self.link_ends.rows[at - 1], 0)
        total = np.cumsum(sizes)
        return self.links.rows[np.arange(total[-1]) + np.repeat(ends - total, sizes)]

    def distinct(self, numbers: np.ndarray) -> np.ndarray:
        """Each number once: the place that was written last stands for it."""
        places = np.arange(len(numbers))
        self.mark.rows[numbers] = places
        return numbers[self.mark.rows[numbers] == places]

    def count(self, numbers: np.ndarray) -> None:
        """One more document for each of the pairs."""
        self.documents.rows[self.distinct(numbers)] += 1

    def counted(self) -> tuple[np.ndarray, np.ndarray]:
        n = self.documents.rows[: self.documents.n]
        return self.pairs.rows[: self.pairs.n][n > 0], n[n > 0]


def keys_of(part: str) -> list[str]:
    if ODD_SPACE.search(part):
        keys = CUT.split(" " + part)
        keys[0] = keys[0][1:]
        return keys
    return part.split(" ")


def slices(text: str) -> Iterator[str]:
    """Parts of a text that are chunked alike on their own, each with a space of its own before it."""
    at = 0
    while len(text) - at > SLICE and (cut := CUT.search(text, at + SLICE)):
        yield text[at : cut.start()]
        at = cut.end()
    yield text[at:]


def batched(texts: Iterator[str | None]) -> Iterator[list[str | None]]:
    """Texts that are looked up together: of up to ``SLICE`` characters, or one longer text."""
    held, size = [], 0
    for text in texts:
        n = len(text or "")
        if held and size + n > SLICE:
            yield held
            held, size = [], 0
        held.append(text)
        size += n
    if held:
        yield held


def count_texts(chunks: Chunks, texts: list[str | None]) -> None:
    """Counts the documents of the texts' pairs."""
    if len(texts) > 1 or len(texts[0] or "") <= SLICE:
        for codes in chunks.of([t for t in texts if t]):
            if chunks.differ.isdisjoint(codes):
                chunks.count(chunks.links_of(codes))
        return
    found = []
    for part in slices(texts[0]):
        codes = chunks.of([part])[0]
        if not chunks.differ.isdisjoint(codes):
            return
        found.append(chunks.distinct(chunks.links_of(codes)))
    chunks.count(np.concatenate(found))


class Row(NamedTuple):
    counts: np.ndarray  # COUNTS and SUMS
    digest: str
    keys: np.ndarray  # distinct pairs and how often the text links them, if asked for
    times: np.ndarray


NO_TOKENS = Row(np.zeros(len(COUNTS) + len(SUMS), np.int64), "", np.empty(0, np.int64), np.empty(0, np.int64))


def align_texts(chunks: Chunks, texts: list[str | None], links: bool = False) -> Iterator[Row]:
    if len(texts) > 1 or len(texts[0] or "") <= SLICE:
        found = iter(chunks.of([t for t in texts if t]))
        for text in texts:
            yield align_text(chunks, [next(found)] if text else [], links)
    else:
        yield align_text(chunks, (chunks.of([part])[0] for part in slices(texts[0])), links)


def align_text(chunks: Chunks, parts, links: bool) -> Row:
    """Of the codes of a text's slices."""
    counts, digest, numbers = NO_TOKENS.counts.copy(), hashlib.sha256(), []
    started = False
    for codes in parts:
        if not chunks.differ.isdisjoint(codes):
            return NO_TOKENS
        counts += chunks.counts.rows[codes].sum(axis=0)
        digest.update((";" * started + ";".join(map(chunks.groups.__getitem__, codes))).encode())
        started = True
        if links:
            numbers.append(chunks.links_of(codes))
    if not started:
        return NO_TOKENS
    own, times = np.unique(np.concatenate(numbers), return_counts=True) if links else (NO_TOKENS.keys, NO_TOKENS.times)
    return Row(counts, digest.hexdigest(), chunks.pairs.rows[own] if links else own, times)


class Vocabularies(NamedTuple):
    path_a: str
    path_b: str
    by_rank: bool


@functools.lru_cache(maxsize=1)
def tokenizers_of(v: Vocabularies) -> Tokenizers:
    return Tokenizers(*v)


@functools.lru_cache(maxsize=1)
def chunks_of(v: Vocabularies, texts: bool, run: str) -> Chunks:
    """One for each worker and run, so that tasks that follow each other share what it remembers."""
    return Chunks(tokenizers_of(v), texts)


def task_counts(docs: DataFrame, v: Vocabularies, text_col: str) -> DataFrame:
    """key, n: the pairs with each task's number of documents that hold them; written.

    A task writes what it has counted when it forgets its chunks, and at its end.
    """
    run_id = uuid.uuid4().hex

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunks = chunks_of(v, False, run_id)
        chunks.documents.rows[:] = 0  # another task's
        for batch in batches:
            for texts in batched(t.as_py() for t in batch["text"]):
                count_texts(chunks, texts)
                if len(chunks.codes) > REMEMBERED:
                    yield pa.RecordBatch.from_arrays(list(map(pa.array, chunks.counted())), ["key", "n"])
                    chunks.clear()
        yield pa.RecordBatch.from_arrays(list(map(pa.array, chunks.counted())), ["key", "n"])

    found = docs.select(F.col(text_col).alias("text")).mapInArrow(run, "key long, n long")
    return staged(found, "task_counts")


def dense_vectors(counts: DataFrame, numbers: ph.PerfectHash) -> DataFrame:
    """branch, bucket, vector: each task's counts by the pairs' numbers, a vector for each bucket that it meets."""
    shared = counts.sparkSession.sparkContext.broadcast((numbers, numbers.firsts()))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        numbers, firsts = shared.value
        vectors: dict[int, np.ndarray] = {}
        size = 0

        def written() -> pd.DataFrame:
            return pd.DataFrame({"bucket": list(vectors), "vector": [v.tobytes() for v in vectors.values()]}).astype({"bucket": "int32"})

        for frame in frames:
            at = numbers.numbers(frame["key"].to_numpy(np.int64))
            bucket = np.searchsorted(firsts, at, "right") - 1
            order = np.argsort(bucket, kind="stable")
            n = frame["n"].to_numpy(np.int64)
            for part in np.split(order, np.flatnonzero(np.diff(bucket[order])) + 1):
                own = int(bucket[part[0]])
                if own not in vectors:
                    vectors[own] = np.zeros(int(firsts[own + 1] - firsts[own]), np.int64)
                    size += vectors[own].nbytes
                np.add.at(vectors[own], at[part] - firsts[own], n[part])
            if size > VECTOR_BYTES:
                yield written()
                vectors, size = {}, 0
        if vectors:
            yield written()

    return counts.select("key", "n").mapInPandas(run, "bucket int, vector binary").withColumn("branch", F.spark_partition_id())


def tree_sum(vectors: DataFrame, n_branches: int) -> DataFrame:
    """bucket, vector: sums over the branches, ``FAN`` at a time, so that no group holds more, however many tasks there are."""

    def add(frame: pd.DataFrame) -> pd.DataFrame:
        total = np.frombuffer(frame["vector"].iloc[0], np.int64).copy()
        for other in frame["vector"].iloc[1:]:
            total += np.frombuffer(other, np.int64)
        return pd.DataFrame({"bucket": frame["bucket"].iloc[:1], "branch": frame["branch"].iloc[:1], "vector": [total.tobytes()]})

    while n_branches > 1:
        n_branches = -(-n_branches // FAN)
        branch = F.floor(F.col("branch") / FAN).cast("int") if n_branches > 1 else F.lit(0)
        vectors = vectors.withColumn("branch", branch)
        vectors = vectors.groupBy("bucket", "branch").applyInPandas(add, "bucket int, branch int, vector binary")
    return vectors.select("bucket", "vector")


def count_pairs(counts: DataFrame) -> tuple[DataFrame, ph.PerfectHash]:
    """key, place (its number), n, best of all distinct pairs, and the hash that numbers them."""
    keys = counts.select("key").distinct()
    n_buckets = ph.bucket_count(counts.agg(F.approx_count_distinct("key")).first()[0])
    buckets = ph.build_buckets(keys, n_buckets)
    numbers = ph.perfect_hash(buckets, n_buckets)
    spark = counts.sparkSession
    vectors = dense_vectors(counts, numbers)
    sums = staged(tree_sum(vectors, max(2, counts.rdd.getNumPartitions())), "pair_sums")
    firsts = numbers.firsts()
    starts = spark.sparkContext.broadcast(firsts)

    def rows(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for bucket, own, vector in zip(frame["bucket"], frame["keys"], frame["vector"], strict=True):
                found = np.frombuffer(own, np.int64)
                place = np.arange(len(found)) + starts.value[bucket]
                yield pd.DataFrame({"key": found, "a": found >> 32, "place": place, "n": np.frombuffer(vector, np.int64)})

    counted = staged(
        buckets.select("bucket", "keys").join(sums, "bucket").mapInPandas(rows, "key long, a long, place long, n long"), "pair_counts"
    )
    highest = counted.groupBy("a").agg(F.max("n").alias("highest"))  # a row for each id of A
    found = counted.join(highest, "a").select("key", "place", "n", (F.col("n") == F.col("highest")).alias("best"))
    return staged(found, "pairs"), numbers


def lookup_of(pairs: DataFrame, numbers: ph.PerfectHash) -> Lookup:
    """All counts as arrays on the driver, for a number of pairs that was checked."""
    found = pairs.toArrow().sort_by("place")
    key, n, best = (found[c].to_numpy() for c in ("key", "n", "best"))
    return Lookup(numbers, key, n, best)


def aligned_rows(docs: DataFrame, v: Vocabularies, lookup: Broadcast | None, *, links: bool, id_col: str, text_col: str) -> DataFrame:
    """id, COUNTS, SUMS and the digest of each document; with ``links`` also its distinct pairs and how often it has each."""
    run_id = uuid.uuid4().hex
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    columns = [*COUNTS, *SUMS]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunks = chunks_of(v, True, run_id)
        chunks.lookup = lookup.value if lookup else None
        for batch in batches:
            counts, digests, keys, times = [], [], [], []
            for texts in batched(t.as_py() for t in batch["text"]):
                for row in align_texts(chunks, texts, links):
                    counts.append(row.counts)
                    digests.append(row.digest)
                    keys.append(row.keys)
                    times.append(row.times)
                if len(chunks.codes) > REMEMBERED:
                    chunks.clear()
            found = np.array(counts, np.int64).reshape(len(counts), len(columns))
            arrays = [batch["id"], *(pa.array(found[:, i]) for i in range(len(columns))), pa.array(digests, pa.string())]
            names = ["id", *columns, "groups_sha256"]
            if links:
                arrays += [pa.array(keys, pa.list_(pa.int64())), pa.array(times, pa.list_(pa.int64()))]
                names += ["keys", "times"]
            yield pa.RecordBatch.from_arrays(arrays, names)

    id_type = rows.schema["id"].dataType.simpleString()
    schema = f"id {id_type}, {', '.join(f'{c} long' for c in columns)}, groups_sha256 string"
    return rows.mapInArrow(run, schema + (", keys array<long>, times array<long>" if links else ""))


def joined_sums(rows: DataFrame, pairs: DataFrame) -> DataFrame:
    """The documents with their sums by a join of their pairs with the counts, for any number of pairs."""
    rows = staged(rows.withColumn("row", F.monotonically_increasing_id()), "aligned")
    each = rows.select("row", F.inline(F.arrays_zip(F.col("keys").alias("key"), F.col("times").alias("times"))))
    sums = (
        each.join(pairs.select("key", "n", "best"), "key")
        .groupBy("row")
        .agg(
            F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("found_best"),
            F.sum(F.col("times") * F.col("n")).alias("found_sum"),
        )
    )
    zero = F.lit(0).cast("long")
    return rows.join(sums, "row", "left").withColumns(
        {"n_best": F.coalesce("found_best", zero), "count_sum": F.coalesce("found_sum", zero)}
    )


def align_documents(
    docs: DataFrame,
    path_a: str,
    path_b: str,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    most_pairs: int = MOST_PAIRS,
) -> DataFrame:
    """id, n_a, n_b, n_groups, n_links, n_best, count_sum and groups_sha256 of every document.

    The paths are those of the vocabularies on the driver and every executor.
    """
    v = Vocabularies(path_a, path_b, merges_by_rank(described(path_a)))
    pairs, numbers = count_pairs(task_counts(docs, v, text_col))
    names = {"id_col": id_col, "text_col": text_col}
    if numbers.n <= most_pairs:
        lookup = docs.sparkSession.sparkContext.broadcast(lookup_of(pairs, numbers))
        rows = aligned_rows(docs, v, lookup, links=False, **names)
    else:
        rows = joined_sums(aligned_rows(docs, v, None, links=True, **names), pairs)
    return rows.select(F.col("id").alias(id_col), *COUNTS, *SUMS, "groups_sha256")
