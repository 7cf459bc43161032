"""Removal of repeated passages: windows repeated at one length are extended to twice that length.

A window of ``window`` words that starts in two places has the same shorter windows in it at both.
So lengths are taken one after the other, from ``SHORTEST`` words or fewer on, each twice the one before, until no
candidate survives or the window's own length is reached: of each candidate
window the smallest shorter window (by hash) is tallied over the corpus, and only candidates whose
own is found elsewhere too go on to the next length. The last length is the window itself.
Equal windows pick equal representatives, so nothing is lost, and a level before the last
tallies about one position in ten.

A tally is one shuffle. Each task first settles what repeats within it, so that a window, however
common, arrives once a task, and occurrences that are settled are dealt out by place. Hashes of
a window decide whether it goes on; at the last length they have 96 bits.

Texts travel once: the later lengths and the result read one shuffle of them by id. Where ids
are null or repeat, a hash of the text goes with the id; equal rows have equal answers.

Defined cases: a null text has no words; a text shorter than the window keeps all words; an id may
be null or repeat; extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from voltlake.llm.common import SPACES, staged

#: Window starts handled at once when smallest windows are picked.
BLOCK = 1 << 16
#: Words of the first length, at most.
SHORTEST = 5
_ODD = tuple(np.uint64(n) for n in (0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93))


def lengths_of(window: int, shortest: int) -> list[int]:
    """Lengths that end with the window, each half of the next, rounded up; the first is the first one
    that has no more than ``shortest`` words."""
    out = [window]
    while out[0] > max(1, shortest):
        out.insert(0, -(-out[0] // 2))
    return out


def word_hashes(words: list[bytes]) -> np.ndarray:
    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(w) for w in words), np.uint64, len(words))


def _mix(a: np.ndarray, b: np.ndarray, kind: int) -> np.ndarray:
    x = a * _ODD[kind] + (b ^ (b >> np.uint64(31)))
    x ^= x >> np.uint64(29)
    x *= _ODD[kind + 2]
    return x ^ (x >> np.uint64(32))


def window_hashes(words: np.ndarray, length: int, kind: int = 0) -> np.ndarray:
    """A hash of the ``length`` words from each position on, by doubling."""
    out, size = _mix(words, words, kind), 1
    while size < length and len(out):
        step = min(size, length - size)
        out, size = _mix(out[:-step], out[step:], kind), size + step
    return out if size == length else out[:0]


def smallest_in(hashes: np.ndarray, starts: np.ndarray, span: int) -> np.ndarray:
    """For each start the position of the smallest of ``span`` hashes from there, leftmost first."""
    if span == 1:
        return starts
    views = np.lib.stride_tricks.sliding_window_view(hashes, span)
    parts = [starts[i : i + BLOCK] for i in range(0, len(starts), BLOCK)]
    return np.concatenate([p + views[p].argmin(axis=1) for p in parts]) if parts else starts


def candidates(words: np.ndarray, window: int, before: int | None, alive: np.ndarray | None) -> np.ndarray:
    """Starts of the windows whose smallest part of the length ``before`` is alive."""
    starts = np.arange(max(0, len(words) - window + 1))
    if before is None or not len(starts):
        return starts
    lives = np.zeros(len(words), bool)
    lives[alive] = True
    return starts[lives[smallest_in(window_hashes(words, before), starts, window - before + 1)]]


def level_positions(words: np.ndarray, window: int, length: int, starts: np.ndarray) -> np.ndarray:
    """Distinct positions of the smallest windows of ``length`` words in the candidates."""
    if not len(starts) or length == window:
        return starts
    return np.unique(smallest_in(window_hashes(words, length), starts, window - length + 1))


def settle(h: np.ndarray, tie: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which occurrences repeat within a task, and the first occurrence of each such window."""
    order = np.lexsort((tie, h))
    same = (h[order][1:] == h[order][:-1]) & (tie[order][1:] == tie[order][:-1])
    known = np.zeros(len(h), bool)
    known[order[1:]] |= same
    known[order[:-1]] |= same
    first = known.copy()
    first[order[1:]] &= ~same
    return known, np.flatnonzero(first)


_FOUND = "h long, tie int, known boolean, id {id}, extra long, pos int"


def keyed_texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """id, extra and text of every row; extra tells rows apart whose ids are null or repeat."""
    ids, text = docs.select(F.col(id_col).alias("id")), F.coalesce(text_col, F.lit(""))
    plain = ids.groupBy("id").agg(F.count("*").alias("n")).where("n > 1 or id is null").isEmpty()
    extra = F.lit(0).cast("long") if plain else F.xxhash64(text)
    return docs.select(F.col(id_col).alias("id"), extra.alias("extra"), text.alias("text"))


def words_of(text: pa.StringScalar) -> list[bytes]:
    return text.as_buffer().to_pybytes().split()


def _tally(docs: DataFrame, window: int, length: int, before: int | None) -> DataFrame:
    """(id, extra, pos) of the level's windows that start in more than one place.

    ``docs`` has id, extra, text and, from the second level on, alive.
    """
    id_type = docs.schema["id"].dataType
    last = length == window

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, extras, rows, positions, hashes, ties, id_kind = [], [], [], [], [], [], None
        for batch in batches:
            alive, id_kind = batch["alive"] if before else [None] * batch.num_rows, batch["id"].type
            for i, (text, lives) in enumerate(zip(batch["text"], alive, strict=True)):
                words = word_hashes(words_of(text))
                starts = candidates(words, window, before, lives.values.to_numpy() if before else None)
                at = level_positions(words, window, length, starts)
                if len(at):
                    rows.append(np.full(len(at), len(ids), np.int64))
                    ids.append(batch["id"][i].as_py())
                    extras.append(batch["extra"][i].as_py())
                    positions.append(at.astype(np.int32))
                    hashes.append(window_hashes(words, length)[at])
                    ties.append(window_hashes(words, length, 1)[at].astype(np.uint32) if last else np.zeros(len(at), np.uint32))
        if not rows:
            return
        row, pos, h, tie = map(np.concatenate, (rows, positions, hashes, ties))
        known, first = settle(h, tie)
        # Settled occurrences are dealt out by number; one more row speaks for each such window.
        place = np.arange(len(h), dtype=np.uint64)
        all_ids, all_extras = pa.array(ids, id_kind), pa.array(extras, pa.int64())
        for part in np.array_split(np.arange(len(h) + len(first)), max(1, -(-(len(h) + len(first)) // BLOCK))):
            own = part[part < len(h)]
            more = first[part[part >= len(h)] - len(h)]
            at, speaks = np.concatenate([own, more]), np.repeat([False, True], [len(own), len(more)])
            settled = known[at] & ~speaks
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.where(settled, place[at], h[at]).view(np.int64)), pa.array(tie[at].view(np.int32)),
                    pa.array(settled), all_ids.take(pa.array(row[at])), all_extras.take(pa.array(row[at])),
                    pa.array(np.where(speaks, -1, pos[at]).astype(np.int32)),
                ],
                ["h", "tie", "known", "id", "extra", "pos"],
            )

    found = docs.mapInArrow(run, _FOUND.format(id=id_type.simpleString()))
    # As many rows as there are tasks, at most: each brings a window once.
    met = F.count("*").over(Window.partitionBy("h", "tie", "known"))
    return found.withColumn("met", met).where("(known or met > 1) and pos >= 0").select("id", "extra", "pos")


def _with_lists(texts: DataFrame, found: DataFrame, how: str) -> DataFrame:
    """Each row's texts with the list of its positions, no longer than the text."""
    lists = found.groupBy("id", "extra").agg(F.collect_set("pos").alias("alive"))
    lists = lists.withColumnsRenamed({"id": "__id", "extra": "__extra"})
    on = texts["id"].eqNullSafe(lists["__id"]) & (texts["extra"] == lists["__extra"])
    return texts.join(lists, on, how).select("id", "extra", "text", "alive")


def copies_of(texts: DataFrame) -> DataFrame:
    """(id, extra, speaks) of the texts whose words are, in order, those of other texts; one of
    each group speaks for it."""
    words = F.trim(F.regexp_replace("text", SPACES, " "))
    marked = staged(
        texts.select("id", "extra", F.sha2(F.encode(words, "UTF-8"), 256).alias("digest")), "digests"
    )
    first = F.min(F.struct(F.col("id").isNull(), "id", "extra"))
    groups = marked.groupBy("digest").agg(F.count("*").alias("n"), first.alias("first")).where("n > 1")
    groups = staged(groups, "groups")  # so that the join is one of two shuffles, whose hot keys can be split
    speaks = F.col("id").eqNullSafe(F.col("first.id")) & (F.col("extra") == F.col("first.extra"))
    return marked.join(groups, "digest").select("id", "extra", speaks.alias("speaks"))


def repeated_windows(docs: DataFrame, *, window: int, shortest: int, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame]:
    """The texts, and (id, extra, pos) of every window that starts elsewhere too.

    A level's survivors are written, as the next one reads them twice, and the lengths end when none survive.

    Every window of a copy does. Copies are told by a digest first, with pos -1 for all their
    windows, and one of each group goes through the later levels for all.
    """
    texts = keyed_texts(docs, id_col, text_col)
    copies = staged(copies_of(texts), "copies")
    silent = copies.where("not speaks").select(F.col("id").alias("__id"), F.col("extra").alias("__extra"))
    before, found, at = None, None, texts
    for length in lengths_of(window, shortest):
        found = _tally(at, window, length, before)
        if length < window:
            on = found["id"].eqNullSafe(silent["__id"]) & (found["extra"] == silent["__extra"])
            found = staged(found.join(silent, on, "left_anti"), f"alive-{length}")
            if found.isEmpty():
                break
            at, before = _with_lists(texts, found, "inner"), length
    whole = copies.select("id", "extra", F.lit(-1).alias("pos"))
    return texts, found.unionByName(whole)


def remove_repeats(
    docs: DataFrame, *, window: int = 35, shortest: int = SHORTEST, id_col: str = "doc_id", text_col: str = "text", keep_text: bool = False
) -> DataFrame:
    """id, n_words, n_removed and kept_sha256 of every document, and the kept words if asked."""
    texts, found = repeated_windows(docs, window=window, shortest=shortest, id_col=id_col, text_col=text_col)
    joined = _with_lists(texts, found, "left")
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            totals, removed, digests, kept_texts = [], [], [], []
            for text, starts in zip(batch["text"], batch["alive"], strict=True):
                words = words_of(text)
                kept = words
                if starts.is_valid and -1 in starts.values.to_numpy():
                    kept = words if len(words) < window else []
                elif starts.is_valid:
                    edges = np.zeros(len(words) + 1, np.int64)
                    at = starts.values.to_numpy()
                    edges[at] += 1
                    edges[at + window] -= 1  # starts are distinct
                    stays = np.cumsum(edges)[:-1] == 0
                    kept = [w for w, stay in zip(words, stays.tolist(), strict=True) if stay]
                joined_words = b" ".join(kept)
                totals.append(len(words))
                removed.append(len(words) - len(kept))
                digests.append(hashlib.sha256(joined_words).hexdigest())
                kept_texts.append(joined_words.decode() if keep_text else None)
            yield pa.RecordBatch.from_arrays(
                [batch["id"], pa.array(totals, pa.int64()), pa.array(removed, pa.int64()), pa.array(digests, pa.string()), pa.array(kept_texts, pa.string())],
                ["id", "n_words", "n_removed", "kept_sha256", "kept_text"],
            )

    schema = f"id {id_type}, n_words long, n_removed long, kept_sha256 string, kept_text string"
    out = joined.mapInArrow(run, schema).withColumnRenamed("id", id_col)
    return out if keep_text else out.drop("kept_text")
