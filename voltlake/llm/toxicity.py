"""Toxicity by FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

A text's lower-cased words give features: each word, each pair and triple of neighbours, and pairs
that skip one or two words. A feature counts once a text and is known by a hash of ``bits`` bits.

The learner goes through the training texts one by one. Each coordinate has a rate of its own,
which falls with the squared gradients that it saw, and the L1 penalty keeps a weight at
zero until its evidence outgrows the penalty. A feature is taken in once ``seen`` texts have it.
What is left is a short list of (feature, weight), which goes to the tasks with the scoring function;
its size is bounded by 2 ** ``bits`` entries and is some hundreds in practice.

It learns from a bounded sample of labelled texts, up to ``per_label`` of either label and up to
``train_bytes`` long each. The share of the labels is corrected for.

Defined cases: a null text counts as empty and is scored like any other, by the offset alone;
without labels of both kinds every score is 0.5; ids without a label, or null, teach nothing; a
document with several labels teaches each; extra columns are ignored, whatever their names; texts are
scored whole and in blocks, whatever their length; repeated rows are scored each; an empty table
gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voltlake.llm.sampling import bounded_sample, crc_bucket

WORD = regex.compile(r"[\p{L}\p{M}\p{N}]+")
BITS = 20
#: Words whose features are made at once; the last words of a block are seen again by the next one.
BLOCK = 1 << 16
#: Hashes of words that a worker remembers.
REMEMBERED = 1 << 18
#: Offsets of the words that make up a feature.
SHAPES = ((0,), (0, 1), (0, 1, 2), (0, 2), (0, 3))
SPAN = 1 + max(max(s) for s in SHAPES)


class Features:
    """Feature numbers of texts; words are hashed once each."""

    def __init__(self, bits: int = BITS):
        self.shift = np.uint64(64 - bits)
        self.known: dict[str, int] = {}

    def blocks(self, text: str) -> Iterator[np.ndarray]:
        """Feature numbers with repeats, block by block. Every feature is in one block at least."""
        words: list[str] = []
        fresh = 0
        for found in WORD.finditer(text.lower()):
            words.append(found.group())
            fresh += 1
            if len(words) == BLOCK:
                yield self.of(words)
                words, fresh = words[-(SPAN - 1) :], 0
        if fresh:
            yield self.of(words)

    def of(self, words: list[str]) -> np.ndarray:
        if len(self.known) > REMEMBERED:
            self.known = {}
        known = self.known
        for w in set(words):
            if w not in known:
                known[w] = xxhash.xxh64_intdigest(w.encode("utf-8", "surrogatepass"))
        hashes = np.fromiter((known[w] for w in words), np.uint64, len(words))
        parts = []
        for number, shape in enumerate(SHAPES):
            n = len(hashes) - shape[-1]
            if n <= 0:
                continue
            mixed = np.full(n, 0x9E3779B97F4A7C15 + number, np.uint64)
            for at in shape:
                mixed = (mixed ^ hashes[at : at + n]) * np.uint64(0xD6E8FEB86659FD93)
                mixed ^= mixed >> np.uint64(32)
            parts.append((mixed * np.uint64(0x9E3779B97F4A7C15)) >> self.shift)
        return np.concatenate(parts).astype(np.int32)

    def distinct(self, text: str) -> np.ndarray:
        found = [np.unique(b) for b in self.blocks(text)]
        return np.unique(np.concatenate(found)) if found else np.empty(0, np.int32)


class Weights(NamedTuple):
    """The weights that are not zero."""

    features: np.ndarray
    values: np.ndarray
    offset: float
    bits: int


class Ftrl:
    """State of each coordinate: z, the gradients less what the weight has moved, and n, the sum of their squares."""

    def __init__(self, bits: int = BITS, *, alpha: float = 3.0, beta: float = 1.0, l1: float = 8.0, l2: float = 0.0):
        self.alpha, self.beta, self.l1, self.l2, self.bits = alpha, beta, l1, l2, bits
        self.z, self.n = np.zeros(1 << bits), np.zeros(1 << bits)
        self.offset = np.zeros(2)  # z and n of the offset, which has no penalty

    def weights(self, at: np.ndarray | slice) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        shrunk = np.sign(z) * np.maximum(np.abs(z) - self.l1, 0.0)
        return -shrunk / ((self.beta + np.sqrt(n)) / self.alpha + self.l2)

    def bias(self) -> float:
        return -self.offset[0] / ((self.beta + np.sqrt(self.offset[1])) / self.alpha)

    def learn(self, features: np.ndarray, label: float) -> None:
        w, b = self.weights(features), self.bias()
        g = 1 / (1 + np.exp(-np.clip(w.sum() + b, -30, 30))) - label
        n = self.n[features]
        self.z[features] += g - (np.sqrt(n + g * g) - np.sqrt(n)) / self.alpha * w
        self.n[features] = n + g * g
        self.offset += (g - (np.sqrt(self.offset[1] + g * g) - np.sqrt(self.offset[1])) / self.alpha * b, g * g)

    def result(self) -> Weights:
        w = self.weights(slice(None))
        kept = np.flatnonzero(w)
        return Weights(kept.astype(np.int32), w[kept], float(self.bias()), self.bits)


def train(
    rows: list[np.ndarray], labels: np.ndarray, *, epochs: int = 10, seen: int = 3, seed: int = 7, bits: int = BITS, **rates: float
) -> Weights:
    """FTRL over the rows in shuffled order, ``epochs`` times."""
    draw, learner = np.random.default_rng(seed), Ftrl(bits, **rates)
    counts = np.zeros(1 << bits, np.int32)
    for row in rows:
        counts[row] += 1  # a row's features are distinct
    rows = [row[counts[row] >= seen] for row in rows]
    for _ in range(epochs):
        for k in draw.permutation(len(rows)):
            learner.learn(rows[k], float(labels[k]))
    return learner.result()


def fit_toxicity(
    docs: DataFrame,
    labels: DataFrame,
    learnable: Column,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    per_label: int = 3000,
    train_bytes: int = 1 << 14,
    **options: float,
) -> Weights | None:
    """Weights from at most ``per_label`` documents of either label; None without both."""
    taught = labels.where(learnable & F.col(label_col).isin(0, 1)).select(
        F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("label")
    )
    shares = {r["label"]: r["n"] for r in taught.groupBy("label").agg(F.count("*").alias("n")).collect()}
    if len(shares) < 2:
        return None
    text = F.coalesce(F.col(text_col), F.lit(""))
    short = docs.select(F.col(id_col).alias("id"), text.alias("text")).where(F.octet_length("text") <= train_bytes)
    chosen = bounded_sample(taught.join(short.select("id"), "id", "left_semi"), "label", F.col("id"), per_label)
    picked = short.join(F.broadcast(chosen), "id").select("label", "text")  # 2 per_label rows
    found = sorted(map(tuple, picked.collect()))
    target = np.array([y for y, _ in found], np.float64)
    if not 0 < target.sum() < len(target):
        return None
    features = Features(int(options.get("bits", BITS)))
    weights = train([features.distinct(t) for _, t in found], target, **options)
    ones = target.sum()
    shift = np.log(shares[1] / shares[0]) - np.log(ones / (len(target) - ones))
    return weights._replace(offset=weights.offset + float(shift))


class Scorer:
    def __init__(self, weights: Weights):
        self.features, self.weights = Features(weights.bits), weights
        self.place = np.full(1 << weights.bits, -1, np.int32)
        self.place[weights.features] = np.arange(len(weights.features))

    def logit(self, text: str) -> float:
        met = np.zeros(len(self.weights.features), bool)
        for block in self.features.blocks(text):
            at = self.place[block]
            met[at[at >= 0]] = True
        return float(self.weights.values[met].sum() + self.weights.offset)


def score_toxicity(docs: DataFrame, weights: Weights | None, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id and score, the probability of label 1, of every document."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(weights) if weights else None
        for batch in batches:
            logits = [scorer.logit(t.as_py() or "") if scorer else 0.0 for t in batch["text"]]
            scores = 1 / (1 + np.exp(-np.clip(logits, -30, 30)))
            yield pa.RecordBatch.from_arrays([batch["id"], pa.array(scores, pa.float64())], ["id", "score"])

    id_type = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(run, f"id {id_type}, score double").withColumnRenamed("id", id_col)


def held_out(id_col: str = "doc_id") -> Column:
    return F.coalesce(crc_bucket(id_col, 5) == 0, F.lit(False))


def classify_toxicity(
    docs: DataFrame,
    labels: DataFrame,
    *,
    threshold: float = 0.5,
    id_col: str = "doc_id",
    text_col: str = "text",
    **options: float,
) -> DataFrame:
    """id, held_out, score and predicted of every document; learned from the rows not held out."""
    weights = fit_toxicity(docs, labels, ~held_out(id_col) & F.col(id_col).isNotNull(), id_col=id_col, text_col=text_col, **options)
    scored = score_toxicity(docs, weights, id_col=id_col, text_col=text_col)
    return scored.select(id_col, held_out(id_col).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
