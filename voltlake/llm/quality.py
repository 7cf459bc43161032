"""Quality of documents by a byte-level convolutional network in numpy.

A text's bytes are read in chunks that overlap, so that the whole document is covered. Bytes are
embedded, learned filters slide over each chunk, and each filter's strongest response in it is
kept (max pooling). Over the document these are averaged, and their maxima and minima taken; a
logistic layer makes one probability of them.

To apply the network, embedding and filters are folded into one table for each place in a filter:
the response of a byte there. A response is then a sum of table rows, without a product.

The network is fitted on a bounded sample of labelled documents, as many of either label as there
are up to ``per_label``, each up to ``train_bytes`` long; the share of the labels is corrected for.

Defined cases: a null text counts as empty and is scored like any other; without labels of both
kinds every score is 0.5; ids without a label, or null, teach nothing; a document with several
labels teaches each; extra columns are ignored; texts are scored whole, whatever their length.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from voltlake.llm.sampling import bounded_sample, crc_bucket

CHUNK, OVERLAP, WIDTH = 256, 32, 7
FILTERS, EMBEDDING = 24, 8
PAD = 256
#: Chunks whose responses are held at once.
BLOCK = 256


def chunks_of(text: str) -> np.ndarray:
    """Overlapping chunks of the text's bytes, the last one padded."""
    data = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8).astype(np.int64)
    step = CHUNK - OVERLAP
    n = 1 + max(0, -(-(len(data) - CHUNK) // step))
    padded = np.full((n - 1) * step + CHUNK, PAD, np.int64)
    padded[: len(data)] = data
    return np.lib.stride_tricks.sliding_window_view(padded, CHUNK)[::step]


class Network(NamedTuple):
    tables: np.ndarray  # place in the filter, byte, filter
    bias: np.ndarray
    weights: np.ndarray  # of mean, maximum and minimum of each filter
    offset: float

    def pooled(self, chunks: np.ndarray) -> np.ndarray:
        """Each filter's strongest response in each chunk, 0 at least."""
        out = np.empty((len(chunks), len(self.bias)), np.float32)
        for at in range(0, len(chunks), BLOCK):
            out[at : at + BLOCK] = responses(self.tables, chunks[at : at + BLOCK]).max(axis=1)
        return np.maximum(out + self.bias, 0.0)

    def logit(self, text: str) -> float:
        pooled = self.pooled(chunks_of(text))
        return float(summary(pooled) @ self.weights + self.offset)


def responses(tables: np.ndarray, chunks: np.ndarray) -> np.ndarray:
    """Sum over the filter's places of the byte's response there: chunk, position, filter."""
    n = chunks.shape[1] - len(tables) + 1
    out = tables[0][chunks[:, :n]]
    for place in range(1, len(tables)):
        out += tables[place][chunks[:, place : place + n]]
    return out


def summary(pooled: np.ndarray) -> np.ndarray:
    return np.concatenate([pooled.mean(axis=0), pooled.max(axis=0), pooled.min(axis=0)])


def train(texts: list[str], labels: np.ndarray, *, epochs: int = 12, rate: float = 0.01, chunks: int = 12, seed: int = 7) -> Network:
    """Adam over shuffled batches; of each document up to ``chunks`` chunks an epoch, drawn anew."""
    draw = np.random.default_rng(seed)
    cut = [chunks_of(t) for t in texts]
    p = {
        "emb": draw.normal(0, 0.5, (PAD + 1, EMBEDDING)),
        "conv": draw.normal(0, 0.3, (WIDTH, EMBEDDING, FILTERS)),
        "bias": np.zeros(FILTERS),
        "out": draw.normal(0, 0.1, 3 * FILTERS),
        "off": np.zeros(1),
    }
    p = {k: v.astype(np.float32) for k, v in p.items()}
    first, second, step, size = {}, {}, 0, 32
    for epoch in range(epochs):
        order = draw.permutation(len(texts))
        for at in range(0, len(order), size):
            docs, step = order[at : at + size], step + 1
            picked = [cut[d] if len(cut[d]) <= chunks else cut[d][draw.choice(len(cut[d]), chunks, replace=False)] for d in docs]
            grad = gradients(p, picked, labels[docs])
            pace = rate * 0.5 * (1 + np.cos(np.pi * epoch / epochs))
            for k, g in grad.items():
                g = g + 1e-4 * p[k] if k in ("out", "conv") else g
                first[k] = 0.9 * first.get(k, 0) + 0.1 * g
                second[k] = 0.999 * second.get(k, 0) + 0.001 * g * g
                p[k] -= (pace * first[k] / (1 - 0.9**step) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)).astype(np.float32)
    tables = np.einsum("be,wef->wbf", p["emb"], p["conv"]).astype(np.float32)
    return Network(tables, p["bias"], p["out"], float(p["off"][0]))


def gradients(p: dict[str, np.ndarray], picked: list[np.ndarray], labels: np.ndarray) -> dict[str, np.ndarray]:
    """Of the mean log loss. Through a maximum only its place counts, so the way back is sparse."""
    rows = np.concatenate(picked)
    doc = np.repeat(np.arange(len(picked)), [len(c) for c in picked])
    tables = np.einsum("be,wef->wbf", p["emb"], p["conv"])
    found = responses(tables, rows)
    place = found.argmax(axis=1)  # chunk, filter
    top = np.take_along_axis(found, place[:, None, :], axis=1)[:, 0] + p["bias"]
    pooled = np.maximum(top, 0.0)
    ends = np.cumsum([len(c) for c in picked])
    spans = list(zip(ends - [len(c) for c in picked], ends, strict=True))
    vectors = np.array([summary(pooled[a:b]) for a, b in spans])
    guess = 1 / (1 + np.exp(-(vectors @ p["out"] + p["off"])))
    error = ((guess - labels) / len(labels)).astype(np.float32)
    back = error[:, None] * p["out"]  # document, summary
    f = FILTERS
    d_pooled = back[doc, :f] / np.diff(np.concatenate([[0], ends]))[doc][:, None]
    columns = np.arange(f)
    for k, (a, b) in enumerate(spans):
        d_pooled[a + pooled[a:b].argmax(axis=0), columns] += back[k, f : 2 * f]
        d_pooled[a + pooled[a:b].argmin(axis=0), columns] += back[k, 2 * f :]
    d_top = np.where(top > 0, d_pooled, 0.0).astype(np.float32)
    grad = {"out": vectors.T @ error, "off": error.sum(keepdims=True), "bias": d_top.sum(axis=0), "conv": np.empty_like(p["conv"]), "emb": np.zeros_like(p["emb"])}
    for w in range(WIDTH):
        read = np.take_along_axis(rows, place + w, axis=1)  # chunk, filter: the byte that met place w
        grad["conv"][w] = np.einsum("cf,cfe->ef", d_top, p["emb"][read])
        np.add.at(grad["emb"], read, d_top[..., None] * p["conv"][w].T)
    return grad


def fit_quality(
    docs: DataFrame,
    labels: DataFrame,
    learnable: Column,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    per_label: int = 1500,
    train_bytes: int = 1 << 15,
) -> Network | None:
    """A network from at most ``per_label`` documents of either label; None without both."""
    taught = labels.where(learnable & F.col(label_col).isin(0, 1)).select(
        F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("label")
    )
    shares = {r["label"]: r["n"] for r in taught.groupBy("label").agg(F.count("*").alias("n")).collect()}
    if len(shares) < 2:
        return None
    text = F.coalesce(F.col(text_col), F.lit(""))
    short = docs.select(F.col(id_col).alias("id"), text.alias("text")).where(F.octet_length("text") <= train_bytes)
    chosen = bounded_sample(taught.join(short.select("id"), "id", "left_semi"), "label", F.col("id"), per_label)
    rows = short.join(F.broadcast(chosen), "id").select("label", "text")  # 2 per_label rows
    found = sorted(map(tuple, rows.collect()))
    target = np.array([y for y, _ in found], np.float32)
    if not 0 < target.sum() < len(target):
        return None
    network = train([t for _, t in found], target)
    ones = target.sum()
    shift = np.log(shares[1] / shares[0]) - np.log(ones / (len(target) - ones))
    return network._replace(offset=network.offset + float(shift))


def score_quality(docs: DataFrame, network: Network | None, *, text_col: str = "text", score_col: str = "score") -> DataFrame:
    """``docs`` with the probability of label 1 as one more column."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            logits = [network.logit(t.as_py() or "") if network else 0.0 for t in batch[text_col]]
            scores = 1 / (1 + np.exp(-np.clip(logits, -30, 30)))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(scores, pa.float64())], [*batch.schema.names, score_col])

    schema = T.StructType([*docs.schema.fields, T.StructField(score_col, T.DoubleType())])
    return docs.mapInArrow(run, schema)


def held_out(id_col: str = "doc_id") -> Column:
    return F.coalesce(crc_bucket(id_col, 4) == 2, F.lit(False))


def classify_quality(
    docs: DataFrame, labels: DataFrame, *, threshold: float = 0.7, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """id, held_out, score and predicted of every document; learned from the rows not held out."""
    network = fit_quality(docs, labels, ~held_out(id_col) & F.col(id_col).isNotNull(), id_col=id_col, text_col=text_col)
    scored = score_quality(docs.select(id_col, text_col), network, text_col=text_col)
    return scored.select(id_col, held_out(id_col).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
