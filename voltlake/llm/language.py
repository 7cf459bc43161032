"""Language identification in two steps: family, then language within the family.

A text is the square roots of the shares of its hashed letter groups (one to three bytes of the
lower-cased UTF-8). Linear support vector machines, one for each pair of families, vote for the
family; within it one machine for each pair of its languages, trained on those two alone, votes
for the language. So closely related languages are told apart by what separates them and not
by what separates them from all others.

The machines are fitted on at most ``per_language`` labelled rows of each language, chosen by
hash; every text is then judged whole, in its task.

Defined cases: a null text, or one without a letter, is ``und`` with score 0, as is every text
when nothing could be learned; rows without a language, or with a null id, teach nothing; a
null id isn't held out; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voltlake.llm.sampling import bounded_sample, crc_bucket

#: Families of common language codes (fixed values). A code not named is a family of its own.
FAMILIES = {
    "germanic": "en de nl sv da no nb nn is af fy lb yi fo",
    "romance": "fr es it pt ro ca gl oc la",
    "slavic": "ru uk be pl cs sk bg sr hr bs sl mk",
    "baltic": "lt lv",
    "celtic": "ga gd cy br",
    "uralic": "fi et hu",
    "turkic": "tr az kk uz ky tk tt",
    "semitic": "ar he mt am",
    "indic": "hi bn ur mr gu pa ne si",
    "iranian": "fa ps ku tg",
    "dravidian": "ta te kn ml",
    "austronesian": "id ms tl jv",
}
DIMENSIONS = 4096
#: Bytes turned into features at once.
BLOCK = 1 << 20
LETTER = regex.compile(r"\p{L}")


def features(text: str) -> np.ndarray:
    """Unit vector of the whole text."""
    data = np.frombuffer(text.lower().encode("utf-8", "surrogatepass"), np.uint8).astype(np.uint32)
    counts = np.zeros(DIMENSIONS, np.int64)
    for at in range(0, len(data), BLOCK):
        code = data[at : at + BLOCK + 2]
        for length, rest in ((1, code), (2, code[1:]), (3, code[2:])):
            n = min(BLOCK, len(rest))
            if n <= 0:
                break
            hashed = np.full(n, length, np.uint32) * np.uint32(0x9E3779B1)
            for i in range(length):
                hashed = (hashed ^ code[i : i + n]) * np.uint32(0x85EBCA6B)
                hashed ^= hashed >> np.uint32(15)
            counts += np.bincount(hashed & np.uint32(DIMENSIONS - 1), minlength=DIMENSIONS)
    roots = np.sqrt(counts, dtype=np.float32)
    return roots / max(float(np.linalg.norm(roots)), 1e-9)


def fit_machine(x: np.ndarray, y: np.ndarray, cost: float = 10.0, rounds: int = 150) -> np.ndarray:
    """Weights and bias of a linear support vector machine with squared hinge, y in -1, 1.

    Accelerated gradient descent; the classes count alike however many rows they have.
    """
    x = np.hstack([x, np.ones((len(x), 1), np.float32)])
    share = np.where(y > 0, 0.5 / max(1, (y > 0).sum()), 0.5 / max(1, (y < 0).sum()))
    step = 1.0 / (1.0 + 4.0 * cost)  # rows have norm sqrt 2 at most
    w = np.zeros(x.shape[1])
    ahead, momentum = w.copy(), 1.0
    for _ in range(rounds):
        slack = np.maximum(0.0, 1.0 - y * (x @ ahead))
        grad = ahead - 2.0 * cost * (x.T @ (share * slack * y))
        following = ahead - step * grad
        faster = (1.0 + np.sqrt(1.0 + 4.0 * momentum**2)) / 2.0
        ahead = following + (momentum - 1.0) / faster * (following - w)
        w, momentum = following, faster
    return w


class Duel(NamedTuple):
    """One machine for each pair of classes."""

    classes: list[str]
    pairs: list[tuple[int, int]]
    weights: np.ndarray  # one row for each pair, bias last
    slope: float

    def shares(self, x: np.ndarray) -> np.ndarray:
        """For each row and class the mean of its duels' probabilities."""
        out = np.zeros((len(x), len(self.classes)))
        if not self.pairs:
            return out + 1.0
        margins = x @ self.weights[:, :-1].T + self.weights[:, -1]
        first = 1.0 / (1.0 + np.exp(-np.clip(self.slope * margins, -30, 30)))
        for k, (a, b) in enumerate(self.pairs):
            out[:, a] += first[:, k]
            out[:, b] += 1.0 - first[:, k]
        return out / (len(self.classes) - 1)


def fit_duel(x: np.ndarray, labels: np.ndarray, slope: float = 4.0) -> Duel:
    classes = sorted(set(labels.tolist()))
    pairs = list(combinations(range(len(classes)), 2))
    weights = []
    for a, b in pairs:
        rows = (labels == classes[a]) | (labels == classes[b])
        weights.append(fit_machine(x[rows], np.where(labels[rows] == classes[a], 1.0, -1.0)))
    return Duel(classes, pairs, np.array(weights).reshape(len(pairs), x.shape[1] + 1), slope)


class LanguageModel(NamedTuple):
    families: Duel
    languages: dict[str, Duel]

    def predict(self, x: np.ndarray) -> tuple[list[str], np.ndarray]:
        by_family = self.families.shares(x)
        best = by_family.argmax(axis=1)
        names, scores = [""] * len(x), by_family.max(axis=1)
        for k, family in enumerate(self.families.classes):
            rows = np.flatnonzero(best == k)
            if len(rows):
                duel = self.languages[family]
                shares = duel.shares(x[rows])
                for row, share in zip(rows, shares, strict=True):
                    names[row] = duel.classes[int(share.argmax())]
                    scores[row] *= share.max()
        return names, np.clip(scores, 0.0, 1.0)


def family_of(language: str, families: dict[str, str] = FAMILIES) -> str:
    code = language.lower().replace("_", "-").split("-")[0]
    return next((name for name, codes in families.items() if code in codes.split()), f"={language}")


def fit_languages(
    docs: DataFrame,
    learnable: Column,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    per_language: int = 300,
) -> LanguageModel | None:
    """A model from at most ``per_language`` rows of each language; None without any row."""
    rows = docs.where(learnable & F.col(lang_col).isNotNull() & F.col(text_col).rlike(r"\p{L}")).select(
        F.col(id_col).alias("id"), F.col(lang_col).alias("lang"), F.col(text_col).alias("text")
    )
    # A row with only the id is ranked; texts are looked up for the chosen ones.
    chosen = bounded_sample(rows.select("id", "lang"), "lang", F.col("id"), per_language)
    sample = rows.join(F.broadcast(chosen.distinct()), ["id", "lang"])  # per_language rows a language

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = [features(t.as_py()).astype("<f4").tobytes() for t in batch["text"]]
            yield pa.RecordBatch.from_arrays([batch["lang"], pa.array(vectors, pa.binary())], ["lang", "x"])

    found = sorted(map(tuple, sample.select("lang", "text").mapInArrow(run, "lang string, x binary").collect()))
    if not found:
        return None
    x = np.frombuffer(b"".join(v for _, v in found), "<f4").reshape(len(found), -1)
    labels = np.array([lang for lang, _ in found], dtype=object)
    family = np.array([family_of(lang) for lang in labels], dtype=object)
    return LanguageModel(
        fit_duel(x, family),
        {name: fit_duel(x[family == name], labels[family == name]) for name in set(family.tolist())},
    )


def predict_languages(
    docs: DataFrame, model: LanguageModel | None, *, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """id, lang_pred and score of every whole text."""
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, scores = ["und"] * batch.num_rows, [0.0] * batch.num_rows
            texts = [(i, t) for i, t in enumerate(batch["text"].to_pylist()) if t and LETTER.search(t)]
            for at in range(0, len(texts) if model else 0, 256):
                part = texts[at : at + 256]
                found = model.predict(np.array([features(t) for _, t in part]))
                for (i, _), name, score in zip(part, *found, strict=True):
                    names[i], scores[i] = name, float(score)
            yield pa.RecordBatch.from_arrays(
                [batch["id"], pa.array(names, pa.string()), pa.array(scores, pa.float64())], ["id", "lang_pred", "score"]
            )

    return (
        docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
        .mapInArrow(run, f"id {id_type}, lang_pred string, score double")
        .withColumnRenamed("id", id_col)
    )


def identify_languages(docs: DataFrame, *, id_col: str = "doc_id", folds: int = 3, held: int = 1, **names) -> DataFrame:
    """id, held_out, lang_pred, score; learned from the rows that aren't held out."""
    held_out = F.coalesce(crc_bucket(id_col, folds) == held, F.lit(False))
    model = fit_languages(docs, ~held_out & F.col(id_col).isNotNull(), id_col=id_col, **names)
    text = {k: v for k, v in names.items() if k == "text_col"}
    return predict_languages(docs, model, id_col=id_col, **text).select(
        id_col, held_out.alias("held_out"), "lang_pred", "score"
    )
