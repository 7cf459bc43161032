"""Mixing sources to target weights by balanced sampling with the cube method.

Each source gets a target number of words; its documents are taken target / size times on
average. Whole takes are certain, the fraction left is an inclusion probability. The cube
method moves these probabilities inside the unit cube along directions in which neither the
number of documents nor the number of words changes, until they are 0 or 1. With two totals to
hold, any three documents leave such a direction: for sizes a, b, c it is (b - c, c - a, a - b).
The flight leaves two documents at most. With a few of all sizes that were kept back they are
the landing problem: of the choices that come nearest to both totals one is drawn.

Sources are flown in buckets of bounded size, however many documents they have. Each bucket
leaves two documents at most and the few it keeps back; these are flown again, until one bucket of
the source is left. Rows that are equal are numbered, so that their copies are dealt over the
buckets like other rows. Each source lands with its own last bucket, whatever the other sources' sizes.
Random numbers come from the seed, the source and the bucket, so reruns agree on any layout of the
rows.

Defined cases: a null text has no words; null is a source of its own, after all others; repeated
rows are drawn one by one; a document without words may be taken and adds nothing; extra columns
are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import random

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from voltlake.llm.common import WORD, staged, text_digest

#: Documents flown together.
BUCKET_ROWS = 8192
#: Documents kept back for the landing, which weighs all 2^(these + 2) choices.
LANDING_ROWS = 16
#: Equal rows that one row of the numbering stands for.
COPY_BLOCK = 4096
#: Distance from 0 or 1 below which a probability has arrived.
ARRIVED = 1e-9


def flight(sizes: list[float], probs: list[float], draw: random.Random) -> list[float]:
    """Probabilities moved to 0 or 1 in the given order, all but two documents at most.

    Sums of the probabilities, and of the probabilities times the sizes, are kept.
    """
    out, active = list(probs), []

    def move(units: list[int], way: list[float]) -> None:
        ahead = min((1 - out[i]) / w if w > 0 else -out[i] / w for i, w in zip(units, way, strict=True) if w)
        back = min(out[i] / w if w > 0 else (out[i] - 1) / w for i, w in zip(units, way, strict=True) if w)
        step = ahead if draw.random() * (ahead + back) < back else -back
        for i, w in zip(units, way, strict=True):
            p = out[i] + step * w
            out[i] = 0.0 if p < ARRIVED else 1.0 if p > 1 - ARRIVED else p

    for i, p in enumerate(out):
        if ARRIVED < p < 1 - ARRIVED:
            active.append(i)
        while len(active) == 3 or len(active) == 2 and sizes[active[0]] == sizes[active[1]]:
            a, b, *c = (sizes[k] for k in active)
            way = [b - c[0], c[0] - a, a - b] if c and not a == b == c[0] else [1.0, -1.0, 0.0][: len(active)]
            move(active, way)
            active = [k for k in active if 0 < out[k] < 1]
    return out


def landing(sizes: list[float], probs: list[float], draw: random.Random) -> list[float]:
    """The few documents that are left, set to 0 or 1.

    All choices are weighed. Of those that come nearest to the words, and then the documents,
    expected of them, one is drawn by how likely the probabilities make it.
    """
    out = list(probs)
    left = [i for i, p in enumerate(out) if 0 < p < 1]
    if not left:
        return out
    p, size = np.array([out[i] for i in left]), np.array([sizes[i] for i in left])
    choices = (np.arange(1 << len(left))[:, None] >> np.arange(len(left))) & 1
    apart = np.abs(choices @ size - p @ size) / max(1.0, size.mean()) + 0.25 * np.abs(choices.sum(1) - p.sum())
    near = np.argsort(apart, kind="stable")[: max(1, len(choices) // 1024)]
    likely = np.exp(np.where(choices[near] == 1, np.log(p), np.log1p(-p)).sum(1))
    taken = choices[draw.choices(near.tolist(), likely.tolist())[0]]
    for i, choice in zip(left, taken.tolist(), strict=True):
        out[i] = float(choice)
    return out


def part_flight(sizes: list[float], probs: list[float], draw: random.Random, keep: int) -> list[float]:
    """A flight of all but ``keep`` documents, whose probabilities stay as they are.

    They are kept back for the landing, or a long document that the flight leaves could
    not be made up for: half of them at equal steps of the words, half at equal steps of the
    rows, so that there are long and short ones. ``sizes`` fall.
    """
    open_ = [i for i, p in enumerate(probs) if 0 < p < 1]
    kept_back: set[int] = set()
    if open_:
        half = keep // 2
        words = np.cumsum([sizes[i] for i in open_])
        by_words = np.searchsorted(words, words[-1] * np.arange(half) / half)
        kept_back = {open_[k] for k in by_words} | {open_[k * len(open_) // half] for k in range(half)}
    moving = [i for i in open_ if i not in kept_back]
    out = list(probs)
    flown = flight([sizes[i] for i in moving], [probs[i] for i in moving], draw)
    for i, p in zip(moving, flown, strict=True):
        out[i] = p
    return out


def settle(sizes: list[float], probs: list[float], draw: random.Random) -> list[float]:
    """A flight and the landing. ``sizes`` fall."""
    return landing(sizes, part_flight(sizes, probs, draw, LANDING_ROWS), draw)


def targets(sizes: DataFrame, share: float, most: float, weights: tuple[int, ...]) -> DataFrame:
    """source, source_size, n, target: one row for each source of ``sizes`` (source, size).

    The total is dealt by weight; a target stops at ``most`` times its source's size and the
    excess is dealt again. That ends at one level x with target = least(cap, x * weight), so
    sources are capped in order of cap / weight.
    """
    per_source = sizes.groupBy("source").agg(
        F.sum("size").cast("long").alias("source_size"), F.count("*").alias("n"), F.max("size").alias("largest")
    )
    in_order = Window.orderBy(F.col("source").asc_nulls_last())  # a row for each source
    place = F.pmod(F.row_number().over(in_order) - 1, F.lit(len(weights))) + 1
    weighted = per_source.withColumn(
        "weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), place)
    ).withColumn("cap", most * F.col("source_size"))
    everyone = Window.partitionBy().orderBy().rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    before = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last()).rowsBetween(
        Window.unboundedPreceding, -1
    )
    free = (
        weighted.withColumn("total", share * F.sum("source_size").over(everyone))
        .withColumn("left", F.col("total") - F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
        .withColumn("rest", F.sum("weight").over(everyone) - F.coalesce(F.sum("weight").over(before), F.lit(0.0)))
        .withColumn("capped", F.col("cap") * F.col("rest") <= F.col("left") * F.col("weight"))
    )
    levelled = free.withColumn(
        "level", F.min(F.when(~F.col("capped"), F.struct((F.col("cap") / F.col("weight")).alias("o"), (F.col("left") / F.col("rest")).alias("x")))).over(everyone)["x"]
    )
    target = F.when(F.col("capped") | F.col("level").isNull(), F.col("cap")).otherwise(F.col("level") * F.col("weight"))
    return levelled.select("source", "source_size", "n", target.alias("target"))


def numbered(rows: DataFrame) -> DataFrame:
    """``rows`` with ``copy``, which numbers equal rows from 0.

    Equal rows are counted, and made again from blocks that are dealt over the tasks, so no task
    holds all copies of a row.
    """
    counted = rows.groupBy(*rows.columns).agg(F.count("*").alias("copies"))
    blocks = F.sequence(F.lit(0).cast("long"), F.floor((F.col("copies") - 1) / COPY_BLOCK))
    dealt = counted.withColumn("block", F.explode(blocks)).repartition("key", "block")
    first = F.col("block") * COPY_BLOCK
    copies = F.sequence(first, F.least(first + COPY_BLOCK, F.col("copies")) - 1)
    return dealt.withColumn("copy", F.explode(copies)).select(*rows.columns, "copy")


def fly(pending: DataFrame, level: int, seed: int, bucket_rows: int, keep: int) -> DataFrame:
    """One level of flights: rows of ``pending`` with ``p`` moved, by source and bucket.

    A source whose ``n`` rows fit one bucket lands. Buckets of the others keep ``keep`` rows back.
    """

    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["size", "key", "copy"], ascending=[False, True, True], kind="stable")
        draw = random.Random(f"{seed}/{level}/{rows['source'].iloc[0]!r}/{rows['bucket'].iloc[0]}")
        sizes = rows["size"].astype(float).tolist()
        probs = rows["p"].tolist()
        lands = rows["n"].iloc[0] <= bucket_rows
        return rows.assign(p=settle(sizes, probs, draw) if lands else part_flight(sizes, probs, draw, keep))

    buckets = F.when(F.col("n") <= bucket_rows, F.lit(1)).otherwise(F.ceil(F.col("n") / (bucket_rows // 2)))
    keyed = pending.withColumn("bucket", F.pmod(F.xxhash64("key", "copy", F.lit(level)), buckets))
    return keyed.groupBy("source", "bucket").applyInPandas(run, keyed.schema).drop("bucket")


def _drawn(
    docs: DataFrame, share: float, most: float, weights: tuple[int, ...], id_col: str, text_col: str,
    source_col: str, seed: int, bucket_rows: int,
) -> DataFrame:
    """id (as text), key, size, source_size, target, taken and times of every document."""
    rows = docs.select(
        F.col(id_col).cast("string").alias("id"),  # pandas has no long with nulls
        F.col(source_col).alias("source"),
        F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
        row_digest(id_col, text_col).alias("key"),
    )
    sized = staged(numbered(rows), "sizes")
    goals = staged(targets(sized, share, most, weights), "targets")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    aimed = goals.select(F.col("source").alias("goal"), "source_size", "target", "n", rate.alias("rate"))
    pending = sized.join(aimed, F.col("source").eqNullSafe(F.col("goal"))).select(
        "id", "source", "size", "key", "copy", "n", F.floor("rate").cast("int").alias("whole"), (F.col("rate") % 1).alias("p")
    )
    largest = goals.agg(F.max("n")).first()[0] or 0
    half = bucket_rows // 2  # documents in a bucket on average
    keep = max(0, min(LANDING_ROWS, 2 * half // 3 - 2))  # more in small buckets would not grow fewer
    done, level = [], 0
    while True:
        flown = staged(fly(pending, level, seed, bucket_rows, keep), "flight")
        done.append(flown.where("p = 0 or p = 1"))
        if largest <= bucket_rows:  # of the sources that have not landed before
            break
        pending = flown.where("p > 0 and p < 1").withColumn("n", F.ceil(F.col("n") / half) * (keep + 2))
        largest, level = -(-largest // half) * (keep + 2), level + 1
    settled = done[0]
    for more in done[1:]:
        settled = settled.unionByName(more)
    times = F.col("whole") + F.col("p").cast("int")
    return settled.join(aimed.drop("n", "rate"), F.col("source").eqNullSafe(F.col("goal"))).select(
        "id", "key", "size", "source_size", "target", (F.col("size") * times).cast("long").alias("taken"), times.alias("times")
    )


def row_digest(id_col: str, text_col: str) -> Column:
    """Tells rows apart that differ in id or text."""
    id_text = F.coalesce(F.col(id_col).cast("string"), F.lit("-"))
    return F.sha2(F.concat_ws("/", id_text, text_digest(F.col(text_col))), 256)


def mix(
    docs: DataFrame,
    *,
    share: float = 1.5,
    most: float = 2.0,
    weights: tuple[int, ...] = (3, 1, 2),
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    seed: int = 42,
    bucket_rows: int = BUCKET_ROWS,
) -> DataFrame:
    """id, size, source_size, target, taken and times of every document."""
    drawn = _drawn(docs, share, most, weights, id_col, text_col, source_col, seed, bucket_rows)
    return drawn.select(
        F.col("id").cast(docs.schema[id_col].dataType).alias(id_col), "size", "source_size", "target", "taken", "times"
    )


def mixed_rows(
    docs: DataFrame,
    *,
    share: float = 1.5,
    most: float = 2.0,
    weights: tuple[int, ...] = (3, 1, 2),
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    seed: int = 42,
    bucket_rows: int = BUCKET_ROWS,
) -> DataFrame:
    """The documents that the mix takes, with all their columns, mix_times and mix_words.

    Rows that are equal in id and text are given once, with the times of all. Columns of
    these two names that the documents have already, as the output of a mix does, are replaced.
    """
    drawn = _drawn(docs, share, most, weights, id_col, text_col, source_col, seed, bucket_rows)
    taken = staged(
        drawn.groupBy(F.col("key").alias("__key"))
        .agg(F.count("*").alias("__n"), F.sum("times").alias("mix_times"), F.sum("taken").alias("mix_words"))
        .where("mix_times > 0"),
        "taken",
    )
    rows = docs.select(F.struct("*").alias("row"), row_digest(id_col, text_col).alias("__key"))
    found = rows.join(taken.hint("merge"), "__key")
    once = found.where("__n = 1").unionByName(found.where("__n > 1").dropDuplicates(["__key"]))
    own = [F.col("row")[c].alias(c) for c in docs.columns if c not in ("mix_times", "mix_words")]
    return once.select(*own, "mix_times", "mix_words")
