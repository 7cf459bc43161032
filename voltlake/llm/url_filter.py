"""URL rules held in a cascade of Bloom filters, in DataFrame functions only.

The keys a corpus can ask for are known: every host suffix of a url with every path prefix that
is as long as some rule's. Level 0 encodes the listed keys, level 1 the keys of that universe
which level 0 wrongly lets through, level 2 the listed keys which level 1 wrongly lets through,
and so on until a level errs no more. For each key of the universe the cascade's answer is then
exact, and urls are judged by arithmetic on a few machine words: no join.

A level is one row, an array of 64-bit words. Level 0 takes some 1.44 log2(universe / listed)
bits a listed key, the others less, so what is shipped follows the list and not the corpus; a
list that needs more than ``max_filter_bytes`` is refused.

Defined cases: a null url, or one without ``://``, has an empty host and path and matches no
rule; the longest fitting rule (host and path together, then the host) wins; of a block and an
allow rule that are equal the block rule wins; without rules the default verdict holds.
"""

from __future__ import annotations

import math
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voltlake.llm.common import ascii_lower, staged

MAX_FILTER_BYTES = 64 << 20


class Level(NamedTuple):
    words: DataFrame  # one row, one column: array<bigint>
    bits: int
    hashes: int
    seed: int


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host and path of a url; both empty where there is no ``://``."""
    pattern = r"://([^/?#]*)([^?#]*)"
    part = lambda group: F.coalesce(F.regexp_extract(url, pattern, group), F.lit(""))
    return ascii_lower(part(1)), part(2)


def candidate_keys(host: Column, path: Column, labels: int, lengths: list[int]) -> Column:
    """Keys a rule could have to fit: host suffixes of up to ``labels`` labels, path prefixes."""
    names = F.split(host, r"\.")
    first = F.greatest(F.lit(1), F.size(names) - labels + 1)
    hosts = F.transform(
        F.sequence(first, F.size(names)),
        lambda i: F.array_join(F.slice(names, i, F.size(names)), "."),
    )
    cuts = F.filter(F.array(*[F.lit(n) for n in lengths]), lambda n: n <= F.length(path))
    keys = F.transform(
        hosts,
        lambda h: F.transform(
            cuts,
            lambda n: F.struct(F.concat(h, F.substring(path, F.lit(1), n)).alias("key"), F.length(h).alias("host")),
        ),
    )
    return F.when(host == "", F.array().cast("array<struct<key:string,host:int>>")).otherwise(F.flatten(keys))


def _positions(key: Column, bits: int, hashes: int, seed: int) -> list[Column]:
    a, b = (F.pmod(F.xxhash64(key, F.lit(seed + i)), F.lit(bits)) for i in (0, 1))
    return [(a + i * b) % bits for i in range(hashes)]


def _passes(key: Column, words: Column, level: Level) -> Column:
    found = F.lit(True)
    for at in _positions(key, level.bits, level.hashes, level.seed):
        word = F.element_at(words, (F.floor(at / 64) + 1).cast("int"))
        bit = F.call_function("shiftright", word, (at % 64).cast("int")).bitwiseAND(F.lit(1))
        found = found & (bit == 1)
    return found


def bloom_level(keys: DataFrame, count: int, rate: float, seed: int, most: int) -> Level:
    """A filter over ``count`` keys that lets through about ``rate`` of all others."""
    hashes = max(1, round(math.log2(1 / rate)))
    bits = 64 * max(1, math.ceil(1.4427 * count * math.log2(1 / rate) / 64))
    if bits / 8 > most:
        raise ValueError(f"a filter level needs {bits // 8} bytes, more than max_filter_bytes")
    at = F.explode(F.array(*_positions(F.col("key"), bits, hashes, seed))).alias("at")
    spark = keys.sparkSession
    set_words = (
        keys.select(at)
        .select(F.floor(F.col("at") / 64).alias("i"), F.expr("shiftleft(1L, cast(at % 64 as int))").alias("bit"))
        .groupBy("i").agg(F.bit_or("bit").alias("word"))
    )
    all_words = spark.range(bits // 64).select(F.col("id").alias("i"), F.lit(0).cast("long").alias("word"))
    words = (
        set_words.unionByName(all_words)
        .groupBy("i").agg(F.bit_or("word").alias("word"))
        .agg(F.transform(F.sort_array(F.collect_list(F.struct("i", "word"))), lambda x: x["word"]).alias("words"))
    )
    return Level(staged(words, "filter"), bits, hashes, seed)


def build_cascade(listed: DataFrame, universe: DataFrame, max_filter_bytes: int) -> list[Level]:
    """Levels that answer exactly for every key of ``universe``; both have one column, key."""
    listed = staged(listed.distinct(), "listed")
    n_listed = listed.count()
    if not n_listed:
        return []
    n_universe = universe.agg(F.approx_count_distinct("key")).first()[0]
    rate = min(0.5, n_listed / max(1, n_universe))
    levels = [bloom_level(listed, n_listed, rate, 0, max_filter_bytes)]
    passed = through(universe, levels[0]).distinct()
    other = staged(
        passed.select("key", F.lit(0).alias("listed"))
        .unionByName(listed.select("key", F.lit(1).alias("listed")))
        .groupBy("key").agg(F.max("listed").alias("listed")).where("listed = 0").select("key"),
        "wrong",
    )
    same = listed
    while n := other.count():
        levels.append(bloom_level(other, n, 0.5, 2 * len(levels), max_filter_bytes))
        same, other = other, staged(through(same, levels[-1]), "wrong")
    return levels


def through(keys: DataFrame, level: Level) -> DataFrame:
    """Keys that the level lets through."""
    return keys.where(_passes(F.col("key"), level.words.scalar(), level))


def is_listed(key: Column, levels: list[tuple[Level, Column]]) -> Column:
    """The cascade's answer: the first level that stops a key tells on which side it is."""
    answer = F.lit(len(levels) % 2 == 1)
    for i, (level, words) in reversed(list(enumerate(levels))):
        answer = F.when(_passes(key, words, level), answer).otherwise(F.lit(i % 2 == 1))
    return answer


def judge_urls(
    pages: DataFrame,
    rules: DataFrame,
    *,
    id_col: str = "page_id",
    url_col: str = "url",
    default: str = "allow",
    max_filter_bytes: int = MAX_FILTER_BYTES,
) -> DataFrame:
    """id, host, path, rule and verdict of every url.

    ``rules`` has verdict (block or allow), host and path; a path is empty or starts with ``/``.
    """
    listed = staged(
        rules.select("verdict", ascii_lower(F.col("host")).alias("host"), F.coalesce("path", F.lit("")).alias("path")),
        "rules",
    )
    # One row for each length of a rule's path, so no more than the longest path has characters.
    sizes = listed.groupBy(F.length("path").alias("n")).agg(F.max(F.size(F.split("host", r"\."))).alias("labels")).collect()
    host, path = url_parts(F.col(url_col))
    parts = pages.select(F.col(id_col).alias(id_col), host.alias("host"), path.alias("path"))
    if not sizes:
        return parts.select("*", F.lit(None).cast("string").alias("rule"), F.lit(default).alias("verdict"))
    labels, lengths = max(r["labels"] for r in sizes), sorted(r["n"] for r in sizes)
    keyed = parts.withColumn("keys", candidate_keys(F.col("host"), F.col("path"), labels, lengths))
    universe = staged(keyed.select(F.explode("keys.key").alias("key")).distinct(), "universe")

    words, cascades = {}, {}
    for verdict in ("allow", "block"):
        keys = listed.where(F.col("verdict") == verdict).select(F.concat("host", "path").alias("key"))
        levels = build_cascade(keys, universe, max_filter_bytes)
        names = [f"{verdict}{i}" for i in range(len(levels))]
        words |= {name: level.words.scalar() for name, level in zip(names, levels, strict=True)}
        cascades[verdict] = [(level, F.col(name)) for name, level in zip(names, levels, strict=True)]

    def fitting(verdict: str) -> Column:
        hits = F.filter("keys", lambda k: is_listed(k["key"], cascades[verdict]))
        return F.transform(
            hits,
            lambda k: F.struct(
                F.length(k["key"]).alias("n"), k["host"].alias("host"),
                F.lit(verdict).alias("verdict"), k["key"].alias("key"),
            ),
        )

    found = F.array_max(F.concat(fitting("allow"), fitting("block")))
    return (
        keyed.withColumns(words)
        .withColumn("found", found)
        .select(
            id_col, "host", "path", F.col("found.key").alias("rule"),
            F.coalesce("found.verdict", F.lit(default)).alias("verdict"),
        )
    )
