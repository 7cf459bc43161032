"""Benchmark decontamination by a positional inverted index, in DataFrame functions only.

The index is a table of postings (row, position, term) of the training texts for the terms
that occur in the benchmark. A phrase is looked up from its rarest term: that term's postings,
moved by its offset, are the places where the phrase could start. The other terms' postings,
moved by theirs, are intersected with those places; a place at which all meet is an exact
match. Proximity matches ask for a phrase's rarest terms within a distance instead; they are
counted on request.

A phrase is ``window`` consecutive words of an item, or the whole item if it is shorter. Terms
and rows are numbers in the index; texts are read once.

Defined cases: a null text has no words; an item without words has no phrase; an item with a
null id marks words but isn't named; repeated rows are rows of their own; extra columns are
ignored; an empty benchmark leaves every document clean.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from voltlake.llm.common import ascii_lower, kept_rows, staged, text_digest

#: A word: digits, lower-case letters and everything beyond ASCII.
TOKEN = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


class Index(NamedTuple):
    rows: DataFrame  # row, id, digest, n_words: one for each document
    postings: DataFrame  # row, pos (from 0), term
    phrases: DataFrame  # phrase, offset (from 0), term, n_terms
    items: DataFrame  # phrase, item


def words_of(text: Column) -> Column:
    lowered = ascii_lower(F.coalesce(text, F.lit("")))
    return F.regexp_extract_all(lowered, F.lit(TOKEN), F.lit(0))


def phrases_of(items: DataFrame, id_col: str, text_col: str, window: int) -> tuple[DataFrame, DataFrame]:
    """Distinct phrases (phrase, words), and (phrase, item)."""
    words = F.col("words")
    starts = F.sequence(F.lit(1), F.greatest(F.size(words) - window + 1, F.lit(1)))
    found = (
        items.select(F.col(id_col).cast("string").alias("item"), words_of(F.col(text_col)).alias("words"))
        .where(F.size("words") > 0)
        .select("item", F.explode(F.transform(starts, lambda i: F.slice(words, i, window))).alias("words"))
        .distinct()
    )
    found = staged(found, "windows")
    phrases = staged(
        found.select("words").distinct().withColumn("phrase", F.monotonically_increasing_id()), "phrases"
    )
    return phrases, staged(found.join(phrases, "words").select("phrase", "item"), "phrase_items")


def build_index(
    docs: DataFrame,
    items: DataFrame,
    *,
    window: int = 10,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    digests: bool = False,
) -> Index:
    """Postings of ``docs`` for the terms of ``items``, in tables of the shared folder."""
    phrases, phrase_items = phrases_of(items, item_col, item_text_col, window)
    placed = phrases.select("phrase", F.size("words").alias("n_terms"), F.posexplode("words").alias("offset", "word"))
    terms = staged(
        placed.select("word").distinct()
        # The empty string is no word. It stands for the head of a text, which every text has.
        .unionByName(items.sparkSession.createDataFrame([("",)], "word string"))
        .withColumn("term", F.monotonically_increasing_id()),
        "terms",
    )
    digest = text_digest(F.col(text_col)) if digests else F.lit(None).cast("string")
    tokens = (
        docs.select(
            F.monotonically_increasing_id().alias("row"),
            F.col(id_col).alias("id"), digest.alias("digest"), words_of(F.col(text_col)).alias("words"),
        )
        .select(
            "row", "id", "digest", F.size("words").alias("n_words"),
            F.posexplode(F.concat(F.array(F.lit("")), "words")).alias("pos", "word"),
        )
    )
    head = F.col("pos") == 0
    entries = tokens.join(terms, "word").select(
        "row", (F.col("pos") - 1).alias("pos"), "term", head.alias("head"),
        *[F.when(head, F.col(c)).alias(c) for c in ("id", "digest", "n_words")],
    )
    entries = staged(entries, "postings", ["head"])
    return Index(
        entries.where("head").select("row", "id", "digest", "n_words"),
        entries.where("not head").select("row", "pos", "term"),
        staged(placed.join(terms, "word").select("phrase", "offset", "term", "n_terms"), "placed"),
        phrase_items,
    )


def rarest_terms(index: Index, count: int) -> DataFrame:
    """phrase, offset, term, n_terms and rank of each phrase's rarest terms.

    A phrase with a term that has no posting matches nowhere and is left out.
    """
    known = index.postings.groupBy("term").agg(F.count("*").alias("n"))
    by_phrase = Window.partitionBy("phrase")  # as many rows as a phrase has words
    return (
        index.phrases.join(known, "term")
        .withColumn("present", F.count("*").over(by_phrase))
        .withColumn("rank", F.row_number().over(by_phrase.orderBy("n", "offset")))
        .where((F.col("present") == F.col("n_terms")) & (F.col("rank") <= count))
        .select("phrase", "offset", "term", "n_terms", "rank")
    )


def phrase_matches(index: Index, first: int = 3) -> DataFrame:
    """(row, phrase, start, n_terms) of every place where a phrase occurs word for word.

    The lists of a phrase's ``first`` rarest terms are intersected one after the other, each with
    the postings of such terms alone; what is left is held against all its terms.
    """
    rarest = staged(rarest_terms(index, first), "rarest")
    places = staged(
        index.postings.join(rarest.where("rank = 1"), "term")
        .select("phrase", "row", (F.col("pos") - F.col("offset")).alias("start"), "n_terms")
        .where("start >= 0"),
        "places",
    )
    for rank in range(2, first + 1):
        lookups = rarest.where(F.col("rank") == rank).select("phrase", "offset", "term")
        lists = index.postings.join(lookups.select("term").distinct(), "term", "left_semi")
        asked = places.join(lookups, "phrase").withColumn("pos", F.col("start") + F.col("offset"))
        met = asked.join(lists, ["row", "pos", "term"], "left_semi").select(places.columns)
        places = staged(met.unionByName(places.where(F.col("n_terms") < rank)), "places")
    asked = places.join(index.phrases.drop("n_terms"), "phrase").select(
        "phrase", "row", "start", "n_terms", (F.col("start") + F.col("offset")).alias("pos"), "term"
    )
    # The rows with a place grow with the input, so they are not broadcast at any size.
    within = index.postings.join(places.select("row").distinct().hint("merge"), "row", "left_semi")
    return (
        asked.join(within, ["row", "pos", "term"])
        .groupBy("phrase", "row", "start", "n_terms")
        .agg(F.count("*").alias("met"))
        .where("met = n_terms")
        .select("row", "phrase", "start", "n_terms")
    )


def nearest_terms(index: Index, count: int) -> DataFrame:
    """phrase and its ``count`` rarest terms of those that have postings, from the rarest on.

    Repeats of a term count once. Phrases with fewer such terms are left out, unless they have no
    more terms at all.
    """
    known = index.postings.groupBy("term").agg(F.count("*").alias("n"))
    return (
        index.phrases.groupBy("phrase", "term").agg(F.min("offset").alias("offset")).join(known, "term", "left")
        .groupBy("phrase")  # as many rows as a phrase has words
        .agg(
            F.count("*").alias("distinct"),
            F.array_sort(F.collect_list(F.when(F.col("n").isNotNull(), F.struct("n", "offset", "term")))).alias("present"),
        )
        .where(F.size("present") >= F.least("distinct", F.lit(count)))
        .select("phrase", F.slice(F.col("present.term"), 1, count).alias("terms"))
    )


def proximity_matches(index: Index, distance: int, terms: int = 3) -> DataFrame:
    """(row, phrase, pos) where a phrase's rarest terms lie within ``distance`` words of the
    rarest of them, in any order. A looser test than a phrase match, which it includes as
    far as the distance reaches. Places are met by stretches of text, not in pairs.

    Phrases with the same rarest terms are looked up once, from the places of the rarest."""
    wanted = staged(nearest_terms(index, terms), "nearest")
    groups = staged(
        wanted.select("terms").distinct().withColumn("group", F.monotonically_increasing_id()), "groups"
    )
    at_rank = groups.select("group", F.posexplode("terms").alias("rank", "term"))
    places = staged(
        index.postings.join(at_rank.where("rank = 0").select("group", "term"), "term").select("row", "group", "pos"),
        "near",
    )
    size = F.size("terms")
    for rank in range(1, terms):
        lookups = at_rank.where(F.col("rank") == rank).select("group", "term")
        stretch = F.floor(F.col("pos") / distance)
        asked = places.join(lookups, "group").select(
            *places.columns, "term", F.explode(F.array(*[stretch + i for i in (-1, 0, 1)])).alias("bin")
        )
        lists = index.postings.join(lookups.select("term").distinct(), "term", "left_semi").select(
            "row", "term", F.col("pos").alias("at"), stretch.alias("bin")
        )
        on = [asked[c] == lists[c] for c in ("row", "term", "bin")]
        met = asked.join(lists, [*on, F.abs(asked["pos"] - lists["at"]) <= distance], "left_semi")
        short = places.join(groups.where(size <= rank).select("group"), "group", "left_semi")
        places = staged(met.select(places.columns).distinct().unionByName(short), "near")
    return places.join(groups, "group").join(wanted, "terms").select("row", "phrase", "pos")


def near_items(index: Index, distance: int) -> DataFrame:
    """(row, n_near): items of which a phrase's rarest terms lie within ``distance`` words."""
    near = proximity_matches(index, distance).select("row", "phrase").distinct().join(index.items, "phrase")
    return near.groupBy("row").agg(F.count_distinct("item").alias("n_near"))


def hits(index: Index) -> DataFrame:
    """row, id, digest, n_words, n_hit, items of every document."""
    matches = staged(phrase_matches(index), "matches")
    covered = (
        matches.select("row", F.explode(F.sequence("start", F.col("start") + F.col("n_terms") - 1)).alias("pos"))
        .distinct().groupBy("row").agg(F.count("*").alias("n_hit"))
    )
    named = (
        matches.select("row", "phrase").distinct()
        .join(index.items, "phrase").groupBy("row")
        .agg(F.sort_array(F.collect_set("item")).alias("items"))
    )
    return (
        index.rows.join(covered, "row", "left").join(named, "row", "left")
        .withColumn("n_hit", F.coalesce("n_hit", F.lit(0)).cast("long"))
        .withColumn("items", F.coalesce("items", F.array().cast("array<string>")))
    )


def contamination(
    docs: DataFrame, items: DataFrame, *, window: int = 10, id_col: str = "doc_id", near: int | None = None, **names: str
) -> DataFrame:
    """One row per document: id, n_words, n_hit, n_items, items_sha256, contaminated.

    ``near`` adds n_near, the items of which a phrase's rarest terms lie within so many words.
    From ``window`` - 1 on it counts all items of n_items, too.
    """
    index = build_index(docs, items, window=window, id_col=id_col, **names)
    found = hits(index)
    if near is not None:
        found = found.join(near_items(index, near), "row", "left")
    return found.select(
        F.col("id").alias(id_col),
        F.col("n_words").cast("long").alias("n_words"),
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.encode(F.array_join("items", ","), "UTF-8"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
        *([] if near is None else [F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near")]),
    )


def without_contaminated(
    docs: DataFrame, items: DataFrame, *, window: int = 10, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Rows of ``docs``, all columns, in which no phrase of the benchmark occurs."""
    found = hits(build_index(docs, items, window=window, id_col=id_col, text_col=text_col, digests=True))
    hit = found.where("n_hit > 0").select(F.col("id").alias("__hit_id"), "digest").distinct()
    hit = staged(hit, "contaminated")
    keyed = docs.select(F.struct("*").alias("row"), F.col(id_col).alias("__id"), text_digest(F.col(text_col)).alias("__digest"))
    on = keyed["__id"].eqNullSafe(hit["__hit_id"]) & (keyed["__digest"] == hit["digest"])
    # The rows that go grow with the input, so they are not broadcast at any size.
    return keyed.join(hit.hint("merge"), on, "left_anti").select("row.*")
