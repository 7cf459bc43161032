"""Columns of the documents may have any names, those that the operators use among them."""

import pytest
from helpers import awkward, sentence
from pyspark.sql import functions as F

import corpus_pipeline
from voltlake.llm import decontaminate, exact_dedup, mixing, simhash

NAMES = ["__id", "__digest", "__n", "__stays", "__key", "__hit_id", "__quality", "quality", "row", "digest", "special", "taken", "times", "__row", "copy"]

STAGES = {
    "exact": lambda spark, d: exact_dedup.without_exact_duplicates(d),
    "near": lambda spark, d: simhash.without_near_duplicates(d),
    "clean": lambda spark, d: decontaminate.without_contaminated(d, benchmark(spark)),
    "mix": lambda spark, d: mixing.mixed_rows(d),
    "good": lambda spark, d: good(spark, d),
}


def benchmark(spark):
    return spark.createDataFrame([(1, sentence(40, 13)), (2, "one two three")], "item_id long, text string")


def good(spark, docs):
    from unittest import mock

    labels = spark.createDataFrame([(i, i % 2) for i in range(15)], "doc_id long, quality int")
    with mock.patch.object(corpus_pipeline, "read_table", lambda *_: labels):
        return corpus_pipeline.good_quality(spark, docs, "")


def rows_of(df, columns):
    return sorted(map(str, df.select(*[F.col(f"`{c}`") for c in columns]).collect()))


@pytest.mark.parametrize("stage", list(STAGES))
def test_clashing_names_change_nothing(spark, stage):
    plain = awkward(spark).drop("row")
    named = plain.select("*", *[F.concat(F.lit(f"{n}:"), F.coalesce("source", F.lit("-"))).alias(n) for n in NAMES])
    expected, found = STAGES[stage](spark, plain), STAGES[stage](spark, named)
    assert set(found.columns) == set(expected.columns) | set(NAMES)
    assert rows_of(found, expected.columns) == rows_of(expected, expected.columns)
    assert found.where(" or ".join(f"`{n}` <> concat('{n}:', coalesce(source, '-'))" for n in NAMES)).count() == 0


def test_a_mix_of_a_mix(spark):
    once = mixing.mixed_rows(awkward(spark))
    twice = mixing.mixed_rows(once)
    assert twice.columns == once.columns and twice.columns.count("mix_times") == 1
    assert 0 < twice.count() <= once.count()
