"""The learner against a plain reading of its update, features against plain Python, held-out accuracy."""

import random
import zlib

import numpy as np
import pytest
from helpers import awkward, awkward_rows, empty, sentence

from voltlake.llm import toxicity

BAD = "vile awful horrid".split()


def plain_ftrl(rows, labels, alpha, beta, l1, l2):
    """One pass, coordinate by coordinate, with dictionaries."""
    z, n = {}, {}
    z0 = n0 = 0.0
    for row, y in zip(rows, labels):
        w = {}
        for i in row:
            if abs(z.get(i, 0)) > l1:
                w[i] = -(z[i] - np.sign(z[i]) * l1) / ((beta + n[i] ** 0.5) / alpha + l2)
        b = -z0 / ((beta + n0**0.5) / alpha)
        g = 1 / (1 + np.exp(-(sum(w.values()) + b))) - y
        for i in row:
            sigma = ((n.get(i, 0) + g * g) ** 0.5 - n.get(i, 0) ** 0.5) / alpha
            z[i] = z.get(i, 0) + g - sigma * w.get(i, 0)
            n[i] = n.get(i, 0) + g * g
        z0, n0 = z0 + g - ((n0 + g * g) ** 0.5 - n0**0.5) / alpha * b, n0 + g * g
    return {i: -(z[i] - np.sign(z[i]) * l1) / ((beta + n[i] ** 0.5) / alpha + l2) for i in z if abs(z[i]) > l1}


def test_updates_follow_the_formula():
    draw = random.Random(1)
    rows = [np.array(sorted(draw.sample(range(40), 6)), np.int32) for _ in range(300)]
    labels = [float(3 in r or draw.random() < 0.1) for r in rows]
    learner = toxicity.Ftrl(6, alpha=0.5, beta=1.0, l1=0.8, l2=0.1)
    for r, y in zip(rows, labels):
        learner.learn(r, y)
    found = learner.result()
    expected = plain_ftrl([r.tolist() for r in rows], labels, 0.5, 1.0, 0.8, 0.1)
    assert dict(zip(found.features.tolist(), found.values.tolist())) == pytest.approx(expected)
    assert 0 < len(expected) < 40  # some stay at zero


def test_blocks_see_every_feature(monkeypatch):
    text = sentence(500, 3) + " Straße ÉTÉ don't 42"
    whole = toxicity.Features().distinct(text)
    for block in (8, 17, 504, 505):
        monkeypatch.setattr(toxicity, "BLOCK", block)
        assert np.array_equal(toxicity.Features().distinct(text), whole)
    assert len(toxicity.Features().distinct("")) == len(toxicity.Features().distinct(" .,!")) == 0
    assert len(toxicity.Features().distinct("one")) == 1
    # one two three: 3 words, 2 pairs, 1 triple, 1 pair that skips a word
    assert len(toxicity.Features().distinct("One two THREE")) == 7


def toxic_rows(n=900):
    draw, rows, labels = random.Random(5), [], []
    for i in range(n):
        words = sentence(draw.randrange(5, 90), i).split()
        toxic = i % 4 == 0
        if toxic:
            for _ in range(3):
                words.insert(draw.randrange(len(words)), draw.choice(BAD))
        rows.append((i, " ".join(words)))
        if i % 7:
            labels.append((i, None, int(toxic)))
    return rows, labels


def labelled(spark, labels):
    return spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_held_out_accuracy(spark):
    rows, labels = toxic_rows()
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r.doc_id: r for r in toxicity.classify_toxicity(docs, labelled(spark, labels)).collect()}
    again = {r.doc_id: r for r in toxicity.classify_toxicity(docs.repartition(5), labelled(spark, labels).repartition(3)).collect()}
    assert found == again and len(found) == len(rows)
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0) for i, r in found.items())
    assert all(r.predicted == int(r.score >= 0.5) and 0 <= r.score <= 1 for r in found.values())
    held = [i for i, r in found.items() if r.held_out]
    assert np.mean([found[i].predicted == (i % 4 == 0) for i in held]) > 0.97


def test_weights_are_few_and_held_out_labels_teach_nothing(spark):
    rows, labels = toxic_rows()
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    weights = toxicity.fit_toxicity(docs, labelled(spark, labels), ~toxicity.held_out())
    assert 0 < len(weights.features) < 300
    other = [(i, q, t if zlib.crc32(str(i).encode()) % 5 else 1 - t) for i, q, t in labels]
    same = toxicity.fit_toxicity(docs, labelled(spark, other), ~toxicity.held_out())
    assert np.array_equal(weights.features, same.features) and np.allclose(weights.values, same.values)


def test_awkward_rows(spark):
    docs, rows = awkward(spark), awkward_rows()
    labels = labelled(spark, [(i % 14, 1, i % 2) for i in range(40)] + [(None, 1, 1), (3, 1, None), (5, 1, 7)])
    found = toxicity.classify_toxicity(docs, labels).collect()
    assert sorted(str(r.doc_id) for r in found) == sorted(str(r[0]) for r in rows)
    assert all(r.score is not None and r.held_out is not None for r in found)
    assert toxicity.classify_toxicity(empty(spark), labels).count() == 0
    for none in ([], [(1, 1, 0)]):
        assert {r.score for r in toxicity.classify_toxicity(docs, labelled(spark, none)).collect()} == {0.5}
    assert toxicity.score_toxicity(docs, None).columns == ["doc_id", "score"]
