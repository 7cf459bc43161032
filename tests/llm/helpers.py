"""Small documents with the awkward cases every operator must take."""

import random


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, words string, n long, row string"
WORDS = "the of and river stone cloud lamp table winter green glass paper seven train morning copper".split()


def sentence(n, seed, words=WORDS):
    draw = random.Random(seed)
    return " ".join(draw.choice(words) for _ in range(n))


def awkward_rows():
    """Null and empty texts, repeated rows, null ids and sources, one very long text."""
    long_text = sentence(60_000, 1)
    texts = [
        (1, "One  two\tthree"), (2, "One two three"), (3, None), (4, ""), (5, "  \n "), (6, "x"),
        (7, sentence(120, 7)), (8, sentence(120, 7)), (8, sentence(120, 7)), (9, sentence(119, 7) + " end"),
        (10, long_text), (11, long_text + " tail"), (None, "no id"), (None, "no id"), (None, None),
        (12, "ÄÖÜ ß É 日本語 ok fine"), (13, sentence(50, 13)), (14, "A B c " + sentence(40, 13)),
    ]
    return [
        (i, t, ["en", "de", None][k % 3], ["a", None, "b"][k % 3], len(t or ""), 0.5, "w", 1, "r")
        for k, (i, t) in enumerate(texts)
    ]


def awkward(spark):
    return spark.createDataFrame(awkward_rows(), SCHEMA).repartition(4)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def same_rows(left, right):
    def key(row):
        return tuple((v is None, str(v)) for v in row)

    return sorted(map(tuple, left), key=key) == sorted(map(tuple, right), key=key)


