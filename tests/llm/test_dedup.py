"""Exact, near and passage duplicates and decontamination against plain Python."""

import hashlib
import re
from collections import Counter, defaultdict

import pytest
import xxhash
from helpers import SCHEMA, awkward, awkward_rows, empty, sentence
from hypothesis import given, settings
from hypothesis import strategies as st

from voltlake.llm import decontaminate, exact_dedup, simhash, substring_dedup
from voltlake.llm.components import smallest_reachable

SPACE = re.compile(r"[\x20\x09-\x0D]+")


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def expected_exact(rows):
    groups = defaultdict(list)
    for r in rows:
        groups[SPACE.sub(" ", r[1] or "")].append(r[0])
    out = Counter()
    for text, ids in groups.items():
        known = [i for i in ids if i is not None]
        first = min(known) if known else None
        for k, i in enumerate(sorted(ids, key=lambda i: (i is None, i))):
            out[(i, first, len(ids), k == 0, sha(text))] += 1
    return out


@pytest.mark.parametrize("bits", [64, 1])
def test_exact_groups(spark, bits):
    """With one bit every chunk clashes, so identifiers have to be split."""
    rows = awkward_rows()
    found = exact_dedup.exact_duplicates(awkward(spark), chunk_min=8, chunk_max=40, hash_bits=bits)
    assert Counter(map(tuple, found.collect())) == expected_exact(rows)


def test_exact_rows_that_stay(spark):
    kept = exact_dedup.without_exact_duplicates(awkward(spark))
    assert kept.columns == awkward(spark).columns
    expected = Counter((r[0], r[4]) for r in expected_exact(awkward_rows()).elements() if r[3])
    assert Counter((r.doc_id, sha(SPACE.sub(" ", r.text or ""))) for r in kept.collect()) == expected


def test_chunks_make_up_the_text(spark):
    text = sentence(3000, 3) + "\n" + "z" * 20_000 + " é日" * 50
    df = spark.createDataFrame([(text,)], "t string")
    parts = df.select(exact_dedup.chunks_of(df.t).alias("c")).first().c
    assert "".join(parts) == text and len(parts) > 5 and max(map(len, parts)) <= exact_dedup.CHUNK_MAX


def naive_print(text):
    ws = words("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    shingles = [" ".join(ws[i : i + 3]) for i in range(max(1, len(ws) - 2))] if ws else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes)) if hashes else 0


def naive_components(prints, bits):
    """prints: id -> fingerprint; the smallest id that can be reached from each."""
    root = {i: i for i in prints}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(prints)
    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            if (prints[a] ^ prints[b]).bit_count() <= bits:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: find(i) for i in ids}


def test_simhash_of_awkward_texts(spark):
    rows = [r for r in awkward_rows() if r[0] is not None and len(r[1] or "") < 10_000]
    df = spark.createDataFrame(rows, SCHEMA)
    found = simhash.simhash_groups(df).collect()
    prints = {r[0]: naive_print(r[1]) for r in rows}
    assert len(found) == len(rows)
    assert {r.doc_id: r.fingerprint for r in found} == {i: f"{p:016x}" for i, p in prints.items()}
    assert {r.doc_id: r.component_id for r in found} == naive_components(prints, 2)
    assert simhash.simhash_groups(awkward(spark)).count() == len(awkward_rows())
    kept = simhash.without_near_duplicates(awkward(spark)).collect()
    groups = {r.component_id for r in simhash.simhash_groups(awkward(spark)).collect()}
    assert len(kept) == len(groups)


@pytest.mark.parametrize("list_max", [64, 2])
def test_near_pairs_lose_no_link(spark, list_max):
    """Many fingerprints around few centres; lists above two are not paired in the second run."""
    import random

    draw, prints = random.Random(5), set()
    for _ in range(4):
        centre = draw.getrandbits(64)
        for _ in range(40):
            prints.add(centre ^ sum(1 << b for b in draw.sample(range(24), draw.choice([1, 2, 3, 4]))))
    prints |= {draw.getrandbits(64) for _ in range(100)} | {0, (1 << 64) - 1, 1 << 63}
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    df = spark.createDataFrame([(p,) for p in signed], "fp long")
    pairs = simhash.near_pairs(df, 2, list_max)
    for a, b in pairs.collect():
        assert ((a ^ b) & (1 << 64) - 1).bit_count() <= 2
    roots = {r.node: r.root for r in smallest_reachable(pairs).collect()}
    expected = naive_components({p: p & (1 << 64) - 1 for p in signed}, 2)
    assert {p: roots.get(p, p) for p in signed} == expected


def test_components_of_a_chain_a_star_and_a_ring(spark):
    edges = [(i, i + 1) for i in range(60)] + [(500, 500 + i) for i in range(1, 200)] + [(i, 1000 + (i - 999) % 9) for i in range(1000, 1009)]
    found = smallest_reachable(spark.createDataFrame(edges + edges[:5] + [(7, 7)], "a long, b long"))
    rows = found.collect()
    assert len(rows) == len({r.node for r in rows}) == 61 + 200 + 9
    assert {r.root for r in rows} == {0, 500, 1000}
    assert smallest_reachable(spark.createDataFrame([], "a long, b long")).count() == 0


def expected_removed(texts, window):
    lists = [words(t) for t in texts]
    seen = Counter(tuple(w[i : i + window]) for w in lists for i in range(len(w) - window + 1))
    out = []
    for w in lists:
        gone = set()
        for i in range(len(w) - window + 1):
            if seen[tuple(w[i : i + window])] > 1:
                gone |= set(range(i, i + window))
        out.append((len(w), len(gone), sha(" ".join(x for i, x in enumerate(w) if i not in gone))))
    return out


@pytest.mark.parametrize("shortest", [35, 18, 5, 1])
def test_repeated_passages(spark, shortest):
    shared, other = sentence(60, 90), sentence(35, 91)
    texts = [
        sentence(80, 1) + " " + shared + " " + sentence(30, 2), sentence(20, 3) + "\n" + shared, shared,
        other + " x " + other, sentence(34, 4), sentence(34, 4), other[:-1], None, "", "the " * 100, sentence(200, 5),
        *[sentence(50, 6)] * 3,
    ]
    df = spark.createDataFrame([(i, t, 1) for i, t in enumerate(texts)], "doc_id long, text string, pos int").repartition(3)
    found = substring_dedup.remove_repeats(df, window=35, shortest=shortest).orderBy("doc_id").collect()
    assert [tuple(r)[1:] for r in found] == expected_removed(texts, 35)


def test_lengths_double_until_no_candidate_survives(spark, monkeypatch):
    assert substring_dedup.lengths_of(35, 5) == [5, 9, 18, 35] and substring_dedup.lengths_of(35, 35) == [35]
    taken, tally = [], substring_dedup._tally

    def watched(docs, window, length, before):
        taken.append(length)
        return tally(docs, window, length, before)

    monkeypatch.setattr(substring_dedup, "_tally", watched)
    own = [" ".join(f"{k}w{i}" for i in range(60)) for k in range(3)]
    shared = " ".join(f"s{i}" for i in range(20))  # shorter than the window: no window of 35 repeats
    cases = [
        (own, [5]),
        ([t + " " + shared for t in own], None),
        ([own[0] + " x " + own[0], own[1]], [5, 9, 18, 35]),
    ]
    for rows, lengths in cases:
        taken.clear()
        df = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
        found = substring_dedup.remove_repeats(df).orderBy("doc_id").collect()
        assert [tuple(r)[1:] for r in found] == expected_removed(rows, 35)
        assert taken == (lengths or [5, 9, 18, 35][: len(taken)])


def test_repeated_passages_of_awkward_rows(spark):
    """Repeated and null ids: equal rows have equal answers, no text is mixed up with another."""
    rows = awkward_rows()
    found = substring_dedup.remove_repeats(awkward(spark), window=20, shortest=10).collect()
    expected = expected_removed([r[1] for r in rows], 20)
    assert Counter(map(tuple, found)) == Counter((r[0], *e) for r, e in zip(rows, expected, strict=True))
    assert substring_dedup.remove_repeats(empty(spark)).count() == 0


@settings(max_examples=40, deadline=None)
@given(st.lists(st.integers(0, 2), max_size=60), st.integers(1, 9))
def test_window_hashes_tell_windows_apart(values, length):
    """Equal windows have equal hashes, others don't."""
    hashed = substring_dedup.word_hashes([b"%d" % v for v in values])
    found = substring_dedup.window_hashes(hashed, length)
    wanted = [tuple(values[i : i + length]) for i in range(len(values) - length + 1)]
    assert len(found) == len(wanted)
    assert len(set(found.tolist())) == len(set(wanted))
    assert len(set(zip(found.tolist(), wanted, strict=True))) == len(set(wanted))


TOKEN = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def tokens(text):
    return TOKEN.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def expected_contamination(texts, items, window):
    windows = defaultdict(set)
    for item, text in items:
        w = tokens(text)
        for i in range(max(1, len(w) - window + 1) if w else 0):
            windows[tuple(w[i : i + window])].add(item)
    out = []
    for text in texts:
        w, hit, named = tokens(text), set(), set()
        for length in {len(k) for k in windows}:
            for i in range(len(w) - length + 1):
                if (key := tuple(w[i : i + length])) in windows:
                    hit |= set(range(i, i + length))
                    named |= {str(x) for x in windows[key] if x is not None}
        out.append((len(w), len(hit), len(named), sha(",".join(sorted(named))), bool(hit)))
    return out


def test_contamination(spark):
    exam = sentence(25, 70)
    items = [(1, exam), (2, "Rare, WORD!"), (10, exam + " more"), (3, None), (4, " .. "), (5, "é日本"), (None, sentence(12, 71)), (1, exam)]
    texts = [
        sentence(40, 1) + ". " + exam.upper() + "! " + sentence(10, 2), exam[:60], "a rare-word here", "rare x word", None, "",
        "zz é日本, É日本", sentence(12, 71), " ".join(exam.split()[3:14]), "rare word " * 30, sentence(500, 72),
    ]
    docs = spark.createDataFrame([(i, t, "x", 1) for i, t in enumerate(texts)], "doc_id long, text string, word string, pos int")
    bench = spark.createDataFrame(items, "item_id long, text string")
    expected = expected_contamination(texts, items, 10)
    found = decontaminate.contamination(docs, bench).orderBy("doc_id").collect()
    assert [tuple(r)[1:] for r in found] == expected
    kept = decontaminate.without_contaminated(docs, bench)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {i for i, e in enumerate(expected) if not e[4]}


def test_contamination_of_awkward_rows(spark):
    rows, items = awkward_rows(), [(1, sentence(60, 7)), (2, "one two three"), (3, "no id")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    found = decontaminate.contamination(awkward(spark), bench).collect()
    expected = expected_contamination([r[1] for r in rows], items, 10)
    assert Counter(map(tuple, found)) == Counter((r[0], *e) for r, e in zip(rows, expected, strict=True))
    assert decontaminate.contamination(awkward(spark), bench.limit(0)).where("contaminated").count() == 0
    assert decontaminate.contamination(empty(spark), bench).count() == 0


def test_proximity(spark):
    docs = spark.createDataFrame(
        [(0, "alpha " + "x " * 3 + "gamma beta"), (1, "alpha " + "x " * 30 + "beta gamma"), (2, "beta alpha gamma alpha")],
        "doc_id long, text string",
    )
    bench = spark.createDataFrame([(1, "alpha beta gamma")], "item_id long, text string")
    index = decontaminate.build_index(docs, bench)
    near = decontaminate.proximity_matches(index, 6)
    ids = {r.id for r in near.join(index.rows, "row").select("id").distinct().collect()}
    assert ids == {0, 2} and decontaminate.phrase_matches(index).count() == 0


def test_near_items(spark):
    """Against brute force, with a word that the texts lack, repeated words and short items."""
    items = [(1, "alpha beta gamma absent"), (2, "alpha alpha beta"), (3, "delta"), (4, "absent missing"), (5, sentence(30, 3)), (None, "beta gamma")]
    texts = ["gamma x beta x alpha", "alpha x beta", "alpha " + "x " * 30 + "beta gamma delta", sentence(300, 4), sentence(40, 3), None, "delta delta"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    count = Counter(w for t in texts for w in tokens(t))

    def phrases(text):
        w = tokens(text)
        return {tuple(w[i : i + 10]) for i in range(max(1, len(w) - 9))} if w else set()

    def near(text, phrase):
        present = sorted({t for t in phrase if count[t]}, key=lambda t: (count[t], phrase.index(t)))
        if len(present) < min(3, len(set(phrase))):
            return False
        at = {t: [i for i, w in enumerate(tokens(text)) if w == t] for t in present}
        return any(all(any(abs(i - j) <= 10 for j in at[t]) for t in present[:3]) for i in at[present[0]])

    found = decontaminate.contamination(docs, bench, near=10).orderBy("doc_id").collect()
    expected = [sum(i is not None and any(near(t, p) for p in phrases(item)) for i, item in items) for t in texts]
    assert [r.n_near for r in found] == expected and expected[:3] == [2, 1, 1]
    assert all(r.n_near >= r.n_items for r in found)
    assert "n_near" not in decontaminate.contamination(docs, bench).columns


@pytest.mark.parametrize("operator", [exact_dedup.exact_duplicates, simhash.simhash_groups])
def test_empty_tables(spark, operator):
    assert operator(empty(spark)).count() == 0


def test_text_ids(spark):
    """Ids of another type, some null, pass through every operator on documents."""
    rows = [("a", sentence(60, 1)), (None, sentence(60, 1)), ("b", None), ("b", "x")]
    docs = spark.createDataFrame(rows, "doc_id string, text string")
    bench = spark.createDataFrame([(1, sentence(20, 1))], "item_id long, text string")
    removed = substring_dedup.remove_repeats(docs).collect()
    assert Counter((r.doc_id, r.n_removed) for r in removed) == Counter([("a", 60), (None, 60), ("b", 0), ("b", 0)])
    assert {r.keep_id for r in exact_dedup.exact_duplicates(docs).collect()} == {"a", "b"}
    assert {r.component_id for r in simhash.simhash_groups(docs).collect()} == {"a", "b"}
    assert decontaminate.contamination(docs, bench).where("contaminated").count() == 2
