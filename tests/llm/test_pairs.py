"""Near-duplicates against brute force."""

import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from corpusmill.llm import neardup
from corpusmill.llm.neardup import components, linked, near_duplicates, rooted, shingles


def words(text):
    return (text or "").encode().lower().split()


def plain_sets(docs):
    out = []
    for _, text in docs:
        w = words(text)
        out.append({tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set()))
    return out


def brute(docs):
    sets, links = plain_sets(docs), []
    for i, a in enumerate(sets):
        for j in range(i):
            common = len(a & sets[j])
            if a and sets[j] and 100 * common >= 85 * (len(a) + len(sets[j]) - common):
                links.append((docs[i][0], docs[j][0]))
    roots = rooted(links)
    return {d: (len(s), roots.get(d, d)) for (d, _), s in zip(docs, sets, strict=True)}


def check(spark, docs):
    df = spark.createDataFrame([(d, "x", t, 7) for d, t in docs], "doc_id long, root string, text string, size long")
    found = near_duplicates(df).collect()
    assert len(found) == len(docs)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found} == brute(docs)
    assert all(r.kept == (r.doc_id == r.component_id) for r in found)


def corpus(seed, groups, copies, n=80, vocabulary=3000):
    rng = random.Random(seed)
    docs, k = [], 0
    for _ in range(groups):
        base = [f"w{rng.randrange(vocabulary)}" for _ in range(rng.randrange(6, n))]
        for _ in range(rng.randrange(1, copies)):
            own = list(base)
            for _ in range(rng.choice([0, 0, 1, 2, 5])):
                own[rng.randrange(len(own))] = f"x{rng.randrange(10**6)}"
            docs.append((k, (" " if rng.random() < 0.5 else "\n").join(own)))
            k += 1
    rng.shuffle(docs)
    return docs


def test_like_brute_force(spark):
    check(spark, corpus(1, 40, 8))


def test_edge_cases(spark):
    long = " ".join(f"long{k}" for k in range(30_000))
    check(spark, [(1, None), (2, ""), (3, " \n"), (4, "one two"), (5, "ONE  two"), (6, "one two three four five"), (7, "É é"), (8, "é é"), (9, long), (10, long + " end"), (11, "one two three")])


def test_empty_table(spark):
    assert near_duplicates(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_repeated_and_missing_ids(spark):
    rows = [(1, "a b c d e f"), (1, "u v w x y z"), (2, "u v w x y z"), (None, "a b c d e f"), (None, "only here in this text")]
    found = near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r.doc_id or 0, r.component_id or 0, r.kept) for r in found) == [(0, 0, True), (0, 1, False), (1, 1, True), (1, 1, True), (2, 1, False)]


@pytest.mark.parametrize("blocks", [1, 8])
def test_large_regions(spark, monkeypatch, blocks):
    """Regions over the bound meet in blocks, or deepen first; nothing is lost."""
    monkeypatch.setattr(neardup, "REGION_SETS", 4)
    monkeypatch.setattr(neardup, "REGION_BLOCKS", blocks)
    rng = random.Random(9)
    base = [f"w{k}" for k in range(200)]
    docs = [(k, " ".join([*base[:-1], f"tail{k}"])) for k in range(25)] + [(100 + k, " ".join(rng.sample(base, 50))) for k in range(5)]
    check(spark, docs)


@settings(max_examples=15, deadline=None)
@given(st.lists(st.lists(st.integers(0, 40), max_size=30), max_size=14))
def test_linked(sets):
    arrays = [np.array(sorted(set(s)), np.uint64) for s in sets if s]
    names = list(range(len(arrays)))
    wanted = [(x, x) for x in names]
    for i, a in enumerate(arrays):
        for j in range(i):
            common = len(np.intersect1d(a, arrays[j]))
            if 100 * common >= 85 * (len(a) + len(arrays[j]) - common):
                wanted.append((i, j))
    assert linked(names, arrays) == rooted(wanted)


@pytest.mark.parametrize("seed", [1, 2])
def test_components(spark, seed):
    rng = random.Random(seed)
    edges = [(k, k + 1) for k in range(40)] + [(rng.randrange(100, 200), rng.randrange(100, 200)) for _ in range(70)] + [(500, k) for k in range(501, 560)]
    edges = [(a, b) for a, b in edges if a != b]
    df = spark.createDataFrame([(min(e), max(e)) for e in edges], "a long, b long").repartition(5)
    assert dict(map(tuple, components(df).collect())) == rooted(edges)


def test_shingles():
    assert len(shingles("a b c d e f")) == 2 and len(shingles("A")) == 1 and np.array_equal(shingles("A b"), shingles("a\tB"))
