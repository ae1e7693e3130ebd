"""Near-duplicates close to their threshold."""

import random

from test_pairs import plain_sets

import corpus_pipeline
from corpusmill.llm import neardup
from corpusmill.llm.neardup import near_duplicates, rooted
from corpusmill.llm.queries import table


def similar_pair(rng, k, low, high, n=120):
    """Two texts of their own words whose similarity is in [low, high)."""
    while True:
        a = [f"p{k}w{j}" for j in range(n)]
        b = list(a)
        for _ in range(rng.randrange(1, 5)):
            b[rng.randrange(n)] = f"p{k}x{rng.randrange(10**6)}"
        x, y = plain_sets([(0, " ".join(a)), (1, " ".join(b))])
        if low <= len(x & y) / len(x | y) < high:
            return " ".join(a), " ".join(b)


def plain_roots(docs, percent):
    """doc_id -> smallest doc_id over the links of that similarity."""
    sets, links = plain_sets(docs), []
    for i, a in enumerate(sets):
        for j in range(i):
            common = len(a & sets[j])
            if a and sets[j] and 100 * common >= percent * (len(a) + len(sets[j]) - common):
                links.append((docs[i][0], docs[j][0]))
    roots = rooted(links)
    return {d: roots.get(d, d) for d, _ in docs}


def test_stage_links_from_80_on(spark):
    rng = random.Random(4)
    texts = [t for k in range(60) for t in similar_pair(rng, k, 0.8, 0.85)] + [t for k in range(60, 90) for t in similar_pair(rng, k, 0.7, 0.8)]
    docs = list(enumerate(texts))
    wanted = plain_roots(docs, 80)
    df = spark.createDataFrame(docs, "doc_id long, text string")
    kept = {r.doc_id for r in corpus_pipeline.near_dedup(spark, df, "").collect()}
    assert kept == {k for k, root in wanted.items() if k == root} and len(kept) == 120
    assert {r.doc_id: r.component_id for r in near_duplicates(df, 85).collect()} == plain_roots(docs, 85)


def test_stage_like_brute_force(spark):
    docs = table(spark, "/root/testdata/sf0.001", "documents")
    wanted = plain_roots([(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()], 80)
    assert {r.doc_id for r in corpus_pipeline.near_dedup(spark, docs, "").collect()} == {k for k, root in wanted.items() if k == root}


def test_large_regions_lose_no_pairs(spark, monkeypatch):
    """Each pair is a region of two blocks, which is over the bound."""
    monkeypatch.setattr(neardup, "REGION_SETS", 1)
    monkeypatch.setattr(neardup, "REGION_BLOCKS", 1)
    rng = random.Random(5)
    texts = [t for k in range(700) for t in similar_pair(rng, k, 0.85, 0.87)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert [r.doc_id for r in near_duplicates(df, 85).collect() if r.component_id != r.doc_id - r.doc_id % 2] == []
