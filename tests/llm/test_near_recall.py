"""Near-duplicates against an exact join of whole tables, and regions that are compared through leaders."""

import random
from collections import Counter, defaultdict

import pytest
from test_near_thresholds import plain_roots
from test_pairs import plain_sets

from corpusmill.llm import neardup
from corpusmill.llm.neardup import near_duplicates, rooted
from corpusmill.llm.queries import table


def exact_links(docs, percent):
    """All links of documents by prefix filtering: two sets at the threshold share one of their rarest elements; every candidate is compared."""
    sets = plain_sets(docs)
    often = Counter(x for s in sets for x in s)
    by_set = defaultdict(list)
    for (d, _), s in zip(docs, sets, strict=True):
        if s:
            by_set[frozenset(s)].append(d)
    links = [(ds[0], d) for ds in by_set.values() for d in ds[1:]]
    index, seen = defaultdict(list), sorted(by_set, key=len)
    for s in seen:
        prefix = sorted(s, key=lambda x: (often[x], x))[: len(s) - -(-percent * len(s) // 100) + 1]
        for other in {o for x in prefix for o in index[x]}:
            common = len(s & other)
            if 100 * common >= percent * (len(s) + len(other) - common):
                links.append((by_set[s][0], by_set[other][0]))
        for x in prefix:
            index[x].append(s)
    return links


@pytest.mark.parametrize("sf,percent", [("sf0.01", 80), ("sf0.1", 85)])
def test_whole_tables(spark, sf, percent):
    docs = table(spark, f"/root/testdata/{sf}", "documents").select("doc_id", "text")
    links = exact_links([tuple(r) for r in docs.collect()], percent)
    wanted = rooted(links)
    found = {r.doc_id: r.component_id for r in near_duplicates(docs, percent).collect()}
    assert len(links) >= 60 and all(found[d] == wanted.get(d, d) for d in found)


def family(rng, base, size, most):
    """Texts that differ from the base, or from one another in a chain, by some words."""
    out, last = [], base
    for _ in range(size):
        last = list(rng.choice([base, base, last]))
        for _ in range(rng.randrange(most)):
            last[rng.randrange(len(last))] = f"x{rng.randrange(10**6)}"
        out.append(" ".join(last))
    return out


@pytest.mark.parametrize("block,percent", [(2, 85), (7, 80)])
def test_leaders(spark, monkeypatch, block, percent):
    """One region of texts around the threshold, in blocks of so many: the same groups as all pairs give."""
    monkeypatch.setattr(neardup, "REGION_SETS", block)
    rng = random.Random(block)
    base = [f"w{k}" for k in range(150)]
    near = list(base)
    for k in range(0, 150, 50):
        near[k] = f"y{k}"
    texts = family(rng, base, 60, 3) + family(rng, near, 60, 6) + family(rng, [f"v{k}" for k in range(60)], 20, 2)
    docs = list(enumerate(rng.sample(texts, len(texts))))
    df = spark.createDataFrame(docs, "doc_id long, text string")
    wanted = plain_roots(docs, percent)
    assert 3 <= len(set(wanted.values())) <= 130
    assert {r.doc_id: r.component_id for r in near_duplicates(df, percent).collect()} == wanted


def test_versions_in_blocks(spark, monkeypatch):
    """Rows of one doc_id with other texts stay one document when their region is cut."""
    monkeypatch.setattr(neardup, "REGION_SETS", 2)
    base = [f"w{k}" for k in range(120)]
    rows = [(k % 9, " ".join([*base[:-1], f"t{k}"])) for k in range(18)] + [(0, "some other text of six words"), (50, "some other text of six words")]
    found = near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.component_id for r in found} == {0} and len(found) == 20
