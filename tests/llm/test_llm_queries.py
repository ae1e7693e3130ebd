import pytest
from oracle import same

import corpus_pipeline
from corpusmill.llm.queries import ORACLE_SQL, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_oracle(spark, name):
    same(spark, QUERIES[name], ORACLE_SQL[name], SF)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE_SQL)))
def test_runs(spark, name):
    assert QUERIES[name](spark, SF).count() >= 200 or name == "op9_html_extraction"


def test_ten_operators():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 11))


def test_pipeline(spark):
    """Each stage against plain rules on its own input; all but the last keep the columns."""
    from test_near_thresholds import plain_roots
    from test_scans import plain_hits, plain_spans

    from corpusmill.llm import quality
    from corpusmill.llm.kit import staged
    from corpusmill.llm.queries import table

    docs = table(spark, SF, "documents")
    items = [tuple(r) for r in table(spark, SF, "benchmark").select("item_id", "text").collect()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = {r.doc_id: r for r in docs.collect()}
        out = staged(stage(spark, docs, SF), name)
        after = {r.doc_id: r for r in out.collect()}
        assert out.columns == docs.columns and out.count() == len(after)
        if name == "quality":
            assert set(after) == {k for k, r in before.items() if not any(x.rejects(quality.Page(r.text)) for x in quality.RULES)}
        elif name == "near_dedup":
            assert set(after) == {k for k, root in plain_roots([(k, r.text) for k, r in before.items()], corpus_pipeline.SIMILAR).items() if k == root}
        elif name == "decontamination":
            assert set(after) == {k for k, r in before.items() if not plain_hits(r.text, items)[-1]}
        else:
            assert set(after) == set(before) and not any(plain_spans(r.text) for r in after.values())
            assert all(after[k].text == r.text for k, r in before.items() if "[" not in after[k].text)
        docs = out
    total = docs.count()
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    assert packed.select("doc_id").distinct().count() == total


@pytest.mark.parametrize("rows", [[], [(None, None, None, None, None), (1, "", "en", "s", 0), (1, "a b", None, "s", 3), (2, None, "en", None, None)]])
def test_pipeline_edges(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for _, stage in corpus_pipeline.STAGES:
        stage(spark, docs, SF).collect()


def test_near_dedup_keeps_one_row(spark):
    docs = spark.createDataFrame([(1, "b"), (1, "a"), (2, "a"), (3, "c"), (None, "d")], "doc_id long, text string")
    found = corpus_pipeline.near_dedup(spark, docs, SF).collect()
    assert sorted((r.doc_id or 0, r.text) for r in found) == [(0, "d"), (1, "a"), (3, "c")]
