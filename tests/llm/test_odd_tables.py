"""Repeated and missing ids, clashing names and hostile lengths for operators that look at one row at a time."""

import pytest

from corpusmill.llm import compression, decontaminate, html, kit, packing, quality
from corpusmill.llm.queries import tokenizer_file

ROWS = [(1, "one two three four five six seven eight nine ten eleven"), (1, "one two three four five six seven eight nine ten eleven"), (None, "a b"), (None, None), (2, "")]


def docs(spark, **more):
    names = "".join(f", {k} string" for k in more)
    return spark.createDataFrame([(*r, *more.values()) for r in ROWS], f"doc_id long, text string{names}")


def test_free_names():
    assert kit.free_names(["a", "B", "b_"], "a", "b", "c", "c") == ["a_", "b__", "c", "c_"]


def test_decontamination_keeps_columns(spark):
    df = docs(spark, words="w", hit="h", items="i", _words="x", _hit="y", _items="z")
    bench = spark.createDataFrame([(7, "three four five six seven eight nine ten eleven twelve"), (7, None), (None, "")], "item_id long, text string")
    out = decontaminate.decontaminate(df, bench)
    assert out.columns == df.columns and out.count() == 5 and {tuple(r)[2:] for r in out.collect()} == {("w", "h", "i", "x", "y", "z")}
    found = decontaminate.contamination(df, spark.createDataFrame([(7, "two three four")], "item_id long, text string")).collect()
    assert sorted((r.doc_id or 0, r.n_hit) for r in found) == [(0, 0), (0, 0), (1, 3), (1, 3), (2, 0)]


def test_packing_keeps_columns(spark):
    pieces = spark.createDataFrame([(1, 0, 10, "a"), (1, 0, 10, "a"), (None, 0, 4096, "b"), (2, 16, 1, None)], "doc_id long, start long, length long, width string").withColumnsRenamed({"start": "start"})
    out = packing.packed(pieces)
    rows = out.collect()
    assert set(out.columns) == {"doc_id", "start", "length", "width", "sequence_id", "offset"} and sorted(r.width or "" for r in rows) == ["", "a", "a", "b"]
    assert len({(r.sequence_id, r.offset) for r in rows}) == 4


def test_packing_repeated_ids(spark):
    rows = packing.pack_documents(docs(spark), tokenizer_file("word_bpe_49k.json")).collect()
    assert sorted((r.doc_id or 0, r.doc_tokens) for r in rows) == [(0, 1), (0, 3), (1, 12), (1, 12), (2, 1)]


def test_quality_repeated_ids(spark):
    rows = quality.quality_metrics(docs(spark, n_words="x", kept="y")).collect()
    assert sorted((r.doc_id or 0, r.n_words, r.base_failed) for r in rows) == [(0, 0, True), (0, 2, True), (1, 11, False), (1, 11, False), (2, 0, True)]


def test_scores_of_odd_rows(spark):
    labels = spark.createDataFrame([(1, 1, 0), (1, 1, 0), (2, 0, 1), (None, 1, 0), (3, None, None)], "doc_id long, quality int, toxic int")
    rows = compression.quality_scores(docs(spark, score="s", quality="q"), labels).collect()
    assert len(rows) == 5 and all(0 <= r.score <= 1 for r in rows) and not any(r.held_out for r in rows if r.doc_id is None)
    assert len({r.score for r in rows if r.doc_id == 1}) == 1


def test_very_long_texts(spark):
    long = [(1, "word " * 2_000_000), (2, "é" * 5_000_000), (3, "# " * 1_000_000 + "\n" * 1_000_000)]
    df = spark.createDataFrame(long, "doc_id long, text string")
    assert quality.quality_metrics(df).count() == 3
    assert decontaminate.contamination(df, spark.createDataFrame([(1, "word word word word")], "item_id long, text string")).where("contaminated").count() == 1
    assert compression.classify(df, compression.fit([("good text here", 1), ("bad!!", 0)] * 4)).count() == 3
    assert html.extract(df.selectExpr("doc_id AS page_id", "'u' AS url", "text AS html")).where("n_chars > 1000000").count() == 3


def test_no_local_scratch_on_a_cluster(monkeypatch):
    class Context:
        master, applicationId = "spark://host:7077", "app"

    class Conf:
        def get(self, name, default=None):
            return default

    class Session:
        sparkContext, conf = Context(), Conf()

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        kit.scratch_path(Session(), "x")
