import pytest
from pyspark.sql import functions as F

from corpusmill.functions.text import char_count, word_count
from corpusmill.operators.credibility import credibility, entries_of
from corpusmill.operators.quality import checked, richness


def document(spark, text, language="ar-MSA", **more):
    row = {"doc_id": "d", "source_id": "s", "title": "t", "text": text, "language": language, "source_name": "n", "source_type": "encyclopedia", "source_url": "u", "credibility": "tier_1", "date_collected": "2026-01-01"} | more
    df = spark.createDataFrame([tuple(row.values())], ", ".join(f"{k} string" for k in row))
    return checked(df.withColumns({"word_count": word_count(F.col("text")), "char_count": char_count(F.col("text"))})).first()


def test_accepts(spark):
    r = document(spark, "فلسطين ثقافة تاريخ تراث مدينة قرية موسيقى أدب فن مطبخ " * 25)
    assert (r.is_valid, r.quality_decision, r.quality_score, r.rejection_reason) == (True, "accept", 0.7, None)


def test_short(spark):
    r = document(spark, "قصير جدا")
    assert (r.is_valid, r.quality_decision, r.quality_score) == (False, "hard_reject", 0.3)
    assert r.rejection_reason == "Too short: 2 words (min 50); Too short: 8 chars (min 300)"


def test_wrong_script(spark):
    r = document(spark, "english text only " * 60)
    assert r.quality_decision == "reject"
    assert r.rejection_reason == "Declared Arabic but Arabic script ratio is only 0.0% (min 40%)"


def test_missing_fields(spark):
    r = document(spark, "word " * 400, "en", source_name="", source_type=None)
    assert r.rejection_reason == "Missing required fields: source_name, source_type"


def test_low_score_has_no_reason(spark):
    r = document(spark, "w" * 10 + " word" * 60, "unknown", credibility="tier_4", title=None, source_url=None)
    assert (r.quality_decision, r.rejection_reason, r.is_valid) == ("reject", None, True)


def test_long_is_a_warning(spark):
    r = document(spark, "فلسطين " * 100_001)
    assert r.warnings == ["WARN: very long document (100001 words), may need chunking"] and r.errors == []


@pytest.mark.parametrize("n,wanted", [(49, 0.0), (50, 0.4), (99, 0.4), (100, 0.7), (199, 0.7), (200, 0.2), (1000, 1.0), (1001, 1.0)])
def test_richness(spark, n, wanted):
    assert spark.range(1).select(richness(F.lit(n))).first()[0] == wanted


def test_credibility(spark):
    urls = ["https://www.un.org/x", "https://nowhere.example", None, "wafa.ps"]
    df = spark.createDataFrame([(u,) for u in urls], "u string")
    assert [r[0] for r in df.select(credibility(F.col("u"))["tier"]).collect()] == ["tier_1", "tier_3", "tier_3", "tier_2"]
    own = entries_of({"a.b": 0.5, "c.d": {"tier": "tier_4"}, "e.f": None})
    assert [tuple(r[0]) for r in spark.createDataFrame([("http://a.b",), ("http://c.d",), ("http://e.f",)], "u string").select(credibility(F.col("u"), own)).collect()] == [("tier_3", 0.5), ("tier_4", 0.45), ("tier_3", 0.45)]
    with pytest.raises(ValueError):
        entries_of({"x": {"tier": "tier_9"}})
