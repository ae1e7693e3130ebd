import json
import random

import pytest

from corpusmill.plans import run
from corpusmill.queries import PAGE_ROWS, wiki
from corpusmill.sources.wiki import WikiSource


def tables(spark):
    pages, members = wiki(spark)
    rng = random.Random(1)
    words = lambda letters: " ".join("".join(rng.choice(letters) for _ in range(5)) for _ in range(900))
    texts = {"فلسطين": words("ابتثجح"), "نابلس": words("دذرزسش"), "دبكة": "قصير", "شخص": "<br>"}
    texts["نابلس"] = texts["نابلس"] + "\nCookie Policy x"
    more = spark.createDataFrame([(r[0], texts.get(r[0])) for r in PAGE_ROWS], "title string, text string")
    return pages.join(more, "title"), members


def test_ingest(spark, tmp_path):
    pages, members = tables(spark)
    sources = {"wikipedia": {"enabled": True, "seed_categories": {"ar": ["فلسطين"]}, "category_depth": 1, "max_articles_per_category": 10, "languages": [{"code": "ar", "source_id": "wikipedia-ar", "name": "Arabic Wikipedia", "credibility_tier": "tier_1"}]}}
    found = run.ingest(spark, pages, members, sources, out=str(tmp_path))
    assert (found["attempted_documents"], found["accepted_documents"], found["rejected_documents"], found["duplicate_documents"]) == (3, 2, 1, 0)
    assert found["seed_category_distribution"] == {"فلسطين": 2} and found["category_distribution"] == {"فلسطين": 1, "Cities": 1, "مدن": 1}
    assert json.loads((tmp_path / run.STATS).read_text())["accepted_documents"] == 2
    kept = spark.read.json(f"{tmp_path}/{run.ACCEPTED}").collect()
    assert {r.title for r in kept} == {"فلسطين", "نابلس"} and not any("Cookie" in r.text for r in kept)
    log = spark.read.json(f"{tmp_path}/{run.LOG}").where("event = 'run_finish'").first()
    assert (log.docs_attempted, log.docs_collected, log.docs_rejected) == (4, 3, 1)
    assert spark.read.json(f"{tmp_path}/{run.SNAPSHOT}").count() == 3
    with pytest.raises(RuntimeError):
        run.ingest(spark, pages, members, {"wikipedia": {"enabled": False}}, out=str(tmp_path))


def test_cap_counts_documents(spark):
    """Against the walk taken page by page: empty pages take no place, those after the last document are not met."""
    rng = random.Random(3)
    names = [f"p{k:02d}" for k in range(40)]
    texts = {n: "<br>" if rng.random() < 0.6 else f"text of {n}" for n in names}
    pages = spark.createDataFrame([("تصنيف:x", 14, True, None), *((n, 0, True, texts[n]) for n in names)], "title string, ns int, exists boolean, text string")
    members = spark.createDataFrame([("تصنيف:x", n, k) for k, n in enumerate(names)], "parent string, member string, pos long")
    good = [n for n in names if texts[n] != "<br>"]
    for cap in (0, 5, len(good) + 1, None):
        docs, rejected = WikiSource(pages, members, {"seed_categories": {"ar": ["x"]}, "max_articles_per_category": 100}, max_docs=cap).walked()
        wanted = good[:cap] if cap is not None else good
        met = names[: names.index(wanted[-1])] if cap is not None and cap <= len(good) and wanted else names if cap != 0 else []
        assert [r.title for r in docs.orderBy("ingest_seq").collect()] == wanted
        assert [r.key for r in rejected.orderBy("ingest_seq").collect()] == [n for n in met if texts[n] == "<br>"]


def test_audit_and_entities(spark, tmp_path):
    pages, members = tables(spark)
    seeds = spark.createDataFrame([(0, "فلسطين"), (1, "لا شيء")], "pos int, seed string")
    assert run.audit(spark, pages, members, seeds, f"{tmp_path}/reports") == {"seeds": 2, "missing_or_empty": 1, "visited": 3, "recommended": 0, "rejected": 3}
    assert spark.read.json(f"{tmp_path}/reports/rejected_seed_categories").count() == 3
    assert run.audit(spark, pages, members, seeds, f"{tmp_path}/only", discovery=False) == {"seeds": 2, "missing_or_empty": 1}
    spark.createDataFrame([("1", "أكل محمد المسخن اليوم")], "doc_id string, text string").write.parquet(f"{tmp_path}/in")
    assert run.tag(spark, f"{tmp_path}/in", f"{tmp_path}/out").first().n_entities == 1
