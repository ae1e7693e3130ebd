"""Whole runs: ingestion, seed audit and discovery, entities. Also `python -m corpusmill.plans.run ingest|audit|entities`."""

from __future__ import annotations

import argparse
import json
import time
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import dedup, entities, graph, stats
from ..operators.credibility import CREDIBILITY_MAP, entries_of
from ..sources import files
from ..sources.config import load_seeds, load_yaml
from ..sources.wiki import WikiSource
from .ingest import SOURCE_ID, routed

#: Where a run writes, under its output folder.
ACCEPTED, REJECTED, STATS, SNAPSHOT, LOG = "processed/documents", "metadata/rejected", "metadata/stats.json", "raw", "metadata/log"


def _counts(df: DataFrame) -> dict:
    """A small distribution as a dict in its order."""
    return {r[0]: r[1] for r in df.collect()}


def _now() -> str:
    return datetime.now(timezone.utc).isoformat()


def ingest(spark: SparkSession, pages: DataFrame, members: DataFrame, sources: dict, quality: dict | None = None, out: str = "data", max_docs: int | None = 100) -> dict:
    """Collect the pages of the seeds, clean, judge and compare them, write both routes, a snapshot, statistics and a log; returns the statistics.

    sources and quality are the contents of the two configuration files. Raises RuntimeError when collection is switched off.
    """
    began = time.time()
    config = sources.get("wikipedia") or {}
    if not config.get("enabled", False):
        raise RuntimeError("Wikipedia collection is disabled in the sources configuration")
    threshold = float(((quality or {}).get("deduplication") or {}).get("threshold", dedup.THRESHOLD))
    entries = entries_of(sources["credibility_map"]) if sources.get("credibility_map") else CREDIBILITY_MAP
    source = WikiSource(pages, members, config, max_docs=max_docs, entries=entries)
    run_id = f"run_{SOURCE_ID}_{datetime.now(timezone.utc):%Y%m%d_%H%M%S}"
    seeds = list((config.get("seed_categories") or {}).get("ar") or [])
    start = {"event": "run_start", "run_id": run_id, "source_id": SOURCE_ID, "timestamp": _now(), "language": "ar", "seed_categories": seeds, "max_docs": source.cap(), "category_depth": int(config.get("category_depth", 1))}
    files.append_log(spark, f"{out}/{LOG}", start)
    docs, empty = source.collect()
    docs = dedup.shared(docs, "documents")
    files.write_snapshot(docs.drop("ingest_seq"), f"{out}/{SNAPSHOT}")
    found = dedup.shared(routed(docs, threshold), "routed")
    files.write_routes(found.drop("ingest_seq", "errors", "warnings", "is_valid"), f"{out}/{ACCEPTED}", f"{out}/{REJECTED}")
    collected, n_empty = docs.count(), empty.count()
    result = {"source_id": SOURCE_ID} | stats.run_stats(found).first().asDict()
    result["category_distribution"] = _counts(stats.category_distribution(found))
    result["quality_decision_distribution"] = _counts(stats.decision_distribution(found))
    result["rejection_reason_distribution"] = _counts(stats.rejection_distribution(found))
    result["seed_category_distribution"] = _counts(stats.seed_distribution(found))
    checked = result["accepted_documents"] + result["duplicate_documents"]
    result["deduplication"] = {"checked": checked, "duplicates": result["duplicate_documents"], "unique": result["accepted_documents"], "threshold": threshold, "backend": "exact_jaccard"}
    result["outputs"] = {"accepted_jsonl": f"{out}/{ACCEPTED}", "rejected_jsonl": f"{out}/{REJECTED}", "stats_json": f"{out}/{STATS}"}
    result["duration_seconds"] = round(time.time() - began, 2)
    files.write_text(spark, f"{out}/{STATS}", json.dumps(result, ensure_ascii=False, indent=2))
    finish = {"event": "run_finish", "run_id": run_id, "source_id": SOURCE_ID, "timestamp": _now(), "docs_attempted": collected + n_empty, "docs_collected": collected, "docs_rejected": n_empty}
    files.append_log(spark, f"{out}/{LOG}", finish | {"rejection_reasons": {"empty_after_cleaning": n_empty} if n_empty else {}, "duration_seconds": result["duration_seconds"], "errors": []})
    return result


def audit(spark: SparkSession, pages: DataFrame, members: DataFrame, seeds: DataFrame, out: str, max_depth: int = graph.MAX_DEPTH, discovery: bool = True) -> dict:
    """Audit the seeds, discover and rank further categories, write the reports; returns counts."""
    rows = dedup.shared(graph.audit_seeds(seeds, pages, members, pages.select("title")), "audit")
    reports = {"category_audit_report": rows.orderBy("pos").drop("pos")}
    bad = graph.missing_or_empty(rows).first()
    result = {"seeds": bad.total, "missing_or_empty": bad.bad}
    if discovery:
        found = dedup.shared(graph.classify_discovered(graph.discover(pages, members, max_depth=max_depth)), "discovered")
        plain = found.orderBy("rank").drop("rank", "bfs_seq", "recommended")
        good = found.where("recommended").orderBy("rank").select([c for c in plain.columns if c != "rejection_reasons"])
        reports |= {"recommended_seed_categories": good, "rejected_seed_categories": found.where("not recommended").orderBy("rank").select(plain.columns)}
        result |= {"visited": found.count(), "recommended": good.count()}
        result["rejected"] = result["visited"] - result["recommended"]
    files.write_reports(reports, out)
    return result


def tag(spark: SparkSession, source: str, out: str, tagger: entities.Tagger | None = None, limit: int | None = None, order: str | None = None) -> DataFrame:
    """Add entities to a Parquet corpus, write it, and return counts by document."""
    docs = entities.with_entities(files.read_parquet(spark, source), tagger, limit=limit, order=order)
    docs.write.mode("overwrite").parquet(out)
    return entities.entity_counts(spark.read.parquet(out))


def main(args: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    kinds = parser.add_subparsers(dest="kind", required=True)
    for kind in ("ingest", "audit"):
        one = kinds.add_parser(kind)
        for name in ("--pages", "--members", "--sources"):
            one.add_argument(name, required=True)
        one.add_argument("--out", default="data" if kind == "ingest" else "reports/seed_audit")
        if kind == "ingest":
            one.add_argument("--quality")
            one.add_argument("--max-docs", type=int, default=100)
        else:
            one.add_argument("--max-depth", type=int, default=graph.MAX_DEPTH)
            one.add_argument("--skip-discovery", action="store_true")
    one = kinds.add_parser("entities")
    one.add_argument("--input", required=True)
    one.add_argument("--out", required=True)
    given = parser.parse_args(args)
    spark = SparkSession.builder.getOrCreate()
    if given.kind == "entities":
        total = tag(spark, given.input, given.out).agg(F.count("*").alias("documents"), F.sum("n_entities").alias("entities")).first().asDict()
        print(json.dumps(total))
        return
    pages, members = spark.read.parquet(given.pages), spark.read.parquet(given.members)
    if given.kind == "ingest":
        result = ingest(spark, pages, members, load_yaml(spark, given.sources), load_yaml(spark, given.quality) if given.quality else None, given.out, given.max_docs)
    else:
        result = audit(spark, pages, members, load_seeds(spark, given.sources), given.out, given.max_depth, not given.skip_discovery)
    print(json.dumps(result, ensure_ascii=False, indent=2))


if __name__ == "__main__":
    main()
