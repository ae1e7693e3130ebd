"""Statistics of a run over routed documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Fixed value: how many entries a distribution has.
TOP = 50


def run_stats(routed: DataFrame) -> DataFrame:
    """One row: attempted, accepted, rejected, duplicate documents; words and mean length of the accepted ones."""
    accepted = F.col("route") == "accepted"
    n, words = F.count_if(accepted), F.coalesce(F.sum(F.when(accepted, F.col("word_count"))), F.lit(0))
    mean = F.when(n > 0, F.round(words / n, 2)).otherwise(F.lit(0.0))
    return routed.agg(
        F.count("*").alias("attempted_documents"), n.alias("accepted_documents"), F.count_if(~accepted).alias("rejected_documents"),
        F.count_if(F.col("has_duplicate")).alias("duplicate_documents"), words.alias("total_words"), mean.alias("average_document_length"),
    )


def distribution(df: DataFrame, value: Column, name: str, order: str = "ingest_seq", top: int | None = TOP, position: Column | None = None) -> DataFrame:
    """name, n, in descending order of n; equal ones by their first occurrence in order."""
    place = F.lit(0) if position is None else position
    first = F.min(F.struct(F.col(order), F.col("_at")))
    out = df.select(value.alias(name), order, place.alias("_at"))
    out = out.groupBy(name).agg(F.count("*").alias("n"), first.alias("_first")).orderBy(F.desc("n"), "_first")
    return (out.limit(top) if top is not None else out).drop("_first")


def category_distribution(routed: DataFrame, top: int | None = TOP) -> DataFrame:
    """Categories of the accepted documents."""
    each = routed.where(F.col("route") == "accepted").select("ingest_seq", F.posexplode("wikipedia_categories").alias("_pos", "category"))
    return distribution(each, F.col("category"), "category", top=top, position=F.col("_pos"))


def decision_distribution(routed: DataFrame) -> DataFrame:
    """Decisions of all attempted documents, before duplicates are told."""
    return routed.groupBy("quality_decision").agg(F.count("*").alias("n"))


def rejection_distribution(routed: DataFrame, top: int | None = TOP) -> DataFrame:
    reason = F.coalesce(F.nullif(F.col("rejection_reason"), F.lit("")), F.lit("unknown"))
    return distribution(routed.where(F.col("route") == "rejected"), reason, "rejection_reason", top=top)


def seed_distribution(routed: DataFrame, top: int | None = TOP) -> DataFrame:
    seed = F.coalesce(F.nullif(F.col("seed_category"), F.lit("")), F.lit("unknown"))
    return distribution(routed.where(F.col("route") == "accepted"), seed, "seed_category", top=top)


def export_summary(docs: DataFrame) -> dict:
    """num_rows, columns in order, total_words (0 without word_count), average_words."""
    words = F.coalesce(F.sum("word_count"), F.lit(0)) if "word_count" in docs.columns else F.lit(0)
    n, total = docs.agg(F.count("*"), words).first()
    out = {"num_rows": n, "columns": list(docs.columns), "total_words": int(total)}
    if n:
        out["average_words"] = round(out["total_words"] / n, 2)
    return out


def run_log_summary(events: DataFrame) -> DataFrame:
    """One row of a run's document events (kind: attempt, success, rejection or error; reason)."""
    attempted, collected = F.count_if(F.col("kind") == "attempt"), F.count_if(F.col("kind") == "success")
    return events.agg(attempted.alias("docs_attempted"), collected.alias("docs_collected"), (attempted - collected).alias("docs_rejected"), F.count_if(F.col("kind") == "error").alias("n_errors"))


def rejection_counts(events: DataFrame) -> DataFrame:
    return events.where(F.col("kind") == "rejection").groupBy("reason").agg(F.count("*").alias("n"))
