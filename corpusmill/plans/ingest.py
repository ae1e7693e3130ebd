"""The ingestion plan: pages to documents, quality gate, duplicate gate, routing."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.fields import make_doc_id, optional_int, page_url
from ..functions.text import char_count, cleaned, word_count
from ..operators.credibility import CREDIBILITY_MAP, credibility
from ..operators.dedup import THRESHOLD, duplicates, duplicates_beside, shared
from ..operators.graph import page_categories, page_key
from ..operators.quality import checked
from .schema import as_documents

# The source when configuration does not say.
SOURCE_ID, SOURCE_NAME = "wikipedia-ar", "Arabic Wikipedia"


def language_config(source: dict, language: str) -> dict:
    return next((x for x in source.get("languages", []) if x.get("code") == language), {})


def pages_to_documents(pages: DataFrame, source: dict | None = None, language: str = "ar", entries=CREDIBILITY_MAP) -> tuple[DataFrame, DataFrame]:
    """(documents, rejections) of pages (ingest_seq, seed, title, text, ...): rejections (ingest_seq, key, reason) are pages empty after cleaning.

    A value of a wrong type becomes null instead of failing its page.
    """
    info = language_config(source or {}, language)
    have = set(pages.columns)
    column = lambda name, kind="string": F.col(name) if name in have else F.lit(None).cast(kind)
    raw = pages.withColumn("text_raw", F.coalesce("text", F.lit("")))
    clean = cleaned(raw, "text_raw", "text", is_wiki=True)
    rejected = clean.where(F.length("text") == 0).select("ingest_seq", page_key(F.col("title"), column("pageid")).alias("key"), F.lit("empty_after_cleaning").alias("reason"))
    url = page_url(column("fullurl"), F.col("title"), language)
    docs = clean.where(F.length("text") > 0).withColumn("source_url", url)
    tier = F.lit(info["credibility_tier"]) if "credibility_tier" in info else credibility(F.col("source_url"), entries)["tier"]
    revisions = [column(c) for c in ("revision_id", "revid", "lastrevid")]
    docs = docs.select(
        "ingest_seq", make_doc_id(F.col("source_url"), F.col("text")).alias("doc_id"), F.lit(info.get("source_id", SOURCE_ID)).alias("source_id"), "title", "text", "text_raw",
        word_count(F.col("text")).alias("word_count"), char_count(F.col("text")).alias("char_count"), F.lit("ar-MSA" if language == "ar" else "en").alias("language"),
        F.lit(info.get("name", SOURCE_NAME)).alias("source_name"), F.lit("encyclopedia").alias("source_type"), "source_url", F.lit(f"{language}.wikipedia.org").alias("source_domain"),
        tier.alias("credibility"), optional_int(column("pageid")).alias("wikipedia_page_id"), optional_int(*revisions).alias("wikipedia_revid"),
        page_categories(column("categories", "array<string>")).alias("wikipedia_categories"), F.col("seed").alias("seed_category"),
    )
    return as_documents(docs, ("ingest_seq",)), rejected


def gate() -> Column:
    """Whether the quality decision keeps a document out."""
    return F.col("quality_decision").isin("reject", "hard_reject")


def gated(judged: DataFrame, dups: DataFrame, names: DataFrame, order: str) -> DataFrame:
    """judged with has_duplicate, is_duplicate_of, rejection_reason and route. dups: seq, canonical; names: seq, doc_id of all canonical documents."""
    named = dups.join(names.select(F.col("seq").alias("canonical"), F.col("doc_id").alias("is_duplicate_of")), "canonical").select(F.col("seq").alias("_seq"), "is_duplicate_of")
    out = judged.join(named, judged[order].cast("bigint") == F.col("_seq"), "left").drop("_seq")
    repeated = F.col("is_duplicate_of").isNotNull()
    return out.withColumns(
        {
            "has_duplicate": repeated,
            "rejection_reason": F.when(repeated, "duplicate").otherwise(F.col("rejection_reason")),
            "route": F.when(~gate() & ~repeated, "accepted").otherwise("rejected"),
        }
    )


def routed(docs: DataFrame, threshold: float = THRESHOLD, order: str = "ingest_seq", columns: Sequence[str] | None = None) -> DataFrame:
    """docs with quality columns, has_duplicate, is_duplicate_of, rejection_reason and route (accepted or rejected).

    Documents that fail the quality gate are not compared for duplicates. A duplicate keeps its quality decision,
    is rejected for the reason duplicate, and names the document it repeats. The checked documents are written to
    the shared folder once, since both gates and every output read them. columns: those of the result that are wanted,
    if not all; without text among them, no text is written, only these columns and, until the duplicates are known, sets.
    """
    judged = checked(docs.drop("quality_score", "quality_decision", "rejection_reason", "has_duplicate", "is_duplicate_of"))
    seq = F.col(order).cast("bigint").alias("seq")
    if columns is None or "text" in columns:
        judged = shared(judged, "checked")
        dups = duplicates(judged.where(~gate()).select(seq, "text"), threshold)
    else:
        needed = {order, "doc_id", "quality_decision", "rejection_reason", *columns}
        judged, dups = duplicates_beside(judged, threshold, order, ~gate(), [c for c in judged.columns if c in needed], "checked")
    out = gated(judged, dups, judged.select(seq, "doc_id"), order)
    return out if columns is None else out.select(*columns)
