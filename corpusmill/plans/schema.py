"""The document schema, its enumerations and checks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.fields import decade, iso_timestamp
from ..operators.entities import ENTITIES

_S, _L, _D, _B, _I, _TS = T.StringType(), T.LongType(), T.DoubleType(), T.BooleanType(), T.IntegerType(), T.TimestampType()
# Fields in order, with whether null is forbidden.
DOCUMENT = T.StructType(
    [
        T.StructField(name, kind, not required)
        for name, kind, required in (
            ("doc_id", _S, True), ("source_id", _S, True), ("title", _S, False), ("text", _S, True), ("text_raw", _S, False), ("summary", _S, False),
            ("word_count", _L, True), ("char_count", _L, True), ("language", _S, True), ("dialect_region", _S, False), ("is_bilingual", _B, False),
            ("source_name", _S, True), ("source_type", _S, True), ("source_url", _S, False), ("source_domain", _S, False), ("credibility", _S, True),
            ("wikipedia_page_id", _L, False), ("wikipedia_revid", _L, False), ("wikipedia_categories", T.ArrayType(_S), False), ("seed_category", _S, False),
            ("date_published", _TS, False), ("date_collected", _TS, False), ("date_processed", _TS, False), ("decade", _I, False),
            ("category", _S, False), ("category_confidence", _D, False), ("tags", T.ArrayType(_S), False), ("geographic_scope", _S, False),
            ("quality_score", _D, False), ("quality_decision", _S, False), ("has_duplicate", _B, False), ("minhash_signature", T.ArrayType(_L), False),
            ("is_duplicate_of", _S, False), ("rejection_reason", _S, False), ("entities", ENTITIES, False), ("topic_id", _I, False),
            ("topic_label", _S, False), ("embedding_id", _S, False), ("raw_file_path", _S, False), ("processed_file_path", _S, False),
        )
    ]
)
# Enumerations.
LANGUAGES = ("ar-MSA", "ar-PAL", "ar-OTHER", "en", "multi", "unknown")
SOURCE_TYPES = ("news", "academic_paper", "ngo_report", "book_chapter", "oral_testimony", "encyclopedia", "museum_record", "government_doc", "social_media", "poetry", "legal_doc", "book", "archive_document", "interview", "image_metadata", "other")
CATEGORIES = ("conflict", "culture", "history", "arts_literature", "politics", "daily_life", "food_cuisine", "religion", "architecture", "education", "economy", "music", "folklore", "heritage", "biography", "geography", "uncategorized")
TIERS = ("tier_1", "tier_2", "tier_3", "tier_4")
DECISIONS = ("accept", "accept_with_warning", "reject", "hard_reject")
ENUMS = {"language": LANGUAGES, "source_type": SOURCE_TYPES, "category": CATEGORIES, "credibility": TIERS, "quality_decision": DECISIONS}
UNIT_RANGES = ("category_confidence", "quality_score")
#: Left out when documents are handed on.
INTERNAL = ("text_raw", "minhash_signature", "raw_file_path", "processed_file_path", "entities", "embedding_id")


def defaults() -> dict:
    """Columns for fields that are not given."""
    empty = F.array().cast("array<string>")
    return {"is_bilingual": F.lit(False), "wikipedia_categories": empty, "category": F.lit("uncategorized"), "tags": empty, "has_duplicate": F.lit(False), "entities": F.array().cast(ENTITIES), "date_collected": F.current_timestamp()}


def as_documents(df: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """df with the fields of DOCUMENT in order: missing ones get their default or null, the decade is floored or derived. keep: further columns."""
    given = set(df.columns)
    made = defaults()

    def field(f: T.StructField):
        value = F.col(f.name) if f.name in given else F.lit(None)
        if f.name in made:
            value = F.coalesce(value.cast(f.dataType), made[f.name])
        if f.name == "decade":
            published = F.col("date_published") if "date_published" in given else F.lit(None).cast("timestamp")
            value = decade(value.cast("int"), published)
        return value.cast(f.dataType).alias(f.name)

    return df.select(*map(field, DOCUMENT), *keep)


def validated(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(valid, invalid) rows; invalid ones have the names of the offending fields in violations."""
    bad = []
    for f in DOCUMENT:
        if f.name not in df.columns:
            continue
        value = F.col(f.name)
        if not f.nullable:
            bad.append(F.when(value.isNull(), f.name))
        if f.name in ENUMS:
            bad.append(F.when(value.isNotNull() & ~value.isin(*ENUMS[f.name]), f.name))
        if f.name in UNIT_RANGES:
            bad.append(F.when(value.isNotNull() & ~value.between(0.0, 1.0), f.name))
    marked = df.withColumn("violations", F.array_distinct(F.array_compact(F.array(*bad))))
    return marked.where(F.size("violations") == 0).drop("violations"), marked.where(F.size("violations") > 0)


def export_view(df: DataFrame) -> DataFrame:
    """Documents without internal fields, timestamps as ISO 8601 strings."""
    kept = [f for f in df.schema if f.name not in INTERNAL]
    return df.select(*(iso_timestamp(F.col(f.name)).alias(f.name) if isinstance(f.dataType, T.TimestampType) else F.col(f.name) for f in kept))
