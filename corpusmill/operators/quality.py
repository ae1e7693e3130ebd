"""Document quality: rules with reasons, a weighted score, a decision."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import arabic_ratio

# Thresholds, weights and steps.
MIN_WORDS, MIN_CHARS, MAX_WORDS = 50, 300, 100_000
MIN_ARABIC_RATIO = 0.40
ACCEPT, WARN, REJECT = 0.70, 0.45, 0.20
ERROR_SCORE = 0.30
WEIGHTS = (0.40, 0.20, 0.20, 0.20)
TIER_SCORES = {"tier_1": 1.0, "tier_2": 0.75, "tier_3": 0.45, "tier_4": 0.15}
REQUIRED = ("doc_id", "text", "source_id", "language", "date_collected", "source_name", "source_type")
COMPLETE = ("title", "source_url", "language", "source_name")
ARABIC = ("ar-MSA", "ar-PAL", "ar-OTHER")


def length_errors(words: Column, chars: Column) -> Column:
    found = F.array(
        F.when(words < MIN_WORDS, F.concat(F.lit("Too short: "), words.cast("string"), F.lit(f" words (min {MIN_WORDS})"))),
        F.when(chars < MIN_CHARS, F.concat(F.lit("Too short: "), chars.cast("string"), F.lit(f" chars (min {MIN_CHARS})"))),
    )
    return F.when(words > MAX_WORDS, F.array().cast("array<string>")).otherwise(F.array_compact(found))


def length_warnings(words: Column) -> Column:
    text = F.concat(F.lit("WARN: very long document ("), words.cast("string"), F.lit(" words), may need chunking"))
    return F.array_compact(F.array(F.when(words > MAX_WORDS, text)))


def language_errors(language: Column, ratio: Column) -> Column:
    share = F.format_string("%.1f", F.bround(ratio.cast("decimal(20,18)") * 100, 1).cast("double"))
    text = F.concat(F.lit("Declared Arabic but Arabic script ratio is only "), share, F.lit(f"% (min {MIN_ARABIC_RATIO:.0%})"))
    return F.array_compact(F.array(F.when(language.startswith("ar") & (ratio < MIN_ARABIC_RATIO), text)))


def missing_fields(df_columns: dict[str, str]) -> Column:
    """One error naming the required fields that are null, empty or 0, in their order; a field that is no column is missing."""

    def absent(name: str) -> Column:
        if name not in df_columns:
            return F.lit(name)
        value = F.col(name)
        empty = value.isNull()
        if df_columns[name] == "string":
            empty = empty | (value == "")
        elif df_columns[name] in ("int", "bigint", "double", "float", "smallint", "tinyint"):
            empty = empty | (value == 0)
        return F.when(empty, F.lit(name))

    names = F.array_compact(F.array(*map(absent, REQUIRED)))
    return F.array_compact(F.array(F.when(F.size(names) > 0, F.concat(F.lit("Missing required fields: "), F.array_join(names, ", ")))))


def richness(words: Column) -> Column:
    return F.when(words >= 200, F.least(words / F.lit(1000.0), F.lit(1.0))).when(words >= 100, F.lit(0.70)).when(words >= MIN_WORDS, F.lit(0.40)).otherwise(F.lit(0.0))


def score_of(words: Column, tier: Column, filled: Column, language: Column, ratio: Column) -> Column:
    """Weighted sum of richness, tier, share of filled fields and language, rounded to 4 places."""
    trust = F.coalesce(F.try_element_at(F.create_map(*(F.lit(x) for item in TIER_SCORES.items() for x in item)), tier), F.lit(0.30))
    spoken = F.when(language.isin(*ARABIC), F.least(F.lit(1.0), ratio / F.lit(0.5))).when(language == "unknown", F.lit(0.0)).otherwise(F.lit(1.0))
    r, c, m, s = (F.lit(w) for w in WEIGHTS)
    return F.round(richness(words) * r + trust * c + filled * m + spoken * s, 4)


def decision_of(score: Column) -> Column:
    return F.when(score >= ACCEPT, "accept").when(score >= WARN, "accept_with_warning").when(score >= REJECT, "reject").otherwise("hard_reject")


def checked(docs: DataFrame) -> DataFrame:
    """docs with is_valid, quality_score, quality_decision, warnings, errors, rejection_reason.

    docs need text, word_count, char_count, language, credibility and title, source_url, source_name; what is
    missing of the required columns is an error of every row. The ratio of Arabic is computed only where a rule asks for it.
    """
    kinds = dict(docs.dtypes)
    ratio = F.when(F.col("language").startswith("ar"), arabic_ratio(F.col("text"))).otherwise(F.lit(0.0))
    docs = docs.withColumn("_ratio", ratio)
    words, chars, language = F.col("word_count"), F.col("char_count"), F.coalesce("language", F.lit(""))
    filled = sum(((F.col(c).isNotNull().cast("int") if c in kinds else F.lit(0)) for c in COMPLETE), F.lit(0)) / F.lit(float(len(COMPLETE)))
    docs = docs.withColumns(
        {
            "errors": F.concat(length_errors(words, chars), language_errors(language, F.col("_ratio")), missing_fields(kinds)),
            "warnings": length_warnings(words),
            "_score": score_of(words, F.col("credibility"), filled, language, F.col("_ratio")),
        }
    )
    n = F.size("errors")
    return docs.withColumns(
        {
            "is_valid": n == 0,
            "quality_decision": F.when(n > 1, "hard_reject").when(n == 1, "reject").otherwise(decision_of(F.col("_score"))),
            "quality_score": F.when(n > 0, F.least("_score", F.lit(ERROR_SCORE))).otherwise(F.col("_score")),
            "rejection_reason": F.when(n > 0, F.array_join("errors", "; ")),
        }
    ).drop("_ratio", "_score")
