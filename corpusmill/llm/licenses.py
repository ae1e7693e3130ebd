"""License scans by canonical digests: whole texts, made canonical, are hash-joined to the digests of known licences.

Everything here is DataFrame functions. The canonical form has lower case, no copyright lines, single spaces
for punctuation and white space, and one spelling for words that are spelt in several ways.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .license_texts import DIGESTS, LICENSES, NOTICES

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Known texts up to this number are broadcast; more are joined by shuffling digests.
BROADCAST_ROWS = 20_000
#: (expression, replacement), in this order, after lower-casing A-Z; expressions that Java and RE2 read alike.
STEPS = (
    # lines that begin with a copyright mark, a year or an owner, and reservations of rights
    (r"(^|\n)[^a-z0-9\n]*(?:(?:copyright[ \t]*)?(?:\(c\)|©)|copyright[ \t]*(?:[0-9]{4}|\[year\]|<year>|by[ \t])|all rights reserved)[^\n]*", "$1"),
    # ASCII and general punctuation, white space
    (r"[\x00-\x2F\x3A-\x60\x7B-\xA0\xA9\xAB\xB7\xBB\x{2000}-\x{206F}\x{3000}-\x{3003}]+", " "),
    (r"^ +", ""),
    (r" *$", " "),
    # equivalent spellings, at the end of a word
    (r"licenc(e|es|ed|ing|or|ors|ee|ees) ", "licens$1 "),
    (r"([a-z][a-z])is(e|ed|es|ing|ation|ations) ", "$1iz$2 "),
    (r"([a-z][a-z])our(s|ed|able|)? ", "$1or$2 "),
    (r"(judg|acknowledg)ement(s|) ", "$1ment$2 "),
    (r"sub licens", "sublicens"),
    (r"non (commercial|exclusive|infring)", "non$1"),
    (r"https ", "http "),
    (r"whilst ", "while "),
    (r"wilful", "willful"),
)


def canonical(text: Column) -> Column:
    text = F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)
    for expression, replacement in STEPS:
        text = F.regexp_replace(text, F.lit(expression), F.lit(replacement))
    return F.rtrim(text)


def digest(text: Column) -> Column:
    return F.sha2(canonical(text), 256)


def known_licenses(spark: SparkSession, texts: tuple[tuple[str, str], ...] = LICENSES, digests: tuple[tuple[str, str], ...] = DIGESTS) -> DataFrame:
    """license_id, digest of (license_id, text) and (license_id, digest) pairs; of texts that are equal in canonical form, the first by name."""
    rows = lambda pairs, name: spark.range(1).select(F.inline(F.array(*(F.struct(F.lit(x).alias("license_id"), F.lit(y).alias(name)) for x, y in pairs))))
    known = rows(texts, "text").select("license_id", digest(F.col("text")).alias("digest"))
    return known.union(rows(digests, "digest")).groupBy("digest").agg(F.min("license_id").alias("license_id"))


def license_scan(docs: DataFrame, known: DataFrame | None = None, notices: tuple[tuple[str, str], ...] = NOTICES) -> DataFrame:
    """doc_id, digest, license_id, n_notices, notices; a row for each row of docs (doc_id, text), other columns ignored.

    digest is the SHA-256 of the whole text's canonical form; license_id is the known licence with that digest,
    else null. known: digest, license_id, with distinct digests. notices are the ids, sorted and comma-joined, of
    the short notices that stand on lines of their own, found by the same digests; n_notices counts such lines.
    A null text is an empty one, whose canonical form is empty.
    """
    spark = docs.sparkSession
    known = known_licenses(spark) if known is None else known
    by_digest = F.create_map(*(x for name, text in notices for x in (digest(F.lit(text)), F.lit(name))))
    lines = F.filter(F.split(F.coalesce("text", F.lit("")), "\n"), lambda x: x.rlike("(?i)licen[cs]e|public domain"))
    named = F.filter(F.transform(lines, lambda x: F.try_element_at(by_digest, digest(x))), lambda x: x.isNotNull())
    out = docs.select("doc_id", digest(F.col("text")).alias("digest"), named.alias("_named"))
    if known.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:
        known = F.broadcast(known)
    out = out.join(known, "digest", "left")
    return out.select("doc_id", "digest", "license_id", F.size("_named").cast("long").alias("n_notices"), F.array_join(F.array_sort(F.array_distinct("_named")), ",").alias("notices"))


def _sql(text: str) -> str:
    text = f"translate(coalesce({text}, ''), '{UPPER}', '{LOWER}')"
    for expression, replacement in STEPS:
        text = f"regexp_replace({text}, '{expression}', '{replacement.replace('$', chr(92))}', 'g')"
    return f"rtrim({text})"


def _literal(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


ORACLE = f"""
WITH known AS (SELECT d, min(id) AS license_id FROM (SELECT id, sha256({_sql('t')}) AS d FROM (VALUES {', '.join(f"('{n}', {_literal(t)})" for n, t in LICENSES)}) AS v(id, t)
  UNION ALL SELECT * FROM (VALUES {', '.join(f"('{n}', '{d}')" for n, d in DIGESTS)}) AS w(id, d)) GROUP BY d),
notes AS (SELECT id, {_sql('t')} AS c FROM (VALUES {', '.join(f"('{n}', {_literal(t)})" for n, t in NOTICES)}) AS v(id, t)),
lines AS (SELECT doc_id, {_sql('line')} AS c FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents) WHERE regexp_matches(line, '(?i)licen[cs]e|public domain')),
found AS (SELECT doc_id, count(*) AS n, string_agg(DISTINCT id, ',' ORDER BY id) AS names FROM lines JOIN notes USING (c) GROUP BY doc_id)
SELECT doc_id, digest, license_id, coalesce(n, 0)::BIGINT AS n_notices, coalesce(names, '') AS notices
FROM (SELECT doc_id, sha256({_sql('text')}) AS digest FROM documents) LEFT JOIN known ON d = digest LEFT JOIN found USING (doc_id)
"""
