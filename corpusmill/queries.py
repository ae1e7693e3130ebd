"""Queries over the driver's tables, and the same in DuckDB's SQL.

Documents are mapped to the document model: doc_id is the order too, the source names its id and its URL's host,
English is en and any other language unknown, the title is made of the id. Operators on Arabic, on category graphs
and on tags have nothing to find in those tables; their queries carry literal rows, in both engines.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions import fields, text
from .operators import credibility, dedup, entities, graph, quality, stats
from .plans import ingest, run, schema
from .sources import files
from .sources.wiki import WikiSource

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a query under its function's name, with its SQL if there is one."""

    def register(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLE_SQL[f.__name__] = sql
        return f

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spread(spark.read.parquet(f"{sf_dir}/{name}.parquet"))


#: Bytes of files up to which a table is dealt anew over the cores; the shuffle is never larger than that.
SPREAD_BYTES = 256 << 20


def spread(df: DataFrame) -> DataFrame:
    """df, dealt evenly if its files are few and small (a small file is often one row group); larger inputs stay as they are."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() > cores or int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()) > SPREAD_BYTES:
        return df
    return df.repartition(cores)


def quote(value) -> str:
    if value is None:
        return "NULL"
    if isinstance(value, bool):
        return str(value).upper()
    if isinstance(value, (list, tuple)):
        return "[" + ", ".join(map(quote, value)) + "]"
    return str(value) if isinstance(value, (int, float)) else "'" + value.replace("'", "''") + "'"


def values(rows: list[tuple], *names: str) -> str:
    """Literal rows as a subquery."""
    return f"(SELECT * FROM (VALUES {', '.join('(' + ', '.join(map(quote, r)) + ')' for r in rows)}) AS v({', '.join(names)}))"


# --- cleaning ---


@query(f"SELECT doc_id, {text.sql_full_clean('text')} AS cleaned FROM documents")
def clean_text(spark, sf_dir):
    return text.cleaned(table(spark, sf_dir, "documents"), into="cleaned").select("doc_id", "cleaned")


@query(f"SELECT page_id, {text.sql_full_clean('html', is_wiki=False)} AS cleaned FROM pages")
def clean_pages(spark, sf_dir):
    return text.cleaned(table(spark, sf_dir, "pages"), "html", "cleaned", is_wiki=False).select("page_id", "cleaned")


@query(f"SELECT page_id, {text.sql_remove_html('html')} AS plain FROM pages")
def remove_html(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", text.remove_html(F.col("html")).alias("plain"))


@query(f"SELECT doc_id, {text.sql_remove_boilerplate('text')} AS plain FROM documents")
def remove_boilerplate(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", text.remove_boilerplate(F.col("text")).alias("plain"))


@query(f"SELECT doc_id, {text.sql_collapse('text')} AS plain FROM documents")
def collapse_whitespace(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", text.collapse_whitespace(F.col("text")).alias("plain"))


@query("SELECT doc_id, nfc_normalize(text) AS fixed FROM documents")
def fix_encoding(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", text.fix_encoding(F.col("text")).alias("fixed"))


@query("SELECT doc_id, nfc_normalize(text) AS fixed FROM documents")
def repair_encoding(spark, sf_dir):
    """Texts whose UTF-8 was read as Latin-1, every third one twice, as they were."""
    mangled = lambda t: F.decode(F.encode(t, "UTF-8"), "ISO-8859-1")
    docs = table(spark, sf_dir, "documents").withColumn("text", mangled(F.col("text"))).withColumn("text", F.when(F.col("doc_id") % 3 == 0, mangled(F.col("text"))).otherwise(F.col("text")))
    return docs.select("doc_id", text.fix_encoding(F.col("text")).alias("fixed"))


ARABIC = [
    (1, "أَرض إِلى"), (2, "فلسطين abc"), (3, ""), (4, "٠١٢٣ ٤٥٦٧٨٩"), (5, "مـــدرسة"), (6, "[[فلسطين|فلسطين التاريخية]] '''نص''' [1]"), (7, "x [١] y [2]"),
    (8, "Cookie Policy abc\nnext"), (9, "SUBSCRIBE TO our\nnewsletter now\nrest"), (10, "نص == مراجع == ذيل"), (11, "{{قالب}}بعد\n* عنصر\n# عنصر"), (12, "[[ملف:صورة.png]] صورة © 2024 حقوق"),
]


def literal(spark: SparkSession, rows: list[tuple], columns: str) -> DataFrame:
    return spark.createDataFrame(rows, columns)


@query(f"SELECT id, {text.sql_normalize_arabic('t')} AS normal, {text.sql_normalize_arabic('t', False)} AS with_marks FROM {values(ARABIC, 'id', 't')}")
def normalize_arabic(spark, sf_dir):
    t = F.col("t")
    return literal(spark, ARABIC, "id int, t string").select("id", text.normalize_arabic(t).alias("normal"), text.normalize_arabic(t, False).alias("with_marks"))


@query(f"SELECT id, {text.sql_wiki_markup('t')} AS plain, {text.sql_full_clean('t')} AS cleaned FROM {values(ARABIC, 'id', 't')}")
def wiki_markup(spark, sf_dir):
    t = F.col("t")
    return literal(spark, ARABIC, "id int, t string").select("id", text.clean_wiki_markup(t).alias("plain"), text.full_clean(t, is_wiki=True).alias("cleaned"))


@query(f"SELECT id, {text.sql_arabic_ratio('t')} AS ratio FROM (SELECT id, t FROM {values(ARABIC, 'id', 't')} UNION ALL SELECT doc_id + 1000, text FROM documents)")
def arabic_ratio(spark, sf_dir):
    rows = literal(spark, ARABIC, "id long, t string").union(table(spark, sf_dir, "documents").select(F.col("doc_id") + 1000, "text"))
    return rows.select("id", text.arabic_ratio(F.col("t")).alias("ratio"))


@query(f"SELECT doc_id, {text.sql_word_count('text')} AS word_count, length(text)::BIGINT AS char_count FROM documents")
def doc_stats(spark, sf_dir):
    t = F.col("text")
    return table(spark, sf_dir, "documents").select("doc_id", text.word_count(t).alias("word_count"), text.char_count(t).alias("char_count"))


# --- fields ---


@query("SELECT doc_id, sha256(concat('https://', source, '.example.org/', doc_id, substring(text, 1, 200))) AS made_id FROM documents")
def doc_identity(spark, sf_dir):
    url = F.concat(F.lit("https://"), F.col("source"), F.lit(".example.org/"), F.col("doc_id").cast("string"))
    return table(spark, sf_dir, "documents").select("doc_id", fields.make_doc_id(url, F.col("text")).alias("made_id"))


URLS = [
    (1, "https://ar.wikipedia.org/wiki/X"), (2, "https://www.un.org/a?b#c"), (3, "wafa.ps/path"), (4, ""), (5, None), (6, "//HRW.org:80/x"), (7, "http://user@www.amnesty.org"),
    (8, "mailto:a@b.c"), (9, "https://unknown.example/"), (10, "https://www.wafa.ps"),
]
_LOCATION = r"regexp_extract(u, '^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//([^/?#]*)', 1)"
_DOMAIN = rf"lower(CASE WHEN {_LOCATION} <> '' THEN {_LOCATION} ELSE regexp_extract(u, '^(?:[A-Za-z][A-Za-z0-9+.-]*:)?(?://[^/?#]*)?([^?#]*)', 1) END)"
_URLS = f"(SELECT id, coalesce(url, '') AS u FROM (SELECT * FROM {values(URLS, 'id', 'url')} UNION ALL SELECT page_id + 1000, url FROM pages))"


def all_urls(spark, sf_dir) -> DataFrame:
    return literal(spark, URLS, "id long, url string").union(table(spark, sf_dir, "pages").select(F.col("page_id") + 1000, "url"))


@query(f"SELECT id, {_DOMAIN} AS domain, regexp_replace({_DOMAIN}, '^www\\.', '') AS bare FROM {_URLS}")
def url_domain(spark, sf_dir):
    domain = fields.domain_of(F.col("url"))
    return all_urls(spark, sf_dir).select("id", domain.alias("domain"), fields.strip_www(domain).alias("bare"))


_MAP = values(list(credibility.CREDIBILITY_MAP), "name", "tier", "score")


@query(
    f"""WITH m AS {_MAP}, d AS (SELECT id, {_DOMAIN} AS domain FROM {_URLS})
SELECT id, coalesce(a.tier, b.tier, c.tier) AS tier, coalesce(a.score, b.score, c.score)::DOUBLE AS score
FROM d LEFT JOIN m a ON a.name = domain LEFT JOIN m b ON b.name = regexp_replace(domain, '^www\\.', '') LEFT JOIN m c ON c.name = 'default'"""
)
def source_credibility(spark, sf_dir):
    return all_urls(spark, sf_dir).select("id", credibility.credibility(F.col("url")).alias("c")).select("id", "c.tier", "c.score")


TITLES = [(1, "قرى فلسطين", None), (2, "A b/c~d*e+f", ""), (3, "x", "https://known.example/x")]


@query(
    "SELECT * FROM (VALUES (1, 'https://ar.wikipedia.org/wiki/%D9%82%D8%B1%D9%89_%D9%81%D9%84%D8%B3%D8%B7%D9%8A%D9%86', 'تصنيف:قرى فلسطين', 'Category:قرى فلسطين'), "
    "(2, 'https://ar.wikipedia.org/wiki/A_b/c~d%2Ae%2Bf', 'تصنيف:A b/c~d*e+f', 'Category:A b/c~d*e+f'), (3, 'https://known.example/x', 'تصنيف:x', 'Category:x')) AS v(id, url, ar, en)"
)
def page_titles(spark, sf_dir):
    t = F.col("t")
    return literal(spark, TITLES, "id int, t string, full string").select("id", fields.page_url(F.col("full"), t).alias("url"), fields.category_title(t).alias("ar"), fields.category_title(t, "en").alias("en"))


@query(
    "SELECT o_orderkey, try_cast(substring(o_orderpriority, 1, 1) AS BIGINT) AS priority_number, (year(o_orderdate) // 10 * 10)::INT AS decade, strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S.%f') || 'Z' AS collected FROM orders"
)
def optional_fields(spark, sf_dir):
    """optional_int, decade and ISO timestamps over orders."""
    orders = table(spark, sf_dir, "orders")
    number = fields.optional_int(F.lit(None).cast("string"), F.substring("o_orderpriority", 1, 1), F.lit("x"))
    return orders.select("o_orderkey", number.alias("priority_number"), fields.decade(F.lit(None).cast("int"), F.col("o_orderdate")).alias("decade"), fields.iso_timestamp(F.col("o_orderdate").cast("timestamp")).alias("collected"))


# --- quality ---


def model(spark, sf_dir, clean: bool = True) -> DataFrame:
    """documents in the document model, with ingest_seq."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    if clean:
        docs = text.cleaned(docs)
    return docs.select(
        F.col("doc_id").alias("ingest_seq"), F.col("doc_id").cast("string").alias("doc_id"), F.col("source").alias("source_id"), F.concat(F.lit("doc-"), "doc_id").alias("title"), "text",
        text.word_count(F.col("text")).alias("word_count"), text.char_count(F.col("text")).alias("char_count"), F.when(F.col("lang") == "en", "en").otherwise("unknown").alias("language"),
        F.col("source").alias("source_name"), F.lit("other").alias("source_type"), F.concat(F.lit("https://"), "source", F.lit(".example.org/"), "doc_id").alias("source_url"),
        F.lit("2026-01-01").cast("timestamp").alias("date_collected"), F.lit("tier_3").alias("credibility"),
    )


_CLEANED = f"SELECT doc_id, lang, source, {text.sql_full_clean('text')} AS text FROM documents"
_CHECKED = f"""WITH c AS ({_CLEANED}),
n AS (SELECT *, {text.sql_word_count('text')} AS words, length(text) AS chars FROM c),
e AS (SELECT *, list_filter([CASE WHEN words < 50 THEN concat('Too short: ', words, ' words (min 50)') END, CASE WHEN chars < 300 THEN concat('Too short: ', chars, ' chars (min 300)') END,
         CASE WHEN text = '' THEN 'Missing required fields: text' END], lambda x: x IS NOT NULL) AS errors,
       round(((CASE WHEN words >= 200 THEN least(words / 1000::DOUBLE, 1::DOUBLE) WHEN words >= 100 THEN 0.7::DOUBLE WHEN words >= 50 THEN 0.4::DOUBLE ELSE 0::DOUBLE END) * 0.4::DOUBLE
         + 0.45::DOUBLE * 0.2::DOUBLE + 1::DOUBLE * 0.2::DOUBLE) + (CASE WHEN lang = 'en' THEN 1::DOUBLE ELSE 0::DOUBLE END) * 0.2::DOUBLE, 4) AS raw FROM n),
q AS (SELECT doc_id, source, lang, text, words, errors, CASE WHEN len(errors) > 0 THEN least(raw, 0.3::DOUBLE) ELSE raw END AS quality_score,
       CASE WHEN len(errors) > 1 THEN 'hard_reject' WHEN len(errors) = 1 THEN 'reject' WHEN raw >= 0.7 THEN 'accept' WHEN raw >= 0.45 THEN 'accept_with_warning' WHEN raw >= 0.2 THEN 'reject' ELSE 'hard_reject' END AS quality_decision,
       CASE WHEN len(errors) > 0 THEN array_to_string(errors, '; ') END AS rejection_reason FROM e)
"""


@query(f"{_CHECKED} SELECT doc_id::VARCHAR AS doc_id, quality_score, quality_decision, rejection_reason, len(errors) = 0 AS is_valid FROM q")
def quality_check(spark, sf_dir):
    return quality.checked(model(spark, sf_dir)).select("doc_id", "quality_score", "quality_decision", "rejection_reason", "is_valid")


@query(f"{_CHECKED} SELECT quality_decision, count(*) AS n FROM q GROUP BY quality_decision")
def decision_distribution(spark, sf_dir):
    return stats.decision_distribution(quality.checked(model(spark, sf_dir)))


@query(f"{_CHECKED} SELECT coalesce(rejection_reason, 'unknown') AS rejection_reason, count(*) AS n FROM q WHERE quality_decision IN ('reject', 'hard_reject') GROUP BY 1 ORDER BY n DESC, min(doc_id) LIMIT 50")
def rejection_distribution(spark, sf_dir):
    judged = dedup.shared(quality.checked(model(spark, sf_dir)), "checked").withColumn("route", F.when(F.col("quality_decision").isin("reject", "hard_reject"), "rejected"))
    return stats.rejection_distribution(judged)


CASES = [
    (1, "ar-MSA", 49, 300, 0.5), (2, "ar-MSA", 50, 299, 0.39), (3, "ar-PAL", 100, 1000, 0.4), (4, "en", 199, 1000, 0.0), (5, "en", 200, 1000, 0.0), (6, "unknown", 1001, 9000, 0.0), (7, "ar-OTHER", 100001, 900000, 0.25), (8, "multi", 10, 20, 0.0),
]


@query(
    f"""SELECT id, array_to_string(list_filter([CASE WHEN w <= 100000 AND w < 50 THEN concat('Too short: ', w, ' words (min 50)') END, CASE WHEN w <= 100000 AND c < 300 THEN concat('Too short: ', c, ' chars (min 300)') END], lambda x: x IS NOT NULL), '; ') AS length_errors,
CASE WHEN w > 100000 THEN concat('WARN: very long document (', w, ' words), may need chunking') ELSE '' END AS warnings,
CASE WHEN starts_with(l, 'ar') AND r < 0.4 THEN concat('Declared Arabic but Arabic script ratio is only ', format('{{:.1f}}', r * 100), '% (min 40%)') ELSE '' END AS language_errors
FROM (SELECT id, l, w, c, r::DOUBLE AS r FROM {values(CASES, 'id', 'l', 'w', 'c', 'r')})"""
)
def quality_rules_literal(spark, sf_dir):
    df = literal(spark, CASES, "id int, l string, w long, c long, r double")
    w, c = F.col("w"), F.col("c")
    joined = lambda errors, name: F.array_join(errors, "; ").alias(name)
    return df.select("id", joined(quality.length_errors(w, c), "length_errors"), joined(quality.length_warnings(w), "warnings"), joined(quality.language_errors(F.col("l"), F.col("r")), "language_errors"))


# --- duplicates ---


_SETS = "SELECT doc_id, list_distinct(list_transform(range(1, greatest(length(text) - 2, 1) + 1), lambda i: substring(text, i, 3))) AS s FROM documents"


@query(f"SELECT doc_id, len(s)::BIGINT AS n_shingles, sha256(array_to_string(list_sort(s), '')) AS digest FROM ({_SETS})")
def shingle_sets(spark, sf_dir):
    s = F.array_sort(dedup.shingles(F.col("text")))
    return table(spark, sf_dir, "documents").select("doc_id", s.alias("s")).select("doc_id", F.size("s").cast("bigint").alias("n_shingles"), F.sha2(F.array_join("s", ""), 256).alias("digest"))


def _pairs(source: str) -> str:
    """CTEs: d, the distinct texts of source (id, text) by their first id; pairs, those of them that share shingles."""
    return f"""d AS (SELECT text, min(id) AS id FROM {source} GROUP BY text),
sets AS (SELECT id, list_distinct(list_transform(range(1, greatest(length(text) - 2, 1) + 1), lambda i: substring(text, i, 3))) AS s FROM d),
each AS (SELECT id, len(s) AS n, unnest(s) AS g FROM sets),
pairs AS (SELECT a.id AS a, b.id AS b, count(*)::DOUBLE / (any_value(a.n) + any_value(b.n) - count(*)) AS similarity FROM each a JOIN each b ON a.g = b.g AND a.id < b.id AND a.n >= 0.8 * b.n AND b.n >= 0.8 * a.n GROUP BY a.id, b.id)"""


def _greedy(source: str) -> str:
    """CTEs after _pairs: dups, the (seq, canonical) that visiting source in the order of id finds."""
    return f"""{_pairs(source)},
near AS (SELECT a, b FROM pairs WHERE similarity >= 0.8 UNION SELECT d.id, x.id FROM d JOIN {source} x ON x.text = d.text AND x.id > d.id),
firsts AS (SELECT b AS id, list(DISTINCT a) AS before FROM near GROUP BY b),
copies AS (SELECT x.id AS id, d.id AS first FROM d JOIN {source} x ON x.text = d.text AND x.id > d.id),
ranked AS (SELECT id, before, row_number() OVER (ORDER BY id) AS k FROM firsts WHERE id NOT IN (SELECT id FROM copies)),
walk(k, gone) AS (SELECT 0::BIGINT, []::BIGINT[] UNION ALL SELECT ranked.k, CASE WHEN len(list_filter(before, lambda x: NOT list_contains(gone, x))) > 0 THEN list_append(gone, ranked.id) ELSE gone END FROM walk JOIN ranked ON ranked.k = walk.k + 1),
last AS (SELECT gone FROM walk ORDER BY k DESC LIMIT 1),
own AS (SELECT ranked.id AS seq, list_min(list_filter(before, lambda x: NOT list_contains(gone, x))) AS canonical FROM ranked, last WHERE list_contains(gone, ranked.id)),
dups AS (SELECT seq, canonical FROM own UNION ALL SELECT copies.id, coalesce(own.canonical, first) FROM copies LEFT JOIN own ON own.seq = first)"""


_ALL = "every AS (SELECT doc_id AS id, text FROM documents)"


@query(f"WITH {_ALL}, {_pairs('every')} SELECT a, b, similarity FROM pairs WHERE similarity >= 0.8")
def jaccard_pairs(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").groupBy("text").agg(F.min("doc_id").alias("seq"))
    return dedup.similar_pairs(docs)


@query(f"WITH RECURSIVE {_ALL}, {_greedy('every')} SELECT seq, canonical FROM dups")
def near_dup_greedy(spark, sf_dir):
    return dedup.duplicates(table(spark, sf_dir, "documents").select(F.col("doc_id").alias("seq"), "text"))


@query(f"WITH RECURSIVE {_ALL}, {_greedy('every')}, n AS (SELECT count(*) AS checked FROM every) SELECT checked, (SELECT count(*) FROM dups) AS duplicates, checked - (SELECT count(*) FROM dups) AS \"unique\", 0.8::DOUBLE AS threshold, 'exact_jaccard' AS backend FROM n")
def index_stats(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("seq"), "text")
    return dedup.index_stats(docs, dedup.duplicates(docs))


@query()
def banded_duplicates(spark, sf_dir):
    """Sharing a band is enough; its hash functions are no SQL, and the tests compare it with a sequential search."""
    return dedup.banded_duplicates(table(spark, sf_dir, "documents").select(F.col("doc_id").alias("seq"), F.col("doc_id").cast("string").alias("doc_id"), "text"))


_HASHES = "SELECT doc_id, list_transform(s, lambda g: ('0x' || substring(md5(g), 1, 7))::BIGINT) AS h FROM (" + _SETS + ")"


@query(f"SELECT doc_id, array_to_string(list_transform(range(1, 17), lambda k: list_min(list_transform(h, lambda x: (x * (k * 7919 + 1) + k * 104729) % 2147483647))), ' ') AS signature FROM ({_HASHES})")
def minhash_signatures(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", F.array_join(dedup.portable_minhash(F.col("text")).cast("array<string>"), " ").alias("signature"))


# --- the pipeline ---


def routes(spark, sf_dir, *columns: str) -> DataFrame:
    docs = model(spark, sf_dir).withColumns({"wikipedia_categories": F.array("source_id", "language"), "seed_category": F.when(F.col("source_id") != "src0", F.col("source_id"))})
    return ingest.routed(docs, columns=columns or None)


_ROUTED = f"""{_CHECKED.replace("WITH c", "WITH RECURSIVE c", 1).rstrip()},
passed AS MATERIALIZED (SELECT doc_id AS id, text FROM q WHERE quality_decision IN ('accept', 'accept_with_warning')),
{_greedy('passed')},
routed AS (SELECT q.doc_id AS seq, q.doc_id::VARCHAR AS doc_id, source, CASE WHEN lang = 'en' THEN 'en' ELSE 'unknown' END AS language, words, quality_decision, canonical IS NOT NULL AS has_duplicate,
  canonical::VARCHAR AS is_duplicate_of, CASE WHEN canonical IS NOT NULL THEN 'duplicate' ELSE rejection_reason END AS rejection_reason,
  CASE WHEN canonical IS NULL AND quality_decision IN ('accept', 'accept_with_warning') THEN 'accepted' ELSE 'rejected' END AS route FROM q LEFT JOIN dups ON dups.seq = q.doc_id)
"""


@query(f"{_ROUTED} SELECT doc_id, quality_decision, has_duplicate, is_duplicate_of, rejection_reason, route FROM routed")
def pipeline_routes(spark, sf_dir):
    return routes(spark, sf_dir, "doc_id", "quality_decision", "has_duplicate", "is_duplicate_of", "rejection_reason", "route")


@query(
    f"""{_ROUTED} SELECT count(*) AS attempted_documents, count_if(route = 'accepted')::BIGINT AS accepted_documents, count_if(route <> 'accepted')::BIGINT AS rejected_documents, count_if(has_duplicate)::BIGINT AS duplicate_documents,
coalesce(sum(words) FILTER (route = 'accepted'), 0)::BIGINT AS total_words, CASE WHEN count_if(route = 'accepted') > 0 THEN round(sum(words) FILTER (route = 'accepted') / count_if(route = 'accepted')::DOUBLE, 2) ELSE 0 END AS average_document_length FROM routed"""
)
def run_stats(spark, sf_dir):
    return stats.run_stats(routes(spark, sf_dir, "word_count", "has_duplicate", "route"))


@query(
    f"""{_ROUTED},
each_value AS (SELECT 'category' AS kind, unnest([source, language]) AS value, unnest([0, 1]) AS place, seq FROM routed WHERE route = 'accepted'
  UNION ALL SELECT 'seed_category', CASE WHEN source <> 'src0' THEN source ELSE 'unknown' END, 0, seq FROM routed WHERE route = 'accepted'
  UNION ALL SELECT 'rejection_reason', coalesce(nullif(rejection_reason, ''), 'unknown'), 0, seq FROM routed WHERE route = 'rejected'),
counted AS (SELECT kind, value, count(*) AS n, min(row(seq, place)) AS first FROM each_value GROUP BY kind, value)
SELECT kind, value, n FROM counted QUALIFY row_number() OVER (PARTITION BY kind ORDER BY n DESC, first) <= 50"""
)
def route_distributions(spark, sf_dir):
    """Categories, seeds and reasons of routed documents, with counts."""
    found = dedup.shared(routes(spark, sf_dir, "ingest_seq", "wikipedia_categories", "seed_category", "rejection_reason", "route"), "routed")
    parts = (("category", stats.category_distribution(found)), ("seed_category", stats.seed_distribution(found)), ("rejection_reason", stats.rejection_distribution(found)))
    out = None
    for name, df in parts:
        part = df.select(F.lit(name).alias("kind"), F.col(name).alias("value"), "n")
        out = part if out is None else out.union(part)
    return out


@query("SELECT word, count(*) AS n FROM (SELECT doc_id, unnest(string_split(text, ' ')) AS word, generate_subscripts(string_split(text, ' '), 1) AS k FROM documents) GROUP BY word ORDER BY n DESC, min(row(doc_id, k)) LIMIT 50")
def category_top50(spark, sf_dir):
    """The distribution's top 50 over words; as many as that report has."""
    each = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("ingest_seq"), F.posexplode(F.split("text", " ")).alias("pos", "word"))
    return stats.distribution(each, F.col("word"), "word", position=F.col("pos"))


_MODEL = f"""SELECT doc_id::VARCHAR AS doc_id, source AS source_id, 'doc-' || doc_id AS title, text, {text.sql_word_count('text')} AS word_count, length(text)::BIGINT AS char_count,
CASE WHEN lang = 'en' THEN 'en' ELSE 'unknown' END AS language, source AS source_name, 'other' AS source_type, 'https://' || source || '.example.org/' || doc_id AS source_url, 'tier_3' AS credibility FROM documents"""
_NO_VALUE = ("summary", "dialect_region", "source_domain", "seed_category", "geographic_scope", "quality_decision", "is_duplicate_of", "rejection_reason", "topic_label", "wikipedia_page_id", "wikipedia_revid", "decade", "category_confidence", "quality_score", "topic_id", "date_published", "date_processed")


@query(
    f"SELECT m.*, '2026-01-01T00:00:00.000000Z' AS date_collected, 'false' AS is_bilingual, 'false' AS has_duplicate, 'uncategorized' AS category, '' AS wikipedia_categories, '' AS tags, {', '.join(f'NULL::VARCHAR AS {c}' for c in _NO_VALUE)} FROM ({_MODEL}) m"
)
def export_view(spark, sf_dir):
    """All 34 fields; lists joined, fields without a value and flags as strings."""
    docs = schema.export_view(schema.as_documents(model(spark, sf_dir, clean=False)))
    shown = {c: F.array_join(c, ",") for c in ("wikipedia_categories", "tags")} | {c: F.col(c).cast("string") for c in (*_NO_VALUE, "is_bilingual", "has_duplicate")}
    return docs.select(*(shown.get(c, F.col(c)).alias(c) for c in docs.columns))


@query(f"SELECT count(*) AS num_rows, 1::BIGINT AS n_columns, sum(words)::BIGINT AS total_words, round(sum(words) / count(*), 2) AS average_words FROM (SELECT {text.sql_word_count('text')} AS words FROM documents)")
def export_summary(spark, sf_dir):
    found = stats.export_summary(table(spark, sf_dir, "documents").select(text.word_count(F.col("text")).alias("word_count")))
    return spark.createDataFrame([(found["num_rows"], len(found["columns"]), found["total_words"], found["average_words"])], "num_rows long, n_columns long, total_words long, average_words double")


_INVALID = [
    ("doc_id", "doc_id % 11 = 0"), ("language", f"lang NOT IN {tuple(schema.LANGUAGES)}"), ("source_type", "doc_id % 5 = 1"), ("credibility", "doc_id % 6 IN (0, 5)"), ("quality_score", "doc_id % 7 = 6"), ("quality_decision", "doc_id % 4 = 3"),
]


@query(
    "SELECT v AS violation, count(*) AS n FROM (SELECT array_to_string(list_filter([" + ", ".join(f"CASE WHEN {sql} THEN '{name}' END" for name, sql in _INVALID) + "], lambda x: x IS NOT NULL), ',') AS v FROM documents) GROUP BY 1"
)
def validation(spark, sf_dir):
    """How many documents break which fields, with wrong values in five enumerations, a range and a required field."""
    n, case = F.col("doc_id"), lambda wrong, bad, good: F.when(wrong, bad).otherwise(good)
    docs = table(spark, sf_dir, "documents").select(
        F.when(n % 11 != 0, n.cast("string")).alias("doc_id"), F.col("lang").alias("language"), case(n % 5 == 1, "blog", "news").alias("source_type"), F.concat(F.lit("tier_"), (n % 6).cast("string")).alias("credibility"),
        ((n % 7) / 5).alias("quality_score"), case(n % 4 == 3, "maybe", "accept").alias("quality_decision"), F.lit("history").alias("category"),
    )
    valid, invalid = schema.validated(docs)
    rows = valid.select(F.lit("").alias("violation")).union(invalid.select(F.array_join("violations", ",")))
    return rows.groupBy("violation").agg(F.count("*").alias("n"))


_PAGE_TEXT = "CASE WHEN doc_id % 10 = 3 THEN '<br> ' ELSE text END"
_PAGE_URL = "CASE WHEN doc_id % 2 = 1 THEN concat('https://', source, '.example.org/', doc_id) ELSE concat('https://ar.wikipedia.org/wiki/doc_', doc_id) END"


@query(
    f"""WITH c AS (SELECT *, {text.sql_full_clean('t')} AS clean, {_PAGE_URL} AS url FROM (SELECT *, {_PAGE_TEXT} AS t FROM documents))
SELECT doc_id AS ingest_seq, CASE WHEN clean <> '' THEN sha256(concat(url, substring(clean, 1, 200))) END AS made_id, CASE WHEN clean <> '' THEN url END AS source_url, CASE WHEN clean <> '' THEN {text.sql_word_count('clean')}::VARCHAR END AS word_count,
CASE WHEN clean <> '' THEN doc_id::VARCHAR END AS page, CASE WHEN clean <> '' AND doc_id % 4 <> 0 THEN (doc_id + 7)::VARCHAR END AS revision, CASE WHEN clean <> '' THEN array_to_string(list_sort([source, lang]), ',') END AS categories,
CASE WHEN clean <> '' THEN source END AS seed, CASE WHEN clean <> '' THEN 'ar-MSA/tier_2/w/encyclopedia/ar.wikipedia.org' END AS fixed, CASE WHEN clean = '' THEN concat('doc ', doc_id, ': empty_after_cleaning') END AS rejected FROM c"""
)
def page_documents(spark, sf_dir):
    """Pages made of all documents, as documents or rejections; every tenth is empty but for markup, some have no URL or no numeric revision."""
    n = F.col("doc_id")
    pages = table(spark, sf_dir, "documents").select(
        n.alias("ingest_seq"), F.col("source").alias("seed"), F.concat(F.lit("doc "), n.cast("string")).alias("title"), F.expr(_PAGE_TEXT).alias("text"), n.cast("string").alias("pageid"),
        F.when(n % 4 != 0, (n + 7).cast("string")).otherwise("r1").alias("revid"), F.when(n % 2 == 1, F.concat(F.lit("https://"), "source", F.lit(".example.org/"), n.cast("string"))).otherwise("").alias("fullurl"),
        F.array(F.concat(F.lit(fields.CATEGORY_PREFIXES["ar"]), "source"), F.concat(F.lit("Category:"), "lang"), F.lit("تصنيف:بذرة")).alias("categories"),
    )
    docs, rejected = ingest.pages_to_documents(pages, {"languages": [{"code": "ar", "source_id": "w", "credibility_tier": "tier_2"}]})
    fixed = F.concat_ws("/", "language", "credibility", "source_id", "source_type", "source_domain")
    made = docs.select("ingest_seq", F.col("doc_id").alias("made_id"), "source_url", F.col("word_count").cast("string"), F.col("wikipedia_page_id").cast("string").alias("page"), F.col("wikipedia_revid").cast("string").alias("revision"), F.array_join("wikipedia_categories", ",").alias("categories"), F.col("seed_category").alias("seed"), fixed.alias("fixed"))
    return made.unionByName(rejected.select("ingest_seq", F.concat_ws(": ", "key", "reason").alias("rejected")), allowMissingColumns=True)


# --- scans and sinks: written, read back, compared with what the table holds ---


def _folder(spark: SparkSession, name: str) -> str:
    return f"{dedup.scratch(spark)}/{name}-{uuid.uuid4().hex}"


def _read_back(df: DataFrame) -> DataFrame:
    return df.select("doc_id", "source_id", "language", "title", F.sha2("text", 256).alias("digest"), "word_count", "char_count", F.size("tags").cast("bigint").alias("n_tags"))


_BACK = f"SELECT doc_id, source_id, language, title, sha256(text) AS digest, word_count, char_count, 0::BIGINT AS n_tags FROM ({_MODEL})"


@query(_BACK)
def jsonl_scan(spark, sf_dir):
    """Documents written as JSON lines and read with their schema."""
    path = _folder(spark, "jsonl")
    files.write_jsonl(schema.as_documents(model(spark, sf_dir, clean=False)), path)
    return _read_back(files.read_jsonl(spark, path))


@query(_BACK)
def json_array_scan(spark, sf_dir):
    """JSON arrays of at most 500 documents, one in each line's file."""
    path = _folder(spark, "arrays")
    docs = schema.as_documents(model(spark, sf_dir, clean=False), ("ingest_seq",))
    one = F.to_json(F.struct(*schema.DOCUMENT.names), {"ignoreNullFields": "false"})
    docs.select(F.floor(F.col("ingest_seq") / 500).alias("part"), one.alias("value")).groupBy("part").agg(F.concat(F.lit("["), F.array_join(F.collect_list("value"), ","), F.lit("]")).alias("value")).select("value", "part").write.partitionBy("part").text(path)
    return _read_back(files.read_json_array(spark, path).drop("part"))


@query(_BACK)
def partitioned_scan(spark, sf_dir):
    """Parquet by source and language."""
    path = _folder(spark, "partitioned")
    files.write_partitioned(schema.as_documents(model(spark, sf_dir, clean=False)), path)
    return _read_back(files.read_parquet(spark, path))


@query(_BACK)
def import_scan(spark, sf_dir):
    """A Parquet dataset imported as JSON lines."""
    path = _folder(spark, "import")
    schema.as_documents(model(spark, sf_dir, clean=False)).write.parquet(f"{path}/parquet")
    files.import_dataset(spark, f"{path}/parquet", f"{path}/lines")
    return _read_back(files.read_jsonl(spark, f"{path}/lines"))


@query(f"SELECT 'train' AS part, count(*) AS num_rows, sum(word_count)::BIGINT AS total_words, round(sum(word_count) / count(*), 2) AS average_words FROM ({_MODEL})")
def export_sink(spark, sf_dir):
    """JSON lines exported as a Parquet dataset; the summary that was written beside it, read back."""
    path = _folder(spark, "export")
    files.write_jsonl(schema.as_documents(model(spark, sf_dir, clean=False)), f"{path}/lines")
    found = files.export_dataset(spark, f"{path}/lines", f"{path}/out")
    kept = spark.read.option("multiLine", True).schema("num_rows long, total_words long, average_words double").json(found["summary_json"])
    rows = files.read_parquet(spark, found["train_parquet"]).agg(F.count("*").alias("there"))
    return kept.join(rows, F.col("there") == F.col("num_rows")).select(F.lit("train").alias("part"), "num_rows", "total_words", "average_words")


@query(f"{_CHECKED} SELECT CASE WHEN quality_decision IN ('reject', 'hard_reject') THEN 'rejected' ELSE 'accepted' END AS route, quality_decision, count(*) AS n, sum(words)::BIGINT AS words FROM q GROUP BY 1, 2")
def routes_sink(spark, sf_dir):
    """Checked documents written to the two folders of JSON lines, counted from there."""
    path = _folder(spark, "routes")
    gate = F.col("quality_decision").isin("reject", "hard_reject")
    docs = dedup.shared(quality.checked(model(spark, sf_dir)), "checked").withColumn("route", F.when(gate, "rejected").otherwise("accepted"))
    files.write_routes(schema.as_documents(docs, ("route",)), f"{path}/accepted", f"{path}/rejected")
    parts = [files.read_jsonl(spark, f"{path}/{r}").select(F.lit(r).alias("route"), "quality_decision", "word_count") for r in ("accepted", "rejected")]
    return parts[0].union(parts[1]).groupBy("route", "quality_decision").agg(F.count("*").alias("n"), F.sum("word_count").alias("words"))


@query("SELECT count_if(event_type <> '')::BIGINT AS docs_attempted, count_if(event_type = 'purchase')::BIGINT AS docs_collected, (count_if(event_type <> '') - count_if(event_type = 'purchase'))::BIGINT AS docs_rejected, count_if(value > 100)::BIGINT AS n_errors FROM events")
def run_log(spark, sf_dir):
    """The summary of a run's log, events standing in for documents: all are attempts, purchases successes."""
    events = table(spark, sf_dir, "events")
    kinds = F.array_compact(F.array(F.when(F.col("event_type") != "", "attempt"), F.when(F.col("event_type") == "purchase", "success"), F.when(F.col("value") > 100, "error")))
    return stats.run_log_summary(events.select(F.explode(kinds).alias("kind")))


# --- graphs ---

NAMES = [
    (1, "تصنيف:فلسطين"), (2, "تصنيف:بوابة فلسطين/مقالات متعلقة"), (3, "تصنيف:أردنيون من أصل فلسطيني"), (4, "Category:Villages"), (5, "تصنيف:بذرة قرية"), (6, "تصنيف:تراث فلسطيني"), (7, "تصنيف:شعر وموسيقى"), (8, "مقالات تحتاج إلى صور"),
]


def _contains(column: str, parts) -> str:
    return "(" + " OR ".join(f"contains({column}, {quote(p)})" for p in parts) + ")"


_PLAIN = f"replace(t, {quote(fields.CATEGORY_PREFIXES['ar'])}, '')"
_RELEVANCE = "(" + " + ".join(f"contains({_PLAIN}, {quote(k)})::INT" for k in graph.KEYWORDS) + ")::DOUBLE"


@query(f"SELECT id, {_contains('t', graph.MAINTENANCE)} AS maintenance, {_contains('t', graph.TERMINAL)} AS terminal, {_RELEVANCE} AS relevance FROM {values(NAMES, 'id', 't')}")
def category_filters(spark, sf_dir):
    t = F.col("t")
    return literal(spark, NAMES, "id int, t string").select("id", graph.is_maintenance(t).alias("maintenance"), graph.is_terminal(t).alias("terminal"), graph.relevance(t).alias("relevance"))


PAGE_ROWS = [
    ("تصنيف:فلسطين", 14, 1, True, ["تصنيف:بلدان"]), ("تصنيف:تراث فلسطيني", 14, 2, True, None), ("تصنيف:أردنيون من أصل فلسطيني", 14, 3, True, []), ("تصنيف:وزراء", 14, 4, True, []), ("تصنيف:فارغ", 14, 11, True, []),
    ("فلسطين", 0, 5, True, ["تصنيف:فلسطين", "تصنيف:بذرة"]), ("نابلس", 0, 6, True, ["تصنيف:مدن", "Category:Cities"]), ("دبكة", 0, 7, True, []), ("شخص", 0, 8, True, []), ("مفقود", 0, 9, False, []), ("وزير", 0, 10, True, []),
]
MEMBER_ROWS = [
    ("تصنيف:فلسطين", "فلسطين", 0), ("تصنيف:فلسطين", "تصنيف:تراث فلسطيني", 1), ("تصنيف:فلسطين", "تصنيف:بوابة فلسطين", 2), ("تصنيف:فلسطين", "نابلس", 3), ("تصنيف:فلسطين", "تصنيف:أردنيون من أصل فلسطيني", 4),
    ("تصنيف:تراث فلسطيني", "دبكة", 0), ("تصنيف:تراث فلسطيني", "فلسطين", 1), ("تصنيف:تراث فلسطيني", "تصنيف:فلسطين", 2), ("تصنيف:تراث فلسطيني", "مفقود", 3),
    ("تصنيف:أردنيون من أصل فلسطيني", "شخص", 0), ("تصنيف:أردنيون من أصل فلسطيني", "تصنيف:وزراء", 1), ("تصنيف:وزراء", "وزير", 0),
]
_PAGES, _MEMBERS = values(PAGE_ROWS, "title", "ns", "pageid", "ex", "categories"), values(MEMBER_ROWS, "parent", "member", "pos")


def wiki(spark: SparkSession) -> tuple[DataFrame, DataFrame]:
    pages = literal(spark, PAGE_ROWS, "title string, ns int, pageid long, exists boolean, categories array<string>")
    return pages, literal(spark, MEMBER_ROWS, "parent string, member string, pos int")


_IS_CATEGORY = "(starts_with(member, 'Category:') OR starts_with(member, 'تصنيف:') OR coalesce(ns, 0) = 14)"


@query(
    f"""SELECT parent, count_if(NOT {_IS_CATEGORY})::BIGINT AS pages, count_if({_IS_CATEGORY} AND NOT {_contains('member', graph.MAINTENANCE)})::BIGINT AS subcategories, count_if({_IS_CATEGORY} AND {_contains('member', graph.MAINTENANCE)})::BIGINT AS maintenance_pages_skipped
FROM {_MEMBERS} LEFT JOIN {_PAGES} ON title = member GROUP BY parent"""
)
def category_counts(spark, sf_dir):
    pages, members = wiki(spark)
    return graph.member_counts(members, pages)


@query(
    f"""SELECT title, array_to_string(list_sort(list_filter(list_transform(coalesce(categories, []), lambda c: replace(replace(c, 'تصنيف:', ''), 'Category:', '')), lambda c: NOT {_contains('c', graph.MAINTENANCE)})), ',') AS names,
coalesce(ex, FALSE) AND NOT (starts_with(title, 'Category:') OR starts_with(title, 'تصنيف:') OR ns = 14) AS article FROM {_PAGES}"""
)
def page_categories(spark, sf_dir):
    pages, _ = wiki(spark)
    return pages.select("title", F.array_join(graph.page_categories(F.col("categories")), ",").alias("names"), graph.is_article(F.col("title"), F.col("ns"), F.col("exists")).alias("article"))


SCORES = [("تصنيف:فلسطينيون", 0, 19, 48, 3.0), ("تصنيف:تاريخ_فلسطين", 0, 307, 47, 2.0), ("تصنيف:فلسطين", 0, 161, 40, 1.0), ("تصنيف:رياضة", 1, 3, 1, 0.0), ("تصنيف:فن", 1, 4, 0, 1.0), ("تصنيف:نقل", 2, 50, 5, 0.0)]


@query(
    f"""WITH s AS (SELECT t, p, r >= 1 AND p >= 5 AS recommended, round(r::DOUBLE * 3 + ln(1 + p) + ln(1 + c) * 0.5::DOUBLE, 3) AS total_score, list_filter([CASE WHEN r < 1 THEN 'low_cultural_relevance' END, CASE WHEN p < 5 THEN 'too_few_pages' END], lambda x: x IS NOT NULL) AS rejection_reasons, n
FROM {values([(*r, k) for k, r in enumerate(SCORES)], 't', 'd', 'p', 'c', 'r', 'n')})
SELECT t AS title, total_score, recommended, array_to_string(rejection_reasons, ',') AS rejection_reasons, row_number() OVER (PARTITION BY recommended ORDER BY total_score DESC, n)::INT AS rank FROM s"""
)
def classify_discovered(spark, sf_dir):
    rows = [(*r, k) for k, r in enumerate(SCORES)]
    df = literal(spark, rows, "title string, depth int, pages long, subcategories long, relevance_score double, bfs_seq long")
    df = df.withColumn("total_score", graph.total_score(F.col("relevance_score"), F.col("pages"), F.col("subcategories")))
    return graph.classify_discovered(df).select("title", "total_score", "recommended", F.array_join("rejection_reasons", ",").alias("rejection_reasons"), "rank")


@query(
    f"""WITH RECURSIVE e AS (SELECT parent, member FROM {_MEMBERS} WHERE starts_with(member, 'تصنيف:')),
r(title, depth) AS (SELECT 'تصنيف:فلسطين', 0 UNION SELECT member, depth + 1 FROM r JOIN e ON parent = title WHERE depth < 3)
SELECT title, min(depth) AS depth FROM r GROUP BY title"""
)
def walk_reachable(spark, sf_dir):
    _, members = wiki(spark)
    edges = members.where(F.col("member").startswith("تصنيف:"))
    return graph.reachable(edges, literal(spark, [("تصنيف:فلسطين",)], "title string"), 3)


# Categories made of regions and nations, pages of customers: every third nation is relevant, others are terminal or upkeep.
_AR = fields.CATEGORY_PREFIXES["ar"]
_NATION = f"concat('{_AR}', CASE WHEN n_nationkey % 7 = 6 THEN 'بذرة ' WHEN n_nationkey % 3 = 0 THEN 'قرية ' ELSE '' END, n_name, CASE WHEN n_nationkey % 5 = 4 THEN ' من أصل فلسطيني' ELSE '' END)"
_UPKEEP = "n_nationkey % 7 = 6"


def atlas(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """(pages, members): regions hold nations, nations hold customers and, first, the region they are in; a seventh of the customers are missing."""
    regions, nations, customers = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("region", "nation", "customer"))
    region = F.concat(F.lit(_AR), "r_name")
    held = nations.join(F.broadcast(regions), F.col("n_regionkey") == F.col("r_regionkey")).withColumns({"region": region, "nation": F.expr(_NATION)})
    place = customers.join(F.broadcast(held), F.col("c_nationkey") == F.col("n_nationkey"))
    page = lambda df, title, ns, there: df.select(title.alias("title"), F.lit(ns).alias("ns"), there.alias("exists"))
    pages = page(regions, region, 14, F.lit(True)).union(page(held, F.col("nation"), 14, F.lit(True))).union(page(customers, F.col("c_name"), 0, F.col("c_custkey") % 7 != 3))
    members = held.select(F.col("region").alias("parent"), F.col("nation").alias("member"), F.col("n_nationkey").cast("long").alias("pos"))
    members = members.union(held.select("nation", "region", F.lit(-1).cast("long"))).union(place.select("nation", "c_name", F.col("c_custkey").cast("long")))
    return pages, members


_HELD = f"held AS (SELECT *, concat('{_AR}', r_name) AS region, {_NATION} AS nation FROM nation JOIN region ON n_regionkey = r_regionkey)"


@query(
    f"""WITH {_HELD},
given AS (SELECT r_regionkey, n_nationkey, c_name, c_custkey, row_number() OVER (PARTITION BY n_nationkey ORDER BY c_custkey) AS k FROM customer JOIN held ON c_nationkey = n_nationkey WHERE c_custkey % 7 <> 3 AND NOT {_UPKEEP}),
turns AS (SELECT *, row_number() OVER (PARTITION BY r_regionkey ORDER BY n_nationkey, c_custkey) AS turn FROM given WHERE k <= 5)
SELECT row_number() OVER (ORDER BY turn, r_regionkey) - 1 AS ingest_seq, r_name AS seed, c_name AS title FROM turns JOIN region USING (r_regionkey) QUALIFY row_number() OVER (ORDER BY turn, r_regionkey) <= 60"""
)
def walk_pages(spark, sf_dir):
    """Pages of five regions by turns, five of each nation, sixty in all."""
    pages, members = atlas(spark, sf_dir)
    seeds = [r.r_name for r in spark.read.parquet(f"{sf_dir}/region.parquet").orderBy("r_regionkey").collect()]
    return graph.walk_pages(pages, members, seeds, depth=1, per_category=5, max_docs=60)


@query(
    f"""WITH {_HELD},
given AS (SELECT r_regionkey, n_nationkey, c_name, c_custkey, row_number() OVER (PARTITION BY n_nationkey ORDER BY c_custkey) AS k FROM customer JOIN held ON c_nationkey = n_nationkey WHERE c_custkey % 7 <> 3 AND NOT {_UPKEEP}),
turns AS (SELECT *, row_number() OVER (PARTITION BY r_regionkey ORDER BY n_nationkey, c_custkey) AS turn FROM given WHERE k <= 5),
walk AS (SELECT row_number() OVER (ORDER BY turn, r_regionkey) - 1 AS ingest_seq, r_name AS seed, c_name AS title, c_custkey % 3 <> 1 AS good FROM turns JOIN region USING (r_regionkey)),
told AS (SELECT *, count_if(good) OVER (ORDER BY ingest_seq) AS n FROM walk)
SELECT ingest_seq, title, CASE WHEN good THEN seed ELSE 'empty_after_cleaning' END AS told FROM told WHERE n < 40 OR (n = 40 AND good)"""
)
def wiki_source(spark, sf_dir):
    """Forty documents of five regions by turns, and the pages met before the last that are empty after cleaning, a third of all."""
    pages, members = atlas(spark, sf_dir)
    seeds = [r.r_name for r in spark.read.parquet(f"{sf_dir}/region.parquet").orderBy("r_regionkey").collect()]
    pages = pages.withColumn("text", F.when(F.try_to_number(F.substring_index("title", "#", -1), F.lit("999999999")) % 3 == 1, "<br>").otherwise(F.col("title")))
    config = {"category_depth": 1, "max_articles_per_category": 5, "seed_categories": {"ar": seeds}}
    docs, rejected = WikiSource(pages, members, config, max_docs=40).walked()
    return docs.select("ingest_seq", "title", F.col("seed_category").alias("told")).union(rejected.select("ingest_seq", "key", "reason"))


@query(
    f"""WITH {_HELD},
roots AS (SELECT concat('{_AR}', r_name) AS title, 0 AS depth, NULL::VARCHAR AS parent, r_regionkey AS a, -1 AS b FROM region WHERE r_regionkey < 4),
open AS (SELECT *, row_number() OVER (PARTITION BY r_regionkey ORDER BY n_nationkey) AS k FROM held WHERE r_regionkey < 4 AND NOT {_UPKEEP} AND n_nationkey % 5 <> 4),
ends AS (SELECT r_regionkey AS r, n_nationkey AS e FROM open WHERE k = 2),
inner_nodes AS (SELECT nation, 1 AS depth, region, r_regionkey, n_nationkey FROM open WHERE k <= 2
  UNION ALL SELECT nation, 1, region, r_regionkey, n_nationkey FROM held LEFT JOIN ends ON r = r_regionkey WHERE r_regionkey < 4 AND NOT {_UPKEEP} AND n_nationkey % 5 = 4 AND (e IS NULL OR n_nationkey < e)),
nodes AS (SELECT *, row_number() OVER (ORDER BY depth, a, b) - 1 AS bfs_seq FROM (SELECT * FROM roots UNION ALL SELECT * FROM inner_nodes)),
inside AS (SELECT region AS title, 0 AS pages, count_if(NOT {_UPKEEP}) AS subcategories FROM held GROUP BY region
  UNION ALL SELECT nation, count(c_custkey), 1 FROM held LEFT JOIN customer ON c_nationkey = n_nationkey GROUP BY nation),
scored AS (SELECT *, {_RELEVANCE.replace("t,", "title,")} AS relevance_score FROM nodes JOIN inside USING (title))
SELECT title, depth::INT AS depth, pages::BIGINT AS pages, subcategories::BIGINT AS subcategories, relevance_score, round(relevance_score * 3 + ln(1 + pages) + ln(1 + subcategories) * 0.5::DOUBLE, 3) AS total_score, parent, bfs_seq
FROM scored WHERE bfs_seq < 10"""
)
def discover_bfs(spark, sf_dir):
    """Ten categories from four regions, two open ones of each."""
    pages, members = atlas(spark, sf_dir)
    roots = [r.r_name for r in spark.read.parquet(f"{sf_dir}/region.parquet").where("r_regionkey < 4").orderBy("r_regionkey").collect()]
    return graph.discover(pages, members, roots, max_depth=1, max_children=2, max_nodes=10)


@query(
    f"""WITH {_HELD},
asked AS (SELECT n_nationkey AS pos, n_name AS category, nation, concat('{_AR}', n_name) AS requested_title FROM held),
known AS (SELECT *, requested_title = nation AS "exists" FROM asked),
inside AS (SELECT c_nationkey, count(*) AS pages FROM customer GROUP BY 1)
SELECT pos, category, requested_title, "exists", CASE WHEN "exists" THEN nation END AS resolved_title, FALSE AS is_redirect, CASE WHEN "exists" THEN coalesce(pages, 0) ELSE 0 END::BIGINT AS pages, CASE WHEN "exists" THEN 1 ELSE 0 END::BIGINT AS subcategories, 0::BIGINT AS maintenance_pages_skipped,
CASE WHEN NOT "exists" THEN nation END AS suggested_replacement,
CASE WHEN NOT "exists" THEN 'Category page does not exist on ar.wikipedia.org' WHEN coalesce(pages, 0) < 5 THEN concat('Very few direct pages (', coalesce(pages, 0), ') — likely too narrow as a standalone seed') ELSE '' END AS notes
FROM known LEFT JOIN inside ON c_nationkey = pos"""
)
def seed_audit(spark, sf_dir):
    """Every nation as a seed; those whose category has another name are missing, and its name replaces theirs."""
    pages, members = atlas(spark, sf_dir)
    seeds = spark.read.parquet(f"{sf_dir}/nation.parquet").select(F.col("n_nationkey").alias("pos"), F.col("n_name").alias("seed"))
    return graph.audit_seeds(seeds, pages, members, pages.select("title"))


SEED_ROWS = [(0, "فلسطين"), (1, "لا شيء"), (2, "فارغ"), (3, "تراث فلسطيني"), (4, "تراث_قديم")]


@query(
    """SELECT * FROM (VALUES (0, 'فلسطين', TRUE, 2::BIGINT, 2::BIGINT, 1::BIGINT, NULL, 'Very few direct pages (2) — likely too narrow as a standalone seed'),
(1, 'لا شيء', FALSE, 0, 0, 0, NULL, 'Category page does not exist on ar.wikipedia.org'), (2, 'فارغ', TRUE, 0, 0, 0, 'تصنيف:فارغ', 'Category exists but is empty (no pages, no subcategories)'),
(3, 'تراث فلسطيني', TRUE, 3, 1, 0, NULL, 'Very few direct pages (3) — likely too narrow as a standalone seed'), (4, 'تراث_قديم', FALSE, 0, 0, 0, 'تصنيف:تراث فلسطيني', 'Category page does not exist on ar.wikipedia.org'))
AS v(pos, category, "exists", pages, subcategories, maintenance_pages_skipped, suggested_replacement, notes)"""
)
def seed_audit_cases(spark, sf_dir):
    pages, members = wiki(spark)
    audit = graph.audit_seeds(literal(spark, SEED_ROWS, "pos int, seed string"), pages, members, pages.select("title"))
    return audit.select("pos", "category", "exists", "pages", "subcategories", "maintenance_pages_skipped", "suggested_replacement", "notes")


@query(f"WITH {_HELD}, known AS (SELECT n_nationkey, concat('{_AR}', n_name) = nation AS there FROM held) SELECT count_if(NOT there)::BIGINT AS bad, count(*) AS total FROM known")
def missing_seeds(spark, sf_dir):
    pages, members = atlas(spark, sf_dir)
    seeds = spark.read.parquet(f"{sf_dir}/nation.parquet").select(F.col("n_nationkey").alias("pos"), F.col("n_name").alias("seed"))
    return graph.missing_or_empty(graph.audit_seeds(seeds, pages, members))


# --- entities ---

WORDS = ["المسخن", "والمقلوبة", "بالكنافة", "وشماغ", "الدبكة", "السامر", "الزغاريد", "نابلس", "والخليل", "كوفية", "و", "وب", "أرجيلة"]
_WORDS = values(list(enumerate(WORDS)), "id", "w")
_FORM = "CASE WHEN w IN (SELECT f FROM dict) THEN w " + " ".join(f"WHEN starts_with(w, '{p}') AND length(w) > {len(p) + 1} AND substring(w, {len(p) + 1}) IN (SELECT f FROM dict) THEN substring(w, {len(p) + 1})" for p in entities.PREFIXES) + " ELSE w END"


@query(
    f"""WITH dict AS {values(list(entities.DICTIONARY.items()), 'f', 'label')}, n AS (SELECT id, w, {_FORM} AS form FROM {_WORDS})
SELECT id, form, label, CASE WHEN starts_with(w, 'و') AND length(w) > 2 THEN substring(w, 2) ELSE w END AS bare FROM n LEFT JOIN dict ON f = form"""
)
def heritage_tokens(spark, sf_dir):
    w = F.col("w")
    df = literal(spark, list(enumerate(WORDS)), "id int, w string")
    return df.select("id", entities.normalize_token(w).alias("form"), F.try_element_at(entities._map(entities.DICTIONARY), entities.normalize_token(w)).alias("label"), entities.strip_conjunction(w).alias("bare"))


_TRIM = f"regexp_replace(regexp_replace(s, '^{text.WS}+', ''), '{text.WS}+$', '')"


@query(
    f"SELECT doc_id, array_to_string(list_filter(list_transform(regexp_split_to_array(replace(text, chr(10), '. '), '{entities.SENTENCE_ENDS}'), lambda s: {_TRIM}), lambda s: len(regexp_extract_all(s, '{text.NOT_WS}+')) >= 3), chr(10)) AS sentences FROM documents"
)
def sentences(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", F.array_join(entities.sentences(F.col("text")), "\n").alias("sentences"))


SPEECH = [
    (1, "لبست جدتي الثوب الفلسطيني المطرز في نابلس."), (2, "أكل محمد المسخن والمقلوبة في بيت أبو علي."), (3, "رقص الشباب الدبكة في السامر بقرية سلواد! غنت النساء الزغاريد فرحا."), (4, "اشترت سارة كوفية وشماغ من سوق القدس."), (5, ""), (6, "قصير جدا"),
]


@query(
    """SELECT * FROM (VALUES (1, 0::BIGINT, ''), (2, 2, 'المسخن/PAL_FOOD|والمقلوبة/PAL_FOOD'), (3, 3, 'الدبكة/PAL_HERITAGE|السامر/PAL_HERITAGE|الزغاريد/PAL_HERITAGE'), (4, 2, 'كوفية/PAL_CLOTHES|وشماغ/PAL_CLOTHES'), (5, 0, ''), (6, 0, '')) AS v(doc_id, n_entities, found)"""
)
def dictionary_entities(spark, sf_dir):
    df = entities.with_entities(literal(spark, SPEECH, "doc_id int, text string"))
    return df.select("doc_id", F.size("entities").cast("bigint").alias("n_entities"), F.array_join(F.transform("entities", lambda e: F.concat_ws("/", e["text"], e["label"])), "|").alias("found"))


_SPOKEN = f"(SELECT doc_id, w FROM documents JOIN {_WORDS} ON id = doc_id % {len(WORDS)})"


@query(f"WITH dict AS {values(list(entities.DICTIONARY.items()), 'f', 'label')}, n AS (SELECT doc_id, {_FORM} AS form FROM {_SPOKEN}) SELECT doc_id, count(label)::BIGINT AS n_entities, coalesce(any_value(label), '') AS label FROM n LEFT JOIN dict ON f = form GROUP BY doc_id")
def entity_counts(spark, sf_dir):
    """Each document with a sentence more, which says one of the words."""
    said = F.concat(F.coalesce("text", F.lit("")), F.lit(".\nكان هناك "), F.element_at(F.array(*map(F.lit, WORDS)), (F.col("doc_id") % len(WORDS) + 1).cast("int")), F.lit(" هنا"))
    found = entities.entity_counts(entities.with_entities(table(spark, sf_dir, "documents").withColumn("text", said)))
    return found.select("doc_id", "n_entities", F.coalesce(F.get("first_entities", F.lit(0))["label"], F.lit("")).alias("label"))


@query(f"WITH dict AS {values(list(entities.DICTIONARY.items()), 'f', 'label')}, n AS (SELECT doc_id, {_FORM} AS form FROM {_SPOKEN}) SELECT doc_id, (CASE WHEN doc_id < 100 THEN count(label) ELSE 0 END)::BIGINT AS n_entities FROM n LEFT JOIN dict ON f = form GROUP BY doc_id")
def entity_corpus(spark, sf_dir):
    """A Parquet corpus tagged by the whole run, which writes all documents and gives entities to the first hundred: its limit is what is looked at."""
    path = _folder(spark, "corpus")
    said = F.concat(F.lit("كان هناك "), F.element_at(F.array(*map(F.lit, WORDS)), (F.col("doc_id") % len(WORDS) + 1).cast("int")), F.lit(" هنا"))
    table(spark, sf_dir, "documents").withColumn("text", said).write.parquet(f"{path}/in")
    return run.tag(spark, f"{path}/in", f"{path}/out", limit=100, order="doc_id").select("doc_id", "n_entities")


def capitals(sentences: list[list[str]]) -> list[list[str]]:
    """A tagger: tokens that begin with A-Z begin an entity, digits go on with it."""
    return [["B-UP" if "A" <= w[0] <= "Z" else "I-UP" if w.isascii() and w.isdigit() else "O" for w in words] for words in sentences]


@query(
    f"""WITH s AS (SELECT doc_id, generate_subscripts(ss, 1) AS k, unnest(ss) AS s FROM (SELECT doc_id, list_filter(list_transform(regexp_split_to_array(replace(text, chr(10), '. '), '{entities.SENTENCE_ENDS}'), lambda s: {_TRIM}), lambda s: len(regexp_extract_all(s, '{text.NOT_WS}+')) >= 3) AS ss FROM documents)),
t AS (SELECT doc_id, k, generate_subscripts(ts, 1) AS p, unnest(ts) AS w FROM (SELECT doc_id, k, regexp_extract_all(s, '{entities.TOKEN}') AS ts FROM s)),
g AS (SELECT *, count_if(NOT regexp_full_match(w, '[0-9]+')) OVER (PARTITION BY doc_id, k ORDER BY p) AS run FROM t),
e AS (SELECT doc_id, k, min(p) AS p, string_agg(w, ' ' ORDER BY p) AS entity FROM g GROUP BY doc_id, k, run HAVING regexp_matches(first(w ORDER BY p), '^[A-Z]'))
SELECT d.doc_id, count(entity) AS n_entities, md5(coalesce(string_agg(entity, '|' ORDER BY k, p), '')) AS digest FROM documents d LEFT JOIN e ON d.doc_id = e.doc_id GROUP BY d.doc_id"""
)
def tagged_entities(spark, sf_dir):
    """All documents through a tagger that is plugged in."""
    docs = entities.with_entities(table(spark, sf_dir, "documents"), capitals)
    return docs.select("doc_id", F.size("entities").cast("bigint").alias("n_entities"), F.md5(F.array_join(F.col("entities")["text"], "|").cast("binary")).alias("digest"))


TAGGED = [
    (1, ["محمد", "علي", "والخليل", "كوفية"], ["B-PERS", "I-PERS", "B-LOC", "O"]), (2, ["محمد", "علي", "والخليل", "اليوم", "كوفية"], ["B-PERS", "I-PERS", "B-LOC", "O", "O"]),
    (3, ["وسعيد", "في"], ["B-PERS", "I-LOC"]), (4, [], []), (5, ["من"], ["I-PERS"]),
]


@query(
    """SELECT * FROM (VALUES (1, 'كوفية/PAL_CLOTHES/heritage_dict|محمد علي/PERS/camel_ner|والخليل/LOC/camel_ner'), (2, 'كوفية/PAL_CLOTHES/heritage_dict|محمد علي/PERS/camel_ner|الخليل/LOC/camel_ner'),
(3, 'سعيد في/PERS/camel_ner'), (4, ''), (5, '')) AS v(id, found)"""
)
def bio_merge(spark, sf_dir):
    df = entities.bio_merge(literal(spark, TAGGED, "id int, words array<string>, tags array<string>"), "words", "tags")
    return df.select("id", F.array_join(F.transform("entities", lambda e: F.concat_ws("/", e["text"], e["label"], e["source"])), "|").alias("found"))
