"""Columns derived for documents: identity, URLs, titles, dates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Prefixes of category titles by language.
CATEGORY_PREFIXES = {"ar": "تصنيف:", "en": "Category:"}


def make_doc_id(url: Column, text: Column) -> Column:
    """SHA-256 of the URL (null: empty) and the first 200 characters of the cleaned text."""
    return F.sha2(F.concat(F.coalesce(url, F.lit("")), F.substring(text, 1, 200)), 256)


def domain_of(url: Column) -> Column:
    """Network location in lower case, with user and port; without one, the path; empty for null or empty."""
    url = F.coalesce(url, F.lit(""))
    location = F.regexp_extract(url, r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//([^/?#]*)", 1)
    path = F.regexp_extract(url, r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?(?://[^/?#]*)?([^?#]*)", 1)
    return F.lower(F.when(location != "", location).otherwise(path))


def strip_www(domain: Column) -> Column:
    return F.regexp_replace(domain, r"^www\.", "")


def quoted(text: Column) -> Column:
    """Percent-encoding of UTF-8 in which letters, digits and _.-~/ stay."""
    out = F.url_encode(text)
    for found, meant in (("+", "%20"), ("%2F", "/"), ("%7E", "~"), ("*", "%2A")):
        out = F.replace(out, F.lit(found), F.lit(meant))
    return out


def page_url(full_url: Column, title: Column, language: str = "ar") -> Column:
    made = F.concat(F.lit(f"https://{language}.wikipedia.org/wiki/"), quoted(F.replace(F.coalesce(title, F.lit("")), F.lit(" "), F.lit("_"))))
    return F.coalesce(F.nullif(full_url, F.lit("")), made)


def category_title(name: Column, language: str = "ar") -> Column:
    prefix = CATEGORY_PREFIXES.get(language, "Category:")
    return F.when(name.startswith(prefix), name).otherwise(F.concat(F.lit(prefix), name))


def optional_int(*values: Column) -> Column:
    """The first value that is not null, as a long; null if that one is no integer."""
    return F.coalesce(*(v.cast("string") for v in values)).try_cast("bigint")


def decade(given: Column, published: Column) -> Column:
    """The decade given or of the publication date, floored to ten."""
    return F.coalesce((F.floor(given / 10) * 10).cast("int"), (F.floor(F.year(published) / 10) * 10).cast("int"))


def iso_timestamp(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX")
