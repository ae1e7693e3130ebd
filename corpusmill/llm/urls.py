"""URL filters: prefix rules of hosts and paths, and pattern rules indexed by their rarest literal token."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Host, path, verdict.
PREFIX_RULES = (
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
)


@dataclass(frozen=True)
class Pattern:
    """Blocks a URL (A-Z lower-cased) in which a regular expression is found.

    tokens are runs of [a-z0-9] that every URL the expression is found in holds as whole tokens, so that the rule may be
    filed under any of them; an expression with alternatives of other tokens is several patterns. Without tokens it is
    tried on every URL.
    """

    tokens: tuple[str, ...]
    expression: str


def in_host(*phrases: str) -> list[Pattern]:
    """A pattern for each phrase (tokens with characters between them), which must stand in the host between ends of tokens."""
    return [Pattern(tuple(TOKEN.findall(x)), rf"://(?:[^/?#]*[^a-z0-9/?#])?{re.escape(x)}(?:[^a-z0-9]|$)") for x in phrases]


TOKEN = re.compile("[a-z0-9]+")
PATTERNS = (
    *in_host("adult", "casino", "escort", "gambling", "malware", "phishing", "poker", "porn", "roulette", "slots", "spam", "warez", "xxx"),
    *in_host("ads-track", "ad-server", "adserver", "free-bet", "free-bets", "sports-bet", "sports-bets", "cheap-pill", "cheap-pills"),
    Pattern(("doubleclick", "net"), r"://(?:[^/?#]*[^a-z0-9/?#])?doubleclick\.net(?:[^a-z0-9.-]|$)"),
    Pattern(("buy", "viagra"), r"(?:^|[^a-z0-9])buy-viagra(?:[^a-z0-9]|$)"),
    Pattern(("banner", "click"), r"/banner/click(?:[^a-z0-9]|$)"),
)


def ascii_lower(column):
    return F.translate(column, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def rarity(urls: DataFrame, patterns: tuple[Pattern, ...] = PATTERNS) -> dict[str, int]:
    """In how many URLs of the whole table each token of the patterns stands; a row for each token reaches the driver."""
    literals = sorted({t for p in patterns for t in p.tokens})
    tokens = F.array_distinct(F.regexp_extract_all(ascii_lower(F.col("url")), F.lit("[a-z0-9]+"), F.lit(0)))
    found = urls.select(F.explode(F.array_intersect(tokens, F.array(*map(F.lit, literals)))).alias("token")).groupBy("token").count()
    return dict.fromkeys(literals, 0) | dict(map(tuple, found.collect()))


def index_of(patterns: tuple[Pattern, ...], counts: dict[str, int]) -> dict[str, list[re.Pattern]]:
    """Patterns under the one of their tokens that is rarest in the table (the first by name among equals); under "" those without."""
    index: dict[str, list[re.Pattern]] = {}
    for p in patterns:
        index.setdefault(min(p.tokens, key=lambda t: (counts.get(t, 0), t), default=""), []).append(re.compile(p.expression, re.ASCII))
    return index


def found_in(url: str, index: dict[str, list[re.Pattern]]) -> bool:
    """Whether one of the indexed patterns is found in a URL with A-Z lower-cased; only those under its tokens are tried."""
    return any(p.search(url) for t in {"", *TOKEN.findall(url)} for p in index.get(t, ()))


def split(url: str | None) -> tuple[str, str]:
    """(host, path): host after the first :// with A-Z in lower case; both empty without one."""
    rest = (url or "").partition("://")[2]
    host = re.match("[^/?#]*", rest)[0]
    path = re.match("[^?#]*", rest[len(host) :])[0]
    return re.sub("[A-Z]+", lambda m: m[0].lower(), host), path


def url_verdicts(pages: DataFrame, patterns: tuple[Pattern, ...] = PATTERNS, prefixes=PREFIX_RULES) -> DataFrame:
    """page_id, host, path, rule, verdict; a row for each row of pages (page_id, url), other columns ignored.

    rule is the longest prefix rule that fits, host and path joined, and gives the verdict; without one, rule is
    null and the verdict is block if a pattern is found, else allow. A null or odd URL has an empty host and
    path, fits no rule and is allowed unless a pattern is found in it. A row's verdict depends on its own URL alone:
    the table decides only under which token a pattern is filed. Of prefix rules that are equally long, the first wins.
    """
    index = index_of(patterns, rarity(pages, patterns))
    by_host: dict[str, list[tuple[str, str]]] = {}
    for host, path, says in prefixes:
        by_host.setdefault(host, []).append((path, says))

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
        for batch in batches:
            rows = []
            for url in batch.column(1).to_pylist():
                host, path = split(url)
                fits = []
                parts = host.split(".")
                for k in range(len(parts)):
                    suffix = ".".join(parts[k:])
                    fits += [(suffix + p, says) for p, says in by_host.get(suffix, ()) if path.startswith(p)]
                rule, verdict = max(fits, key=lambda x: len(x[0]), default=(None, None))
                if rule is None:
                    verdict = "block" if found_in((url or "").translate(lower), index) else "allow"
                rows.append((host, path, rule, verdict))
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array([r[k] for r in rows], pa.string()) for k in range(4))], ["page_id", "host", "path", "rule", "verdict"])

    kind = pages.schema["page_id"].dataType.simpleString()
    return pages.select("page_id", "url").mapInArrow(judge, f"page_id {kind}, host string, path string, rule string, verdict string")


def _oracle() -> str:
    longest = sorted(PREFIX_RULES, key=lambda r: -len(r[0] + r[1]))
    fits = [(f"(host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}')", h + p, v) for h, p, v in longest]
    found = " OR ".join(f"regexp_matches(small, '{p.expression}')" for p in PATTERNS)
    return rf"""
WITH u AS (SELECT page_id, coalesce(url, '') AS url FROM pages),
s AS (SELECT page_id, translate(url, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS small,
             translate(regexp_extract(url, '://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
             regexp_extract(url, '://[^/?#]*([^?#]*)', 1) AS path FROM u),
r AS (SELECT *, CASE {' '.join(f"WHEN {t} THEN '{name}'" for t, name, _ in fits)} END AS rule FROM s)
SELECT page_id, host, path, rule, CASE {' '.join(f"WHEN rule = '{name}' THEN '{v}'" for _, name, v in fits)} WHEN {found} THEN 'block' ELSE 'allow' END AS verdict FROM r
"""


ORACLE = _oracle()
