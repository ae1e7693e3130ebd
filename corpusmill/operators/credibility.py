"""Credibility of a source by its domain."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions.fields import domain_of, strip_www

# Domain, tier, score.
CREDIBILITY_MAP = (
    ("wikipedia.org", "tier_1", 0.90),
    ("ar.wikipedia.org", "tier_1", 0.90),
    ("en.wikipedia.org", "tier_1", 0.90),
    ("gdeltproject.org", "tier_1", 0.88),
    ("unrwa.org", "tier_1", 0.92),
    ("un.org", "tier_1", 0.93),
    ("semanticscholar.org", "tier_1", 0.91),
    ("hrw.org", "tier_1", 0.88),
    ("amnesty.org", "tier_1", 0.87),
    ("wafa.ps", "tier_2", 0.75),
    ("btselem.org", "tier_2", 0.80),
    ("palestine-studies.org", "tier_2", 0.82),
    ("nakba-archive.org", "tier_2", 0.78),
    ("palestineremembered.com", "tier_2", 0.72),
    ("default", "tier_3", 0.45),
)
DEFAULT_TIER, DEFAULT_SCORE = "tier_3", 0.45
TIERS = ("tier_1", "tier_2", "tier_3", "tier_4")


def entries_of(config: dict) -> tuple[tuple[str, str, float], ...]:
    """Rows of a configured map: values are dicts with tier and score, or bare scores; falsy ones are left out."""
    rows = []
    for name, value in config.items():
        if isinstance(value, dict) and value:
            rows.append((name, str(value.get("tier", DEFAULT_TIER)), float(value.get("score", DEFAULT_SCORE))))
        elif value:
            rows.append((name, DEFAULT_TIER, float(value)))
    bad = [r for r in rows if r[1] not in TIERS]
    if bad:
        raise ValueError(f"no such credibility tier: {bad[0]}")
    return tuple(rows)


def credibility(url: Column, entries: tuple[tuple[str, str, float], ...] = CREDIBILITY_MAP) -> Column:
    """struct(tier, score): of the URL's domain, else of it without www., else of the entry default, else the defaults.

    The map is configuration, a literal in the plan, so no join or shuffle is needed.
    """
    if not entries:
        return F.struct(F.lit(DEFAULT_TIER).alias("tier"), F.lit(DEFAULT_SCORE).alias("score"))
    known = F.create_map(*(x for name, tier, score in entries for x in (F.lit(name), F.struct(F.lit(tier).alias("tier"), F.lit(score).alias("score")))))
    domain = domain_of(url)
    get = lambda key: F.try_element_at(known, key)
    fallback = F.struct(F.lit(DEFAULT_TIER).alias("tier"), F.lit(DEFAULT_SCORE).alias("score"))
    return F.coalesce(get(domain), get(strip_www(domain)), get(F.lit("default")), fallback)
