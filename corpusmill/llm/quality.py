"""Quality rules as a short-circuit cascade: costs and rejections are estimated on a sample, rules run in the order of rejections per cost."""

from __future__ import annotations

import re
import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .kit import hashed_words, window_hashes

WINDOW = 5
SYMBOLS = "#*$%&|<>"
SPACES = "\t\n\x0b\x0c\r "
#: Rows that costs and rejections are estimated on; they decide the order of the rules, never a verdict.
SAMPLE_ROWS, SAMPLE_CHARS = 256, 100_000


class Page:
    """What rules ask about one text, computed when first asked for."""

    def __init__(self, text: str | None):
        self.text = text or ""

    @cached_property
    def words(self) -> list[bytes]:
        return self.text.encode("utf-8", "surrogatepass").split()

    @cached_property
    def word_chars(self) -> int:
        return len(self.text) - sum(map(self.text.count, SPACES))

    @cached_property
    def n_symbols(self) -> int:
        return sum(map(self.text.count, SYMBOLS))

    @cached_property
    def lines(self) -> list[str]:
        """Lines with a word."""
        return [x for x in self.text.split("\n") if x.strip(SPACES)]

    @cached_property
    def n_dup_lines(self) -> int:
        return len(self.lines) - len(set(self.lines))

    @cached_property
    def hashes(self) -> np.ndarray:
        return hashed_words(self.words)

    @cached_property
    def n_repeat_words(self) -> int:
        """Words in windows of WINDOW words that occur twice or more, each word once."""
        n = len(self.words)
        if n <= WINDOW:
            return 0
        windows = window_hashes(self.hashes, WINDOW)
        order = np.argsort(windows, kind="stable")
        same = windows[order][1:] == windows[order][:-1]
        if not same.any():
            return 0
        twice = np.zeros(len(windows), bool)
        twice[order[1:][same]] = True
        twice[order[:-1][same]] = True
        steps = np.zeros(n + 1, np.int64)
        at = np.flatnonzero(twice)
        np.add.at(steps, at, 1)
        np.add.at(steps, at + WINDOW, -1)
        return int((np.cumsum(steps)[:n] > 0).sum())

    @cached_property
    def n_stutters(self) -> int:
        """Words equal to the word before."""
        return int((self.hashes[1:] == self.hashes[:-1]).sum())

    @cached_property
    def letters(self) -> tuple[int, int]:
        """A-Z, and A-Z with a-z."""
        large = len(re.findall("[A-Z]", self.text))
        return large, large + len(re.findall("[a-z]", self.text))


@dataclass(frozen=True)
class Rule:
    name: str
    rejects: Callable[[Page], bool]
    #: The same test in SQL over op4's columns and n_lines, n_stutters, n_upper, n_letters.
    sql: str


BASE = (
    Rule("few_words", lambda p: len(p.words) < 10, "n_words < 10"),
    Rule("repeated_windows", lambda p: 100 * p.n_repeat_words > 20 * len(p.words), "100 * n_repeat_words > 20 * n_words"),
)
RULES = (
    *BASE,
    Rule("symbols", lambda p: 10 * p.n_symbols > len(p.words), "10 * n_symbols > n_words"),
    Rule("duplicate_lines", lambda p: 2 * p.n_dup_lines > len(p.lines), "2 * n_dup_lines > n_lines"),
    Rule("word_length", lambda p: not 2 * len(p.words) <= p.word_chars <= 12 * len(p.words), "NOT (word_chars BETWEEN 2 * n_words AND 12 * n_words)"),
    Rule("upper_case", lambda p: 2 * p.letters[0] > p.letters[1], "2 * n_upper > n_letters"),
    Rule("stutters", lambda p: 10 * p.n_stutters > 3 * len(p.words), "10 * n_stutters > 3 * n_words"),
)


def rule_order(docs: DataFrame, rules: tuple[Rule, ...] = RULES, rows: int = SAMPLE_ROWS) -> list[int]:
    """Positions of the rules by rejections per second on a sample of at most rows texts of at most SAMPLE_CHARS characters.

    The sample comes from the first files that fill it and is measured on the driver. Every rule runs on a fresh
    Page, so a cost includes what the rule computes by itself. Equal rules, and all on an empty table, keep their
    order. The order changes speed only: a verdict is the OR of all rules.
    """
    spent, hits = [1e-9] * len(rules), [0] * len(rules)
    short = F.coalesce(F.length("text"), F.lit(0)) <= SAMPLE_CHARS
    for row in docs.select("text").where(short).take(rows):
        for k, rule in enumerate(rules):
            page, began = Page(row.text), time.perf_counter()
            hits[k] += rule.rejects(page)
            spent[k] += time.perf_counter() - began
    return sorted(range(len(rules)), key=lambda k: -hits[k] / spent[k])


def verdict(page: Page, rules: list[Rule]) -> bool:
    """Whether no rule rejects; the first that does ends the cascade."""
    return not any(rule.rejects(page) for rule in rules)


def quality_metrics(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept; a row for each row.

    docs: doc_id, text; other columns are ignored. A null text has no words and fails; repeated rows are judged alike.
    """
    order = [rules[k] for k in rule_order(docs, rules)]
    rest = [rule for rule in order if rule not in BASE]

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text in batch.column(1):
                page = Page(text.as_py())
                failed = any(rule.rejects(page) for rule in BASE)
                rows.append((len(page.words), page.word_chars, page.n_symbols, page.n_dup_lines, page.n_repeat_words, failed, not failed and verdict(page, rest)))
            columns = zip(*rows, strict=True) if rows else [()] * 7
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(x, pa.int64() if k < 5 else pa.bool_()) for k, x in enumerate(columns))], ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(judge, f"doc_id {kind}, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, kept boolean")


def quality_filter(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The rows of docs that no rule rejects, all their columns as they are; rules run in the measured order, each only on what is left."""
    order = [rules[k] for k in rule_order(docs, rules)]
    at = docs.columns.index("text")

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array([verdict(Page(text.as_py()), order) for text in batch.column(at)], pa.bool_()))

    return docs.mapInArrow(keep, docs.schema)


ORACLE = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
w AS (SELECT doc_id, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words,
             list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM d),
windows AS (SELECT doc_id, p, array_to_string(words[p:p + 4], ' ') AS g
            FROM (SELECT doc_id, words, unnest(range(1, len(words) - 3)) AS p FROM w WHERE len(words) >= 5)),
twice AS (SELECT doc_id, p FROM (SELECT doc_id, p, count(*) OVER (PARTITION BY doc_id, g) AS n FROM windows) WHERE n > 1),
covered AS (SELECT doc_id, count(DISTINCT p + k) AS n_repeat_words FROM twice, range(5) AS r(k) GROUP BY doc_id),
m AS (SELECT doc_id, len(words)::BIGINT AS n_words, length(array_to_string(words, ''))::BIGINT AS word_chars,
             length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
             (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words,
             len(lines) AS n_lines, length(regexp_replace(text, '[^A-Z]', '', 'g')) AS n_upper, length(regexp_replace(text, '[^A-Za-z]', '', 'g')) AS n_letters,
             len(list_filter(range(2, len(words) + 1), lambda i: words[i] = words[i - 1])) AS n_stutters
      FROM w LEFT JOIN covered USING (doc_id))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, (BASE) AS base_failed, NOT (ALL) AS kept FROM m
""".replace("BASE", " OR ".join(f"({r.sql})" for r in BASE)).replace("ALL", " OR ".join(f"({r.sql})" for r in RULES))
