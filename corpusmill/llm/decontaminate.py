"""Benchmark decontamination by Wu-Manber search over words.

The alphabet is words, a block is two of them. For windows of m words, the shift table says how far the search
may jump when it sees a block: m - 1 where no window has it, else its least distance from a window's end. At
distance 0 the block's bucket holds the windows that end with it, by their first word; those are compared word by word.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .kit import free_names

WINDOW = 10
#: Text of the benchmark whose tables go to the workers at once; a larger benchmark takes another pass for each block.
BLOCK_BYTES = 1 << 20
#: A-Z in lower case; every byte that no word has becomes a space.
_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(_BYTES).split()


class Searcher:
    """Finds windows of one length."""

    def __init__(self, length: int, patterns: dict[tuple[bytes, ...], list[str]]):
        self.length, self.block = length, min(2, length)
        self.far = length - self.block + 1
        self.shift: dict[bytes, int] = {}
        self.buckets: dict[bytes, dict[bytes, list[tuple[list[bytes], list[str]]]]] = {}
        for window, items in patterns.items():
            for end in range(self.block, length + 1):
                key = b" ".join(window[end - self.block : end])
                self.shift[key] = min(self.shift.get(key, self.far), length - end)
            self.buckets.setdefault(key, {}).setdefault(window[0], []).append((list(window), items))

    def find(self, words: list[bytes]) -> Iterator[tuple[int, list[str]]]:
        """(first word's position, items) of each occurrence."""
        length, shift, far, at, n = self.length, self.shift.get, self.far, self.length - 1, len(words)
        two = self.block == 2
        while at < n:
            key = words[at - 1] + b" " + words[at] if two else words[at]
            step = shift(key, far)
            if step:
                at += step
                continue
            first = at - length + 1
            for window, items in self.buckets[key].get(words[first], ()):
                if words[first : at + 1] == window:
                    yield first, items
            at += 1


def searchers(items: list[tuple[str, str]]) -> list[Searcher]:
    """One for each window length that (item_id, text) rows have."""
    by_length: dict[int, dict[tuple[bytes, ...], list[str]]] = {}
    for item, text in items:
        words = words_of(text)
        length = min(WINDOW, len(words))
        for k in range(len(words) - length + 1 if length else 0):
            known = by_length.setdefault(length, {}).setdefault(tuple(words[k : k + length]), [])
            if item not in known:
                known.append(item)
    return [Searcher(length, x) for length, x in sorted(by_length.items())]


@lru_cache(1)
def _tables(block) -> list[Searcher]:
    return searchers(block.value)


def blocks_of(bench: DataFrame, most: int = BLOCK_BYTES) -> Iterator[list[tuple[str, str]]]:
    """The benchmark's rows in lists of at most `most` bytes of text, at least one row each; the driver holds one list at a time."""
    block, size = [], 0
    for item, text in bench.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")), "text").where("text is not null").toLocalIterator():
        if block and size + len(text) > most:
            yield block
            block, size = [], 0
        block.append((item, text))
        size += len(text)
    yield block


def scanned(docs: DataFrame, bench: DataFrame, block_bytes: int = BLOCK_BYTES) -> tuple[DataFrame, tuple[str, str, str]]:
    """(docs with three columns more, their names, which docs does not have): number of words, hit words (packed bits, null for none), ids of items with occurrences."""
    names = free_names(docs.columns, "words", "hit", "items")
    out = docs.withColumns({names[0]: F.lit(0).cast("long"), names[1]: F.lit(None).cast("binary"), names[2]: F.array().cast("array<string>")})
    columns = out.columns
    text_at, words_at, hit_at, items_at = (columns.index(c) for c in ("text", *names))
    for block in blocks_of(bench, block_bytes):
        shared = docs.sparkSession.sparkContext.broadcast(block)

        def scan(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            tables = _tables(shared)
            for batch in batches:
                counts, hits, found = [], [], []
                for text, before, known in zip(batch.column(text_at), batch.column(hit_at), batch.column(items_at), strict=True):
                    words, marks, items = words_of(text.as_py()), None, set(known.as_py())
                    for table in tables:
                        for first, names in table.find(words):
                            if marks is None:
                                marks = np.zeros(len(words), bool)
                            marks[first : first + table.length] = True
                            items.update(names)
                    old = before.as_py()
                    if marks is not None and old is not None:
                        marks |= np.unpackbits(np.frombuffer(old, np.uint8), count=len(words)).astype(bool)
                    counts.append(len(words))
                    hits.append(np.packbits(marks).tobytes() if marks is not None else old)
                    found.append(sorted(items))
                arrays = list(batch.columns)
                arrays[words_at], arrays[hit_at], arrays[items_at] = pa.array(counts, pa.int64()), pa.array(hits, pa.binary()), pa.array(found, pa.list_(pa.string()))
                yield pa.RecordBatch.from_arrays(arrays, columns)

        out = out.mapInArrow(scan, out.schema)
    return out, tuple(names)


def contamination(docs: DataFrame, bench: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated; a row for each row of docs (doc_id, text).

    bench: item_id, text. Null or empty texts have no words; rows of one item_id are one item, a null item_id
    counts as ''. Without items nothing is contaminated. Other columns are ignored.
    """
    found = scanned(docs.select("doc_id", "text"), bench, block_bytes)[0].drop("text")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hits = [int(np.bitwise_count(np.frombuffer(x, np.uint8)).sum()) if x else 0 for x in batch.column(2).to_pylist()]
            items = batch.column(3).to_pylist()
            digests = [hashlib.sha256(",".join(x).encode()).hexdigest() for x in items]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(hits, pa.int64()), pa.array(map(len, items), pa.int64()), pa.array(digests, pa.string()), pa.array([x > 0 for x in hits], pa.bool_())], ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return found.mapInArrow(count, f"doc_id {kind}, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean")


def decontaminate(docs: DataFrame, bench: DataFrame) -> DataFrame:
    """The rows of docs in which no window of the benchmark occurs, all their columns as they are."""
    found, names = scanned(docs, bench)
    return found.where(F.col(names[1]).isNull()).drop(*names)


ORACLE = r"""
WITH words AS (
  SELECT 'd' AS kind, doc_id::VARCHAR AS id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
  UNION ALL
  SELECT 'b', item_id::VARCHAR, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') FROM benchmark),
items AS (SELECT DISTINCT id AS item, n, array_to_string(w[p:p + n - 1], ' ') AS g
          FROM (SELECT id, w, least(10, len(w)) AS n, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS p FROM words WHERE kind = 'b' AND len(w) > 0)),
places AS (SELECT id, p, n, array_to_string(w[p:p + n - 1], ' ') AS g
           FROM (SELECT id, w, n, unnest(range(1, len(w) - n + 2)) AS p FROM words, (SELECT DISTINCT n FROM items) WHERE kind = 'd' AND len(w) >= n)),
found AS (SELECT id, item, p, n FROM places JOIN items USING (n, g)),
hit AS (SELECT id, count(DISTINCT q) AS n_hit FROM (SELECT id, unnest(range(p, p + n)) AS q FROM found) GROUP BY id),
named AS (SELECT id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names FROM (SELECT DISTINCT id, item FROM found) GROUP BY id)
SELECT id::BIGINT AS doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM words LEFT JOIN hit USING (id) LEFT JOIN named USING (id) WHERE kind = 'd'
"""
