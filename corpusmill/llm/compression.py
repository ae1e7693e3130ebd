"""A quality classifier by compression: zstandard dictionaries of good and of bad labelled texts compress a text, and the difference of the sizes, calibrated, is its score.

A text is compressed in pieces, each by itself: over a long stretch a compressor learns the text and forgets the dictionary.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Labelled rows of each class that a model is fitted on, characters of such a text at most, and of all of a class; half of them build the dictionary, half calibrate.
TRAIN_ROWS, TRAIN_CHARS, TRAIN_TOTAL = 3000, 50_000, 16_000_000
DICTIONARY_BYTES, LEVEL = 112 << 10, 3
#: Bytes of a text that are compressed by themselves.
PIECE = 1200
#: Scores from here on count as label 1.
LIMIT = 0.3


def held_out(doc_id):
    """Whether a row is kept from training: the crc32 of its id as text leaves no remainder by 5."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0


@dataclass(frozen=True)
class Model:
    good: bytes
    bad: bytes
    weights: tuple[float, ...]

    def score(self, text: str | None) -> float:
        return float(1 / (1 + np.exp(-np.clip(np.dot(self.weights, _features(self.good, self.bad, text)), -40, 40))))


@lru_cache(4)
def _compressors(good: bytes, bad: bytes):
    import zstandard as z

    def one(content):
        if not content:
            return z.ZstdCompressor(level=LEVEL, write_content_size=False, write_dict_id=False)
        data = z.ZstdCompressionDict(content)
        data.precompute_compress(level=LEVEL)
        return z.ZstdCompressor(dict_data=data, write_content_size=False, write_dict_id=False)

    return one(good), one(bad)


def _features(good: bytes, bad: bytes, text: str | None) -> np.ndarray:
    """A constant, and how much larger the bad dictionary leaves the text than the good one: over both sizes, over the text's, over the root of the text's."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    with_good, with_bad = (sum(len(c.compress(raw[k : k + PIECE])) for k in range(0, max(1, len(raw)), PIECE)) for c in _compressors(good, bad))
    n, more = max(1, len(raw)), with_bad - with_good
    return np.array([1.0, more / (with_bad + with_good), more / n, more / np.sqrt(n) / 10])


def _dictionary(texts: list[bytes], size: int) -> bytes:
    """A trained dictionary; where there is too little text to train one, the text itself."""
    import zstandard as z

    try:
        return z.train_dictionary(size, texts, level=LEVEL).as_bytes()
    except z.ZstdError:
        return b"".join(texts)[-size:]


def _logistic(x: np.ndarray, y: np.ndarray, rounds: int = 50, ridge: float = 1e-2) -> np.ndarray:
    """Weights by Newton's method."""
    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -40, 40)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w)), x.T @ (y - p) - ridge * w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w


def fit(rows: list[tuple[str | None, int]]) -> Model:
    """A model of (text, label 0 or 1) rows, every other of each class for its dictionary. Without one of the classes every score is the share of label 1, and 0.5 without rows."""
    by_label = {y: [t or "" for t, label in rows if label == y] for y in (0, 1)}
    parts = {y: [t.encode("utf-8", "surrogatepass") for t in x[::2] if t] for y, x in by_label.items()}
    good, bad = (_dictionary(parts[y], DICTIONARY_BYTES) if parts[y] else b"" for y in (1, 0))
    rest = [(t, y) for y, x in by_label.items() for t in x[1::2]]
    if not all(any(y == k for _, y in rest) for k in (0, 1)):
        share = (len(by_label[1]) + 0.5) / (len(rows) + 1)
        return Model(good, bad, (float(np.log(share / (1 - share))), 0.0, 0.0, 0.0))
    x = np.array([_features(good, bad, t) for t, _ in rest])
    return Model(good, bad, tuple(_logistic(x, np.array([y for _, y in rest], float)).tolist()))


def training_rows(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS, chars: int = TRAIN_CHARS, total: int = TRAIN_TOTAL) -> list[tuple[str | None, int]]:
    """(text, quality) of at most `rows` rows of at most `chars` characters, and about `total` of them, of each class; none held out, chosen by a hash of doc_id."""
    out: list[tuple[str | None, int]] = []
    able = labels.where(~held_out(F.col("doc_id"))).select("doc_id", "quality")
    for label in (0, 1):
        chosen = able.where(F.col("quality") == label).select("doc_id").distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
        size = 0
        # at most `rows` ids are broadcast
        found = docs.select("doc_id", "text").where(F.coalesce(F.length("text"), F.lit(0)) <= chars).join(F.broadcast(chosen), "doc_id").select("doc_id", "text").orderBy(F.xxhash64("doc_id"), "doc_id", "text").limit(rows)
        for row in found.toLocalIterator():
            size += len(row.text or "")
            if size > total:
                break
            out.append((row.text, label))
    return out


def classify(docs: DataFrame, model: Model, limit: float = LIMIT) -> DataFrame:
    """doc_id, held_out, score, predicted; a row for each row of docs (doc_id, text), other columns ignored.

    The score depends on the text alone; a null text is empty and gets the score of one. A null doc_id is not held out.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = [shared.value.score(t.as_py()) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores, pa.float64()), pa.array([int(s >= limit) for s in scores], pa.int32())], ["doc_id", "score", "predicted"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    out = docs.select("doc_id", "text").mapInArrow(score, f"doc_id {kind}, score double, predicted int")
    return out.select("doc_id", F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"), "score", "predicted")


def quality_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """classify() with a model fitted on the labels (doc_id, quality) that are not held out."""
    return classify(docs, fit(training_rows(docs, labels)))
