"""The classifier restated plainly: which rows it learns from, what a score is, how well it tells held-out rows apart."""

import math
import zlib

import numpy as np
import pandas as pd
import zstandard

from corpusmill.llm import compression
from corpusmill.llm.queries import op8_quality_classifier, table

SF = "/root/testdata/sf0.01"


def sizes(text, dictionary):
    """Bytes of a text's pieces, each compressed with the dictionary."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    pieces = [raw[k : k + 1200] for k in range(0, len(raw), 1200)] or [b""]
    coder = zstandard.ZstdCompressor(level=3, dict_data=zstandard.ZstdCompressionDict(dictionary), write_content_size=False, write_dict_id=False)
    return sum(len(coder.compress(x)) for x in pieces)


def plain_score(model, text):
    good, bad = sizes(text, model.good), sizes(text, model.bad)
    n = max(1, len((text or "").encode("utf-8", "surrogatepass")))
    x = [1, (bad - good) / (bad + good), (bad - good) / n, (bad - good) / math.sqrt(n) / 10]
    return 1 / (1 + math.exp(-sum(w * v for w, v in zip(model.weights, x, strict=True))))


def test_scores_like_plain(spark):
    docs = pd.read_parquet(f"{SF}/documents.parquet")
    labels = pd.read_parquet(f"{SF}/labels.parquet")
    quality = dict(zip(labels.doc_id, labels.quality, strict=True))
    held = {k for k in docs.doc_id if zlib.crc32(str(k).encode()) % 5 == 0}
    rows = compression.training_rows(table(spark, SF, "documents"), table(spark, SF, "labels"))
    able = sorted((t, quality[k]) for k, t in zip(docs.doc_id, docs.text, strict=True) if k in quality and k not in held and len(t) <= compression.TRAIN_CHARS)
    assert sorted(rows) == able  # all that may be learnt from, and nothing held out
    model = compression.fit(rows)
    found = {r.doc_id: r for r in op8_quality_classifier(spark, SF).collect()}
    for k, text in zip(docs.doc_id[:300], docs.text[:300], strict=True):
        assert abs(found[k].score - plain_score(model, text)) < 1e-9
        assert found[k].held_out == (k in held) and found[k].predicted == (found[k].score >= 0.3)
    told = [(found[k].score, quality[k]) for k in held & quality.keys()]
    good, bad = np.array([s for s, q in told if q]), np.array([s for s, q in told if not q])
    assert (good[:, None] > bad[None, :]).mean() > 0.98 and (good >= 0.3).mean() > 0.98


def test_calibration_is_logistic():
    """The weights are where the penalised likelihood has no slope."""
    rng = np.random.default_rng(1)
    x = np.column_stack([np.ones(400), rng.normal(size=(400, 2))])
    y = (rng.random(400) < 1 / (1 + np.exp(-(x @ [0.5, 2, -1])))).astype(float)
    w = compression._logistic(x, y)
    assert np.abs(x.T @ (y - 1 / (1 + np.exp(-(x @ w)))) - 1e-2 * w).max() < 1e-4


def test_ties_and_one_class():
    same = compression.fit([("same text of both kinds", 1), ("same text of both kinds", 0)] * 10)
    assert same.score("same text of both kinds") == same.score("same text of both kinds") and abs(same.score("same text of both kinds") - 0.5) < 0.05
    one = compression.fit([("only good", 1)] * 9)
    assert abs(one.score("only good") - 0.95) < 1e-9 and one.score(None) == one.score("only good")
