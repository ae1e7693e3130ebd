import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

from corpusmill.operators import blocks, dedup
from corpusmill.plans import ingest
from corpusmill.queries import QUERIES


def texts(seed, many):
    """Texts of few syllables, so that long ones are alike, and near and exact copies of some."""
    rng = random.Random(seed)
    syllables = [a + b for a in "bdklmn" for b in "aeiou"]
    found = []
    for _ in range(many):
        if found and rng.random() < 0.4:
            text = list(rng.choice(found))
            for _ in range(rng.choice([1, 3, 9, 30])):
                text[rng.randrange(len(text))] = rng.choice("xyz")
            found.append("".join(text))
        else:
            found.append("".join(rng.choice(syllables) + rng.choice(["", "", " "]) for _ in range(rng.choice([3, 40, 150, 600, 2500]))))
    return [*found, "", "ab", "ab "]


def table(found):
    codes = [dedup.shingle_codes(t) for t in found]
    return codes, pa.table(
        {"seq": pa.array(range(len(found)), pa.int64()), "n": pa.array([len(c) for c in codes], pa.int32()), "codes": pa.array([blocks.pack(c) for c in codes], pa.binary()), "sketch": pa.array([blocks.sketch(c) for c in codes], pa.binary())}
    )


class Sent:
    def __init__(self, value):
        self.value = value


@pytest.mark.parametrize("threshold", [0.8, 0.85, 0.5])
def test_all_pairs(threshold):
    codes, rows = table(texts(1, 300))
    wanted = {(a, b): len(np.intersect1d(x, y)) / len(np.union1d(x, y)) for b, y in enumerate(codes) for a, x in enumerate(codes[:b])}
    found = pa.Table.from_batches(blocks.all_similar(Sent(blocks.Block.of(rows)), threshold)(rows.to_batches(max_chunksize=64)))
    assert {(r["a"], r["b"]): r["similarity"] for r in found.to_pylist()} == {pair: s for pair, s in wanted.items() if s >= threshold}


def test_blocks_like_one(spark, monkeypatch):
    """Many small blocks decide as a search in the order of seq does; no pair that only might be similar is written."""
    docs = texts(2, 160)
    monkeypatch.setattr(blocks, "FIRST_SETS", 8)
    monkeypatch.setattr(blocks, "BLOCK_SETS", 40)
    monkeypatch.setattr(blocks, "BLOCK_MEMBERS", 9000)
    monkeypatch.setattr(dedup, "candidates", None)
    kept, wanted, sets = [], {}, [set(dedup.shingle_codes(t).tolist()) for t in docs]
    for k, own in enumerate(sets):
        first = next((a for a in kept if len(own & sets[a]) / len(own | sets[a]) >= 0.8), None)
        if first is None:
            kept.append(k)
        else:
            wanted[k] = first
    df = spark.createDataFrame([(k, t) for k, t in enumerate(docs)], "seq int, text string")
    assert dict(map(tuple, dedup.duplicates(df).collect())) == wanted
    distinct = {}
    for k, t in enumerate(docs):
        distinct.setdefault(t, k)
    firsts = sorted(distinct.values())
    pairs = {(a, b) for b in firsts for a in firsts if a < b and len(sets[a] & sets[b]) / len(sets[a] | sets[b]) >= 0.8}
    found = dedup.similar_pairs(df.where(df.seq.isin(firsts))).collect()
    assert len(found) == len(pairs) and {(r.a, r.b) for r in found} == pairs


def test_bands_without_pairs(spark, monkeypatch):
    """Many documents of one band are decided by their keys, without their pairs; copies included."""
    monkeypatch.setattr(dedup, "candidates", None)
    docs = texts(4, 120)
    docs += docs[5:40:3]
    kept, wanted = [], {}
    for k, text in enumerate(docs):
        values = dedup.minhash(dedup.shingle_codes(text))[:6].reshape(3, 2)
        near = [name for name, other in kept if (other == values).all(1).any()]
        if near:
            wanted[k] = min(near)
        else:
            kept.append((f"{(k * 37) % 101:03d}-{k}", values))
    df = spark.createDataFrame([(k, f"{(k * 37) % 101:03d}-{k}", t) for k, t in enumerate(docs)], "seq long, doc_id string, text string")
    assert dict(map(tuple, dedup.banded_duplicates(df, 3, 2).collect())) == wanted


@pytest.mark.parametrize("name", ["index_stats", "pipeline_routes", "route_distributions", "run_stats"])
def test_queries_without_candidates(spark, monkeypatch, name):
    monkeypatch.setattr(dedup, "candidates", None)
    assert QUERIES[name](spark, "/root/testdata/sf0.001").count() > 0


def scratch_tables(spark):
    """Names and bytes of the tables that are in the scratch folder."""
    fs = spark._jvm.org.apache.hadoop.fs.Path(dedup.scratch(spark))
    system = fs.getFileSystem(spark._jsc.hadoopConfiguration())
    return {x.getPath().getName(): system.getContentSummary(x.getPath()).getLength() for x in system.listStatus(fs)} if system.exists(fs) else {}


def test_duplicates_leave_only_their_result(spark):
    """Sets, sketches and what rounds write are deleted when index_stats has its duplicates; texts are not shuffled for copies."""
    docs = texts(6, 200)
    df = spark.createDataFrame([(k, t) for k, t in enumerate(docs + docs[:20])], "seq long, text string")
    before = scratch_tables(spark)
    row = dedup.index_stats(df, dedup.duplicates(df)).first()
    left = {k: v for k, v in scratch_tables(spark).items() if k not in before}
    assert row.checked == len(docs) + 20 and row.duplicates >= 20
    assert [k.split("-")[0] for k in left] == ["duplicates"]


@pytest.mark.parametrize("copied", [5, 60])
def test_copies_are_no_sets_of_blocks(spark, monkeypatch, copied):
    """A text and its copies are one set of the blocks, few copies or more than others; canonical ones are those of a search in order."""
    docs = texts(7, 40)
    docs += docs[:20] * (copied // 5)
    monkeypatch.setattr(blocks, "FIRST_SETS", 16)
    sizes, come = [], blocks.first_come
    monkeypatch.setattr(blocks, "first_come", lambda block, threshold: sizes.append(len(block.seq)) or come(block, threshold))
    kept, wanted, sets = [], {}, [set(dedup.shingle_codes(t).tolist()) for t in docs]
    for k, own in enumerate(sets):
        first = next((a for a in kept if len(own & sets[a]) / len(own | sets[a]) >= 0.8), None)
        if first is None:
            kept.append(k)
        else:
            wanted[k] = first
    df = spark.createDataFrame([(k, t) for k, t in enumerate(docs)], "seq long, text string")
    assert dict(map(tuple, dedup.duplicates(df).collect())) == wanted
    assert sum(sizes) <= len(set(docs))


@pytest.mark.parametrize("many", [8, 16, 32, 64])
def test_folded_sketches_never_rule_out(many):
    """A folded sketch is the sketch of as many bits: it differs in no more bits than there are members apart, and in as odd a number."""
    rng = np.random.default_rng(many)
    for n, apart in ((50, 9), (700, 150), (3000, 640)):
        codes = np.unique(rng.integers(0, 2**62, n + apart, dtype=np.uint64))
        a, b = (blocks.folded(np.frombuffer(blocks.sketch(np.sort(x)), np.uint64), many) for x in (codes[apart // 2 :], codes[: len(codes) - (apart - apart // 2)]))
        differ = int(np.bitwise_count(a ^ b).sum())
        assert differ <= apart and differ % 2 == apart % 2 and differ > 0


@pytest.mark.parametrize(("name", "tables"), [("pipeline_routes", ["checked", "duplicates"]), ("run_stats", ["checked", "duplicates"]), ("route_distributions", ["checked", "duplicates", "routed"])])
def test_routes_leave_no_sets(spark, name, tables):
    """Of the tables that routes are made through, those that the result reads stay."""
    before = scratch_tables(spark)
    assert QUERIES[name](spark, "/root/testdata/sf0.001").count() > 0
    assert sorted(k.split("-")[0] for k in scratch_tables(spark) if k not in before) == tables


@pytest.mark.parametrize("name", ["pipeline_routes", "route_distributions", "run_stats"])
def test_routes_write_no_texts(spark, monkeypatch, name):
    """Of the documents that routes are made of only their sets are written, and the columns that the result reads."""
    written, write = [], dedup.shared
    monkeypatch.setattr(dedup, "shared", lambda df, tag: written.append(df.columns) or write(df, tag))
    monkeypatch.setattr(ingest, "shared", dedup.shared)
    before = scratch_tables(spark)
    assert QUERIES[name](spark, "/root/testdata/sf0.001").count() > 0
    left = [spark.read.parquet(f"{dedup.scratch(spark)}/{k}").columns for k in scratch_tables(spark) if k not in before]
    assert written and not {"text", "text_raw"} & {c for columns in written + left for c in columns}
    assert max(map(len, left)) <= 7


def test_routes_of_some_columns(spark):
    """Columns that are asked for are those of the whole result; rejected documents have theirs, and are not compared."""
    docs = [(k, f"d{k}", t * 6) for k, t in enumerate(texts(8, 60))]
    df = spark.createDataFrame(docs + [(100, "d100", docs[3][2]), (101, "d101", "short"), (102, "d102", "short"), (103, "d103", None)], "ingest_seq long, doc_id string, text string")
    df = df.selectExpr("*", "size(split(text, ' ')) AS word_count", "length(text) AS char_count", "'en' AS language", "'tier_1' AS credibility", "'t' AS title", "'u' AS source_url", "'n' AS source_name", "'i' AS source_id", "'other' AS source_type", "ingest_seq % 3 AS seq", "'2026' AS date_collected")
    for columns in (["route", "is_duplicate_of", "doc_id", "errors", "seq"], ["has_duplicate", "ingest_seq"], ["doc_id", "text", "route"]):
        found, wanted = ingest.routed(df, columns=columns), ingest.routed(df).select(columns)
        assert found.columns == columns and found.dtypes == wanted.dtypes
        assert sorted(map(repr, found.collect())) == sorted(map(repr, wanted.collect()))
    assert {r.route for r in found.collect()} == {"accepted", "rejected"} and wanted.count() == len(docs) + 4


def test_packed_sets():
    """Packed sets are small: two thirds of packed differences at most, as texts' sets are what the disk holds; any sorted numbers come back."""
    codes = [dedup.shingle_codes(t) for t in ["", "ab", "تراث فلسطين 😀" * 3, *texts(9, 40)]]
    codes += [np.array([0, 5, 2**63, 2**64 - 1], np.uint64), np.unique(np.random.default_rng(1).integers(0, 2**64, 500, dtype=np.uint64))]
    assert all((blocks.unpack(blocks.pack(c)) == c).all() for c in codes)
    texts_only = codes[3:-2]
    assert sum(len(blocks.pack(c)) for c in texts_only) < 2 / 3 * sum(len(zlib.compress(np.diff(c, prepend=np.uint64(0)).tobytes(), 1)) for c in texts_only)


def test_blocks_deal_nothing_anew(spark, monkeypatch):
    """Which sets make the next block is told without shuffling sets: no exchange has their codes, whatever Spark would broadcast."""
    monkeypatch.setattr(blocks, "FIRST_SETS", 8)
    monkeypatch.setattr(dedup, "WINDOW", 11)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        docs = texts(10, 90)
        made = dedup.shared(dedup.measured(spark.createDataFrame([(7 * k - 50, t) for k, t in enumerate(docs)], "seq long, text string")), "measured")
        out = spark.createDataFrame([(7 * k - 50,) for k in range(93) if k % 3 == 1 or 20 <= k < 50], "seq long")
        plans, arrow = [], type(made).toArrow
        monkeypatch.setattr(type(made), "toArrow", lambda df: plans.append(df._jdf.queryExecution().executedPlan().toString()) or arrow(df))
        found = [(last, end, sorted(block.seq.tolist())) for last, end, block in dedup._blocks(made, lambda: out)]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    seqs = [7 * k - 50 for k in range(93) if not (k % 3 == 1 or 20 <= k < 50)]
    assert [x for _, _, block in found for x in block] == seqs and [len(x[2]) for x in found[:3]] == [8, 16, len(seqs) - 24]
    assert [x[1] for x in found] == [x[2][-1] for x in found] and [x[0] for x in found] == [None, *(x[1] for x in found[:-1])]
    assert not any("Exchange hashpartitioning" in p and "codes" in p or "TakeOrdered" in p for p in plans)
    assert not list(dedup._blocks(made.limit(0))) and not list(dedup._blocks(made, lambda: made.select("seq")))
