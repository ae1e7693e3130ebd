import json
import random

import pytest
from pyspark.sql import functions as F

from corpusmill.operators import dedup, stats
from corpusmill.plans import ingest, schema
from corpusmill.sources import config, files
from corpusmill.streaming import incremental


def docs(spark):
    rng = random.Random(1)
    good = [" ".join("".join(rng.choice(letters) for _ in range(6)) for _ in range(1000)) for letters in ("abcde", "klmno", "uvwxy")]
    rows = [(0, "a", good[0]), (1, "b", good[0]), (2, "c", "short"), (3, "d", good[1]), (4, "e", good[2] + " more")]
    df = spark.createDataFrame(rows, "ingest_seq long, doc_id string, text string").withColumns(
        {"source_id": F.lit("s"), "title": F.lit("t"), "language": F.lit("en"), "source_name": F.lit("n"), "source_type": F.lit("news"), "source_url": F.lit("u"), "credibility": F.lit("tier_1"), "date_collected": F.lit("2026-01-01").cast("timestamp")}
    )
    return df.withColumns({"word_count": F.size(F.split("text", " ")).cast("bigint"), "char_count": F.length("text").cast("bigint"), "wikipedia_categories": F.array(F.lit("x"), F.lit("y")), "seed_category": F.lit(None).cast("string")})


def test_routes_and_stats(spark):
    found = ingest.routed(docs(spark))
    by = {r.doc_id: (r.route, r.rejection_reason, r.is_duplicate_of, r.has_duplicate) for r in found.collect()}
    assert by["b"] == ("rejected", "duplicate", "a", True) and by["a"] == ("accepted", None, None, False)
    assert by["c"][0] == "rejected" and by["c"][1].startswith("Too short")
    row = stats.run_stats(found).first()
    assert (row.attempted_documents, row.accepted_documents, row.rejected_documents, row.duplicate_documents) == (5, 3, 2, 1)
    assert [tuple(r) for r in stats.category_distribution(found).collect()] == [("x", 3), ("y", 3)]
    assert [tuple(r) for r in stats.seed_distribution(found).collect()] == [("unknown", 3)]
    assert [r.rejection_reason for r in stats.rejection_distribution(found).collect()][0] == "duplicate"


def test_empty_run(spark):
    row = stats.run_stats(ingest.routed(docs(spark).limit(0))).first()
    assert row[:] == (0, 0, 0, 0, 0, 0.0)


def test_export_view(spark):
    full = schema.as_documents(docs(spark))
    assert full.columns == [f.name for f in schema.DOCUMENT] and len(full.columns) == 40
    view = schema.export_view(full)
    assert len(view.columns) == 34 and view.first().date_collected == "2026-01-01T00:00:00.000000Z"
    valid, invalid = schema.validated(full.withColumn("language", F.when(F.col("doc_id") == "a", "xx").otherwise(F.col("language"))))
    assert valid.count() == 4 and invalid.first().violations == ["language"]


def test_files(spark, tmp_path):
    out = str(tmp_path)
    lines = tmp_path / "in.jsonl"
    lines.write_text(json.dumps({"doc_id": "1", "title": "فلسطين", "text": "فلسطين ثقافة وتاريخ", "word_count": 3, "language": "ar-MSA"}, ensure_ascii=False) + "\n\n", encoding="utf-8")
    columns = "doc_id string, title string, text string, word_count long, language string"
    summary = files.export_dataset(spark, str(lines), f"{out}/hf", True, columns)
    assert (summary["num_rows"], summary["total_words"], summary["average_words"], summary["columns"]) == (1, 3, 3.0, ["doc_id", "title", "text", "word_count", "language"])
    assert json.loads((tmp_path / "hf/dataset_summary.json").read_text())["num_rows"] == 1
    assert files.import_dataset(spark, summary["train_parquet"], f"{out}/back").count() == 1
    assert files.read_jsonl(spark, f"{out}/back", columns).first().title == "فلسطين"
    with pytest.raises(FileNotFoundError):
        files.export_dataset(spark, f"{out}/none", f"{out}/x")
    (tmp_path / "empty.jsonl").write_text("\n")
    with pytest.raises(ValueError, match="No records"):
        files.export_dataset(spark, f"{out}/empty.jsonl", f"{out}/x", schema=columns)
    (tmp_path / "bad.jsonl").write_text('{"doc_id": "1"}\n\n{bad\n')
    with pytest.raises(ValueError, match="line 3"):
        files.read_jsonl(spark, f"{out}/bad.jsonl", columns)
    (tmp_path / "array.json").write_text('[{"doc_id": "1"}, {"doc_id": "2"}]')
    assert files.read_json_array(spark, f"{out}/array.json", columns).count() == 2


def test_sinks(spark, tmp_path):
    out = str(tmp_path)
    found = ingest.routed(docs(spark))
    files.write_routes(found, f"{out}/acc", f"{out}/rej")
    first = json.loads(next(iter((tmp_path / "acc").glob("*.json"))).read_text().splitlines()[0])
    assert "is_duplicate_of" in first and first["is_duplicate_of"] is None
    assert spark.read.json(f"{out}/rej").count() == 2
    files.write_partitioned(docs(spark), f"{out}/parts")
    assert (tmp_path / "parts/source_id=s/language=en").is_dir() and files.read_parquet(spark, f"{out}/parts").count() == 5
    files.append_log(spark, f"{out}/log", {"event": "run_start"})
    files.append_log(spark, f"{out}/log", {"event": "run_finish"})
    assert spark.read.json(f"{out}/log").count() == 2
    files.write_reports({"a": spark.range(2)}, f"{out}/reports")
    assert spark.read.json(f"{out}/reports/a").count() == 2


def test_config(spark, tmp_path):
    path = tmp_path / "c.yaml"
    path.write_text("wikipedia:\n  seed_categories:\n    ar: [a, b]\n")
    assert [tuple(r) for r in config.load_seeds(spark, str(path)).collect()] == [(0, "a"), (1, "b")]
    assert config.load_seeds(spark, str(path), "fr").collect() == []


def test_stream(spark, tmp_path):
    source = str(tmp_path / "in")
    docs(spark).drop("word_count", "char_count").withColumn("ts", F.lit("2026-01-01").cast("timestamp")).write.parquet(source)
    stream = incremental.without_copies(spark.readStream.schema(spark.read.parquet(source).schema).parquet(source), "ts")
    q = incremental.routed_to(incremental.prepared(stream), f"{tmp_path}/a", f"{tmp_path}/r", f"{tmp_path}/c")
    q.awaitTermination(120)
    assert spark.read.parquet(f"{tmp_path}/a").count() == 3 and spark.read.parquet(f"{tmp_path}/r").count() == 1


def test_stream_near_duplicates(spark, tmp_path):
    """Files that arrive one by one are routed as the plan routes them together; another run goes on after the first."""
    made = docs(spark).withColumn("text", F.when(F.col("doc_id") == "b", F.concat("text", F.lit(" again"))).otherwise(F.col("text")))
    late = made.where("doc_id = 'd'").withColumns({"ingest_seq": F.lit(5).cast("long"), "doc_id": F.lit("f"), "text": F.concat("text", F.lit(" once more"))})
    whole = made.unionByName(late).drop("word_count", "char_count")
    schema_of = whole.schema
    start = lambda: incremental.deduplicated_to(
        incremental.prepared(spark.readStream.schema(schema_of).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")), f"{tmp_path}/a", f"{tmp_path}/r", f"{tmp_path}/index", f"{tmp_path}/c"
    )
    for part in ((0, 1), (2, 3, 4), (5,)):
        for k in part:
            whole.where(F.col("ingest_seq") == k).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        start().awaitTermination(240)
    shown = lambda df: {r.doc_id: (r.rejection_reason, r.is_duplicate_of, r.quality_decision) for r in df.collect()}
    wanted = ingest.routed(incremental.prepared(whole))
    for route, folder in (("accepted", "a"), ("rejected", "r")):
        assert shown(spark.read.parquet(f"{tmp_path}/{folder}")) == shown(wanted.where(F.col("route") == route))
    found = shown(spark.read.parquet(f"{tmp_path}/r"))
    assert found["b"][:2] == ("duplicate", "a") and found["f"][:2] == ("duplicate", "d")
    assert spark.read.parquet(f"{tmp_path}/index").count() == 3


def test_window_counts(spark, tmp_path):
    rows = [("2026-01-01 00:01:00", "accept", 3), ("2026-01-01 00:04:59", "accept", 4), ("2026-01-01 00:05:00", "accept", 5), ("2026-01-01 00:02:00", "reject", 1), ("2026-01-01 01:00:00", "accept", 9)]
    df = spark.createDataFrame(rows, "ts string, quality_decision string, word_count long").withColumn("ts", F.col("ts").cast("timestamp"))
    df.coalesce(1).write.parquet(f"{tmp_path}/in")
    counted = incremental.counts_by_window(spark.readStream.schema(df.schema).parquet(f"{tmp_path}/in"), "ts")
    counted.writeStream.format("memory").queryName("windows").outputMode("append").option("checkpointLocation", f"{tmp_path}/c").trigger(availableNow=True).start().awaitTermination(120)
    found = {(str(r.window.start.time()), r.quality_decision): (r.n, r.words) for r in spark.table("windows").collect()}
    assert found == {("00:00:00", "accept"): (2, 7), ("00:00:00", "reject"): (1, 1), ("00:05:00", "accept"): (1, 5)}


def test_tidied(spark):
    with dedup.tidied(spark):
        df = dedup.shared(spark.range(3), "gone")
        (path,) = dedup._made.paths
        assert df.count() == 3 and files.exists(spark, path)
    assert not files.exists(spark, path) and dedup._made.paths is None


def test_run_log(spark):
    events = spark.createDataFrame([("attempt", None), ("attempt", None), ("success", None), ("rejection", "empty_after_cleaning"), ("error", "x")], "kind string, reason string")
    assert stats.run_log_summary(events).first()[:] == (2, 1, 1, 1)
    assert [tuple(r) for r in stats.rejection_counts(events).collect()] == [("empty_after_cleaning", 1)]
