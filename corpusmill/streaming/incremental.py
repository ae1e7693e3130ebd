"""Documents that arrive as a stream: cleaned and checked on the way, exact copies or near-duplicates kept out over restarts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.text import char_count, cleaned, word_count
from ..operators.dedup import THRESHOLD, arrivals, shared, tidied
from ..operators.quality import checked
from ..plans.ingest import gate, gated
from ..sources.files import exists

#: What is kept of a document that later ones are compared with.
INDEX = "seq long, n int, codes binary, keys array<long>, sketch array<long>, doc_id string, batch int"


def prepared(stream: DataFrame, is_wiki: bool = True) -> DataFrame:
    """Documents of a stream (text and the fields that quality needs), cleaned, counted and checked; no state is kept."""
    out = cleaned(stream, "text", is_wiki=is_wiki)
    return checked(out.withColumns({"word_count": word_count(F.col("text")), "char_count": char_count(F.col("text"))}))


def without_copies(stream: DataFrame, time: str, delay: str = "1 day") -> DataFrame:
    """The first of equal texts within the delay; the state store forgets digests that the watermark on time has passed."""
    return stream.withColumn("text_digest", F.sha2("text", 256)).withWatermark(time, delay).dropDuplicatesWithinWatermark(["text_digest"])


def routed_to(stream: DataFrame, accepted: str, rejected: str, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    """Start writing a prepared stream's accepted and rejected documents to two Parquet folders.

    A batch that is retried after a failure overwrites its own folders, so each document is written once.
    """

    def write(batch: DataFrame, number: int) -> None:
        batch.where(~gate()).write.mode("overwrite").parquet(f"{accepted}/batch={number}")
        batch.where(gate()).write.mode("overwrite").parquet(f"{rejected}/batch={number}")

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()


def deduplicated_to(stream: DataFrame, accepted: str, rejected: str, index: str, checkpoint: str, order: str = "ingest_seq", threshold: float = THRESHOLD, trigger: dict | None = None) -> StreamingQuery:
    """Start writing a prepared stream's documents as the ingestion plan routes them, near-duplicates over all batches included.

    order is a whole number without repeats over the whole stream, doc_id names a document; a batch counts as later than
    those before it. index is a Parquet folder of the kept documents' signatures by batch, with which a batch is joined by
    bands. A batch that is retried sees only batches before it and overwrites its own folders.
    """

    def write(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        with tidied(spark):
            judged = shared(batch, "batch")
            before = spark.read.schema(INDEX).parquet(index) if exists(spark, index) else spark.createDataFrame([], INDEX)
            before = before.where(F.col("batch") < number)
            seq = F.col(order).cast("bigint").alias("seq")
            dups, kept = arrivals(judged.where(~gate()).select(seq, "text"), before.drop("doc_id", "batch"), threshold)
            named = judged.select(seq, "doc_id")
            kept.join(named, "seq").write.mode("overwrite").parquet(f"{index}/batch={number}")
            routed = shared(gated(judged, dups, before.select("seq", "doc_id").unionByName(named), order), "routed")
            for route, folder in (("accepted", accepted), ("rejected", rejected)):
                routed.where(F.col("route") == route).drop("route").write.mode("overwrite").parquet(f"{folder}/batch={number}")

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()


def counts_by_window(stream: DataFrame, time: str, window: str = "5 minutes", delay: str = "10 minutes") -> DataFrame:
    """Documents and words by window of time and decision, each window once the watermark has passed it."""
    return stream.withWatermark(time, delay).groupBy(F.window(time, window).alias("window"), "quality_decision").agg(F.count("*").alias("n"), F.sum("word_count").alias("words"))
