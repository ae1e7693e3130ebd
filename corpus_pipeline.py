"""The pipeline over documents: quality rules, near-duplicates, decontamination, personal data, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; run() writes each stage's rows as Parquet into
the shared folder and reads them back as the next one's docs. All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corpusmill.llm import decontaminate, neardup, packing, pii, quality
from corpusmill.llm.kit import free_names, mark, release, small_batches, staged
from corpusmill.llm.queries import table, tokenizer_file
from corpusmill.shipping import ship


#: Word sets of this similarity in percent are near-duplicates of the stage; 85 is the contract of op2 alone.
SIMILAR = 80


def ready(spark: SparkSession) -> None:
    """What any stage needs, whoever calls it."""
    ship(spark)
    small_batches(spark)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that no quality rule rejects."""
    ready(spark)
    return quality.quality_filter(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates (similarity 0.8 or more), the one with the smallest doc_id.

    Rows that repeat a doc_id are one document, whose first text by order stays. Rows without doc_id all stay.
    """
    ready(spark)
    found = neardup.near_duplicates(docs.select("doc_id", "text"), SIMILAR).where("kept and doc_id is not null").select("doc_id").distinct()
    # the join's partitioning serves the window too
    first = F.row_number().over(Window.partitionBy("doc_id").orderBy("text"))
    (place,) = free_names(docs.columns, "place")
    named = docs.where("doc_id is not null").join(found, "doc_id", "left_semi").withColumn(place, first).where(F.col(place) == 1)
    return named.select(docs.columns).unionByName(docs.where("doc_id is null"))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents in which no window of the benchmark occurs."""
    ready(spark)
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with personal data replaced by its kind."""
    ready(spark)
    return pii.masked(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of the documents in sequences: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset."""
    ready(spark)
    return packing.pack_documents(docs, tokenizer_file("word_bpe_49k.json"))


STAGES = [
    ("quality", quality_rules),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("personal_data", personal_data),
    ("packing", pack),
]

#: SQL has no tokenizer and no pattern bootstrapping; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents. What a stage leaves on the shared disk goes once its rows are written, which the next one reads."""
    docs, since = table(spark, sf_dir, "documents"), mark()
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = staged(docs, f"pipeline-{name}")
            release(spark, since, keep=1)
    return docs
