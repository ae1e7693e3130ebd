"""Reading and writing documents as JSON lines, JSON arrays and Parquet."""

from __future__ import annotations

import json
from typing import Protocol

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..operators.stats import export_summary
from ..plans.schema import DOCUMENT


class Source(Protocol):
    """Anything that yields documents; the one extension point for further sources."""

    def read(self, spark: SparkSession) -> DataFrame: ...


def _fs(spark: SparkSession, path: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()), path


def exists(spark: SparkSession, path: str) -> bool:
    fs, path = _fs(spark, path)
    return fs.exists(path)


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """One small file in any store that Spark knows."""
    fs, path = _fs(spark, path)
    out = fs.create(path, True)
    out.write(bytearray(text.encode()))
    out.close()


def read_jsonl(spark: SparkSession, path: str, schema: StructType | str = DOCUMENT) -> DataFrame:
    """Documents of JSON lines; blank lines are skipped, a bad line raises ValueError with its number in its file.

    A first pass looks for bad lines; only if there is one, a second pass numbers them.
    """
    schema = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    marked = spark.read.schema(StructType([*schema.fields, StructField("_bad", StringType())])).option("columnNameOfCorruptRecord", "_bad").json(path)
    bad = marked.where("_bad is not null").take(1)
    if bad:
        whole = spark.read.text(path, wholetext=True).select(F.input_file_name().alias("file"), F.posexplode(F.split("value", "\r?\n")).alias("line", "value"))
        one = whole.where(F.trim("value") == bad[0]["_bad"].strip()).orderBy("file", "line").first()
        raise ValueError(f"Invalid JSON on line {one.line + 1} of {one.file}")
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)


def read_json_array(spark: SparkSession, path: str, schema: StructType | str = DOCUMENT) -> DataFrame:
    """Documents of files that each hold one JSON array."""
    return spark.read.schema(schema).option("multiLine", True).json(path)


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def write_jsonl(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """A folder of JSON lines with all fields, nulls too."""
    df.write.mode(mode).option("ignoreNullFields", False).json(path)


def write_routes(routed: DataFrame, accepted: str, rejected: str) -> None:
    """Accepted and rejected documents in two folders of JSON lines."""
    for route, path in (("accepted", accepted), ("rejected", rejected)):
        write_jsonl(routed.where(F.col("route") == route).drop("route"), path)


def write_snapshot(docs: DataFrame, path: str) -> None:
    """All documents before any gate, one dataset with doc_id in each row."""
    write_jsonl(docs, path)


def write_partitioned(docs: DataFrame, path: str, by: tuple[str, ...] = ("source_id", "language")) -> None:
    """Parquet in a folder for each source and language, rebalanced so that no folder gets many small files and no task a whole large source."""
    docs.hint("rebalance", *by).write.mode("overwrite").partitionBy(*by).parquet(path)


def append_log(spark: SparkSession, path: str, event: dict) -> None:
    """One event of a run, appended to a folder of JSON lines."""
    spark.createDataFrame([(json.dumps(event, ensure_ascii=False),)], "value string").write.mode("append").text(path)


def export_dataset(spark: SparkSession, source: str, out: str, jsonl_copy: bool = False, schema: StructType | str = DOCUMENT) -> dict:
    """JSON lines to Parquet under out/train.parquet, with dataset_summary.json; raises if the input is missing or empty."""
    if not exists(spark, source):
        raise FileNotFoundError(f"Processed input not found: {source}")
    docs = read_jsonl(spark, source, schema)
    if not docs.take(1):
        raise ValueError(f"No records found in {source}")
    train = f"{out}/train.parquet"
    docs.write.mode("overwrite").parquet(train)
    copy = None
    if jsonl_copy:
        write_jsonl(docs, copy := f"{out}/train.jsonl")
    summary = {"input": source, "output_dir": out, "train_parquet": train, "jsonl_copy": copy} | export_summary(spark.read.parquet(train))
    write_text(spark, f"{out}/dataset_summary.json", json.dumps(summary, ensure_ascii=False, indent=2))
    return summary | {"summary_json": f"{out}/dataset_summary.json"}


def import_dataset(spark: SparkSession, parquet: str, out: str) -> DataFrame:
    """A Parquet dataset as JSON lines under out; returns it."""
    docs = spark.read.parquet(parquet)
    write_jsonl(docs, out)
    return docs


def write_reports(reports: dict[str, DataFrame], path: str) -> None:
    """Each report in its own folder under path."""
    for name, df in reports.items():
        write_jsonl(df, f"{path}/{name}")
