"""Configuration files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def load_yaml(spark: SparkSession, path: str) -> dict:
    """A YAML file of any store that Spark knows; an empty one is {}."""
    import yaml

    text = "\n".join(r.value for r in spark.read.text(path, wholetext=True).collect())
    return yaml.safe_load(text) or {}


def load_seeds(spark: SparkSession, path: str, language: str = "ar") -> DataFrame:
    """(pos, seed) of the configured seed categories of a language; none for a missing one."""
    config = load_yaml(spark, path)
    seeds = ((config.get("wikipedia") or {}).get("seed_categories") or {}).get(language) or []
    return spark.createDataFrame(list(enumerate(seeds)), "pos int, seed string")
