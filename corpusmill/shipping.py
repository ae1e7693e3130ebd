"""Makes the package importable on executors that were not started with it on their path."""

from __future__ import annotations

import tempfile
import zipfile
from functools import wraps
from pathlib import Path

from pyspark.sql import SparkSession

_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Add the package to this application's Python files, once."""
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    here = Path(__file__).parent
    archive = Path(tempfile.mkdtemp()) / "corpusmill.zip"
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as out:
        for path in sorted(here.rglob("*.py")):
            out.write(path, path.relative_to(here.parent))
    spark.sparkContext.addPyFile(str(archive))
    _SHIPPED.add(app)


def shipped(query):
    """The query, with the package shipped before it runs."""

    @wraps(query)
    def run(spark: SparkSession, *args, **options):
        ship(spark)
        return query(spark, *args, **options)

    return run
