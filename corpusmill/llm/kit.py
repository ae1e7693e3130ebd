"""What the operators of this subpackage share: the scratch folder, hashing of word windows, crc columns."""

from __future__ import annotations

import threading
import uuid
from collections.abc import Iterable
from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame, SparkSession

from ..operators.dedup import scratch

#: Values of splitmix64 and of a 64-bit polynomial; any odd constants would do.
GOLDEN, MIX_A, MIX_B, BASE = 0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xD6E8FEB86659FD93
#: Words whose hashes a worker remembers before it starts afresh.
REMEMBERED = 1 << 17
#: Bytes of an Arrow batch between Spark and a Python worker; rows of text are far from even.
BATCH_BYTES = 16 << 20


def small_batches(spark: SparkSession) -> None:
    """Lower the session's limit on the bytes of an Arrow batch to BATCH_BYTES, so that a worker's memory is bounded by it."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    if int(spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(name))) > BATCH_BYTES:
        spark.conf.set(name, f"{BATCH_BYTES}b")


_made = threading.local()


def scratch_path(spark: SparkSession, tag: str) -> str:
    """A new folder's path below the core's scratch folder, remembered for release()."""
    path = f"{scratch(spark)}/{tag}-{uuid.uuid4().hex}"
    _made.paths = [*getattr(_made, "paths", []), path]
    return path


def staged(df: DataFrame, tag: str, **options) -> DataFrame:
    """Write df into the shared folder and read it back: lineage ends here and a lost executor costs no recomputation."""
    path = scratch_path(df.sparkSession, tag)
    df.write.options(**({"compression": "zstd"} | options)).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def mark() -> int:
    """How many tables this thread has made, for release()."""
    return len(getattr(_made, "paths", []))


def release(spark: SparkSession, since: int = 0, keep: int = 0) -> None:
    """Delete the tables that this thread made since mark(), but for the last `keep`. Only what no result still reads may go."""
    paths = getattr(_made, "paths", [])
    gone = paths[since : len(paths) - keep]
    for name in gone:
        path = spark._jvm.org.apache.hadoop.fs.Path(name)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    _made.paths = [x for x in paths if x not in gone]


def free_names(columns: Iterable[str], *names: str) -> list[str]:
    """The names, each with as many underscores after it as make it differ from all of columns, whatever their case."""
    taken, out = {c.lower() for c in columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def mixed(h: np.ndarray) -> np.ndarray:
    """splitmix64's finaliser over uint64."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(MIX_A)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(MIX_B)
    return h ^ (h >> np.uint64(31))


class WordHashes(dict):
    """bytes of a word -> 64-bit hash; remembers at most REMEMBERED words between calls of trim()."""

    def __missing__(self, word: bytes) -> int:
        import xxhash

        self[word] = h = xxhash.xxh3_64_intdigest(word)
        return h

    def trim(self) -> None:
        if len(self) > REMEMBERED:
            self.clear()


@lru_cache(1)
def word_hashes() -> WordHashes:
    return WordHashes()


def hashed_words(words: list[bytes]) -> np.ndarray:
    known = word_hashes()
    known.trim()
    return np.fromiter(map(known.__getitem__, words), np.uint64, len(words))


def window_hashes(hashes: np.ndarray, width: int) -> np.ndarray:
    """A hash for each run of width words, in order; the whole sequence as one where it is shorter; nothing for no words."""
    n = len(hashes)
    if not n:
        return np.empty(0, np.uint64)
    width = min(width, n)
    out = np.full(n - width + 1, width, np.uint64)
    for k in range(width):
        out = out * np.uint64(BASE) + hashes[k : n - width + 1 + k]
    return mixed(out)
