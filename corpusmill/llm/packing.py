"""Packing token sequences by cutting-stock column generation.

Documents longer than a sequence give whole sequences and a rest. The lengths of all pieces, rounded up to
units, make a histogram of at most capacity / unit bars, whatever the number of documents. A linear program
over patterns (ways of filling one sequence) covers it with the fewest sequences; a knapsack dynamic program
over the dual prices finds each next pattern; the rounded patterns then take documents by their rank among
those of equal length, which Spark computes without gathering them.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .kit import free_names, staged
from .tokens import crc, encoder

CAPACITY, UNIT = 4096, 16


def best_pattern(prices: np.ndarray, capacity: int) -> tuple[np.ndarray, float]:
    """The unbounded knapsack: how often to take each width 1..len(prices), to fill capacity at the highest price."""
    best, last = np.zeros(capacity + 1), np.zeros(capacity + 1, np.int64)
    for room in range(1, capacity + 1):
        worth = prices[:room] + best[room - 1 :: -1][: len(prices[:room])]
        w = int(worth.argmax())
        if worth[w] > best[room - 1]:
            best[room], last[room] = worth[w], w + 1
        else:
            best[room] = best[room - 1]
    taken, room = np.zeros(len(prices), np.int64), capacity
    while room > 0:
        if last[room]:
            taken[last[room] - 1] += 1
            room -= last[room]
        else:
            room -= 1
    return taken, float(best[capacity])


def patterns_for(demand: np.ndarray, capacity: int, gap: float = 1e-4, rounds: int = 5000) -> list[tuple[np.ndarray, int]]:
    """Patterns and their counts that cover demand (of widths 1..len(demand)) exactly; together near the fewest."""
    widths = np.flatnonzero(demand)
    if not len(widths):
        return []
    n, wanted = len(widths), demand[widths].astype(float)
    columns = [np.eye(len(demand), dtype=np.int64)[w] * (capacity // (w + 1)) for w in widths]
    inverse = np.diag([1 / (capacity // (w + 1)) for w in widths])
    amounts = inverse @ wanted
    for _ in range(rounds):
        prices = np.zeros(len(demand))
        prices[widths] = np.maximum(inverse.sum(0), 0)
        column, worth = best_pattern(prices, capacity)
        if worth <= 1 + gap:  # the optimum is at least the current value over worth
            break
        step = inverse @ column[widths]
        able = step > 1e-9
        ratios = np.full(n, np.inf)
        ratios[able] = amounts[able] / step[able]
        out = int(ratios.argmin())
        if not np.isfinite(ratios[out]):
            break
        pivot = inverse[out] / step[out]
        amounts = amounts - step * ratios[out]
        amounts[out] = ratios[out]
        inverse -= np.outer(step, pivot)
        inverse[out] = pivot
        columns[out] = column
    found, left = [], demand.copy()
    for column, amount in sorted(zip(columns, np.floor(amounts + 1e-9).astype(np.int64), strict=True), key=lambda x: -x[1]):
        used = column > 0
        times = int(min(amount, (left[used] // column[used]).min()))
        if times > 0:
            found.append((column, times))
            left = left - column * times
    # what rounding left over is bounded by the widths alone: first fit, the widest first
    while left.any():
        column, room = np.zeros(len(demand), np.int64), capacity
        for w in np.flatnonzero(left)[::-1]:
            k = min(int(left[w]), room // (int(w) + 1))
            column[w], room = k, room - k * (int(w) + 1)
        times = int((left[column > 0] // column[column > 0]).min())
        found.append((column, times))
        left = left - column * times
    return found


@dataclass
class Places:
    """For each width, where its pieces go by rank: ends of rank runs, each run's first sequence, pieces a sequence, first slot."""

    ends: dict[int, np.ndarray]
    first: dict[int, np.ndarray]
    each: dict[int, np.ndarray]
    slot: dict[int, np.ndarray]

    @classmethod
    def of(cls, patterns: list[tuple[np.ndarray, int]]) -> Places:
        rows: dict[int, list[tuple[int, int, int, int]]] = {}
        sequence = 0
        for column, times in patterns:
            slot = 0
            for w in np.flatnonzero(column)[::-1]:
                rows.setdefault(int(w) + 1, []).append((int(column[w]) * times, sequence, int(column[w]), slot))
                slot += int(column[w])
            sequence += times
        array = {w: np.array(x, np.int64) for w, x in rows.items()}
        return cls({w: x[:, 0].cumsum() for w, x in array.items()}, *({w: x[:, k] for w, x in array.items()} for k in (1, 2, 3)))

    def of_ranks(self, width: int, ranks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        run = np.searchsorted(self.ends[width], ranks, "right")
        within = ranks - np.append(0, self.ends[width])[run]
        each = self.each[width][run]
        return self.first[width][run] + within // each, self.slot[width][run] + within % each


def token_pieces(docs: DataFrame, tokenizer_path: str, end_id: int, capacity: int = CAPACITY) -> DataFrame:
    """A row for each piece of at most capacity ids: doc_id, start, length, ids_crc32, doc_tokens."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(tokenizer_path)
        for batch in batches:
            ids, sizes = coder.column(batch.column(1), end_id)
            ends = np.cumsum(sizes)
            n = -(-sizes // capacity)
            owner = np.repeat(np.arange(len(sizes)), n)
            start = (np.arange(len(owner)) - np.repeat(np.cumsum(n) - n, n)) * capacity
            length = np.minimum(capacity, sizes[owner] - start)
            at = (ends - sizes)[owner] + start
            sums = [crc(ids[a : a + k]) for a, k in zip(at.tolist(), length.tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(owner)), pa.array(start), pa.array(length), pa.array(sums, pa.int64()), pa.array(sizes[owner])], ["doc_id", "start", "length", "ids_crc32", "doc_tokens"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(cut, f"doc_id {kind}, start long, length long, ids_crc32 long, doc_tokens long")


def packed(pieces: DataFrame, capacity: int = CAPACITY, unit: int = UNIT) -> DataFrame:
    """Give pieces (doc_id, start, length, ...; length 1 to capacity) a sequence_id and an offset in it, gapless from 0.

    Every row lands in exactly one sequence, repeated rows and null doc_ids too; an empty table gives no rows.
    Pieces that no pattern of whole units fills exactly leave padding of under one unit each.
    """
    spark = pieces.sparkSession
    own = pieces.columns
    width, part_name, rank_name, slot_name = free_names([*own, "sequence_id", "offset"], "width", "part", "rank", "slot")
    pieces = pieces.withColumn(width, F.ceil(F.col("length") / F.lit(unit)).cast("int"))
    ddl = lambda fields: ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)

    def ranked(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        part, seen = TaskContext.get().partitionId(), {}
        for frame in frames:
            rank = frame.groupby(width).cumcount() + frame[width].map(seen).fillna(0).astype("int64")
            for w, k in frame[width].value_counts().items():
                seen[w] = seen.get(w, 0) + int(k)
            yield frame.assign(**{part_name: np.int32(part), rank_name: rank.astype("int64")})

    by = [width, *(c for c in ("doc_id", "start", "ids_crc32") if c in own)]
    ordered = pieces.repartitionByRange(int(spark.conf.get("spark.sql.shuffle.partitions")), *by).sortWithinPartitions(*by)
    ranks = staged(ordered.mapInPandas(ranked, f"{ddl(pieces.schema)}, `{part_name}` int, `{rank_name}` long"), "ranks")
    # the parts hold neighbouring widths, so this has about a row for each part and width
    counts = ranks.groupBy(width, part_name).count().orderBy(width, part_name).collect()
    demand, before = np.zeros(capacity // unit, np.int64), {}
    for w, part, n in counts:
        before[w, part] = int(demand[w - 1])
        demand[w - 1] += n
    places = Places.of(patterns_for(demand, capacity // unit))

    def place(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            sequence, slot = np.zeros(len(frame), np.int64), np.zeros(len(frame), np.int64)
            for (w, part), rows in frame.groupby([width, part_name]).indices.items():
                sequence[rows], slot[rows] = places.of_ranks(int(w), frame[rank_name].to_numpy()[rows] + before[w, part])
            yield frame[own].assign(**{"sequence_id": sequence, slot_name: slot})

    placed = ranks.mapInPandas(place, f"{ddl(f for f in pieces.schema if f.name != width)}, sequence_id long, `{slot_name}` long")
    upto = F.sum("length").over(Window.partitionBy("sequence_id").orderBy(slot_name))
    return placed.withColumn("offset", upto - F.col("length")).drop(slot_name)


def pack_documents(docs: DataFrame, tokenizer_path: str, end_id: int = 2, capacity: int = CAPACITY) -> DataFrame:
    """Tokenise docs (doc_id, text; null text is empty) and pack them into sequences of at most capacity ids."""
    return packed(staged(token_pieces(docs, tokenizer_path, end_id, capacity), "pieces"), capacity)
