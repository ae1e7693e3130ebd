"""Token ids of whole texts, and files of them.

Ids are those of the tokenizers library's encode(text, add_special_tokens=False). For two kinds of tokenizer the
encoder splits each batch into words at white space, where these never merge, encodes every distinct word of the
batch once, and lays the ids out again by word. Texts in which a cut at a space could change the ids (white space
after a space, in the byte-level kind), texts that hold an added token's string, which the library looks for
before anything else, and all texts of other kinds of tokenizer are encoded whole.
"""

from __future__ import annotations

import json
import os
import re
import unicodedata
import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .kit import scratch_path

#: White space in the tokenizers' sense after a space.
SPACES_MEET = r" [\s\x0b\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
#: Words in one call of the library; few enough that its buffers stay small.
TOGETHER = 100
#: Characters of text that are encoded at once.
AT_ONCE = 6_000_000
#: Characters of texts that are encoded whole in one call of the library, unless a text is longer.
WHOLE = 500_000
#: Words whose ids a worker remembers.
KNOWN = 400_000
#: Groups of words whose encodings are held at once.
GROUPS = 50


def kind_of(settings: dict) -> str:
    """"bytes" (byte-level, nothing normalised), "words" (word ends, white space dropped), or "other", of a tokenizer's file.

    Only settings that are known to keep words apart give a kind; whatever differs from them is other.
    """
    steps = lambda x, name: [x] if x and x["type"] != "Sequence" else (x or {}).get(name, [])
    normalizers, splits, model = steps(settings["normalizer"], "normalizers"), steps(settings["pre_tokenizer"], "pretokenizers"), settings["model"]
    plain = all(not (t["normalized"] or t["single_word"] or t["lstrip"] or t["rstrip"]) for t in settings["added_tokens"])
    usual = model["type"] == "BPE" and not (model.get("dropout") or model.get("continuing_subword_prefix") or model.get("byte_fallback") or model.get("unk_token"))
    after = settings.get("post_processor")
    if not plain or not usual or after and after["type"] != "ByteLevel" or settings.get("truncation") or settings.get("padding"):
        return "other"
    names = [x["type"] for x in splits]
    levels = [x for x in splits if x["type"] == "ByteLevel" and not x["add_prefix_space"]]
    if not normalizers and names == ["ByteLevel"] and levels and levels[0].get("use_regex", True) and not model.get("end_of_word_suffix"):
        return "bytes"
    lower = [x["type"] for x in normalizers] == ["NFC", "Replace", "Lowercase"] and normalizers[1]["pattern"] == {"Regex": r"\s+"} and normalizers[1]["content"] == " "
    apart = names == ["Split", "ByteLevel"] and levels and not levels[0].get("use_regex", True) and splits[0]["invert"] and splits[0]["behavior"] == "Removed" and splits[0]["pattern"] == WORDS
    return "words" if lower and apart and model.get("end_of_word_suffix") == "</w>" else "other"


#: Fixed value: the pattern of the word kind, none of whose matches holds white space.
WORDS = {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"}


class Encoder:
    """Encodes columns of texts with one tokenizer file. word_ends: the kind whose tokens mark the ends of words and that drops white space."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark runs a worker for each core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            settings = json.load(file)
        vocabulary = self.tokenizer.get_vocab()
        self.kind = kind_of(settings)
        self.word_ends = self.kind == "words"
        added = sorted(re.escape(t["content"]) for t in settings["added_tokens"] if t["content"])
        odd = [*added, *([SPACES_MEET] if self.kind == "bytes" else ())]
        #: What a text holds that must be encoded whole.
        self.odd = "|".join(odd) or None
        self.bytes_of = np.zeros(max(vocabulary.values()) + 1, np.int64)
        self.known: dict[str, int] = {}
        self.known_ids, self.known_counts = np.empty(0, np.int32), np.empty(0, np.int64)
        for token, number in vocabulary.items():
            self.bytes_of[number] = len(token.removesuffix("</w>") if self.word_ends else token)

    def plain(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(x.ids, np.int32) for x in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def wholes(self, texts: list[str]) -> list[np.ndarray]:
        """plain() of few texts at a time, for what the library holds of an encoded text is much larger than its ids."""
        out, begin, size = [], 0, 0
        for k, text in enumerate(texts):
            if k > begin and size + len(text) > WHOLE:
                out += self.plain(texts[begin:k])
                begin, size = k, 0
            size += len(text)
        return out + (self.plain(texts[begin:]) if begin < len(texts) else [])

    def widths(self, words: pa.Array) -> np.ndarray:
        """Bytes of each word's tokens."""
        size = pc.binary_length(words).to_numpy(zero_copy_only=False).astype(np.int64)
        if not self.word_ends:
            return size + 1
        for k in np.flatnonzero(size != pc.utf8_length(words).to_numpy(zero_copy_only=False)).tolist():
            size[k] = len(unicodedata.normalize("NFC", words[k].as_py()).lower().encode())
        return size

    def encoded(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all the words, how many each has); words of the byte-level kind stand after a space."""
        lead, texts, widths = "" if self.word_ends else " ", words.to_pylist(), self.widths(words)
        ids, counts = [], []
        for i in range(0, len(texts), TOGETHER * GROUPS):
            starts = range(i, min(i + TOGETHER * GROUPS, len(texts)), TOGETHER)
            for k, found in zip(starts, self.plain([lead + " ".join(texts[k : k + TOGETHER]) for k in starts]), strict=True):
                ends, reached = np.cumsum(widths[k : k + TOGETHER]), np.cumsum(self.bytes_of[found])
                at = np.searchsorted(reached, ends)
                if len(reached) and at[-1] == len(reached) - 1 and np.array_equal(reached[at], ends):
                    counts.append(np.diff(at, prepend=-1))
                else:
                    alone = self.plain([lead + w for w in texts[k : k + TOGETHER]])
                    found, counts = np.concatenate(alone), [*counts, np.array([len(x) for x in alone])]
                ids.append(found)
        return (np.concatenate(ids), np.concatenate(counts)) if ids else (np.empty(0, np.int32), np.empty(0, np.int64))

    def words(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ids, where each word's begin, how many it has). The first KNOWN words of a worker are remembered."""
        texts = words.to_pylist()
        slots = np.fromiter(map(self.known.get, texts, repeat(-1)), np.int64, len(texts))
        new = np.flatnonzero(slots < 0)
        ids, counts = self.encoded(words.take(pa.array(new)))
        known = len(self.known)
        slots[new] = known + np.arange(len(new))
        ids, counts = np.concatenate([self.known_ids, ids]), np.concatenate([self.known_counts, counts])
        ends = np.cumsum(counts)
        for k in new[: KNOWN - known].tolist():
            self.known[texts[k]] = len(self.known)
        if len(self.known) > known:
            self.known_counts = counts[: len(self.known)].copy()
            self.known_ids = ids[: ends[len(self.known) - 1]].copy()
        return ids, (ends - counts)[slots], counts[slots]

    def column(self, texts: pa.Array, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all the texts with end_id after each, how many each has); null counts as empty."""
        texts = pc.fill_null(texts, "")
        parts, begin = [], 0
        size = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64))
        while begin < len(texts):
            stop = max(begin + 1, int(np.searchsorted(size, (size[begin - 1] if begin else 0) + AT_ONCE, "right")))
            parts.append(self._some(texts.slice(begin, stop - begin), end_id))
            begin = stop
        if not parts:
            return np.empty(0, np.int32), np.empty(0, np.int64)
        return np.concatenate([x for x, _ in parts]), np.concatenate([n for _, n in parts])

    def _some(self, texts: pa.Array, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        n, whole = len(texts), {}
        if self.kind == "other":
            found = [np.append(x, np.int32(end_id)) for x in self.wholes(texts.to_pylist())]
            return np.concatenate([np.empty(0, np.int32), *found]), np.array([len(x) for x in found], np.int64)
        if self.odd:
            mask = pc.match_substring_regex(texts, self.odd)
            odd = np.flatnonzero(mask.to_numpy(zero_copy_only=False)).tolist()
            if odd:
                whole = dict(zip(odd, self.wholes([texts[i].as_py() for i in odd]), strict=True))
                texts = pc.if_else(mask, "", texts)
        lists = pc.ascii_split_whitespace(texts) if self.word_ends else pc.split_pattern(texts, " ")
        bounds = lists.offsets.to_numpy().astype(np.int64)
        coded = lists.flatten().dictionary_encode()
        vocabulary, index = coded.dictionary, coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        bounds = bounds - bounds[0]
        if not self.word_ends:  # the first word of each text stands after no space
            firsts = index[bounds[:-1]]
            distinct = {int(k): j for j, k in enumerate(dict.fromkeys(firsts.tolist()))}
            alone = self.plain([vocabulary[k].as_py() for k in distinct])
            index[bounds[:-1]] = len(vocabulary) + np.array([distinct[int(k)] for k in firsts], np.int64)
        ids, starts, counts = self.words(vocabulary)
        # one more word stands for the end of a text
        more = [*(alone if not self.word_ends else ()), np.array([end_id], np.int32)]
        sizes = np.array([len(x) for x in more], np.int64)
        starts, counts = np.concatenate([starts, len(ids) + np.cumsum(sizes) - sizes]), np.concatenate([counts, sizes])
        ids = np.concatenate([ids, *more])
        index = np.insert(index, bounds[1:], len(counts) - 1)
        starts, lengths = starts[index], counts[index]
        ends = np.cumsum(lengths)
        at = np.repeat((starts - (ends - lengths)).astype(np.int32), lengths)
        at += np.arange(len(at), dtype=np.int32)
        out = ids[at]
        text_ends = ends[bounds[1:] + np.arange(n)]
        sizes = np.diff(text_ends, prepend=0)
        if whole:
            pieces = [np.append(whole[i], np.int32(end_id)) if i in whole else out[e - s : e] for i, (e, s) in enumerate(zip(text_ends.tolist(), sizes.tolist(), strict=True))]
            out, sizes = np.concatenate(pieces), np.array([len(x) for x in pieces], np.int64)
        return out.astype(np.int32, copy=False), sizes


@lru_cache(4)
def encoder(path: str) -> Encoder:
    return Encoder(path)


def crc(ids: np.ndarray) -> int:
    return zlib.crc32(np.ascontiguousarray(ids, "<u4").data)


#: Layout of the token files. Ids have a dictionary (16 bits each for up to 65,536 ids); doc_id, start and
#: n_tokens are delta-encoded, as the second writer version does for columns without a dictionary. Row groups
#: and pages are small enough to fetch one document's ids without reading its neighbours'; page indexes are
#: written by default. Spark's own Bloom and statistics options stay as they are.
LAYOUT = {
    "parquet.writer.version": "v2",
    "parquet.enable.dictionary": "false",
    "parquet.enable.dictionary#ids.list.element": "true",
    "parquet.dictionary.page.size": str(1 << 20),
    "parquet.block.size": str(64 << 20),
    "parquet.page.size": str(256 << 10),
    "parquet.page.row.count.limit": "2000",
    "compression": "zstd",
}


#: Bytes of input files that one token file is made of, at most about; fewer where there are more shuffle partitions.
SHARD_BYTES = 256 << 20


def shards_for(docs: DataFrame) -> int:
    """Token files for docs: by the bytes that Spark expects to read, where it knows them, and at least a shuffle's partitions."""
    least = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    size = int(docs._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    return max(least, -(-size // SHARD_BYTES)) if size < 1 << 60 else least


def write_tokens(docs: DataFrame, path: str, tokenizer_path: str, end_id: int, shards: int | None = None) -> None:
    """Encode docs (doc_id, text) into token files under path, in ascending doc_id order over and within shards.

    Files have doc_id, shard, shard_start (ids before the document in its shard), n_tokens, ids. Null text is
    empty: its only id is end_id. Rows of equal doc_id all stay, ordered by a hash of their text, and may lie in
    several shards; a null doc_id comes first. Other columns are ignored. No file has rows for an empty table.
    """
    shards = shards or shards_for(docs)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, before, coder = TaskContext.get().partitionId(), 0, encoder(tokenizer_path)
        for batch in batches:
            ids, sizes = coder.column(batch.column(1), end_id)
            ends = np.cumsum(sizes)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(np.full(len(sizes), shard, np.int32)), pa.array(before + ends - sizes), pa.array(sizes), pa.ListArray.from_arrays(pa.array(np.append(0, ends).astype(np.int32)), pa.array(ids))],
                ["doc_id", "shard", "shard_start", "n_tokens", "ids"],
            )
            before += int(ends[-1]) if len(ends) else 0

    kind = docs.schema["doc_id"].dataType.simpleString()
    by = ["doc_id", F.xxhash64("text"), "text"]  # the bounds of the ranges are sampled from ids and hashes, not from texts
    ordered = docs.select("doc_id", "text").repartitionByRange(shards, *by[:2]).sortWithinPartitions(*by)
    ordered.mapInArrow(encode, f"doc_id {kind}, shard int, shard_start long, n_tokens long, ids array<int>").write.options(**LAYOUT).parquet(path)


def read_tokens(spark, path: str, ids: bool = True) -> DataFrame:
    """The token files' rows with start, the number of ids in all documents before; without ids, only metadata pages are read."""
    files = spark.read.parquet(path)
    totals = files.groupBy("shard").agg(F.sum("n_tokens").alias("total"))
    # a row for each shard, a bound the writer sets
    before = totals.select("shard", (F.sum("total").over(Window.orderBy("shard")) - F.col("total")).alias("before"))
    columns = ["doc_id", (F.col("before") + F.col("shard_start")).alias("start"), "n_tokens"]
    return files.join(F.broadcast(before), "shard").select(*columns, *["ids"] * ids)


def token_digests(tokens: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens and the crc32 of the ids, as little-endian unsigned 32-bit integers, of read_tokens() rows."""

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(3)
            values, bounds = lists.values.to_numpy(zero_copy_only=False), lists.offsets.to_numpy()
            sums = [crc(values[a:b]) for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(sums, pa.int64())], ["doc_id", "start", "n_tokens", "ids_crc32"])

    kind = tokens.schema["doc_id"].dataType.simpleString()
    return tokens.select("doc_id", "start", "n_tokens", "ids").mapInArrow(digest, f"doc_id {kind}, start long, n_tokens long, ids_crc32 long")


def token_output(docs: DataFrame, tokenizer_path: str, end_id: int = 2) -> DataFrame:
    """Write the documents' token files into the shared folder and return their digests as read back."""
    spark = docs.sparkSession
    path = scratch_path(spark, "tokens")
    write_tokens(docs, path, tokenizer_path, end_id)
    return token_digests(read_tokens(spark, path))
