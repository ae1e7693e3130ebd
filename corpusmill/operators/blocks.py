"""Sets of numbers compared block by block: a bounded block is sent to all machines, and the others stream past it.

No pair is written before it is confirmed, so disk grows with the sets and the results alone, whatever the number of
candidates. A set has a sketch of BITS bits: each member flips one, and of two sketches as many bits differ as an odd
number of members flipped that only one set has; never more than there are such members. A sketch folded onto itself is the
shorter sketch of the same set. All pairs within the sizes that the threshold allows are compared by folded sketches, long
enough for the sizes, those that may still reach it by whole ones, those left by their sets.
"""

from __future__ import annotations

import zlib
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bits of a sketch, its words, words of the sketches that are compared first, and how many bits these have at
#: least for each member that a pair at the threshold has in one set only.
BITS = 4096
WORDS, FOLDS, ROOM = BITS // 64, (8, 16, 32, 64), 3
#: Standard deviations, and bits more, by which two whole sketches may differ beyond what a pair at the threshold is expected
#: to, where this is less than its members apart (sets of some thousands): less than one pair in a million is missed at the
#: threshold itself. Folded sketches, and whole ones of smaller sets, miss none.
DEVIATIONS, MORE = 5.0, 5.0
#: Sets and members that a block has at most (one set may be larger), and the sets of the first block; each has twice those of the one before.
BLOCK_SETS, BLOCK_MEMBERS, FIRST_SETS = 16384, 16_000_000, 1024
#: Members and candidates that are held at once.
SLICE = 1_000_000
#: Bits of a packed number's fields, and the lowest one's.
FIELD, LOW = 21, np.uint64((1 << 21) - 1)


def pack(codes: np.ndarray) -> bytes:
    """Sorted numbers as three fields of 21 bits (a shingle's characters), the first one's differences; like bytes lie together."""
    fields = np.empty((3, len(codes)), np.uint32)
    fields[0] = np.diff(codes >> np.uint64(2 * FIELD), prepend=np.uint64(0))
    fields[1:] = codes >> np.uint64(FIELD) & LOW, codes & LOW
    return zlib.compress(fields.view(np.uint8).reshape(-1, 4).T[:3].tobytes(), 1)


def unpack(packed) -> np.ndarray:
    low, middle, high = np.frombuffer(zlib.decompress(packed), np.uint8).reshape(3, 3, -1).astype(np.uint64)
    fields = low | middle << np.uint64(8) | high << np.uint64(16)
    return np.cumsum(fields[0]) << np.uint64(2 * FIELD) | fields[1] << np.uint64(FIELD) | fields[2]


def sketch(codes: np.ndarray) -> bytes:
    h = codes * np.uint64(0x9E3779B97F4A7C15)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) >> np.uint64(52)
    return np.packbits((np.bincount(h.astype(np.int64), minlength=BITS) & 1).astype(np.uint8)).tobytes()


def folded(words: np.ndarray, many: int) -> np.ndarray:
    """Sketches, words first, folded to many words."""
    return words if many == WORDS else np.bitwise_xor.reduce(words.reshape(WORDS // many, many, *words.shape[1:]))


class Block:
    """Sets, by size: seq, their sizes, sketches and packed members; what is derived from these is made where it is used."""

    def __init__(self, seq: np.ndarray, n: np.ndarray, sketches: np.ndarray, codes: list[bytes]):
        at = np.lexsort((seq, n))
        self.seq, self.n, self.words, self.codes = seq[at], n[at], np.ascontiguousarray(sketches[at].T), [codes[k] for k in at]

    @classmethod
    def of(cls, table: pa.Table) -> Block:
        """The sets of seq, n, codes, sketch."""
        flat = b"".join(table.column("sketch").to_pylist())
        return cls(table.column("seq").to_numpy(), table.column("n").to_numpy(), np.frombuffer(flat, np.uint64).reshape(-1, WORDS), table.column("codes").to_pylist())

    def only(self, mask: np.ndarray) -> Block:
        return Block(self.seq[mask], self.n[mask], self.words.T[mask], [c for c, m in zip(self.codes, mask, strict=True) if m])

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k in ("seq", "n", "words", "codes")}

    @cached_property
    def rows(self) -> np.ndarray:
        return np.ascontiguousarray(self.words.T)

    @cached_property
    def folds(self) -> dict[int, np.ndarray]:
        return {many: folded(self.words, many) for many in FOLDS}

    @cached_property
    def ends(self) -> np.ndarray:
        return np.concatenate([[0], np.cumsum(self.n, dtype=np.int64)])

    @cached_property
    def members(self) -> tuple[np.ndarray, pa.Array]:
        """All sets' members one after the other as places in the block's distinct members, and these."""
        found = np.empty(int(self.ends[-1]), np.uint64)
        for k, packed in enumerate(self.codes):
            found[self.ends[k] : self.ends[k + 1]] = unpack(packed)
        coded = pa.array(found).dictionary_encode()
        del found
        places = coded.indices.to_numpy()
        return places.astype(np.uint16 if len(coded.dictionary) <= 1 << 16 else np.int32), coded.dictionary


class Limits:
    """Bits in which the sketches of a pair may differ, by the members of both sets, for the members that only one has at the threshold."""

    def __init__(self, threshold: float, largest: int):
        """largest: the sum of the sizes of any pair."""
        apart = np.floor(np.arange(largest + 1) * ((1 - threshold) / (1 + threshold)) + 1e-6)
        p = (1 - np.exp(-2 * apart / BITS)) / 2
        likely = BITS * p + DEVIATIONS * np.sqrt(BITS * p * (1 - p)) + MORE
        self.folded, self.whole = (np.minimum(x, BITS).astype(np.uint16) for x in (apart, np.minimum(apart, likely)))
        self.many = np.array(FOLDS)[np.minimum(np.searchsorted(np.array(FOLDS) * 64 // ROOM, apart[::2]), len(FOLDS) - 1)]


class Comparison:
    """Finds the sets of a block whose similarity to one is at least the threshold."""

    def __init__(self, block: Block, threshold: float):
        self.block, self.threshold = block, threshold
        self.limits = Limits(threshold, int((1 + 1 / threshold) * block.n[-1]) + 2 if len(block.n) else 0)
        self.flags = np.zeros(len(block.members[1]), np.uint8)
        self.room = np.empty(len(block.n), np.uint64), np.empty(len(block.n), np.uint8), np.empty(len(block.n), np.uint8)

    def near(self, n: int, words: np.ndarray, seq: int, allowed: np.ndarray | None = None) -> np.ndarray:
        """Places of the sets before seq, of those allowed, that sizes and sketches do not rule out."""
        block, limits = self.block, self.limits
        lo = block.n.searchsorted(np.int32(np.ceil(n * self.threshold - 1e-6)))
        hi = block.n.searchsorted(np.int32(np.floor(n / self.threshold + 1e-6)), "right")
        if lo >= hi:
            return np.empty(0, np.int64)
        many = int(limits.many[min(n, len(limits.many) - 1)])
        theirs, own = block.folds[many], folded(words, many)
        other, bits, some = (x[: hi - lo] for x in self.room)
        apart = np.zeros(hi - lo, np.uint16)
        for k in range(many):
            np.bitwise_xor(theirs[k, lo:hi], own[k], out=other)
            if k % 3 == 0:  # three words differ in 192 bits at most
                np.bitwise_count(other, out=some)
            else:
                some += np.bitwise_count(other, out=bits)
            if k % 3 == 2 or k == many - 1:
                apart += some
        at = np.flatnonzero(apart <= limits.folded[n + block.n[hi - 1]])
        at = at[(apart[at] <= limits.folded[n + block.n[lo + at]]) & (block.seq[lo + at] < seq)] + lo
        at = at if allowed is None else at[allowed[at]]
        apart = np.bitwise_count(block.rows[at] ^ words).sum(1, dtype=np.uint16)
        return at[apart <= limits.whole[n + block.n[at]]]

    def similarity(self, places: np.ndarray, n: int, at: np.ndarray) -> np.ndarray:
        """Of the set whose members are at places of the block's (those that the block has) and that has n, to the sets at."""
        block, flags = self.block, self.flags
        flags[places] = 1
        common = np.array([np.count_nonzero(flags[block.members[0][block.ends[k] : block.ends[k + 1]]]) for k in at], np.int64)
        flags[places] = 0
        return common / (n + block.n[at] - common)

    def first(self, places: np.ndarray, n: int, at: np.ndarray) -> int | None:
        """The smallest seq of the sets at that are similar; none is compared after it."""
        block = self.block
        at, flags = at[np.argsort(block.seq[at])], self.flags
        flags[places] = 1
        found = None
        for k in at:
            common = int(np.count_nonzero(flags[block.members[0][block.ends[k] : block.ends[k + 1]]]))
            if common / (n + int(block.n[k]) - common) >= self.threshold:
                found = int(block.seq[k])
                break
        flags[places] = 0
        return found

    def streamed(self, batch: pa.RecordBatch):
        """(seq, n, places of the near sets, places of the members) of each set of batch (seq, n, codes, sketch) that has near ones."""
        seqs, sizes = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        waiting, members = [], 0
        for k in range(batch.num_rows):
            at = self.near(int(sizes[k]), np.frombuffer(batch.column(3)[k].as_py(), np.uint64), seqs[k])
            if len(at):
                waiting.append((k, at))
                members += int(sizes[k]) + len(at)
            if waiting and (members >= SLICE or k == batch.num_rows - 1):
                yield from self._placed(batch, waiting, seqs, sizes)
                waiting, members = [], 0
        yield from self._placed(batch, waiting, seqs, sizes)

    def _placed(self, batch, waiting, seqs, sizes):
        if not waiting:
            return
        codes = [unpack(batch.column(2)[k].as_py()) for k, _ in waiting]
        places = pc.fill_null(pc.index_in(pa.array(np.concatenate(codes)), self.block.members[1]), -1).to_numpy()
        end = 0
        for (k, at), own in zip(waiting, codes, strict=True):
            mine = places[end : end + len(own)]
            end += len(own)
            yield int(seqs[k]), int(sizes[k]), at, mine[mine >= 0]


def first_come(block: Block, threshold: float) -> tuple[np.ndarray, list[tuple[int, int]]]:
    """(which sets of the block are kept if they come in the order of seq, (seq, canonical) of the others)."""
    compare, kept, gone = Comparison(block, threshold), np.zeros(len(block.seq), bool), []
    for k in np.argsort(block.seq):
        n = int(block.n[k])
        at = compare.near(n, block.rows[k], block.seq[k], kept)
        first = compare.first(block.members[0][block.ends[k] : block.ends[k + 1]], n, at) if len(at) else None
        if first is None:
            kept[k] = True
        else:
            gone.append((int(block.seq[k]), first))
    return kept, gone


def first_similar(sent, threshold: float):
    """A function over batches (seq, n, codes, sketch): (seq, canonical), the smallest similar seq before it of the block that was sent."""

    def run(batches):
        compare = None
        for batch in batches:
            compare = compare or Comparison(sent.value, threshold)
            found = [(seq, first) for seq, n, at, places in compare.streamed(batch) if (first := compare.first(places, n, at)) is not None]
            yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in found], pa.int64()) for k in (0, 1)], ["seq", "canonical"])

    return run


def all_similar(sent, threshold: float):
    """A function over batches (seq, n, codes, sketch): (a, b, similarity) of all similar sets a of the block before each b."""

    def run(batches):
        compare = None
        for batch in batches:
            compare = compare or Comparison(sent.value, threshold)
            found = [[], [], []]
            for seq, n, at, places in compare.streamed(batch):
                similarity = compare.similarity(places, n, at)
                enough = similarity >= threshold
                for out, values in zip(found, (compare.block.seq[at[enough]], np.full(enough.sum(), seq), similarity[enough]), strict=True):
                    out.append(values)
                if len(found[0]) >= 4096:
                    yield _pairs(found)
                    found = [[], [], []]
            yield _pairs(found)

    return run


def _pairs(found) -> pa.RecordBatch:
    kinds = (np.int64, np.int64, np.float64)
    return pa.RecordBatch.from_arrays([pa.array(np.concatenate([np.empty(0, kind), *x]).astype(kind)) for x, kind in zip(found, kinds, strict=True)], ["a", "b", "similarity"])
