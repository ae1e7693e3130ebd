"""Near-duplicate groups by an LSH forest with exact confirmation.

Every distinct shingle set has a signature of some runs of SHALLOW MinHash values. Each run is one sorted order
of the corpus; neighbours in it that share all its values are candidates. In a region (sets that candidates
connect) all sets are compared exactly, in postings of their shingles, whatever their signatures say. The depth
adapts to the region: the sets of very large ones are signed anew with more and longer runs, of DEEP values, whose
candidates make smaller regions of them.

A region is compared in blocks. Each block compares its sets exactly and names leaders: every set is a leader or links
with one, and a leader's radius is the largest distance of such a set. Only leaders meet those of other blocks. Jaccard
distance is a metric: where two leaders are further apart than the links' distance and both radii, none of their
sets link; where they link, the sets are connected already; else the sets themselves are compared, unless other links
have connected them by then, in meetings of two blocks. So a group of near copies of any size is compared in time that grows
with its blocks, not with their square, and no link between different groups is lost.

With s the similarity and d the depth, a pair is missed with probability (1 - s ** d) ** runs. At either depth there
are as many runs as bring this to MISSED / 2 where s is the threshold: 17 of 4 values and 40 of 8 at 0.85, 24 and 69
at 0.80. So a pair at the threshold is missed with probability MISSED at most, however large its region is.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .kit import hashed_words, staged, window_hashes

WORDS, PERCENT = 5, 85
SHALLOW, DEEP = 4, 8
#: Highest probability that a pair at the threshold is missed.
MISSED = 7.5e-6
#: Most sets and text bytes of a region that one task compares at once; a larger one is cut into blocks.
REGION_SETS, REGION_BYTES = 4096, 16 << 20
#: The sets of a region of more blocks than this are signed anew first.
REGION_BLOCKS = 8


def runs(percent: int, depth: int, missed: float) -> int:
    """The least number of runs of depth values of which a pair at the threshold shares none with probability missed at most."""
    return math.ceil(math.log(missed) / math.log1p(-((percent / 100) ** depth))) if percent < 100 else 1


@lru_cache
def functions(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Odd factors and terms of n hash functions."""
    random = np.random.default_rng(20170613)
    return (random.integers(1, 2**63, n, dtype=np.uint64) << np.uint64(1)) | np.uint64(1), random.integers(0, 2**63, n, dtype=np.uint64)


def shingles(text: str | None) -> np.ndarray:
    """The sorted distinct hashes of a text's word windows, A-Z in lower case; the whole sequence where it has fewer words."""
    return np.unique(window_hashes(hashed_words((text or "").encode("utf-8", "surrogatepass").lower().split()), WORDS))


def signature(found: np.ndarray, n: int) -> bytes:
    """n MinHash values, 16 bits of each, in big-endian order so that bytes sort as values do."""
    factors, terms = functions(n)
    least = np.full(n, np.iinfo(np.uint64).max, np.uint64)
    for k in range(0, len(found), 1024):
        np.minimum(least, (found[None, k : k + 1024] * factors[:, None] + terms[:, None]).min(1), out=least)
    return ((least * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(48)).astype(">u2").tobytes()


def signatures(docs: DataFrame, values: int) -> DataFrame:
    """doc_id, n_shingles, the set's digest as two longs (null for no shingles), its signature of so many values, bytes of text."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        for batch in batches:
            n, high, low, signs, size = [], [], [], [], []
            for text in batch.column(1):
                found = shingles(text.as_py())
                n.append(len(found))
                digest = xxhash.xxh3_128_digest(found.tobytes())
                high.append(int.from_bytes(digest[:8], "big", signed=True) if n[-1] else None)
                low.append(int.from_bytes(digest[8:], "big", signed=True) if n[-1] else None)
                signs.append(signature(found, values) if n[-1] else None)
                size.append(len(text.as_py() or ""))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(high, pa.int64()), pa.array(low, pa.int64()), pa.array(signs, pa.binary()), pa.array(size, pa.int64())], ["doc_id", "n_shingles", "high", "low", "signature", "size"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(sign, f"doc_id {kind}, n_shingles long, high long, low long, signature binary, size long")


def neighbours(signed: DataFrame, trees: int, depth: int) -> DataFrame:
    """(a, b): sets next to each other in one of the sorted orders, with the same run of depth values.

    The orders are cut by range, ties by node, so no run gathers in one task; each cut's two sides meet afterwards.
    """
    spark = signed.sparkSession
    wide = 2 * depth
    kind = signed.schema["node"].dataType.simpleString()
    rows = signed.select(F.explode(F.sequence(F.lit(0), F.lit(trees - 1))).alias("tree"), "signature", "node").select(
        "tree", F.expr(f"substring(signature, tree * {wide} + 1, {wide})").alias("key"), "node"
    )

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def side(tree, key, node):
            return pa.RecordBatch.from_arrays([pa.array(node), pa.nulls(len(node), node.type), pa.array(tree, pa.int32()), pa.array(key, pa.binary())], ["a", "b", "tree", "key"])

        last = None
        for batch in batches:
            if not batch.num_rows:
                continue
            tree, key, node = batch.column(0), batch.column(1), batch.column(2)
            if last is None:
                yield side(tree.slice(0, 1).to_pylist(), key.slice(0, 1).to_pylist(), node.slice(0, 1))
            else:
                tree, key, node = (pa.concat_arrays([x, y]) for x, y in zip(last, (tree, key, node), strict=True))
            last = [x.slice(len(x) - 1) for x in (tree, key, node)]
            values = np.frombuffer(b"".join(key.to_pylist()), f"V{wide}")
            trees = tree.to_numpy(zero_copy_only=False)
            at = np.flatnonzero((values[1:] == values[:-1]) & (trees[1:] == trees[:-1]))
            if len(at):
                yield pa.RecordBatch.from_arrays([node.take(pa.array(at)), node.take(pa.array(at + 1)), pa.nulls(len(at), pa.int32()), pa.nulls(len(at), pa.binary())], ["a", "b", "tree", "key"])
        if last is not None:
            yield side(last[0].to_pylist(), last[1].to_pylist(), last[2])

    ordered = rows.repartitionByRange(int(spark.conf.get("spark.sql.shuffle.partitions")), "tree", "key", "node").sortWithinPartitions("tree", "key", "node")
    met = staged(ordered.mapInArrow(meet, f"a {kind}, b {kind}, tree int, key binary"), "neighbours")
    # two rows for each partition
    sides = sorted((r.tree, bytes(r.key), r.a) for r in met.where("tree is not null").collect())
    across = [(a, b) for (t, k, a), (u, m, b) in zip(sides, sides[1:]) if (t, k) == (u, m)]
    links = met.where("tree is null").select("a", "b").union(spark.createDataFrame(across, f"a {kind}, b {kind}"))
    return links.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def rooted(pairs: Iterator[tuple]) -> dict:
    """Union-find: each name that occurs to the smallest name it is connected with."""
    up: dict = {}

    def root(x):
        up.setdefault(x, x)
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    for x, y in pairs:
        x, y = root(x), root(y)
        if x != y:
            up[max(x, y)] = min(x, y)
    return {x: root(x) for x in up}


def components(edges: DataFrame) -> DataFrame:
    """(node, root): every node of the edges (a, b) with the smallest node it is connected with.

    Each partition first contracts its own edges; then large-star and small-star steps alternate until the
    edges no longer change. Stars are built with an aggregate and a join, so that a node with very many edges
    can be split over tasks.
    """
    kind = edges.schema["a"].dataType.simpleString()

    def contract(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            found = rooted(zip(frame["a"].tolist(), frame["b"].tolist(), strict=True))
            pairs = [(x, r) for x, r in found.items() if x != r]
            yield pd.DataFrame(pairs, columns=["a", "b"])

    def stars(pairs: DataFrame, large: bool) -> DataFrame:
        """pairs: (a, b) with a > b."""
        both = pairs.select("a", "b").union(pairs.select(F.col("b").alias("a"), F.col("a").alias("b"))) if large else pairs
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        moved = both.join(least, "a")
        if large:
            out = moved.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        else:
            out = moved.select(F.col("b").alias("a"), F.col("m").alias("b")).union(least.select("a", F.col("m").alias("b")))
        return out.where("a > b").distinct()

    pairs = staged(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).mapInPandas(contract, f"a {kind}, b {kind}").distinct(), "pairs")
    mark = lambda x: tuple(x.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
    before = mark(pairs)
    while before[0]:
        pairs = staged(stars(stars(pairs, True), False), "pairs")
        now = mark(pairs)
        if now == before:
            break
        before = now
    return pairs.select(F.col("a").alias("node"), F.col("b").alias("root")).union(pairs.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())


def overlaps(sets: list[np.ndarray]) -> Iterator[tuple[int, np.ndarray]]:
    """(x, how many elements x has in common with each set before it), found through postings of the elements."""
    n = len(sets)
    if not n:
        return
    size = np.array([len(x) for x in sets], np.int64)
    owner = np.repeat(np.arange(n), size)
    order = np.argsort(np.concatenate(sets), kind="stable")
    values, owners = np.concatenate(sets)[order], owner[order]
    starts = np.flatnonzero(np.append(True, values[1:] != values[:-1]))
    stops = np.append(starts[1:], len(values))
    group = np.empty(len(values), np.int64)
    group[order] = np.repeat(np.arange(len(starts)), stops - starts)
    at = 0
    for x in range(n):
        own = group[at : at + size[x]]
        at += size[x]
        own = own[stops[own] - starts[own] > 1]
        many = stops[own] - starts[own]
        if not len(own):
            yield x, np.zeros(x, np.int64)
            continue
        ends = np.cumsum(many)
        met = owners[np.repeat(starts[own] - (ends - many), many) + np.arange(ends[-1])]
        yield x, np.bincount(met, minlength=n)[:x]


def clustered(names: list, sets: list[np.ndarray], percent: int = PERCENT) -> tuple[dict, np.ndarray, np.ndarray]:
    """(each name's smallest name over links, each set's leader, the distance to it): sets link with 100 * intersection >= percent * union.

    A set that links with no leader before it is a leader; others have the nearest, the first of equals.
    """
    n = len(sets)
    size = np.array([len(x) for x in sets], np.int64)
    label, leader, distance = np.arange(n), np.arange(n), np.zeros(n)
    for x, common in overlaps(sets):
        union = size[:x] + size[x] - common
        links = np.flatnonzero(100 * common >= percent * union)
        if not len(links):
            continue
        label[np.isin(label, label[links])] = label[links[0]]
        label[x] = label[links[0]]
        heads = links[leader[links] == links]
        if len(heads):
            apart = 1 - common[heads] / union[heads]
            leader[x], distance[x] = heads[apart.argmin()], apart.min()
    least: dict[int, object] = {}
    for k, name in zip(label.tolist(), names, strict=True):
        least[k] = min(name, least.get(k, name))
    # sets of one name are connected
    return rooted((name, least[k]) for k, name in zip(label.tolist(), names, strict=True)), leader, distance


def linked(names: list, sets: list[np.ndarray], percent: int = PERCENT) -> dict:
    """Each name's smallest name over the links of the sets, all compared."""
    return clustered(names, sets, percent)[0]


def regions(edges: DataFrame, sizes: DataFrame, deeper: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """(node, region, blocks): what candidates connect; blocks is 1 for a region that one task compares, else into how many it must be cut.

    deeper gives the candidates among the nodes of very large regions, complete by themselves, which connect less.
    """

    def placed(edges: DataFrame) -> DataFrame:
        found = components(edges).join(sizes, "node")
        # written out, so that a region with very many sets can be split over tasks in the join below
        found = staged(found, "rooted")
        totals = staged(found.groupBy("root").agg(F.count("*").alias("n"), F.sum("size").alias("bytes")), "totals")
        need = F.greatest(F.lit(1), F.ceil(F.col("n") / F.lit(REGION_SETS)), F.ceil(F.col("bytes") / F.lit(REGION_BYTES))).cast("int")
        return staged(found.join(totals.select("root", need.alias("blocks")), "root").select("node", F.col("root").alias("region"), "blocks"), "regions")

    found = placed(edges)
    large = found.where(F.col("blocks") > REGION_BLOCKS)
    if not large.take(1):
        return found
    return found.where(F.col("blocks") <= REGION_BLOCKS).union(placed(deeper(large.select("node"))))


def _sets_of(names: list, texts: list) -> tuple[list, list[np.ndarray]]:
    """Names and shingle sets of texts, without empty ones and without a name's repeated sets."""
    out, sets, seen = [], [], set()
    for name, text in zip(names, texts, strict=True):
        found = shingles(text)
        key = (name, found.tobytes())
        if len(found) and key not in seen:
            seen.add(key)
            out.append(name)
            sets.append(found)
    return out, sets


def confirmed(placed: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """(node, root): the sets of placed (node, region, blocks) that link with others, each with the smallest it is connected with.

    texts: node, text. Every block is compared by itself; of regions with more than one, leaders and what they leave open.
    """
    kind = placed.schema["node"].dataType.simpleString()
    near = 1 - percent / 100
    columns = ["step", "a", "b", "final", "distance", "region", "block", "elements"]
    schema = f"step string, a {kind}, b {kind}, final boolean, distance double, region {kind}, block int, elements binary"
    cut = placed.withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))

    def frame_of(rows: list[tuple]) -> pd.DataFrame:
        return pd.DataFrame(rows, columns=columns)

    def within(frame: pd.DataFrame) -> pd.DataFrame:
        names, sets = _sets_of(frame["node"].tolist(), frame["text"].tolist())
        roots, leader, distance = clustered(names, sets, percent)
        region, block, final = frame["region"].iloc[0], int(frame["block"].iloc[0]), bool(frame["blocks"].iloc[0] == 1)
        rows = [("link", x, r, final, 0.0, region, block, None) for x, r in roots.items() if x != r]
        if not final:
            radius = np.zeros(len(names))
            np.maximum.at(radius, leader, distance)
            rows += [("leader", names[k], names[k], False, radius[k], region, block, sets[k].tobytes()) for k in np.unique(leader).tolist()]
            rows += [("set", names[k], names[x], False, distance[k], region, block, None) for k, x in enumerate(leader.tolist())]
        return frame_of(rows)

    first = staged(cut.join(texts, "node").groupBy("region", "block").applyInPandas(within, schema), "blocks")
    final = first.where("step = 'link' and final").select(F.col("a").alias("node"), F.col("b").alias("root"))
    leaders = first.where("step = 'leader'").select(F.col("a").alias("node"), "region", "block", F.col("distance").alias("radius"), "elements")
    if not leaders.take(1):
        return final

    # leaders meet those of other blocks of their region, again in parts that one task can hold
    held = staged(leaders.groupBy("region").agg(F.greatest(F.ceil(F.count("*") / F.lit(REGION_SETS)), F.ceil(F.sum(F.length("elements")) / F.lit(REGION_BYTES)), F.lit(1)).cast("int").alias("parts")), "parts")
    dealt = leaders.join(held, "region").withColumn("part", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int")).withColumn("other", F.explode(F.expr("sequence(0, parts - 1)")))
    dealt = dealt.select("node", "region", "block", "radius", "elements", F.least("part", "other").alias("p"), F.greatest("part", "other").alias("q"))

    def across(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.drop_duplicates(["node", "elements"])
        names, blocks, radius = frame["node"].tolist(), frame["block"].to_numpy(), frame["radius"].to_numpy()
        sets, rows = [np.frombuffer(x, np.uint64) for x in frame["elements"]], []
        size = np.array([len(x) for x in sets], np.int64)
        region = frame["region"].iloc[0]
        for x, common in overlaps(sets):
            union = size[:x] + size[x] - common
            links = 100 * common >= percent * union
            apart = 1 - common / union
            open_ = ~links & (blocks[:x] != blocks[x]) & (apart <= near + radius[:x] + radius[x] + 1e-9)
            rows += [("link", names[x], names[y], False, 0.0, region, 0, None) for y in np.flatnonzero(links).tolist() if names[x] != names[y]]
            rows += [("open", names[x], names[y], False, apart[y], region, 0, None) for y in np.flatnonzero(open_).tolist()]
        return frame_of(rows)

    second = staged(dealt.groupBy("region", "p", "q").applyInPandas(across, schema), "leaders")
    edges = first.where("step = 'link' and not final").select("a", "b").union(second.where("step = 'link'").select("a", "b"))
    joined = staged(components(edges), "joined")

    # pairs of leaders that nothing has connected yet: their blocks' sets are compared, but for those that are too near to their leader to reach the other's
    heads = leaders.groupBy("node").agg(F.max("radius").alias("radius"), F.min("block").alias("block"), F.min("region").alias("region"))
    side = lambda x: joined.select(F.col("node").alias(x), F.col("root").alias(f"{x}_root"))
    met = second.where("step = 'open'").select("a", "b", "distance").distinct().join(side("a"), "a", "left").join(side("b"), "b", "left")
    met = staged(met.where(~F.coalesce("a_root", "a").eqNullSafe(F.coalesce("b_root", "b"))).select("a", "b", "distance"), "open")
    if met.take(1):
        head = lambda x: heads.select(F.col("node").alias(x), F.col("radius").alias(f"{x}_radius"), F.col("block").alias(f"{x}_block"), "region")
        pairs = met.join(head("a"), "a").join(head("b").drop("region"), "b").select("*", F.least("a_block", "b_block").alias("p"), F.greatest("a_block", "b_block").alias("q"))
        # how far from a leader a set must be at least to matter in a meeting of two blocks
        reach = lambda x, y: pairs.select(F.col(x).alias("leader"), "region", "p", "q", (F.col("distance") - near - F.col(f"{y}_radius")).alias("least"))
        reached = reach("a", "b").union(reach("b", "a")).groupBy("leader", "region", "p", "q").agg(F.min("least").alias("least"))
        sets = first.where("step = 'set'").select(F.col("a").alias("node"), F.col("b").alias("leader"), F.col("distance").alias("own"))
        wanted = sets.join(reached, "leader").where("own >= least - 1e-9").select("region", "p", "q", "node").distinct()

        def compared(frame: pd.DataFrame) -> pd.DataFrame:
            roots = linked(*_sets_of(frame["node"].tolist(), frame["text"].tolist()), percent)
            return pd.DataFrame([(x, r) for x, r in roots.items() if x != r], columns=["a", "b"])

        third = staged(wanted.join(texts, "node").groupBy("region", "p", "q").applyInPandas(compared, f"a {kind}, b {kind}"), "sets")
        joined = components(edges.union(third))
    return final.union(joined.where("node <> root").select("node", "root"))


def near_duplicates(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id (the smallest doc_id reachable over links), kept (doc_id = component_id).

    docs: doc_id, text; other columns are ignored. Sets link whose similarity is percent or more. A row for each input row. Null or empty texts have no shingles
    and link with nothing. Equal sets link at once by digest. Rows of one doc_id are versions of one document:
    what links with any of them is in its component. Rows without doc_id get the component of their exact copies,
    else null, and are kept only then. An empty table gives no rows.
    """
    trees, again = (runs(percent, depth, MISSED / 2) for depth in (SHALLOW, DEEP))
    signed = staged(signatures(docs, trees * SHALLOW), "signatures")
    # written out, so that below both sides of the join on it are dealt anew and a digest with very many copies can be split
    classes = staged(signed.where("high is not null").groupBy("high", "low").agg(F.min("doc_id").alias("node")), "classes")
    nodes = classes.where("node is not null").select("node").distinct()
    distinct = signed.where("high is not null").join(nodes, signed["doc_id"] == nodes["node"], "left_semi").select(F.col("doc_id").alias("node"), "signature", "size")
    edges = staged(neighbours(distinct.select("node", "signature"), trees, SHALLOW), "links")
    sizes = distinct.groupBy("node").agg(F.max("size").alias("size"))

    def deeper(nodes: DataFrame) -> DataFrame:
        named = docs.select("doc_id", "text").join(nodes, docs["doc_id"] == nodes["node"], "left_semi")
        resigned = staged(signatures(named, again * DEEP).where("high is not null").select(F.col("doc_id").alias("node"), "signature"), "resigned")
        return staged(neighbours(resigned, again, DEEP), "links")

    placed = regions(edges, sizes, deeper)
    texts = docs.select(F.col("doc_id").alias("node"), "text").where("text is not null")
    joined = confirmed(placed, texts, percent)
    out = signed.select("doc_id", "n_shingles", "high", "low").join(classes, ["high", "low"], "left").join(joined, "node", "left")
    component = F.coalesce("root", "node", "doc_id")
    return out.select("doc_id", "n_shingles", component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept"))
