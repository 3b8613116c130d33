"""SimHash near-duplicates by BK-trees.

Fingerprints that differ in at most ``RADIUS`` bits agree in one of ``RADIUS + 1`` groups of bits.
The fingerprints of a shard agree in one such group; each shard gets a BK-tree, whose children
are keyed by the whole Hamming distance to their parent, and every fingerprint of the shard
follows only the edges within the radius. Trees reach the tasks of their searchers by the
shuffle: no table of all fingerprints goes through the driver. A shard that is too large
for one task is dealt again by groups of its other bits; what is still too large after
``DEALS`` deals is cut into several trees, and every part of the shard searches each of them.
A shard returns a spanning forest of its links, never all pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dunlin.cluster.components import connected_components
from dunlin.llm.forest import Forest
from dunlin.operators.joins import lookup_join, salted_join
from dunlin.session import materialize

RADIUS = 2
SEED = 42
TREE = 4096  # fingerprints of a tree, and of those that search it together
DEALS = 3
CHUNK = 1 << 16  # shingles counted at a time
FRONTIER = 1 << 20  # pairs of searcher and node held at a time


def fingerprint(text: bytes | None, size: int = 3) -> int:
    """Signed 64-bit SimHash over the shingles of ``size`` words, repeats included; 0 without words."""
    words = (text or b"").lower().split()  # bytes: A-Z only, and \x20 and \x09-\x0D only
    if not words:
        return 0
    size = min(size, len(words))
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.append(0, ends[:-1] + 1)[: len(words) - size + 1].tolist()
    ends = ends[size - 1 :].tolist()
    ones = np.zeros(64, np.int64)
    for i in range(0, len(starts), CHUNK):
        spans = zip(starts[i : i + CHUNK], ends[i : i + CHUNK])
        hashes = b"".join([xxhash.xxh64_digest(joined[a:b], SEED) for a, b in spans])  # high byte first
        bits = np.unpackbits(np.frombuffer(hashes, np.uint8).reshape(-1, 8), axis=1)
        ones += bits.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(starts)).tobytes(), "big", signed=True)


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 3) -> DataFrame:
    """Rows ``(id, fp)``, one per row of ``docs``."""

    def take(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [fingerprint(t, size) for t in batch.column("text").cast(pa.binary()).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(found, pa.int64())], ["id", "fp"])

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(take, "id long, fp long")


class BKTrees:
    """One BK-tree per shard, grown together level by level.

    ``codes`` are 64-bit numbers, different inside a shard; ``shard`` is sorted. The first code of a
    shard is its root. Of the codes at one distance from a node the first becomes its
    child with that key, the others go below it.
    """

    def __init__(self, codes: np.ndarray, shard: np.ndarray):
        self.codes = codes
        first = np.ones(len(shard), bool)
        first[1:] = shard[1:] != shard[:-1]
        self.roots = np.flatnonzero(first)
        node = (np.cumsum(first) - 1).astype(np.int64)
        parent = self.roots[node]  # of the codes that have no place yet
        rest = np.flatnonzero(~first)
        keys, children = [], []
        while len(rest):
            above = parent[rest]
            edge = above * 65 + np.bitwise_count(codes[rest] ^ codes[above]).astype(np.int64)
            order = np.argsort(edge, kind="stable")
            rest, edge = rest[order], edge[order]
            first = np.ones(len(rest), bool)
            first[1:] = edge[1:] != edge[:-1]
            child = rest[first]
            keys.append(edge[first])
            children.append(child)
            parent[rest] = child[np.cumsum(first) - 1]
            rest = rest[~first]
        keys = np.concatenate([np.zeros(0, np.int64), *keys])
        children = np.concatenate([np.zeros(0, np.int64), *children])
        order = np.argsort(keys)
        self.keys, self.children = keys[order], children[order]

    def near(self, codes: np.ndarray, root: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
        """Indexes of searcher and node of all pairs within ``radius``; ``codes[i]`` searches the tree at ``root[i]``."""
        who, at, found = np.arange(len(codes)), root, []
        while len(who):
            gap = np.bitwise_count(codes[who] ^ self.codes[at]).astype(np.int64)
            near = gap <= radius
            found.append((who[near], at[near]))
            next_who, next_at = [], []
            for move in range(-radius, radius + 1):
                edge = gap + move
                key = at * 65 + edge
                spot = np.searchsorted(self.keys, key)
                spot[spot == len(self.keys)] = 0
                on = (edge > 0) & (edge <= 64) & (self.keys[spot] == key) if len(self.keys) else np.zeros(len(key), bool)
                next_who.append(who[on])
                next_at.append(self.children[spot[on]])
            who, at = np.concatenate(next_who), np.concatenate(next_at)
        return tuple(np.concatenate(side) for side in zip(*found)) if found else (who, at)


def _forest(tree: np.ndarray, tree_shard: np.ndarray, searchers: np.ndarray, shard: np.ndarray, radius: int):
    """Spanning forest, as pairs of codes, of what ``searchers`` find in the trees of their shards."""
    trees = BKTrees(tree, tree_shard)
    own = np.searchsorted(tree_shard[trees.roots], shard)
    sizes = np.diff(np.append(trees.roots, len(tree)))
    forest = Forest(len(tree) + len(searchers))
    work = np.cumsum(sizes[own])
    for low in range(0, int(work[-1]), FRONTIER):
        part = slice(*np.searchsorted(work, [low, low + FRONTIER], side="right"))
        who, at = trees.near(searchers[part], trees.roots[own[part]], radius)
        forest.link(who + part.start + len(tree), at)
    codes = np.concatenate([tree, searchers])
    a, b = forest.edges()
    differ = codes[a] != codes[b]
    return codes[a[differ]], codes[b[differ]]


def _whole_shards(batches: Iterator[pa.RecordBatch], keys: tuple[str, ...]) -> Iterator[dict[str, np.ndarray]]:
    """Columns of a sorted stream, cut only where ``keys`` change; with ``shard``, a running number."""
    held: dict[str, np.ndarray] = {}
    for batch in batches:
        new = {c: batch.column(c).to_numpy() for c in batch.schema.names}
        held = {c: np.concatenate([held[c], new[c]]) for c in new} if held else new
        n = len(held["fp"])
        if not n:
            continue
        change = np.zeros(n, bool)
        for c in keys:
            change[1:] |= held[c][1:] != held[c][:-1]
        last = int(np.flatnonzero(change)[-1]) if change.any() else 0
        if last:
            shard = np.cumsum(change[:last])
            yield {c: v[:last] for c, v in held.items()} | {"shard": shard}
            held = {c: v[last:] for c, v in held.items()}
    if held and len(held["fp"]):
        change = np.zeros(len(held["fp"]), bool)
        for c in keys:
            change[1:] |= held[c][1:] != held[c][:-1]
        yield held | {"shard": np.cumsum(change)}


def _links(pairs: tuple[np.ndarray, np.ndarray]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(p, pa.int64()) for p in pairs], ["a", "b"])


def _one_tree_links(dealt: DataFrame, radius: int) -> DataFrame:
    """Forests of the shards that fit one tree."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _whole_shards(batches, ("path", "key")):
            count = np.bincount(rows["shard"])[rows["shard"]]
            codes, shard = rows["fp"][count > 1], rows["shard"][count > 1]
            if len(codes):
                yield _links(_forest(codes, shard, codes, shard, radius))

    return dealt.repartition("path", "key").sortWithinPartitions("path", "key", "fp").mapInArrow(search, "a long, b long")


def _many_tree_links(dealt: DataFrame, counted: DataFrame, radius: int, most: int) -> DataFrame:
    """Forests of the shards cut into several trees: every part of a shard searches every tree."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _whole_shards(batches, ("path", "key", "tree", "part")):
            in_tree = rows["side"] == 0
            tree, shard = rows["fp"][in_tree], rows["shard"][in_tree]
            known = np.isin(rows["shard"], shard) & ~in_tree
            if known.any():
                yield _links(_forest(tree, shard, rows["fp"][known], rows["shard"][known], radius))

    rows = lookup_join(dealt, counted.withColumn("parts", F.ceil(F.col("rows") / most).cast("int")), ["path", "key"])
    own = F.pmod(F.xxhash64("fp"), F.col("parts")).cast("int")
    every = F.explode(F.sequence(F.lit(0), F.col("parts") - 1))
    trees = rows.select("path", "key", "fp", own.alias("tree"), every.alias("part"), F.lit(0).alias("side"))
    parts = rows.select("path", "key", "fp", every.alias("tree"), own.alias("part"), F.lit(1).alias("side"))
    task = ["path", "key", "tree", "part"]
    both = trees.where("tree >= part").unionByName(parts.where("tree >= part"))
    both = both.repartition(*task).sortWithinPartitions(*task, "side", "fp")
    return both.mapInArrow(search, "a long, b long")


def _groups(bits: list[int], parts: int) -> list[list[int]]:
    cuts = [len(bits) * i // parts for i in range(parts + 1)]
    return [bits[a:b] for a, b in zip(cuts, cuts[1:])]


def _signed(bits: list[int]) -> int:
    mask = sum(1 << b for b in bits)
    return mask - (1 << 64) if mask >> 63 else mask


def near_links(codes: DataFrame, radius: int = RADIUS, most: int = TREE) -> DataFrame:
    """Pairs ``a, b`` that join all of the different ``fp`` of ``codes`` that links join, few per shard."""
    spark = codes.sparkSession
    out = spark.createDataFrame([], "a long, b long")
    fixed: list[list[int]] = [[]]  # the bits in which the shards of a path agree
    rows = codes.select("fp", F.lit(0).alias("path"))
    for deal in range(DEALS):
        fixed = [old + new for old in fixed for new in _groups([b for b in range(64) if b not in old], radius + 1)]
        masks = F.array(*[F.lit(_signed(bits)) for bits in fixed])
        path = F.explode(F.sequence(F.col("path") * (radius + 1), F.col("path") * (radius + 1) + radius)).alias("path")
        dealt = rows.select("fp", path)
        dealt = dealt.withColumn("key", F.col("fp").bitwiseAND(F.get(masks, F.col("path"))))
        counted = dealt.groupBy("path", "key").agg(F.count("*").alias("rows")).where(F.col("rows") > most)
        counted = materialize(counted, "simhash-large")
        large = counted.limit(1).count() > 0
        small = dealt
        if large:
            marked = lookup_join(dealt, counted, ["path", "key"], "left")
            dealt = materialize(marked, "simhash-dealt")
            small, dealt = dealt.where("rows is null").drop("rows"), dealt.where("rows is not null").drop("rows")
        out = out.unionByName(_one_tree_links(small, radius))
        if not large:
            return out
        rows = dealt.select("fp", "path")
    return out.unionByName(_many_tree_links(dealt, counted, radius, most))


def simhash_components(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", radius: int = RADIUS, most: int = TREE
) -> DataFrame:
    """Rows ``(id, fp, component_id)``, one per row of ``docs``.

    ``fp`` is the SimHash of the 3-word shingles of the text (ASCII letters in lower case, XXH64
    with seed 42; a bit is 1 if set in over half of the shingles). Fingerprints of at most
    ``radius`` differing bits link; ``component_id`` is the smallest id reachable by links.

    A null text or one without words has the fingerprint 0 and is linked like any other; one of
    fewer than three words is one shingle. Repeated rows have equal fingerprints and are all
    returned. A row with a null id takes part; its component has the smallest id that is not
    null. Other columns are ignored. An empty table gives no rows.
    """
    profile = materialize(fingerprints(docs, id_col, text_col), "simhash-rows")
    classes = materialize(profile.groupBy("fp").agg(F.min("id").alias("least")), "simhash-classes")
    links = materialize(near_links(classes.select("fp"), radius, most).distinct(), "simhash-links")
    nodes = links.select(F.col("a").alias("node")).union(links.select("b")).distinct()
    found = connected_components(nodes, links).withColumnRenamed("node", "fp")
    classes = classes.join(found, "fp", "left").withColumn("component", F.coalesce("component", "fp"))
    least = classes.groupBy("component").agg(F.min("least").alias("component_id"))
    classes = materialize(classes.join(least, "component").select("fp", "component_id"), "simhash-least")
    return salted_join(profile, classes, ["fp"], "left").select("id", "fp", "component_id")
