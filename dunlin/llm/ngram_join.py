"""Jaccard join of documents on word n-grams as a blocked sparse product.

The incidence matrix has a row per distinct text and a column per 5-word
shingle. Its product with its own transpose holds all overlaps. It is never
formed whole:

* Columns are ordered from rare to frequent (inside the lowest ``ZONE`` of
  hashes, where document frequencies are counted exactly; other hashes follow in
  hash order). Two rows of ``n`` and ``m`` shingles that reach the threshold
  overlap in ``ceil(t * max(n, m))`` columns at least, so they share one of the
  first ``n - ceil(t * n) + 1`` columns of either row. Only that block of columns
  is multiplied. Columns with one row cannot add to a product and go first.
* Pairs outside the size bound (``100 * min < t * max``) are discarded; the rest get
  their whole overlap from the full rows, which are sent for such rows only.
* A column of many rows is not multiplied out. Its rows meet one pivot row first;
  rows that link join its component; only rows of different components are then
  multiplied, in blocks of whole rows. A task accumulates the overlaps of two blocks and
  returns a spanning forest of the links it finds, at most one row per component, never
  the pairs. Links inside a component that is already known change nothing in the answer.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dunlin.cluster.components import connected_components
from dunlin.llm.forest import Forest
from dunlin.llm.shingles import set_key, shingle_sets
from dunlin.operators.joins import salted_join
from dunlin.session import materialize

ZONE = 0.3  # share of the hash range in which frequencies are counted
ROUNDS = 2  # pivot rounds before rows of different components are paired
SHORT = 64  # columns of more rows are multiplied in blocks
BLOCK = 4096  # rows of such a block, on average at most
CELLS = 1 << 19  # shingles of such a block, on average at most
PART = 256, 2048  # rows and columns multiplied at a time
SLICE = 512  # texts whose shingles a task holds at a time
SEEN = 1 << 20  # sets that a task remembers, so as to send copies once
FILTER_BITS = 28  # the broadcast filter has at most 2 ** 28 bits, 32 MB

_SIGN = np.uint64(1 << 63)
_ZONE_END = int(ZONE * 2**64)


def _binary(batch: pa.RecordBatch, name: str) -> list[bytes | None]:
    return batch.column(name).cast(pa.binary()).to_pylist()


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    return (batch.slice(at, SLICE) for batch in batches for at in range(0, batch.num_rows, SLICE))


def _fresh(key: int, seen: set[int]) -> bool:
    if key in seen:
        return False
    if len(seen) >= SEEN:
        seen.clear()
    seen.add(key)
    return True


def shingle_profile(docs: DataFrame, id_col: str, text_col: str, size: int = 5) -> DataFrame:
    """Rows ``(id, n_shingles, zone, key)``.

    ``key`` is a 64-bit digest of the whole set, null if it is empty; ``zone`` counts
    the shingles inside the zone.
    """

    def profile(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches):
            sets = list(shingle_sets(_binary(batch, "text"), size))
            n = pa.array([len(s) for s in sets], pa.int64())
            zone = pa.array([_in_zone(s) for s in sets], pa.int32())
            keys = pa.array([set_key(s) if len(s) else None for s in sets], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("id"), n, zone, keys], ["id", "n_shingles", "zone", "key"])

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(profile, "id long, n_shingles long, zone int, key long")


def _in_zone(shingles: np.ndarray) -> int:
    return int(np.searchsorted(shingles, np.uint64(_ZONE_END)))


def _prefix_length(n: int, percent: int) -> int:
    """A row of ``n`` that links shares one of so many first columns, in any order."""
    return n + percent * -n // 100 + 1


def _columns(texts: DataFrame, percent: int, size: int) -> DataFrame:
    """Entries ``column, key`` of the matrix that may be in a prefix.

    A task sends a set once, however many copies it reads.
    """

    def entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in _slices(batches):
            columns, keys = [], []
            for s in shingle_sets(_binary(batch, "text"), size):
                if len(s) and _fresh(key := set_key(s), seen):
                    columns.append(s[: max(_in_zone(s), _prefix_length(len(s), percent))])
                    keys.append(key)
            if keys:
                key = np.repeat(np.array(keys, np.int64), [len(c) for c in columns])
                column = (np.concatenate(columns) ^ _SIGN).view(np.int64)  # keeps the order
                yield pa.RecordBatch.from_arrays([pa.array(column), pa.array(key)], ["column", "key"])

    return texts.mapInArrow(entries, "column long, key long")


def _shared(entries: DataFrame) -> DataFrame:
    """Entries of the columns that hold two rows or more, each once.

    Entries are sorted inside a partition and streamed; a task holds one batch and
    the last entry, however long a column is.
    """

    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, sent = None, False  # the entry before this batch, and whether it went out
        for batch in batches:
            column, key = (batch.column(i).to_numpy() for i in (0, 1))
            if last is not None:
                column, key = np.append(last[0], column), np.append(last[1], key)
            fresh = np.ones(len(column), bool)
            fresh[1:] = (column[1:] != column[:-1]) | (key[1:] != key[:-1])
            column, key = column[fresh], key[fresh]
            same = column[1:] == column[:-1]
            wide = np.zeros(len(column), bool)
            wide[1:] |= same
            wide[:-1] |= same
            out = wide.copy()
            out[0] &= not sent
            sent = bool(wide[-1]) or (sent and len(column) == 1)
            last = column[-1], key[-1]
            if out.any():
                yield pa.RecordBatch.from_arrays([pa.array(column[out]), pa.array(key[out])], ["column", "key"])

    return entries.repartition("column").sortWithinPartitions("column", "key").mapInArrow(runs, entries.schema)


def _prefixes(shared: DataFrame, sizes: DataFrame, percent: int) -> DataFrame:
    """Entries of each row's prefix, ``column, key, n, weight, inner``.

    ``weight`` is high for a row whose shingles are in many rows. ``inner`` marks the
    shorter prefix that suffices for the smaller row of a pair: it overlaps the larger
    one in ``2 t / (1 + t)`` of its shingles at least.
    """
    in_zone = F.col("column") < F.lit(_ZONE_END - 2**63)
    row = Window.partitionBy("key")
    known = shared.withColumn("df", F.when(in_zone, F.count("*").over(Window.partitionBy("column"))))
    # Zone entries that this row alone has were left out; they come first in the order.
    inside, weight = F.count("df").over(row), F.coalesce(F.sum("df").over(row), F.lit(0))
    place = F.row_number().over(row.orderBy(F.col("df").asc_nulls_last(), "column"))
    ranked = known.withColumns({"inside": inside, "weight": weight, "place": place}).join(sizes, "key")
    room = F.expr(f"n + floor(-{percent} * n / 100) + 1 - (zone - inside)")
    inner = F.expr(f"n + floor(-2 * {percent} * n / (100 + {percent})) + 1 - (zone - inside)")
    kept = ranked.where(F.col("place") <= room).withColumn("inner", F.col("place") <= inner)
    return kept.select("column", "key", "n", (F.col("weight") / F.col("n")).alias("weight"), "inner")


def _row_filter(keys: DataFrame) -> np.ndarray:
    """A bitmap over ``key mod size``, of bounded size, put together from its blocks."""
    n = max(keys.count(), 1)
    bits = min(FILTER_BITS, max(19, (32 * n).bit_length()))
    slots = keys.select(F.pmod(F.col("key"), F.lit(1 << bits)).alias("slot")).distinct()

    def fill(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        block = np.zeros(1 << 19, bool)
        block[pdf["slot"].to_numpy() & ((1 << 19) - 1)] = True
        return pd.DataFrame({"block": [key[0]], "bits": [np.packbits(block).tobytes()]})

    blocks = slots.groupBy(F.shiftright("slot", 19).alias("block")).applyInPandas(fill, "block long, bits binary")
    out = np.zeros(1 << (bits - 3), np.uint8)
    for r in blocks.toLocalIterator():  # at most 2 ** (bits - 19) rows of 64 KB
        out[r["block"] << 16 : (r["block"] + 1) << 16] = np.frombuffer(r["bits"], np.uint8)
    return out


def _full_rows(texts: DataFrame, keys: DataFrame, size: int) -> DataFrame:
    """Whole rows ``key, cells`` of the rows in ``keys``.

    A broadcast bitmap keeps back most rows nobody asked for; the join drops the rest.
    """
    wanted = texts.sparkSession.sparkContext.broadcast(_row_filter(keys))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits, seen = wanted.value, set()
        for batch in _slices(batches):
            found = []
            for s in shingle_sets(_binary(batch, "text"), size):
                if len(s):
                    key = set_key(s)
                    slot = key % (len(bits) * 8)
                    if bits[slot >> 3] >> (7 - (slot & 7)) & 1 and _fresh(key, seen):
                        found.append((key, s.tobytes()))
            if found:
                key, cells = (pa.array(c, t) for c, t in zip(zip(*found), types))
                yield pa.RecordBatch.from_arrays([key, cells], ["key", "cells"])

    types = (pa.int64(), pa.binary())
    found = texts.mapInArrow(rows, "key long, cells binary")
    return found.join(keys, "key", "left_semi").dropDuplicates(["key"])


def _linked(pairs: DataFrame, rows: DataFrame, percent: int) -> DataFrame:
    """The pairs ``a, b`` whose whole overlap reaches the threshold."""

    def overlaps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for a, b in zip(batch.column("x").to_pylist(), batch.column("y").to_pylist()):
                x, y = np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)
                at = np.searchsorted(x, y)
                at[at == len(x)] = 0
                common = int(np.count_nonzero(x[at] == y))
                keep.append(100 * common >= percent * (len(x) + len(y) - common))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    left = rows.select(F.col("key").alias("a"), F.col("cells").alias("x"))
    right = rows.select(F.col("key").alias("b"), F.col("cells").alias("y"))
    both = pairs.select("a", "b").join(left, "a").join(right, "b").select("a", "b", "x", "y")
    return both.mapInArrow(overlaps, "a long, b long")


def _mixed_columns(prefix: DataFrame, components: DataFrame | None) -> DataFrame:
    """Prefix entries with their component, of columns that hold more than one."""
    if components is None:
        placed = prefix.withColumn("comp", F.col("key"))
    else:
        found = components.select(F.col("node").alias("key"), "component")
        placed = prefix.join(found, "key", "left").withColumn("comp", F.coalesce("component", "key")).drop("component")
    sides = placed.groupBy("column").agg(
        F.min("comp").alias("low"), F.max("comp").alias("high"), F.count("*").alias("rows")
    )
    return placed.join(sides.where("low <> high").select("column", "rows"), "column")


def _pivot_pairs(mixed: DataFrame, turn: int, percent: int) -> DataFrame:
    """Each row of a column with one pivot row of the column.

    The first pivot is the row of most weight: among many near copies that is the
    text they were made from. Later pivots come from outside its component.
    """
    best = F.max(F.struct("weight", "key", "n", "comp"))
    pivot = mixed.groupBy("column").agg(best.alias("p"))
    if turn:
        rest = mixed.join(pivot.select("column", F.col("p.comp").alias("seen")), "column").where("comp <> seen")
        other = F.max(F.struct(F.xxhash64("key", F.lit(turn)).alias("o"), "key", "n", "comp"))
        pivot = rest.groupBy("column").agg(other.alias("p"))
    met = mixed.join(pivot, "column").where(F.col("comp") != F.col("p.comp"))
    met = met.where(_similar_size(F.col("n"), F.col("p.n"), percent))
    return met.select(F.col("key").alias("a"), F.col("p.key").alias("b")).distinct()


def _similar_size(n, m, percent: int):
    return 100 * F.least(n, m) >= percent * F.greatest(n, m)


def _sided(mixed: DataFrame) -> DataFrame:
    """``mixed`` with ``minor``: whether a row is outside the column's largest component.

    Of two rows of different components one at least is minor.
    """
    held = mixed.groupBy("column", "comp").agg(F.count("*").alias("m"))
    most = held.groupBy("column").agg(F.max(F.struct("m", "comp")).getField("comp").alias("main"))
    return mixed.join(most, "column").withColumn("minor", F.col("comp") != F.col("main"))


def _short_column_pairs(mixed: DataFrame, percent: int) -> DataFrame:
    """Pairs of rows of different components in columns of at most ``SHORT`` rows."""
    few = _sided(mixed.where(F.col("rows") <= SHORT))
    names = ("key", "n", "comp", "minor")
    left = few.where("inner").select("column", *[F.col(c).alias(f"a_{c}") for c in names])
    right = few.select("column", *[F.col(c).alias(f"b_{c}") for c in names])
    met = left.join(right, "column").where("a_comp <> b_comp and a_n <= b_n and (a_minor or b_minor)")
    met = met.where(_similar_size(F.col("a_n"), F.col("b_n"), percent))
    return met.select(F.least("a_key", "b_key").alias("a"), F.greatest("a_key", "b_key").alias("b")).distinct()


class _Side:
    """Rows of a block in order of size, their shingles as numbers shared with the other side."""

    def __init__(self, pdf: pd.DataFrame):
        sizes = pdf["cells"].map(len).to_numpy() // 8
        order = np.argsort(sizes, kind="stable")
        self.sizes, self.comp = sizes[order], pdf["comp"].to_numpy()[order]
        self.cells = np.frombuffer(b"".join(pdf["cells"].to_numpy()[order]), np.uint64)
        self.row = np.repeat(np.arange(len(order)), self.sizes)

    def keep(self, columns: np.ndarray) -> None:
        """Number the shingles by their place in ``columns``; others cannot add to an overlap."""
        at = np.searchsorted(columns, self.cells)
        at[at == len(columns)] = 0
        shared = columns[at] == self.cells if len(columns) else np.zeros(len(at), bool)
        self.row, self.column = self.row[shared], at[shared]
        self.starts = np.searchsorted(self.row, np.arange(len(self.sizes) + 1))

    def dense(self, low: int, high: int, first: int, width: int) -> np.ndarray:
        part = slice(self.starts[low], self.starts[high])
        row, column = self.row[part] - low, self.column[part] - first
        inside = (column >= 0) & (column < width)
        out = np.zeros((high - low, width), np.float32)
        out[row[inside], column[inside]] = 1
        return out


def linked_components(left: pd.DataFrame, right: pd.DataFrame, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of components joined by links of a smaller row of ``left`` and a larger one of ``right``.

    Both have ``cells`` and ``comp``. Overlaps are sums of products of 0/1 blocks; rows whose
    sizes are too far apart are not multiplied.
    """
    x, y = _Side(left), _Side(right)
    shared = np.intersect1d(x.cells, y.cells)
    x.keep(shared)
    y.keep(shared)
    names, comp = np.unique(np.concatenate([x.comp, y.comp]), return_inverse=True)
    x_comp, y_comp = comp[: len(x.comp)], comp[len(x.comp) :]
    forest = Forest(len(names))
    rows, width = PART
    for low in range(0, len(x.sizes), rows):
        high = min(low + rows, len(x.sizes))
        near = np.searchsorted(y.sizes, x.sizes[low]), np.searchsorted(y.sizes, 100 * x.sizes[high - 1] // percent, side="right")
        if near[0] >= near[1]:
            continue
        overlap = np.zeros((high - low, near[1] - near[0]), np.float32)
        for first in range(0, len(shared), width):
            overlap += x.dense(low, high, first, width) @ y.dense(*near, first, width).T
        overlap = overlap.astype(np.int64)
        n, m = x.sizes[low:high, None], y.sizes[None, slice(*near)]
        fit = (n <= m) & (100 * overlap >= percent * (n + m - overlap))
        i, j = np.nonzero(fit)
        forest.link(x_comp[low:high][i], y_comp[slice(*near)][j])
    a, b = forest.edges()
    return names[a], names[b]


def _long_column_links(mixed: DataFrame, rows: DataFrame, percent: int) -> DataFrame:
    """Components ``a, b`` linked by rows of columns of more than ``SHORT`` rows.

    The rows of a column are cut into blocks by number and by shingles; a task multiplies two
    blocks of whole rows and returns fewer rows than the components that meet in it.
    """

    def product(pdf: pd.DataFrame) -> pd.DataFrame:
        left, right = (pdf[pdf["side"] == i] for i in (0, 1))
        a, b = linked_components(left, right, percent) if len(left) and len(right) else (np.empty(0, np.int64),) * 2
        return pd.DataFrame({"a": a, "b": b})

    many = _sided(mixed.where(F.col("rows") > SHORT))
    inner_minor, inner_main = F.col("inner") & F.col("minor"), F.col("inner") & ~F.col("minor")

    def blocks(chosen):
        n = F.greatest(F.count_if(chosen) / BLOCK, F.sum(F.when(chosen, F.col("n"))) / CELLS)
        return F.greatest(F.ceil(F.coalesce(n, F.lit(0))), F.lit(1)).cast("int")

    sums = many.groupBy("column").agg(
        blocks(inner_minor).alias("l0"), blocks(inner_main).alias("l1"),
        blocks(F.lit(True)).alias("r0"), blocks(F.col("minor")).alias("r1"),
    )
    many = many.join(sums, "column")

    def held(first: str, second: str):
        return F.when(F.col("case") == 0, F.col(first)).otherwise(F.col(second))

    # Inner minor rows meet all rows; inner rows of the main component meet the minor ones.
    left = many.where("inner").withColumn("case", F.when(F.col("minor"), 0).otherwise(1))
    both = F.array(F.lit(0), F.lit(1))
    right = many.withColumn("case", F.explode(F.when(F.col("minor"), both).otherwise(F.slice(both, 1, 1))))
    spread = F.xxhash64("key")
    left = left.withColumns({"side": F.lit(0), "lb": F.pmod(spread, held("l0", "l1")).cast("int")})
    left = left.withColumn("rb", F.explode(F.sequence(F.lit(0), held("r0", "r1") - 1)))
    right = right.withColumns({"side": F.lit(1), "rb": F.pmod(spread, held("r0", "r1")).cast("int")})
    right = right.withColumn("lb", F.explode(F.sequence(F.lit(0), held("l0", "l1") - 1)))
    task = ["column", "case", "lb", "rb"]
    sent = left.select(*task, "side", "key", "comp").unionByName(right.select(*task, "side", "key", "comp"))
    met = sent.join(rows, "key").groupBy(*task).applyInPandas(product, "a long, b long")
    return met.distinct()


def ngram_jaccard_components(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = 80, size: int = 5
) -> DataFrame:
    """Rows ``(id, n_shingles, component_id, key)``, one per row of ``docs``.

    Two rows link when ``100 * |A & B| >= percent * |A | B|`` over their sets of
    distinct shingles of ``size`` words (ASCII letters in lower case; a shorter text
    is one shingle). ``component_id`` is the smallest id reachable by links. Rows of
    equal sets share ``key``.

    A null text or one without words has an empty set and links with nothing: it is
    its own component. Repeated rows are linked as equal sets and all returned. A row
    with a null id takes part; its component has the smallest id that is not null.
    Other columns are ignored whatever their names. An empty table gives no rows.
    """
    # By a name of our own: other columns may clash with those used below.
    texts = docs.select(F.col(text_col).cast("string").alias("text"))
    profile = materialize(shingle_profile(docs, id_col, text_col, size), "ngram-profile")
    sizes = profile.where("key is not null").select("key", F.col("n_shingles").alias("n"), "zone").distinct()
    shared = _shared(_columns(texts, percent, size))
    prefix = materialize(_prefixes(shared, sizes, percent), "ngram-prefix")
    keys = materialize(prefix.select("key").distinct(), "ngram-keys")
    components = None
    links = None
    if keys.limit(1).count():
        rows = materialize(_full_rows(texts, keys, size), "ngram-rows")
        nodes = keys.select(F.col("key").alias("node"))
        for turn in range(ROUNDS + 2):
            mixed = materialize(_mixed_columns(prefix, components), "ngram-mixed")
            if not mixed.limit(1).count():
                break
            if turn < ROUNDS:
                new = _linked(_pivot_pairs(mixed, turn, percent), rows, percent)
            elif turn == ROUNDS:
                new = _long_column_links(mixed, rows, percent)
            else:
                new = _linked(_short_column_pairs(mixed, percent), rows, percent)
            new = materialize(new, "ngram-links")
            if not new.limit(1).count():
                continue
            links = new if links is None else links.unionByName(new)
            components = connected_components(nodes, links)
    classes = profile.where("key is not null").groupBy("key").agg(F.min("id").alias("least"))
    if components is not None:
        found = components.select(F.col("node").alias("key"), "component")
        classes = classes.join(found, "key", "left").withColumn("component", F.coalesce("component", "key"))
        least = classes.groupBy("component").agg(F.min("least").alias("component_id"))
        classes = classes.join(least, "component").select("key", "component_id")
    else:
        classes = classes.withColumnRenamed("least", "component_id")
    out = salted_join(profile.drop("zone"), materialize(classes, "ngram-classes"), ["key"], "left")
    return out.select(
        "id",
        "n_shingles",
        F.when(F.col("key").isNull(), F.col("id")).otherwise(F.col("component_id")).alias("component_id"),
        "key",
    )
