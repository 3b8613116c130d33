"""Top-k neighbours of sparse rows by dot product, for ratings and token sets.

Rows are kept in long form ``(item, dim, weight)`` with weights >= 0.

Where it costs less, items are cut into blocks and a task scores one pair of
blocks, so that only the best ``k`` per item leave it. With very many items
the blocks would be copied too often; then each entry of a dimension with at
most ``HOT_ROWS`` items takes the dimension's list of items to the task of its
own item, where pairs are made, summed and cut to the best ``k``, and only the
dimensions with more go through the blocks. They are never expanded into pairs
of rows. An item with a top score either shares a small dimension, and is then
scored in full, or owes its score to the hot ones alone. In blocks, items with
the same entries are scored once.

Lists that are shuffled to each of their items take as much disk as there are
pairs. Beyond ``SHUFFLED_PAIRS`` pairs the lists are written once and each task
reads all of them for its share of the items (``operators/scans.py``).
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dunlin.operators import scans
from dunlin.operators.joins import lookup_join, salted_join
from dunlin.operators.ordering import ranked, top_per_group
from dunlin.session import materialize, shuffle_width

HOT_ROWS = 128
BLOCK_ITEMS = 2048  # rows per side of one matrix of scores
BLOCK_ENTRIES = 500_000  # entries per side of a block pair, on average
PAIR_CELLS = 20  # cells of a matrix of scores that cost as much as one pair of rows
TASK_PAIRS = 1_500_000  # pairs of items that one task sums
SHUFFLED_PAIRS = 10_000_000  # pairs of rows that may be shuffled; lists of more are read by every task
LIST_ROWS = 1_000_000  # entries one item may bring into a task
SUBSET_CLASSES = 50_000  # kinds of items that meet in blocks; more of them meet by the dimensions they share
SUBSET_DIMS = 10  # dimensions of an item whose subsets are listed, at most
SLICE = 4_000_000  # products formed at a time
DIGITS = 9


def unit_rows(df: DataFrame, item: str, weight: str) -> DataFrame:
    """Scale the rows of each item to length 1; items of length 0 are left out."""
    lengths = df.groupBy(item).agg(F.sqrt(F.sum(F.col(weight) * F.col(weight))).alias("__len"))
    joined = lookup_join(df, lengths.where(F.col("__len") > 0), [item])
    return joined.withColumn(weight, F.col(weight) / F.col("__len")).drop("__len")


def _flat(rows: pd.DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row number, dimension and weight of all entries, by dimension."""
    row = np.repeat(np.arange(len(rows)), rows["dims"].map(len))
    dim, weight = np.concatenate(rows["dims"].to_numpy()), np.concatenate(rows["ws"].to_numpy())
    order = np.argsort(dim, kind="stable")
    return row[order], dim[order], weight[order].astype(float)


def _products(x: pd.DataFrame, y: pd.DataFrame) -> np.ndarray:
    """Dot products of all rows of two blocks, by shared dimension."""
    (ra, da, wa), (rb, db, wb) = _flat(x), _flat(y)
    ua, sa, ca = np.unique(da, return_index=True, return_counts=True)
    ub, sb, cb = np.unique(db, return_index=True, return_counts=True)
    _, ia, ib = np.intersect1d(ua, ub, assume_unique=True, return_indices=True)
    sa, ca, sb, cb = sa[ia], ca[ia], sb[ib], cb[ib]
    total = np.zeros(len(x) * len(y))
    work = ca * cb
    full = work > total.size / 8
    for d in np.nonzero(full)[0]:  # a dimension most rows have: add its outer product
        left, right = np.zeros(len(x)), np.zeros(len(y))
        left[ra[sa[d] : sa[d] + ca[d]]] = wa[sa[d] : sa[d] + ca[d]]
        right[rb[sb[d] : sb[d] + cb[d]]] = wb[sb[d] : sb[d] + cb[d]]
        total += np.outer(left, right).ravel()
    sa, ca, sb, cb, work = sa[~full], ca[~full], sb[~full], cb[~full], work[~full]
    for part in np.split(np.arange(len(work)), np.nonzero(np.diff(work.cumsum() // SLICE))[0] + 1):
        if len(part):
            which = np.repeat(part, work[part])
            at = np.arange(len(which)) - np.repeat(work[part].cumsum() - work[part], work[part])
            i, j = sa[which] + at // cb[which], sb[which] + at % cb[which]
            total += np.bincount(ra[i] * len(y) + rb[j], weights=wa[i] * wb[j], minlength=total.size)
    return total.reshape(len(x), len(y))


def _block_scores(x: pd.DataFrame, y: pd.DataFrame, k: int, same: bool = False) -> pd.DataFrame:
    """Best ``k`` of block ``y`` for every row of block ``x``; ``same`` keeps the row itself."""
    if not len(x) or not len(y):
        return pd.DataFrame({"item": [], "other": [], "score": []})
    y = y.sort_values("item")
    found = []
    for at in range(0, len(x), BLOCK_ITEMS):
        best = None
        for beside in range(0, len(y), BLOCK_ITEMS):
            part = _part_scores(x.iloc[at : at + BLOCK_ITEMS], y.iloc[beside : beside + BLOCK_ITEMS], k, same)
            if best is not None:  # items of ``y`` ascend, so a stable sort keeps ties in order
                part = pd.concat([best, part]).sort_values("score", ascending=False, kind="stable")
                part = part.groupby("item", sort=False).head(k)
            best = part
        found.append(best)
    return pd.concat(found)


def _part_scores(x: pd.DataFrame, y: pd.DataFrame, k: int, same: bool) -> pd.DataFrame:
    total = np.round(_products(x, y), DIGITS)
    a, b = x["item"].to_numpy(), y["item"].to_numpy()
    if not same:
        total[a[:, None] == b[None, :]] = 0.0
    if total.max() < 1e6:  # score and column as one whole number: no ties
        whole = np.rint(total * 10**DIGITS).astype("int64") * len(b) + np.arange(len(b))[::-1]
        best = np.argpartition(-whole, min(k, len(b)) - 1, axis=1)[:, :k]
        best = np.take_along_axis(best, np.argsort(-np.take_along_axis(whole, best, 1), axis=1), 1)
    else:
        best = np.argsort(-total, axis=1, kind="stable")[:, :k]
    out = pd.DataFrame(
        {
            "item": np.repeat(a, best.shape[1]),
            "other": b[best.ravel()],
            "score": np.take_along_axis(total, best, 1).ravel(),
        }
    )
    return out[out["score"] > 0]


def _as_lists(coded: DataFrame) -> DataFrame:
    """One row per item: ``(item, dims, ws)``."""
    grouped = coded.groupBy("item").agg(F.sort_array(F.collect_list(F.struct("code", "w"))).alias("e"))
    lists = grouped.select(
        "item",
        F.transform("e", lambda x: x["code"]).alias("dims"),
        F.transform("e", lambda x: x["w"]).alias("ws"),
    )
    return materialize(lists, "lists")


def spread(df: DataFrame, blocks: int) -> DataFrame:
    """Partition by block pair; the count is set, so small but costly pairs are not merged."""
    return df.repartition(min(blocks * blocks, 4 * shuffle_width(df.sparkSession)), "a", "b")


def _block_top(hot: DataFrame, k: int, blocks: int, same: bool = False) -> DataFrame:
    part = F.pmod(F.xxhash64("item"), F.lit(blocks)).cast("int")
    every = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))
    left = hot.withColumn("a", part).withColumn("b", every)
    names = {"item": "item2", "dims": "dims2", "ws": "ws2"}
    right = hot.select(*[F.col(c).alias(n) for c, n in names.items()], part.alias("b")).withColumn("a", every)

    def best(x: pd.DataFrame, y: pd.DataFrame) -> pd.DataFrame:
        return _block_scores(x, y.rename(columns={n: c for c, n in names.items()}), k, same)

    return (
        spread(left, blocks).groupBy("a", "b")
        .cogroup(spread(right, blocks).groupBy("a", "b"))
        .applyInPandas(best, "item long, other long, score double")
    )


def _subset_top(classes: DataFrame, lowest: DataFrame, k: int, most: int) -> DataFrame:
    """Rows ``(class, other, score)``: the ``k`` best items of every class, itself included, by shared subsets of dimensions.

    ``classes`` has ``(class, dims, ws)`` with at most ``most`` dimensions, ``lowest`` the ``k`` lowest
    items of a class as ``others``. Items that share a set of dimensions, with the same weights in it, are a
    group; only its ``k`` lowest can be among the best of a class through that set. Sets get smaller by a
    dimension in each round, until the best of a class are beyond what the smaller ones can give.
    """
    entries = classes.select("class", F.inline(F.arrays_zip("dims", "ws")))
    entries = materialize(entries.groupBy("class", "dims").agg(F.sum("ws").alias("ws")), "entries")  # an item may have one twice
    largest = entries.groupBy("dims").agg(F.max("ws").alias("largest"))
    whole = lookup_join(entries, largest, ["dims"]).groupBy("class").agg(
        F.sort_array(F.collect_list(F.struct("dims", "ws"))).alias("e"),
        F.sort_array(F.collect_list(F.col("ws") * F.col("largest"))).alias("terms"),
    )
    classes = whole.select("class", F.col("e.dims").alias("dims"), F.col("e.ws").alias("ws"), "terms").join(lowest, "class")
    # The largest score of a set with ``i + 1`` dimensions less than the class.
    beyond = F.transform("terms", lambda _, i: F.aggregate(F.slice("terms", i + 2, F.size("terms")), F.lit(0.0), lambda s, t: s + t))
    classes = materialize(classes.select("class", "dims", "ws", "others", beyond.alias("beyond")), "classes")
    width = max(shuffle_width(classes.sparkSession), math.ceil(classes.count() * k / TASK_PAIRS))

    def sets(df: DataFrame, n: int) -> DataFrame:
        """Rows of ``df`` with each of their sets of ``n`` dimensions ``set`` and weights ``held``."""
        masks = F.expr(f"filter(sequence(1L, shiftleft(1L, size(dims)) - 1L), m -> bit_count(m) = {n})")
        each = df.where(F.size("dims") >= n).withColumn("mask", F.explode(masks))
        kept = [F.expr(f"filter({c}, (x, i) -> getbit(mask, i) = 1)") for c in ("dims", "ws")]
        return each.select("*", kept[0].alias("set"), kept[1].alias("held")).drop("dims", "ws", "mask")

    open_ = classes.select("class", "dims", "ws", "beyond")
    best = None
    for n in range(most, 0, -1):
        wanted = materialize(sets(open_, n).select("class", "set", F.col("held").alias("own")), "sets")
        groups = sets(classes.select("dims", "ws", "others"), n)
        if n < most:
            groups = lookup_join(groups, wanted.select("set").distinct(), ["set"])
        groups = top_per_group(groups.withColumn("other", F.explode("others")).drop("others"), ["set", "held"], [F.col("other")], k)
        groups = groups.groupBy("set", "held").agg(F.collect_list("other").alias("others"))
        score = F.aggregate(F.zip_with("own", "held", lambda a, b: a * b), F.lit(0.0), lambda s, x: s + x)
        found = salted_join(wanted, groups, ["set"]).select("class", "others", F.round(score, DIGITS).alias("score"))
        if best is not None:
            found = found.unionByName(best.select("class", F.array("other").alias("others"), "score"))
        found = found.where(F.col("score") > 0).repartition(width, "class")
        found = found.select("class", F.explode("others").alias("other"), "score").groupBy("class", "other").agg(F.max("score").alias("score"))
        best = materialize(top_per_group(found, ["class"], [F.desc("score"), F.col("other")], k), "best")
        last = best.where(F.col("rank") == k).select("class", F.col("score").alias("last"))
        smaller = F.when(F.size("dims") >= n, F.col("beyond")[F.size("dims") - n]) + 10.0**-DIGITS  # scores are rounded
        left = open_.join(last, "class", "left").where(F.col("last").isNull() | smaller.isNull() | (F.col("last") <= smaller))
        open_ = materialize(left.drop("last"), "open")
        if not open_.limit(1).count():
            break
    return best.drop("rank")


def _top_by_class(lists: DataFrame, k: int, blocks: int) -> DataFrame:
    """Best ``k`` other items of every item; items with the same entries are scored once.

    A class stands under its lowest item. Any item among the best ``k + 1`` of a row, itself
    included, is in one of the ``k + 1`` best classes and among the ``k + 1`` lowest of it.
    """
    named = lists.withColumn("h", F.xxhash64("dims", "ws"))
    classes = named.groupBy("h", "dims", "ws").agg(F.min("item").alias("class"), F.count("*").alias("n"))
    classes = materialize(classes, "classes")
    items, distinct, most = classes.agg(F.sum("n"), F.count("*"), F.max(F.size("dims"))).first()
    by_subset = distinct > SUBSET_CLASSES and most <= SUBSET_DIMS
    if items == distinct and not by_subset:
        return _block_top(lists, k, blocks)
    member = named.join(classes.where("n > 1").drop("n"), ["h", "dims", "ws"]).select("class", "item")
    alone = classes.where("n = 1").select("class", F.col("class").alias("item"))
    member = materialize(member.unionByName(alone), "members")
    lowest = top_per_group(member, ["class"], [F.col("item")], k + 1)
    lowest = lowest.groupBy("class").agg(F.collect_list("item").alias("others"))
    if by_subset:
        hits = _subset_top(classes.select("class", "dims", "ws"), lowest, k + 1, most)
        hits = hits.groupBy("class").agg(F.collect_list(F.struct("other", "score")).alias("hits"))
        return salted_join(member, hits, ["class"]).select("item", F.inline("hits")).where("item <> other")
    near = _block_top(classes.select(F.col("class").alias("item"), "dims", "ws"), k + 1, blocks, same=True)
    near = top_per_group(near, ["item"], [F.desc("score"), F.col("other")], k + 1).drop("rank")
    hits = near.join(lowest.withColumnRenamed("class", "other"), "other")
    hits = hits.select(F.col("item").alias("class"), F.explode("others").alias("other"), "score")
    hits = top_per_group(hits, ["class"], [F.desc("score"), F.col("other")], k + 1)
    hits = hits.groupBy("class").agg(F.collect_list(F.struct("other", "score")).alias("hits"))
    return salted_join(member, hits, ["class"]).select("item", F.inline("hits")).where("item <> other")


def _task_of(items: np.ndarray, tasks: int) -> np.ndarray:
    """A task from 0 for each item, by the leading bits of a product."""
    mixed = items.astype("uint64") * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(32)
    return mixed * np.uint64(tasks) >> np.uint64(32)


def _scanned_top(rows: DataFrame, k: int, n_rows: int, pairs: float, lowest: int, highest: int) -> DataFrame:
    """Best ``k`` other items of every item of ``(item, dim, w)``; a task scores its items on one reading of all lists."""
    kind = "int32" if -(1 << 31) <= lowest and highest < 1 << 31 else "int64"
    known = rows.where("dim is not null and item is not null").repartition(scans.scan_files(rows, n_rows), "dim")
    entry = F.struct("item", F.coalesce("w", F.lit(0.0)).alias("w"))
    lists = known.groupBy("dim").agg(F.collect_list(entry).alias("e")).where(F.size("e") > 1).select("e")
    names = ["items", "weights", "sizes"]

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("e")
            item, weight = (lists.flatten().field(c).to_numpy(zero_copy_only=False) for c in ("item", "w"))
            sizes = np.diff(lists.offsets.to_numpy())
            columns = item.astype(kind), weight, sizes.astype("int32")
            yield pa.RecordBatch.from_arrays([pa.array([c.tobytes()], pa.binary()) for c in columns], names)

    files = materialize(lists.mapInArrow(pack, ", ".join(f"{n} binary" for n in names)), "lists").inputFiles()
    tasks = scans.scan_tasks(rows, 2 * pairs)

    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for task in (t for batch in batches for t in batch.column("id").to_pylist()):
            held = scans.Products()
            for chunk in (c for table in scans.tables(files) for c in zip(*(table[n] for n in names))):
                items, weights, sizes = (np.frombuffer(c.as_buffer(), t) for c, t in zip(chunk, (kind, "float64", "int32")))
                firsts = sizes.cumsum(dtype="int64") - sizes
                mine = np.flatnonzero(_task_of(items, tasks) == task)
                at = np.searchsorted(firsts, mine, "right") - 1
                run = scans.runs(firsts[at], sizes[at])
                held.add(items[mine], sizes[at], weights[mine], items[run], weights[run])
            for owners, owner, own, other, weight in held.by_owner():
                owner, other, score = scans.summed(owner, other, own * weight)
                score = np.round(score, DIGITS)
                kept = (owners[owner] != other) & (score > 0)
                owner, other, score = owner[kept], other[kept], score[kept]
                at, rank = scans.best_of_each(owner, score, k, DIGITS)
                columns = owners[owner[at]].astype("int64"), other[at].astype("int64"), score[at], rank.astype("int32")
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["item", "other", "score", "rank"])

    numbers = rows.sparkSession.range(0, tasks, 1, tasks)
    return materialize(numbers.mapInArrow(best, "item long, other long, score double, rank int"), "top")


def _hot_from(sizes: DataFrame, hot_rows: int) -> int:
    """Items from which on a dimension is hot: a few larger ones cost less in lists than as hot ones."""
    counts = sorted((r["n"], r["dims"]) for r in sizes.groupBy("n").agg(F.count("*").alias("dims")).collect())
    base, total, most = sum(n * n * dims for n, dims in counts if n <= hot_rows), 0, hot_rows
    for n, dims in counts:
        total += n * n * dims
        if total > 2 * base:
            break
        most = max(most, n)
    return most


def sparse_topk(
    df: DataFrame, item: str, dim: str, weight: str, k: int, hot_rows: int = HOT_ROWS
) -> DataFrame:
    """The ``k`` other items with the largest dot product: ``(item, other, score, rank)``.

    Items without any shared dimension are not neighbours. Scores equal to
    nine places are ties, broken by the lower item.
    """
    rows = materialize(
        df.select(F.col(item).cast("long").alias("item"), F.col(dim).alias("dim"), F.col(weight).alias("w")),
        "sparse",
    )
    sizes = materialize(rows.groupBy("dim").agg(F.count("*").alias("n")), "sizes")
    n_rows, pairs = sizes.agg(F.sum("n"), F.sum(F.col("n") * (F.col("n") - 1) / 2)).first()
    if not n_rows:
        return rows.select("item", F.col("item").alias("other"), F.lit(0.0).alias("score"), F.lit(1).alias("rank"))
    per_item = rows.groupBy("item").agg(F.count("*").alias("n"))
    items, longest, *ends = per_item.agg(F.count("*"), F.max("n"), F.min("item"), F.max("item")).first()
    cores = df.sparkSession.sparkContext.defaultParallelism
    blocks = max(math.ceil(n_rows / BLOCK_ENTRIES), min(math.isqrt(16 * cores), math.ceil(items / 128)))
    if n_rows * blocks <= pairs and items * items <= PAIR_CELLS * pairs and longest <= LIST_ROWS:
        coded = lookup_join(rows, ranked(sizes.select("dim"), ["dim"], name="code"), ["dim"])
        best = _top_by_class(_as_lists(coded), k, blocks)
        return top_per_group(best, ["item"], [F.desc("score"), F.col("other")], k)
    if pairs > SHUFFLED_PAIRS:
        hot_rows = _hot_from(sizes.where("dim is not null"), hot_rows)
    hot_dims = materialize(sizes.where(F.col("n") > hot_rows).select("dim"), "hot")
    any_hot = bool(hot_dims.limit(1).count())
    if any_hot:
        codes = ranked(hot_dims, ["dim"], name="code")
        coded = lookup_join(rows, codes, ["dim"], "left")
        light = coded.where(F.col("code").isNull()).select("item", "dim", "w")
    else:
        if pairs > SHUFFLED_PAIRS and items > 1:
            return _scanned_top(rows, k, n_rows, pairs, *ends)
        light = rows
    entries = light.where("dim is not null").groupBy("dim").agg(F.collect_list(F.struct("item", "w")).alias("e"))
    entries = entries.select(F.inline("e"), F.col("e.item").alias("others"), F.col("e.w").alias("ws"))
    tasks = max(shuffle_width(df.sparkSession), math.ceil(2 * pairs / TASK_PAIRS))
    made = entries.repartition(tasks, "item").select("item", "w", F.inline(F.arrays_zip("others", "ws")))
    # From here on to the best ``k`` of an item nothing is shuffled: its pairs are in one task.
    half = made.where(F.col("others") > F.col("item") if any_hot else F.col("others") != F.col("item"))
    half = half.groupBy("item", F.col("others").alias("other")).agg(F.sum(F.col("w") * F.col("ws")).alias("score"))
    if any_hot:
        hot = _as_lists(coded.where(F.col("code").isNotNull()))
        mine = hot.select("item", F.arrays_zip("dims", "ws").alias("mine"))
        theirs = hot.select(
            F.col("item").alias("other"), F.map_from_arrays("dims", "ws").alias("theirs")
        )
        shared = F.aggregate(
            F.col("mine"),
            F.lit(0.0),
            lambda s, e: s
            + e["ws"] * F.coalesce(F.try_element_at(F.col("theirs"), e["dims"]), F.lit(0.0)),
        )
        half = (
            half.join(mine, "item", "left")
            .join(theirs, "other", "left")
            .select("item", "other", (F.col("score") + F.coalesce(shared, F.lit(0.0))).alias("score"))
        )
    scored = half.select("item", "other", F.round("score", DIGITS).alias("score"))
    if any_hot:
        turned = scored.select(F.col("other").alias("item"), F.col("item").alias("other"), "score")
        scored = scored.union(turned)
        # The full score of a pair is never below its hot part alone.
        scored = (
            scored.union(_block_top(hot, k, blocks)).groupBy("item", "other").agg(F.max("score").alias("score"))
        )
    scored = scored.where(F.col("score") > 0)
    return top_per_group(scored, ["item"], [F.desc("score"), F.col("other")], k)
