"""Row order on distributed tables: positions, splits, folds, top-k.

Nothing here sorts a whole table in one task. Rows are range-partitioned by
their order key, written once with their place inside the partition, and the
position is that place plus the row count of the partitions before it.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dunlin.session import materialize

_PLACE = "__place"
_PART = "__part"


def _placed(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Range-sorted copy of ``df`` with partition number and place in it."""
    ranged = df.repartitionByRange(*keys).sortWithinPartitions(*keys)
    written = materialize(ranged.withColumn(_PLACE, F.monotonically_increasing_id()), "ranged")
    return written.withColumn(_PART, F.shiftrightunsigned(_PLACE, 33))


def ranked(
    df: DataFrame,
    order_by: Sequence[str],
    group_by: Sequence[str] = (),
    name: str = "row_id",
) -> DataFrame:
    """Add the 0-based position of each row, in the table or in its group.

    ``order_by`` should end with a unique key, so that a value shared by many
    rows can still be split over partitions.
    """
    group_by = list(group_by)
    placed = _placed(df, [*group_by, *order_by])
    # One row per partition and group: at most partitions + groups rows.
    runs = placed.groupBy(_PART, *group_by).agg(
        F.count("*").alias("__rows"), F.min(_PLACE).alias("__first")
    )
    before = Window.partitionBy(*group_by).orderBy(_PART).rowsBetween(Window.unboundedPreceding, -1)
    starts = runs.select(
        F.col(_PART).alias("__p"),
        *[F.col(g).alias(f"__g{i}") for i, g in enumerate(group_by)],
        "__first",
        F.coalesce(F.sum("__rows").over(before), F.lit(0)).alias("__start"),
    )
    match = F.col(_PART) == F.col("__p")
    for i, g in enumerate(group_by):
        match = match & F.col(g).eqNullSafe(F.col(f"__g{i}"))
    if not group_by:
        starts = F.broadcast(starts)  # one row per partition of the range sort
    position = F.col("__start") + F.col(_PLACE) - F.col("__first")
    return placed.join(starts, match).select(*df.columns, position.alias(name))


def exact_quantiles(df: DataFrame, columns: Sequence[str], probs: Sequence[float]) -> DataFrame:
    """Linear-interpolation quantiles as rows ``(column, prob, value)``.

    Equal values are counted before the range sort, so one frequent value costs
    one row; only the partitions that hold a wanted rank are read again.
    """
    pairs = ", ".join(f"'{c}', cast(`{c}` as double)" for c in columns)
    counted = (
        df.select(F.expr(f"stack({len(columns)}, {pairs}) as (column, value)"))
        .where(F.col("value").isNotNull())
        .groupBy("column", "value")
        .agg(F.count("*").alias("n"))
    )
    placed = _placed(counted, ["column", "value"])
    runs = placed.groupBy("column", _PART).agg(F.sum("n").alias("rows"))
    whole = Window.partitionBy("column")
    before = whole.orderBy(_PART).rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select(
        "column",
        _PART,
        "rows",
        F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("start"),
        F.sum("rows").over(whole).alias("total"),
    )
    wanted = runs.withColumn("prob", F.explode(F.expr("array(" + ", ".join(f"double('{float(p)!r}')" for p in probs) + ")")))
    spot = F.col("prob") * (F.col("total") - 1)
    wanted = (
        wanted.withColumn("share", spot - F.floor(spot))
        .withColumn("side", F.explode(F.array(F.lit(0), F.lit(1))))
        .withColumn(
            "rank", F.when(F.col("side") == 0, F.floor(spot)).otherwise(F.ceil(spot)).cast("long")
        )
        .where((F.col("rank") >= F.col("start")) & (F.col("rank") < F.col("start") + F.col("rows")))
    )
    needed = wanted.select("column", _PART, "start").distinct()
    upto = Window.partitionBy("column", _PART).orderBy("value")
    spans = (
        placed.join(F.broadcast(needed), ["column", _PART])  # at most 2 * probs * columns rows
        .withColumn("last", F.col("start") + F.sum("n").over(upto))
        .select("column", "value", "last", (F.col("last") - F.col("n")).alias("first"))
    )
    targets = wanted.select("column", "prob", "share", "side", "rank")
    found = spans.alias("s").join(
        F.broadcast(targets).alias("t"),
        (F.col("s.column") == F.col("t.column"))
        & (F.col("t.rank") >= F.col("s.first"))
        & (F.col("t.rank") < F.col("s.last")),
    )
    low = F.max(F.when(F.col("side") == 0, F.col("value")))
    high = F.max(F.when(F.col("side") == 1, F.col("value")))
    return found.groupBy(F.col("t.column").alias("column"), "prob").agg(
        (low + F.first("share") * (high - low)).alias("value")
    )


def top_per_group(
    df: DataFrame, group_by: Sequence[str], order_by: Sequence[Column], k: int, name: str = "rank"
) -> DataFrame:
    """First ``k`` rows of every group with their rank from 1.

    The ``<= k`` filter on ``row_number`` lets Spark keep only ``k`` rows per
    group and map task before the shuffle, so a hot group stays small.
    """
    w = Window.partitionBy(*group_by).orderBy(*order_by)
    return df.withColumn(name, F.row_number().over(w)).where(F.col(name) <= k)


def hash_order(key: str, seed: int | Column) -> Column:
    """Repeatable pseudo-random 32-bit number of a key, the same in any engine."""
    start = seed.cast("string") if isinstance(seed, Column) else F.lit(str(seed))
    text = F.concat_ws(":", start, F.col(key).cast("string"))
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long")


def test_size(n: int, train_factor: float) -> int:
    """Rows in the test part, with the double arithmetic of ``1 - factor``."""
    return math.ceil((1.0 - train_factor) * n)


def ordered_split(df: DataFrame, order_by: Sequence[str], train_factor: float) -> DataFrame:
    """Mark head rows ``train`` and tail rows ``test`` in column ``part``."""
    cut = df.count()
    cut -= test_size(cut, train_factor)
    rows = ranked(df, order_by)
    return rows.withColumn("part", F.when(F.col("row_id") < cut, "train").otherwise("test"))


def random_split(df: DataFrame, key: str, train_factor: float, seed: int = 42) -> DataFrame:
    """Shuffled split of exact size, repeatable for a key and seed."""
    mixed = df.withColumn("__mix", hash_order(key, seed))
    return ordered_split(mixed, ["__mix", key], train_factor).drop("__mix", "row_id")


def kfold(df: DataFrame, order_by: Sequence[str], folds: int = 5) -> DataFrame:
    """Contiguous folds 0..folds-1, the first ``n mod folds`` one row larger."""
    n = df.count()
    size, extra = divmod(n, folds)
    wide = extra * (size + 1)
    row = F.col("row_id")
    fold = F.when(row < wide, F.floor(row / (size + 1))).otherwise(
        F.floor((row - wide) / max(size, 1)) + extra
    )
    return ranked(df, order_by).withColumn("fold", fold.cast("int"))
