"""Joins beyond one call: by position, on skewed keys, and by distance cells."""

from __future__ import annotations

import itertools
import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dunlin.operators.ordering import ranked
from dunlin.session import materialize, shuffle_width

TASK_ROWS = 250_000  # rows of one key that a task takes
MOST_HOT = 1 << 16  # keys that may be split, so that their list can be broadcast
TASK_PAIRS = 1 << 24  # pairs that a task of `eps_join` measures
MOST_TASKS = 1 << 14


def join_by_position(
    left: DataFrame, right: DataFrame, left_order: Sequence[str], right_order: Sequence[str]
) -> DataFrame:
    """Put the i-th rows of two ordered tables side by side; the shorter side gives nulls."""
    return ranked(left, left_order).join(ranked(right, right_order), "row_id", "full")


def full_outer(left: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    """Outer alignment of two keyed tables, as two group-by results side by side."""
    return left.join(right, list(on), "full")


def hot_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys with more rows than a task should have, and ``__salts``, the tasks each needs.

    At most ``MOST_HOT`` keys, whatever the size of the table: a task's share is
    ``TASK_ROWS`` or, beyond ``TASK_ROWS * MOST_HOT`` rows, the rows over ``MOST_HOT``.
    """
    share = max(TASK_ROWS, -(-df.count() // MOST_HOT))
    counted = df.groupBy(*keys).agg(F.count("*").alias("__n")).where(F.col("__n") > share)
    return counted.select(*keys, F.ceil(F.col("__n") / share).cast("int").alias("__salts"))


def salted_join(big: DataFrame, other: DataFrame, on: Sequence[str], how: str = "inner") -> DataFrame:
    """Join in which a hot key of ``big`` is spread over as many tasks as its rows need.

    Rows of ``other`` are repeated for hot keys only. ``how`` is inner or left.
    A ``big`` side that fits a single task is joined as it is. Rows without a key match
    nothing, so they are spread over as many tasks as there are.
    """
    on = list(on)
    if big.limit(TASK_ROWS + 1).count() <= TASK_ROWS:
        return big.join(other, on, how)
    hot = F.broadcast(hot_keys(big, on))  # at most MOST_HOT rows
    salts = F.coalesce("__salts", F.lit(1))
    no_key = F.coalesce(*[F.when(F.col(c).isNull(), F.lit(MOST_HOT)) for c in on])
    spread = F.pmod(F.xxhash64(*big.columns), F.coalesce(no_key, salts)).cast("int")
    left = big.join(hot, on, "left").withColumn("__salt", spread).drop("__salts")
    every = F.explode(F.sequence(F.lit(0), salts - 1))
    right = other.join(hot, on, "left").withColumn("__salt", every).drop("__salts")
    return left.join(right, [*on, "__salt"], how).drop("__salt")


def cell_columns(features: Sequence[str], side: float, prefix: str = "__c") -> dict:
    return {f"{prefix}{i}": F.floor(F.col(f) / side) for i, f in enumerate(features)}


def dealt_by_pairs(left: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    """Inner join whose tasks are as many as its pairs need, however few bytes the rows have.

    The pairs are counted first. A key of more than ``TASK_PAIRS`` pairs is cut into blocks of
    rows on both sides, a task for each two of them; at most ``MOST_HOT`` keys are listed for that.
    """
    on = list(on)
    sides = [d.groupBy(*on).agg(F.count("*").alias(n)) for d, n in ((left, "__l"), (right, "__r"))]
    counted = materialize(sides[0].join(sides[1], on).withColumn("__pairs", F.col("__l") * F.col("__r").cast("double")), "pairs")
    total = counted.agg(F.sum("__pairs")).first()[0] or 0.0
    if total <= TASK_PAIRS // 16:
        return left.join(right, on)
    share = max(TASK_PAIRS, total / MOST_HOT)
    side = math.sqrt(share)
    cuts = [F.ceil(F.col(n) / side).cast("int").alias(c) for n, c in (("__l", "__lcuts"), ("__r", "__rcuts"))]
    hot = F.broadcast(counted.where(F.col("__pairs") > share).select(*on, *cuts))  # fewer than MOST_HOT rows

    def dealt(df: DataFrame, own: str, other: str) -> DataFrame:
        cut, copies = F.coalesce(f"__{own}cuts", F.lit(1)), F.coalesce(f"__{other}cuts", F.lit(1))
        block = F.pmod(F.xxhash64(*df.columns), cut).cast("int")
        placed = df.join(hot, on, "left").withColumn(f"__{own}block", block)
        placed = placed.withColumn(f"__{other}block", F.explode(F.sequence(F.lit(0), copies - 1)))
        return placed.select(*df.columns, *blocks).repartition(tasks, *on, *blocks)

    blocks = ["__lblock", "__rblock"]
    cores = left.sparkSession.sparkContext.defaultParallelism
    tasks = max(shuffle_width(left.sparkSession), 4 * cores, min(MOST_TASKS, math.ceil(total / TASK_PAIRS)))
    # Sorted groups spill; a broadcast of either side would pass it through the driver.
    return dealt(left, "l", "r").join(dealt(right, "r", "l").hint("merge"), [*on, *blocks]).drop(*blocks)


def rounded(value: str, digits: int) -> Column:
    """``F.round`` of a column of small numbers, which takes its decimal text only near a tie."""
    scaled = F.col(value) * F.lit(10.0**digits)
    near_tie = F.abs(scaled - F.floor(scaled) - 0.5) < 1e-3
    plain = F.rint(scaled) / F.lit(10.0**digits)
    return F.when(near_tie | (F.abs(scaled) > 1e12), F.round(value, digits)).otherwise(plain)


def eps_join(
    left: DataFrame, right: DataFrame, features: Sequence[str], eps: float, strict: bool = False
) -> DataFrame:
    """Pairs within Euclidean distance ``eps``, with column ``distance``.

    Both sides carry the ``features`` columns; other column names must differ.
    The first three features are cut into cells of side ``eps``: a row meets
    only rows of its own and the neighbouring cells, by an equality join. Tasks
    are dealt by the pairs they measure, see ``dealt_by_pairs``.
    """
    features = list(features)
    axes = features[:3]
    cells = [f"__c{i}" for i in range(len(axes))]
    lefts = left.withColumns(cell_columns(axes, eps))
    moves = list(itertools.product((-1, 0, 1), repeat=len(axes)))
    near = F.explode(
        F.array(
            *[
                F.struct(*[(F.floor(F.col(a) / eps) + d).alias(c) for a, d, c in zip(axes, m, cells)])
                for m in moves
            ]
        )
    )
    renamed = right.withColumnsRenamed({f: f"__r_{f}" for f in features})
    rights = right.withColumn("__cell", near).select("*", "__cell.*").drop("__cell")
    rights = rights.withColumnsRenamed({f: f"__r_{f}" for f in features})
    gap = sum((F.col(f) - F.col(f"__r_{f}")) * (F.col(f) - F.col(f"__r_{f}")) for f in features)
    joined = dealt_by_pairs(lefts, rights, cells).withColumn("distance", F.sqrt(gap))
    inside = F.col("distance") < eps if strict else F.col("distance") <= eps
    other = [c for c in renamed.columns if not c.startswith("__r_")]
    return joined.where(inside).select(*left.columns, *other, "distance")


BROADCAST_ROWS = 100_000


def lookup_join(big: DataFrame, lookup: DataFrame, on: Sequence[str], how: str = "inner") -> DataFrame:
    """Join to a table with unique keys: broadcast if counted small, else salted on hot keys.

    The lookup table is written first, so that counting it does not compute it twice.
    """
    lookup = materialize(lookup, "lookup")
    if lookup.count() <= BROADCAST_ROWS:
        return big.join(F.broadcast(lookup), list(on), how)
    return salted_join(big, lookup, on, how)
