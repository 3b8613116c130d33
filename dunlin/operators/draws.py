"""Draws without replacement by a hash of the row, so that the same rows come back after a retry."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dunlin.operators.joins import lookup_join
from dunlin.operators.ordering import ranked

LEAD_BITS = 12  # of the 32 of the hash, by which rows are counted


def first_drawn(df: DataFrame, mix: str, tie: str, group_by: Sequence[str], size: Column) -> DataFrame:
    """The first ``size`` rows of every group in order of ``mix``, a 32-bit hash, and ``tie``.

    Rows are counted by the leading bits of the hash. Those before the bits at which the draw of a
    group ends are taken where they lie; only those at these bits, one in 4,096, are ranked. ``df``
    is read three times, so it should be a table. A null in a group column is a group like others.
    """
    lead = F.shiftrightunsigned(F.col(mix).cast("long"), 32 - LEAD_BITS).alias("__lead")
    led = df.select("*", F.struct(*group_by).alias("__group"), lead, size.cast("long").alias("__size"))
    counted = led.groupBy("__group", "__lead").agg(F.count("*").alias("__n"), F.max("__size").alias("__size"))
    lower = Window.partitionBy("__group").orderBy("__lead").rowsBetween(Window.unboundedPreceding, -1)  # a row a lead
    counted = counted.withColumn("__before", F.coalesce(F.sum("__n").over(lower), F.lit(0)))
    ends = counted.where("__before <= __size and __before + __n > __size").select(
        "__group", F.col("__lead").alias("__end"), (F.col("__size") - F.col("__before")).alias("__left")
    )
    led = lookup_join(led, ends, ["__group"], "left")
    whole = led.where("__end is null or __lead < __end").select(*df.columns)
    edge = ranked(led.where("__lead = __end"), [mix, tie], group_by, name="__rank")
    return whole.union(edge.where("__rank < __left").select(*df.columns))
