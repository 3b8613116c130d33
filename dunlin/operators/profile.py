"""Unique values, counts, summaries, correlation, histograms and bins."""

from __future__ import annotations

import itertools
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dunlin.operators.ordering import exact_quantiles

QUARTILES = {0.25: "q25", 0.5: "q50", 0.75: "q75"}


def melt(df: DataFrame, columns: Sequence[str], kind: str = "string", keep: Sequence[str] = ()):
    """Rows ``(keep..., column, value)``, one per input row and column."""
    pairs = ", ".join(f"'{c}', cast(`{c}` as {kind})" for c in columns)
    return df.select(*keep, F.expr(f"stack({len(columns)}, {pairs}) as (column, value)"))


def unique_all_columns(df: DataFrame) -> DataFrame:
    return melt(df, df.columns).distinct()


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Counts per value, largest first; nulls are left out."""
    counts = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("n"))
    return counts.orderBy(F.desc("n"), column)


def nunique_columns(df: DataFrame, columns: Sequence[str], approximate: bool = False) -> DataFrame:
    count = F.approx_count_distinct if approximate else F.count_distinct
    return melt(df.agg(*[count(c).alias(c) for c in columns]), columns, "bigint")


def nunique_row(*columns: str) -> Column:
    """Distinct non-null values across the columns of a row."""
    return F.size(F.array_distinct(F.array_compact(F.array(*columns))))


def describe(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows ``(column, n, mean, std, min, q25, q50, q75, max)`` with exact quartiles."""
    stats = []
    for c in columns:
        stats.append(
            F.struct(
                F.lit(c).alias("column"),
                F.count(c).alias("n"),
                F.avg(c).alias("mean"),
                F.stddev_samp(c).alias("std"),
                F.min(F.col(c).cast("double")).alias("min"),
                F.max(F.col(c).cast("double")).alias("max"),
            )
        )
    moments = df.agg(F.array(*stats).alias("s")).select(F.inline("s"))
    quartiles = exact_quantiles(df, columns, list(QUARTILES))
    wide = quartiles.groupBy("column").agg(
        *[F.max(F.when(F.col("prob") == p, F.col("value"))).alias(q) for p, q in QUARTILES.items()]
    )
    return moments.join(wide, "column", "left")


def correlation_matrix(df: DataFrame, columns: Sequence[str], digits: int = 2) -> DataFrame:
    """Rows ``(col_a, col_b, corr)`` for each pair, from one aggregate over the table."""
    def entry(a: str, b: str, value: Column) -> Column:
        return F.struct(F.lit(a).alias("col_a"), F.lit(b).alias("col_b"), value.alias("corr"))

    entries = [entry(c, c, F.when(F.stddev_pop(c) > 0, 1.0)) for c in columns]
    for a, b in itertools.combinations(columns, 2):
        value = F.round(F.corr(a, b), digits)
        entries += [entry(a, b, value), entry(b, a, value)]
    return df.agg(F.array(*entries).alias("p")).select(F.inline("p"))


def histogram(df: DataFrame, column: str, bins: int = 80) -> DataFrame:
    """Non-empty equal-width bins ``(bin, n)``; the last one holds the maximum."""
    low, high = df.agg(F.min(column).cast("double"), F.max(column).cast("double")).first()
    if low is None:
        return df.select(F.lit(0).alias("bin"), F.lit(0).cast("long").alias("n")).limit(0)
    width = (high - low) or 1.0
    spot = F.floor((F.col(column) - low) / width * bins)
    rows = df.where(F.col(column).isNotNull())
    return rows.groupBy(F.least(spot, F.lit(bins - 1)).cast("int").alias("bin")).agg(
        F.count("*").alias("n")
    )


def quantile_bins(df: DataFrame, column: str, labels: Sequence[int], name: str) -> DataFrame:
    """Label each row by equal-probability, right-closed bins of the column."""
    k = len(labels)
    found = exact_quantiles(df, [column], [i / k for i in range(1, k)]).orderBy("prob").collect()
    bin_of = F.when(F.col(column).isNull(), F.lit(None))
    for edge, label in zip((r["value"] for r in found), labels):
        bin_of = bin_of.when(F.col(column) <= edge, label)
    return df.withColumn(name, bin_of.otherwise(labels[-1]))


def pick_max(df: DataFrame, group_by: Sequence[str], score: str, first_by: str, keep: Sequence[str]):
    """Row with the highest score per group; ties go to the lowest ``first_by``.

    An aggregate, not a window, so a hot group is reduced before the shuffle.
    """
    best = F.max_by(F.struct(score, first_by, *keep), F.struct(score, -F.col(first_by)))
    return df.where(F.col(score).isNotNull()).groupBy(*group_by).agg(best.alias("b")).select(
        *group_by, "b.*"
    )
