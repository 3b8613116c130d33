"""Scaling fitted by one aggregate and applied as plain column arithmetic."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def fit_standard(df: DataFrame, columns: Sequence[str]) -> dict[str, tuple[float, float]]:
    """Mean and population deviation of each column."""
    stats = df.agg(*[f(c).alias(f"{n}{c}") for c in columns for n, f in (("m", F.avg), ("s", F.stddev_pop))])
    row = stats.first()
    return {c: (row[f"m{c}"], row[f"s{c}"]) for c in columns}


def fit_minmax(df: DataFrame, columns: Sequence[str]) -> dict[str, tuple[float, float]]:
    """Minimum and range of each column."""
    row = df.agg(*[f(c).alias(f"{n}{c}") for c in columns for n, f in (("l", F.min), ("h", F.max))]).first()
    return {
        c: (None, None) if row[f"l{c}"] is None
        else (float(row[f"l{c}"]), float(row[f"h{c}"]) - float(row[f"l{c}"]))
        for c in columns
    }


def apply_scale(df: DataFrame, fitted: dict[str, tuple[float, float]]) -> DataFrame:
    """Subtract the offset and divide by the width; a constant column gives 0."""
    return df.withColumns(
        {c: (F.col(c) - F.lit(at)) / F.lit(width or 1.0) for c, (at, width) in fitted.items()}
    )


def standard_scale(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return apply_scale(df, fit_standard(df, columns))


def minmax_scale(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return apply_scale(df, fit_minmax(df, columns))
