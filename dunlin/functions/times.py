"""Timestamps, intervals and regular time grids."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def parse_timestamp(c: Column) -> Column:
    """``yyyy-MM-dd HH:mm:ss`` with a space or a ``T``; null if the text is neither."""
    return F.try_to_timestamp(F.replace(c, F.lit("T"), F.lit(" ")), F.lit("yyyy-MM-dd HH:mm:ss")).cast(
        "timestamp_ntz"
    )


def parse_date(c: Column) -> Column:
    return F.try_to_date(c, "yyyy-MM-dd")


def epoch_millis(c: Column) -> Column:
    return F.unix_millis(c.cast("timestamp"))


def seconds_between(later: Column, earlier: Column) -> Column:
    return F.unix_micros(later.cast("timestamp")) / 1e6 - F.unix_micros(earlier.cast("timestamp")) / 1e6


def age_at(year: int, born: Column) -> Column:
    return F.lit(year) - F.year(born)


def time_grid(start: Column, end: Column, step: Column) -> Column:
    """Regular points from start to end, both included when they fit the step."""
    return F.sequence(start, end, step)


def series_bounds(df: DataFrame, ts: str) -> DataFrame:
    """One row ``first_ts, second_ts, last_ts``: the two earliest distinct points and the last.

    Two top-1 aggregates; the series is never sorted as a whole.
    """
    first, last = df.agg(F.min(ts), F.max(ts)).first()
    second = df.where(F.col(ts) > F.lit(first)).agg(F.min(ts).alias("second_ts"))
    return second.select(
        F.lit(first).cast("timestamp_ntz").alias("first_ts"),
        "second_ts",
        F.lit(last).cast("timestamp_ntz").alias("last_ts"),
    )


def _points(bounds: DataFrame, start: str, end: Column) -> DataFrame:
    """Points from ``start`` to ``end`` of the one row of ``bounds``, a step apart, as a distributed range."""
    spark = bounds.sparkSession
    row = bounds.select(F.col(start).alias("a"), end.cast("timestamp_ntz").alias("b"), "first_ts", "second_ts").first()
    count, micros, first = 0, 0, "1970-01-01"
    if row is not None and None not in row:
        step = row["second_ts"] - row["first_ts"]
        count = max(0, (row["b"] - row["a"]) // step + 1)
        micros, first = round(step / timedelta(microseconds=1)), row["a"].isoformat(sep=" ")
    seconds = ((F.col("id") * micros).cast("decimal(24,6)") / 1_000_000).cast("decimal(18,6)")
    moved = F.lit(first).cast("timestamp_ntz") + F.make_dt_interval(secs=seconds)
    return spark.range(count).select(moved.alias("ts"))


def infer_step_grid(df: DataFrame, ts: str, end: Column) -> DataFrame:
    """Grid from the first point to ``end`` with the step of the first two points."""
    return _points(series_bounds(df, ts), "first_ts", end)


def forecast_horizon(df: DataFrame, ts: str) -> DataFrame:
    """Grid of future points after the series, as long as the series itself.

    The span counts in whole days, or in whole hours if it is under one day.
    """
    seconds = F.unix_seconds(F.col("last_ts").cast("timestamp")) - F.unix_seconds(
        F.col("first_ts").cast("timestamp")
    )
    unit = F.when(seconds >= 86400, 86400).otherwise(3600)
    whole = (F.floor(seconds / unit) * unit).cast("int")
    end = F.col("last_ts") + F.make_dt_interval(secs=whole)
    return _points(series_bounds(df, ts), "last_ts", end)


def is_open(closed: Column) -> Column:
    return F.when(closed.isNull(), 1).otherwise(0)
