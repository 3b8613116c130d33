"""Whole-table checks, shape and label columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

NUMERIC = {"int", "bigint", "float", "double"}  # the types a model may be trained on


def table_shape(df: DataFrame) -> DataFrame:
    """One row ``n_rows, n_cols, n_cells``."""
    width = len(df.columns)
    return df.agg(F.count("*").alias("n_rows")).select(
        "n_rows",
        F.lit(width).cast("long").alias("n_cols"),
        (F.col("n_rows") * width).alias("n_cells"),
    )


def table_schema(df: DataFrame) -> DataFrame:
    """Rows ``(pos, column, type, non_null)``, counted in one pass."""
    counts = df.agg(*[F.count(F.col(f"`{c}`")).alias(c) for c in df.columns])
    entries = [
        F.struct(
            F.lit(i).alias("pos"),
            F.lit(name).alias("column"),
            F.lit(kind).alias("type"),
            F.col(f"`{name}`").alias("non_null"),
        )
        for i, (name, kind) in enumerate(df.dtypes)
    ]
    return counts.select(F.inline(F.array(*entries)))


def check_input(df: DataFrame, required: Sequence[str], numeric: Sequence[str]) -> DataFrame:
    """Rows ``(check, problem)`` for empty input, missing and non-numeric columns.

    Nulls count as 0, so only the declared type of a column can be wrong.
    """
    types = dict(df.dtypes)
    missing = [c for c in required if c not in types]
    wrong = [c for c in numeric if c in types and types[c] not in NUMERIC]
    return df.agg(F.count("*").alias("n")).select(
        F.inline(
            F.array(
                F.struct(
                    F.lit("empty").alias("check"),
                    F.when(F.col("n") == 0, "no rows").otherwise("").alias("problem"),
                ),
                F.struct(
                    F.lit("missing").alias("check"), F.lit(",".join(missing)).alias("problem")
                ),
                F.struct(
                    F.lit("not_numeric").alias("check"), F.lit(",".join(wrong)).alias("problem")
                ),
            )
        )
    )


def flag_mismatch(truth: str, predicted: str) -> Column:
    """0 where both are equal, else 1; a null on either side is a mismatch."""
    return F.when(F.col(truth) == F.col(predicted), 0).otherwise(1)


def combined_key(*columns: str) -> Column:
    """Text of several columns joined; a missing part reads ``nan``."""
    return F.concat(*[F.coalesce(F.col(c).cast("string"), F.lit("nan")) for c in columns])
