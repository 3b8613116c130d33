"""Categories to numbers: ordinal codes, indicators and bands."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline
from pyspark.ml.feature import OneHotEncoder, StringIndexer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dunlin.operators.joins import lookup_join
from dunlin.operators.ordering import ranked

MAX_INDICATORS = 1000
NUMERIC = {"tinyint", "smallint", "int", "bigint", "float", "double"}


def categories(df: DataFrame, column: str) -> DataFrame:
    """Sorted distinct values with their code from 0: ``(column, code)``."""
    values = df.where(F.col(column).isNotNull()).select(column).distinct()
    return ranked(values, [column], name="code")


def ordinal_encode(df: DataFrame, column: str, name: str, codes: DataFrame | None = None) -> DataFrame:
    """Code in sorted order; -1 for null and for values the codes do not hold."""
    codes = categories(df, column) if codes is None else codes
    joined = lookup_join(df, codes, [column], "left")
    return joined.select(*df.columns, F.coalesce("code", F.lit(-1)).cast("int").alias(name))


def category_list(df: DataFrame, column: str, limit: int = MAX_INDICATORS) -> list:
    """Sorted distinct values for one indicator column each; refused beyond ``limit``."""
    rows = df.where(F.col(column).isNotNull()).select(column).distinct().limit(limit + 1).collect()
    if len(rows) > limit:
        raise ValueError(f"{column} has more than {limit} values: use one_hot_stages (sparse vectors)")
    return sorted(r[0] for r in rows)


def one_hot(df: DataFrame, column: str, values: Sequence | None = None) -> DataFrame:
    """One 0/1 column per category; a value not in the list, or null, gives all zeros."""
    values = category_list(df, column) if values is None else values
    return df.withColumns({f"{column}_{v}": F.when(F.col(column) == v, 1).otherwise(0) for v in values})


def one_hot_stages(columns: Sequence[str]) -> Pipeline:
    """Sparse-vector form with all categories; unseen and null rows give zeros."""
    indexed = [f"{c}_index" for c in columns]
    return Pipeline(
        stages=[
            StringIndexer(
                inputCols=list(columns),
                outputCols=indexed,
                stringOrderType="alphabetAsc",
                handleInvalid="keep",
            ),
            OneHotEncoder(
                inputCols=indexed, outputCols=[f"{c}_hot" for c in columns], dropLast=True
            ),
        ]
    )


def code_indicators(code: str, names: Sequence[str]) -> dict[str, Column]:
    """One 0/1 column per code 0, 1, 2, ..."""
    return {n: F.when(F.col(code) == i, 1).otherwise(0) for i, n in enumerate(names)}


def bands(column: str, edges: Sequence[float], names: Sequence[str]) -> dict[str, Column]:
    """0/1 columns for ranges open below and closed above; null is in none."""
    low = [None, *edges]
    high = [*edges, None]
    out = {}
    for name, a, b in zip(names, low, high):
        inside = F.lit(True)
        if a is not None:
            inside = inside & (F.col(column) > a)
        if b is not None:
            inside = inside & (F.col(column) <= b)
        out[name] = F.when(inside, 1).otherwise(0)
    return out


def count_bands(column: str, name: str, top: int) -> dict[str, Column]:
    """0/1 columns for the values 0..top."""
    return {f"{name}_{i}": F.when(F.col(column) == i, 1).otherwise(0) for i in range(top + 1)}


def split_types(df: DataFrame, columns: Sequence[str]) -> tuple[list[str], list[str]]:
    """Numeric and categorical columns by their declared type."""
    types = dict(df.dtypes)
    numeric = [c for c in columns if types[c] in NUMERIC]
    return numeric, [c for c in columns if c not in numeric]
