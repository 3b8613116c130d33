"""Tables from literal rows and repeatable random columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from dunlin.operators.ordering import hash_order


def inline_table(spark: SparkSession, rows: Sequence[tuple], schema: StructType | str) -> DataFrame:
    return spark.createDataFrame(list(rows), schema)


def random_columns(df: DataFrame, key: str, columns: Sequence[str], seed: int = 42) -> DataFrame:
    """Add random 0/1 columns that depend on the key and seed only.

    Rows keep their values whatever the partitioning or a retry does, which
    ``rand()`` does not promise.
    """
    return df.withColumns(
        {c: (hash_order(key, seed + i) % 2).cast("int") for i, c in enumerate(columns)}
    )


def random_table(
    spark: SparkSession, n: int, columns: Sequence[str] = ("A", "B", "C", "D"), seed: int = 42
) -> DataFrame:
    """``n`` rows of random 0/1 values with their row id."""
    return random_columns(spark.range(n).withColumnRenamed("id", "row_id"), "row_id", columns, seed)
