"""CSV in and out."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def read_csv(
    spark: SparkSession,
    path: str,
    schema: StructType | str | None = None,
    columns: Sequence[str] | None = None,
    sep: str = ",",
    null_value: str = "",
    line_end: str = "\n",
    multi_line: bool = False,
) -> DataFrame:
    """Header CSV. With a schema there is no pass over the data to infer one,
    and ``columns`` reaches the scan as its read schema.

    A quote inside quotes is doubled. Line ends inside quotes need ``multi_line``,
    which reads every file in one task. A malformed row stops the read.
    """
    reader = (
        spark.read.option("header", True)
        .option("mode", "FAILFAST")
        .option("escape", '"')
        .option("multiLine", multi_line)
        .option("sep", sep)
        .option("lineSep", line_end)
        .option("nullValue", null_value)
    )
    reader = reader.schema(schema) if schema is not None else reader.option("inferSchema", True)
    df = reader.csv(path)
    return df.select(*columns) if columns else df


def write_csv(
    df: DataFrame,
    path: str,
    by: Sequence[str] = (),
    sep: str = ",",
    null_value: str = "",
    line_end: str = "\n",
) -> str:
    """Header CSV without an index; ``by`` makes one folder per key in one pass."""
    writer = (
        df.write.option("header", True)
        .option("escape", '"')
        .option("sep", sep)
        .option("lineSep", line_end)
        .option("nullValue", null_value)
    )
    if by:
        writer = writer.partitionBy(*by)
    writer.csv(path)
    return path
