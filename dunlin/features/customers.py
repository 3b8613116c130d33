"""Client and contract feature tables: bands, indicators and sums per client."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dunlin.features.encoding import bands, code_indicators, count_bands, ordinal_encode
from dunlin.functions.times import age_at, is_open
from dunlin.operators.joins import full_outer

# The edges of the bands.
AGE_YEAR = 2018
AGE_BANDS = ((25, 50, 75), ("young", "middle", "senior", "old"))
INCOME_BANDS = ((1500, 2000, 3300), ("income_1", "income_2", "income_3", "income_4"))
BALANCE_BANDS = (
    (1000, 5500, 20000, 45000),
    ("balance_1", "balance_2", "balance_3", "balance_4", "balance_5"),
)


def _code_names(df: DataFrame, column: str) -> list[str]:
    """A column name for every category that the data hold."""
    found = df.agg(F.count_distinct(column)).first()[0]
    return [f"{column}_{i}" for i in range(found)]


def client_features(df: DataFrame) -> DataFrame:
    """From ``(id, segment, born, income, cars)`` to one row of sums per client."""
    segments = _code_names(df, "segment")
    coded = ordinal_encode(df, "segment", "code").withColumn("age", age_at(AGE_YEAR, F.col("born")))
    flags = coded.withColumns(
        {
            **bands("age", *AGE_BANDS),
            **code_indicators("code", segments),
            **bands("income", *INCOME_BANDS),
        }
    )
    summed = ["cars", *AGE_BANDS[1], *segments, *INCOME_BANDS[1]]
    return flags.groupBy("id").agg(*[F.sum(c).alias(c) for c in summed])


def contract_features(df: DataFrame) -> DataFrame:
    """From ``(id, product, closed, balance)`` to one row of sums and bands per client."""
    products = _code_names(df, "product")
    coded = ordinal_encode(df, "product", "code")
    flags = coded.withColumns(
        {**code_indicators("code", products), "ongoing": is_open(F.col("closed"))}
    )
    sums = flags.groupBy("id").agg(*[F.sum(c).alias(c) for c in (*products, "balance", "ongoing")])
    banded = sums.withColumns(
        {**count_bands("ongoing", "ongoing", 4), **bands("balance", *BALANCE_BANDS)}
    )
    return banded.drop("ongoing", "balance")


def feature_table(clients: DataFrame, contracts: DataFrame) -> DataFrame:
    """Contract and client features side by side, clients of either kept."""
    return full_outer(contract_features(contracts), client_features(clients), ["id"])
