"""One linear model per group: fitted from aggregates, kept as a table."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType

from dunlin.operators.joins import lookup_join


@F.pandas_udf(ArrayType(DoubleType()))
def _solve(cov: pd.Series, cross: pd.Series) -> pd.Series:
    """Coefficients from the covariances of one group per row; least norm if they are singular."""
    out = []
    for c, x in zip(cov, cross):
        d = len(x)
        full = np.zeros((d, d))
        full[np.triu_indices(d)] = c
        full = full + np.triu(full, 1).T
        out.append(np.linalg.lstsq(full, np.asarray(x, dtype=float), rcond=1e-12)[0].tolist())
    return pd.Series(out)


def train_per_group(df: DataFrame, group: str, features: Sequence[str], target: str) -> DataFrame:
    """Least-squares table ``(group, n, intercept, coefficients)``, one shuffle for all groups.

    Sums of products combine before the shuffle, so one huge group costs no
    more than many small ones. Python sees one row per group.
    """
    d = len(features)
    upper = [(i, j) for i in range(d) for j in range(i, d)]
    stats = df.groupBy(group).agg(
        F.count("*").alias("n"),
        F.array(*[F.covar_pop(features[i], features[j]) for i, j in upper]).alias("cov"),
        F.array(*[F.covar_pop(f, target) for f in features]).alias("cross"),
        F.array(*[F.avg(f) for f in features]).alias("means"),
        F.avg(target).alias("mean"),
    )
    solved = stats.withColumn("coefficients", _solve("cov", "cross"))
    shift = F.aggregate(
        F.zip_with("coefficients", "means", lambda b, m: b * m), F.lit(0.0), lambda s, x: s + x
    )
    return solved.select(group, "n", (F.col("mean") - shift).alias("intercept"), "coefficients")


def infer_per_group(
    df: DataFrame, models: DataFrame, group: str, features: Sequence[str], target: str
) -> DataFrame:
    """Predictions to two places by the model of the row's group; unknown groups are dropped."""
    used = models.select(group, "intercept", "coefficients")
    value = F.col("intercept")
    for i, f in enumerate(features):
        value = value + F.col("coefficients")[i] * F.col(f)
    joined = lookup_join(df, used, [group])
    return joined.select(*df.columns, F.round(value, 2).alias(f"predicted({target})"))
