"""G-means: split clusters until their rows look normal along the split direction.

One round tests every cluster at once: all 2-means fits share their scans, and
the ranks of the normality test come from one range sort by cluster.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from dunlin.cluster.assign import CenterModel
from dunlin.cluster.kmeans import Fit, label_rows, run_fits, spread_centers, spreads
from dunlin.features.scaling import apply_scale, fit_minmax
from dunlin.operators.joins import lookup_join
from dunlin.operators.neighbors import vector_of
from dunlin.operators.ordering import ranked
from dunlin.session import materialize, widen

CLUSTER = "clusterId"
MAX_CLUSTERS = 200


@F.pandas_udf(DoubleType())
def _log_lower_tail(w: pd.Series) -> pd.Series:
    """ln of the normal distribution function."""
    tail = np.fromiter((math.erfc(-x / math.sqrt(2)) / 2 for x in w.clip(-37, 37)), float, len(w))
    return pd.Series(np.log(tail))


def critical_value(n):
    """1 % threshold of the statistic with estimated mean and deviation."""
    return 1.092 / (1 + 4 / n - 25 / (n * n))


def anderson_darling(df: DataFrame, group: str, value: str, row_id: str) -> DataFrame:
    """Rows ``(group, n, statistic, critical, normal)`` of the normality test per group."""
    stats = df.groupBy(group).agg(
        F.avg(value).alias("__m"), F.stddev_samp(value).alias("__s"), F.count("*").alias("__n")
    )
    placed = ranked(df.select(group, value, row_id), [value, row_id], [group], name="__i")
    joined = lookup_join(placed, stats, [group]).where((F.col("__n") > 1) & (F.col("__s") > 0))
    w = (F.col(value) - F.col("__m")) / F.col("__s")
    i, n = F.col("__i") + 1, F.col("__n")
    term = (2 * i - 1) * _log_lower_tail(w) + (2 * (n - i) + 1) * _log_lower_tail(-w)
    sums = joined.withColumn("__t", term).groupBy(group).agg(
        F.sum("__t").alias("__t"), F.max("__n").alias("n")
    )
    statistic = -F.col("n") - F.col("__t") / F.col("n")
    return sums.select(
        group, "n", statistic.alias("statistic"), critical_value(F.col("n")).alias("critical")
    ).withColumn("normal", (F.col("statistic") < F.col("critical")).cast("int"))


def gmeans(
    df: DataFrame,
    row_id: str,
    features: Sequence[str],
    max_clusters: int = MAX_CLUSTERS,
    max_iter: int = 100,
    seed: int = 42,
) -> tuple[CenterModel, DataFrame]:
    """``(model, rows (row, clusterId))`` on min-max scaled features."""
    scale = fit_minmax(df, features)
    scaled = apply_scale(df, scale)
    rows = scaled.select(
        F.col(row_id).cast("long").alias("row"), F.lit(0).alias("grp"), vector_of(*features).alias("v")
    )
    rows = materialize(widen(rows), "rows")
    scale_of = spreads(rows, len(features))[0]
    start = spread_centers(rows, min(2, max_clusters), seed)[0]
    fit = run_fits(rows, [Fit(0, start, max_iter=max_iter, scale=scale_of)])[0]
    while len(fit.centers) < max_clusters:
        placed = materialize(
            label_rows(rows, [{0: fit}]).select("row", F.col("labels")[0].alias("grp"), "v"), "split"
        )
        starts, own = spread_centers(placed, 2, seed), spreads(placed, len(features))
        # A cluster whose rows are all equal has one starting center.
        big = [c for c in sorted(starts) if fit.sizes[c] > 2 and len(starts[c]) > 1]
        halves = run_fits(placed, [Fit(c, starts[c], max_iter=max_iter, scale=own[c]) for c in big])
        halves = {h.grp: h for h in halves if (h.centers[0] != h.centers[1]).any()}
        split = _rejected(placed, halves)
        centers, room = [], max_clusters - len(fit.centers)
        for c in np.argsort(-fit.sizes, kind="stable"):
            if int(c) in split and room > 0:
                centers.extend(halves[int(c)].centers)
                room -= 1
            else:
                centers.append(fit.centers[c])
        if len(centers) == len(fit.centers):
            break
        fit = run_fits(rows, [Fit(0, np.array(centers), max_iter=max_iter, scale=scale_of)])[0]
    labelled = label_rows(rows, [{0: fit}]).select("row", F.col("labels")[0].alias(CLUSTER))
    return CenterModel(features, scale, fit.centers), labelled


def _rejected(placed: DataFrame, halves: dict[int, Fit]) -> set[int]:
    """Clusters whose rows, projected on the line between their halves, are not normal."""
    if not halves:
        return set()
    lines = {c: h.centers[0] - h.centers[1] for c, h in halves.items()}

    def project(batches):
        for pdf in batches:
            for c, part in pdf.groupby("grp"):
                if c in lines:
                    v = lines[c]
                    y = np.stack(part["v"].to_numpy()) @ v / (v @ v)
                    yield pd.DataFrame({"row": part["row"], "grp": part["grp"], "y": y})

    projected = placed.mapInPandas(project, "row long, grp int, y double")
    tests = anderson_darling(projected, "grp", "y", "row")
    return {r["grp"] for r in tests.where("normal = 0").select("grp").collect()}
