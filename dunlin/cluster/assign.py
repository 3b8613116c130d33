"""Clusters of new rows from a fitted clustering."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dunlin.cluster.kmeans import Fit, label_rows
from dunlin.features.scaling import apply_scale
from dunlin.operators.joins import lookup_join
from dunlin.operators.neighbors import knn_join, vector_of

CLUSTER = "clusterId"


@dataclass
class CenterModel:
    """Centers in the scaled space of the training rows."""

    features: Sequence[str]
    scale: dict[str, tuple[float, float]]
    centers: np.ndarray

    def infer(self, df: DataFrame, row_id: str) -> DataFrame:
        """Rows ``(row, clusterId)`` by the nearest center, scaled as in training."""
        rows = apply_scale(df, self.scale).select(
            F.col(row_id).cast("long").alias("row"), F.lit(0).alias("grp"), vector_of(*self.features).alias("v")
        )
        labelled = label_rows(rows, [{0: Fit(0, self.centers)}])
        return labelled.select("row", F.col("labels")[0].alias(CLUSTER))


def nearest_label(new: DataFrame, known: DataFrame, new_id: str, known_id: str, vector: str) -> DataFrame:
    """Rows ``(new_id, clusterId)``: the cluster of the nearest known vector.

    For clusterings without centers, from labelled rows, and for summaries,
    from their labelled centers.
    """
    refs = known.select(F.col(known_id).alias("__known"), vector)
    near = knn_join(new.select(new_id, vector), refs, 1, new_id, "__known", vector)
    labels = known.select(F.col(known_id).alias("__known"), CLUSTER)
    return lookup_join(near, labels, ["__known"]).select(new_id, CLUSTER)
