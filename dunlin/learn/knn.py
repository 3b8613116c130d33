"""k-nearest-neighbour classification, regression and choice of k."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dunlin.learn.metrics import ratio
from dunlin.operators.joins import lookup_join
from dunlin.operators.neighbors import knn_join


def _neighbours(train: DataFrame, test: DataFrame, row_id: str, vector: str, target: str, k: int):
    pairs = knn_join(test, train, k, row_id, row_id, vector)
    known = train.select(F.col(row_id).alias(f"neighbor_{row_id}"), F.col(target).alias("__t"))
    return lookup_join(pairs, known, [f"neighbor_{row_id}"])


def _vote(votes: DataFrame, keys: list[str]) -> DataFrame:
    """Most frequent label per key; of equally frequent ones the lowest."""
    counts = votes.groupBy(*keys, "__t").agg(F.count("*").alias("n"))
    winner = F.min(F.struct((-F.col("n")).alias("n"), "__t"))
    return counts.groupBy(*keys).agg(winner.getField("__t").alias("predicted"))


def knn_classify(
    train: DataFrame, test: DataFrame, row_id: str, vector: str, target: str, k: int = 5
) -> DataFrame:
    """Rows ``(row_id, predicted)`` by majority among the ``k`` nearest training rows."""
    return _vote(_neighbours(train, test, row_id, vector, target, k), [row_id])


def knn_regress(
    train: DataFrame, test: DataFrame, row_id: str, vector: str, target: str, k: int = 5
) -> DataFrame:
    """Rows ``(row_id, predicted)`` by the mean of the ``k`` nearest training rows."""
    pairs = _neighbours(train, test, row_id, vector, target, k)
    return pairs.groupBy(row_id).agg(F.avg("__t").alias("predicted"))


def knn_k_sweep(
    train: DataFrame, test: DataFrame, row_id: str, vector: str, target: str, k_max: int
) -> DataFrame:
    """Rows ``(k, accuracy, weighted_f1)`` for k = 1..k_max from one neighbour join."""
    pairs = _neighbours(train, test, row_id, vector, target, k_max)
    voters = pairs.withColumn("k", F.explode(F.sequence(F.col("rank"), F.lit(k_max))))
    predicted = _vote(voters.select(row_id, "k", "__t"), [row_id, "k"])
    truth = test.select(row_id, F.col(target).alias("truth"))
    cells = (
        predicted.join(truth, row_id)
        .groupBy("k", "truth", "predicted")
        .agg(F.count("*").alias("n"))
        .select("k", "n", F.inline(F.array(
            F.struct(F.col("truth").alias("label"), F.lit(1).alias("t"),
                     (F.col("truth") == F.col("predicted")).cast("int").alias("p")),
            F.struct(F.col("predicted").alias("label"),
                     (F.col("truth") == F.col("predicted")).cast("int").alias("t"),
                     F.lit(1).alias("p")),
        )))
    )
    # A hit appears twice (as truth and as prediction) and counts half each time.
    hit = F.sum(F.when((F.col("t") == 1) & (F.col("p") == 1), F.col("n")).otherwise(0)) / 2
    classes = cells.groupBy("k", "label").agg(
        hit.alias("tp"),
        (F.sum(F.when((F.col("t") == 1) & (F.col("p") == 0), F.col("n")).otherwise(0))).alias("fn"),
        (F.sum(F.when((F.col("t") == 0) & (F.col("p") == 1), F.col("n")).otherwise(0))).alias("fp"),
    )
    support = F.col("tp") + F.col("fn")
    f1 = ratio(2 * F.col("tp"), 2 * F.col("tp") + F.col("fp") + F.col("fn"))
    return classes.groupBy("k").agg(
        (F.sum("tp") / F.sum(support)).alias("accuracy"),
        (F.sum(f1 * support) / F.sum(support)).alias("weighted_f1"),
    )
