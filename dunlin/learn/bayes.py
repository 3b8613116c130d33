"""Naive Bayes whose parameters are plain aggregates, for any number of labels at once."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.classification import NaiveBayes
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dunlin.learn.classify import FEATURES, INDEX
from dunlin.operators.joins import lookup_join
from dunlin.operators.neighbors import as_double
from dunlin.session import materialize


def gaussian_nb() -> NaiveBayes:
    """MLlib estimator for continuous features."""
    return NaiveBayes(modelType="gaussian", featuresCol=FEATURES, labelCol=INDEX)


def gaussian_parameters(df: DataFrame, vector: str, label: str) -> DataFrame:
    """Rows ``(label, pos, n, mean, var)`` of class-wise normal densities."""
    cells = df.select(F.col(label).alias("label"), F.posexplode(as_double(vector)).alias("pos", "x"))
    return cells.groupBy("label", "pos").agg(
        F.count("*").alias("n"), F.avg("x").alias("mean"), F.var_pop("x").alias("var")
    )


def melt_labels(df: DataFrame, row_id: str, labels: Sequence[str]) -> DataFrame:
    """Rows ``(row_id, label, class)``, one per row and label column."""
    pairs = ", ".join(f"'{c}', cast(`{c}` as int)" for c in labels)
    return df.select(row_id, F.expr(f"stack({len(labels)}, {pairs}) as (label, class)"))


def multinomial_parameters(
    weights: DataFrame, truth: DataFrame, row_id: str, smoothing: float = 1.0
) -> tuple[DataFrame, DataFrame]:
    """Smoothed ``(label, class, term, logp)`` and ``(label, class, prior)``.

    ``weights`` is long form ``(row_id, term, tfidf)``; ``truth`` as from ``melt_labels``.
    """
    known = weights.join(truth, row_id)
    sums = materialize(known.groupBy("label", "class", "term").agg(F.sum("tfidf").alias("w")), "sums")
    totals = sums.groupBy("label", "class").agg(F.sum("w").alias("total"))
    # All terms of the labelled rows: a class lacking a term still has its smoothed weight.
    terms = sums.groupBy("label", "term").agg(F.max(F.lit(1)).alias("one"))
    sizes = terms.groupBy("label").agg(F.count("*").alias("size"))
    classes = totals.join(sizes, "label")
    every = lookup_join(terms.select("label", "term"), classes.groupBy("label").agg(
        F.collect_list(F.struct("class", "total", "size")).alias("c")
    ), ["label"]).select("label", "term", F.inline("c"))
    logp = F.log(
        (F.coalesce("w", F.lit(0.0)) + smoothing) / (F.col("total") + smoothing * F.col("size"))
    )
    table = every.join(sums, ["label", "class", "term"], "left").select(
        "label", "class", "term", logp.alias("logp")
    )
    counts = truth.groupBy("label", "class").agg(F.count("*").alias("n"))
    rows = counts.groupBy("label").agg(F.sum("n").alias("all"))
    prior = counts.join(rows, "label").select("label", "class", F.log(F.col("n") / F.col("all")).alias("prior"))
    return table, prior


def multinomial_predict(
    weights: DataFrame, table: DataFrame, prior: DataFrame, row_id: str
) -> DataFrame:
    """Rows ``(row_id, label, predicted)``: the class of the largest log probability.

    The classes of all labels are columns, so a term of a row stays one row; the driver sees the prior only.
    """
    known = prior.where(F.col("label").isNotNull() & F.col("class").isNotNull()).collect()
    if not known:
        return weights.crossJoin(prior).where(F.lit(False)).select(row_id, "label", F.col("class").alias("predicted"))
    own = [(F.col("label") == r["label"]) & (F.col("class") == r["class"]) for r in known]
    per_term = table.groupBy("term").agg(
        *[F.sum(F.when(c, F.col("logp"))).alias(f"p{i}") for i, c in enumerate(own)],
        *[F.max(c).alias(f"h{i}") for i, c in enumerate(own)],
    )
    scored = lookup_join(weights, per_term, ["term"])
    sums = scored.groupBy(row_id).agg(
        *[F.sum(F.col("tfidf") * F.col(f"p{i}")).alias(f"s{i}") for i in range(len(known))],
        *[F.max(f"h{i}").alias(f"h{i}") for i in range(len(known))],
    )
    each = [
        F.struct(
            F.lit(r["label"]).alias("label"), F.lit(r["class"]).cast(prior.schema["class"].dataType).alias("class"),
            F.round(F.col(f"s{i}") + F.lit(r["prior"]), 9).alias("s"), F.coalesce(f"h{i}", F.lit(False)).alias("held"),
        )
        for i, r in enumerate(known)
    ]
    total = sums.select(row_id, F.inline(F.array(*each))).where("held")
    winner = F.max_by("class", F.struct("s", -F.col("class")))
    return total.groupBy(row_id, "label").agg(winner.alias("predicted"))
