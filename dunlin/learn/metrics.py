"""Classification, multi-label and regression metrics as single aggregates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dunlin.session import materialize

DIGITS = 2


def ratio(top: Column, bottom: Column) -> Column:
    return F.when(bottom == 0, 0.0).otherwise(top / bottom)


def _cells(truth: Column, predicted: Column) -> dict[str, Column]:
    def n(t, p):
        return F.count(F.when((truth == t) & (predicted == p), 1))

    return {"tn": n(0, 0), "fp": n(0, 1), "fn": n(1, 0), "tp": n(1, 1)}


def binary_report(df: DataFrame, truth: str, predicted: str) -> DataFrame:
    """One row of accuracy, F1, recall, precision, ROC AUC of hard labels and the 2x2 counts."""
    counts = df.agg(*[c.alias(n) for n, c in _cells(F.col(truth), F.col(predicted)).items()])
    tn, fp, fn, tp = (F.col(c) for c in ("tn", "fp", "fn", "tp"))
    recall = ratio(tp, tp + fn)
    scores = {
        "accuracy": ratio(tp + tn, tp + tn + fp + fn),
        "f1": ratio(2 * tp, 2 * tp + fp + fn),
        "recall": recall,
        "precision": ratio(tp, tp + fp),
        "roc_auc": (recall + ratio(tn, tn + fp)) / 2,
    }
    return counts.select(
        *[F.round(s, DIGITS).alias(n) for n, s in scores.items()], "tn", "fp", "fn", "tp"
    )


def class_counts(df: DataFrame, truth: str, predicted: str) -> DataFrame:
    """Rows ``(label, tn, fp, fn, tp)`` for every true class, one against the rest.

    One shuffle of the confusion matrix; later steps see classes squared rows.
    """
    matrix = df.groupBy(F.col(truth).alias("t"), F.col(predicted).alias("p")).agg(
        F.count("*").alias("n")
    )
    hit = F.when(F.col("t") == F.col("p"), F.col("n")).otherwise(0)
    none = F.lit(0).cast("long")
    sides = F.array(
        F.struct(F.col("t").alias("label"), F.col("n").alias("support"), hit.alias("tp"), none.alias("given")),
        F.struct(F.col("p").alias("label"), none.alias("support"), none.alias("tp"), F.col("n").alias("given")),
    )
    rows = matrix.select(F.inline(sides)).groupBy("label").agg(
        F.sum("support").alias("support"), F.sum("tp").alias("tp"), F.sum("given").alias("given")
    )
    total = F.sum("support").over(Window.partitionBy(F.lit(0)))  # one row per class
    fp, fn = F.col("given") - F.col("tp"), F.col("support") - F.col("tp")
    return (
        rows.withColumn("total", total)
        .where(F.col("label").isNotNull() & (F.col("support") > 0))
        .select("label", (F.col("total") - F.col("support") - fp).alias("tn"), fp.alias("fp"), fn.alias("fn"), "tp")
    )


def _class_scores(df: DataFrame, truth: str, predicted: str) -> DataFrame:
    fp, fn, tp = F.col("fp"), F.col("fn"), F.col("tp")
    return class_counts(df, truth, predicted).select(
        F.col("label").cast("string").alias("label"),
        ratio(tp, tp + fp).alias("precision"),
        ratio(tp, tp + fn).alias("recall"),
        ratio(2 * tp, 2 * tp + fp + fn).alias("f1"),
        (tp + fn).alias("support"),
        "tn",
        "fp",
        "fn",
        "tp",
    )


def multiclass_report(df: DataFrame, truth: str, predicted: str) -> DataFrame:
    """Per-class scores and counts, then ``accuracy``, ``macro avg`` and ``weighted avg`` rows."""
    scores = materialize(_class_scores(df, truth, predicted), "scores")  # read by four branches
    names = ["precision", "recall", "f1"]
    support = F.sum("support")
    none = F.lit(None).cast("long")
    empty = [none.alias(c) for c in ("tn", "fp", "fn", "tp")]

    def summary(label: str, value) -> DataFrame:
        return scores.agg(*[value(c).alias(c) for c in names], support.alias("support")).select(
            F.lit(label).alias("label"), *names, "support", *empty
        )

    return (
        scores.union(summary("accuracy", lambda _: F.sum("tp") / support))
        .union(summary("macro avg", lambda c: F.avg(c)))
        .union(summary("weighted avg", lambda c: F.sum(F.col(c) * F.col("support")) / support))
    )


def weighted_f1(df: DataFrame, truth: str, predicted: str) -> DataFrame:
    scores = _class_scores(df, truth, predicted)
    return scores.agg(
        (F.sum(F.col("f1") * F.col("support")) / F.sum("support")).alias("weighted_f1")
    )


def _melted(df: DataFrame, labels: Sequence[str], suffix: str) -> DataFrame:
    pairs = ", ".join(f"'{c}', cast(`{c}` as int), cast(`{c}{suffix}` as int)" for c in labels)
    return df.select(F.expr(f"stack({len(labels)}, {pairs}) as (label, truth, predicted)"))


def multilabel_confusion(df: DataFrame, labels: Sequence[str], suffix: str = "_predicted") -> DataFrame:
    """Rows ``(label, tn, fp, fn, tp)`` from one pass over 0/1 label columns."""
    cells = _cells(F.col("truth"), F.col("predicted"))
    return _melted(df, labels, suffix).groupBy("label").agg(*[c.alias(n) for n, c in cells.items()])


def label_accuracy(df: DataFrame, labels: Sequence[str], suffix: str = "_predicted") -> DataFrame:
    hit = F.when(F.col("truth") == F.col("predicted"), 1.0).otherwise(0.0)
    return _melted(df, labels, suffix).groupBy("label").agg(F.avg(hit).alias("accuracy"))


def multilabel_scores(df: DataFrame, labels: Sequence[str], suffix: str = "_predicted") -> DataFrame:
    """One row: share of rows with all labels right, and share of wrong cells."""
    wrong = sum(
        F.when(F.col(c) == F.col(f"{c}{suffix}"), 0).otherwise(1) for c in labels
    )
    return df.agg(
        F.avg(F.when(wrong == 0, 1.0).otherwise(0.0)).alias("subset_accuracy"),
        (F.avg(wrong) / len(labels)).alias("hamming_loss"),
    )


def regression_report(df: DataFrame, truth: str, predicted: str) -> DataFrame:
    """One row: max error, R2, MAE, MSE and RMSE to two places."""
    gap = F.col(truth) - F.col(predicted)
    mse = F.avg(gap * gap)
    spread = F.var_pop(truth)
    return df.agg(
        F.round(F.max(F.abs(gap)), DIGITS).alias("max_error"),
        F.round(
            F.when(spread == 0, F.when(mse == 0, 1.0).otherwise(0.0)).otherwise(1 - mse / spread),
            DIGITS,
        ).alias("r2"),
        F.round(F.avg(F.abs(gap)), DIGITS).alias("mae"),
        F.round(mse, DIGITS).alias("mse"),
        F.round(F.sqrt(mse), DIGITS).alias("rmse"),
    )


def anomaly_flags(df: DataFrame, detected: str) -> DataFrame:
    """Detector output 1 / -1 as ``isAnomaly`` 0 / 1."""
    return df.withColumn("isAnomaly", F.when(F.col(detected) == -1, 1).otherwise(0))


def anomaly_totals(df: DataFrame, detected: str, group: str) -> DataFrame:
    """Anomalies and normal results, ``Total`` first, then per group id."""
    flags = anomaly_flags(df, detected).rollup(group).agg(
        F.grouping(group).alias("g"),
        F.sum("isAnomaly").alias("anomalies"),
        F.sum(1 - F.col("isAnomaly")).alias("normal"),
    )
    name = F.when(F.col("g") == 1, "Total").otherwise(F.col(group).cast("string"))
    return flags.orderBy(F.desc("g"), group).select(name.alias("id"), "anomalies", "normal")
