"""Several 0/1 labels by one classifier each, in a chain, or by label combination."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Estimator, PipelineModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dunlin.learn.classify import classify_infer, fit_classifier
from dunlin.session import materialize


def binary_relevance(
    train: DataFrame, labels: Sequence[str], features: Sequence[str], estimator: Estimator
) -> dict[str, PipelineModel]:
    """One pipeline per label on the same features."""
    return {c: fit_classifier(train, c, estimator, features) for c in labels}


def predict_each(models: dict[str, PipelineModel], df: DataFrame) -> DataFrame:
    """Add ``<label>_predicted`` for every label; all models run in one pass."""
    for c, model in models.items():
        df = classify_infer(model, df, f"{c}_predicted").withColumn(
            f"{c}_predicted", F.col(f"{c}_predicted").cast("int")
        )
    return df


def classifier_chain(
    train: DataFrame, labels: Sequence[str], features: Sequence[str], estimator: Estimator
) -> list[tuple[str, list[str], PipelineModel]]:
    """Each label also sees the true earlier labels: ``(label, inputs, model)`` in order."""
    chain = []
    for i, c in enumerate(labels):
        inputs = [*features, *[f"{e}_seen" for e in labels[:i]]]
        seen = train.withColumns({f"{e}_seen": F.col(e).cast("double") for e in labels[:i]})
        chain.append((c, inputs, fit_classifier(seen, c, estimator, inputs)))
    return chain


def predict_chain(chain: list, df: DataFrame) -> DataFrame:
    """Add ``<label>_predicted``, each fed the earlier predictions."""
    columns = list(df.columns)
    for c, _, model in chain:
        df = classify_infer(model, df, f"{c}_predicted")
        df = df.withColumn(f"{c}_predicted", F.col(f"{c}_predicted").cast("int"))
        df = df.withColumn(f"{c}_seen", F.col(f"{c}_predicted").cast("double"))
    return df.select(*columns, *[f"{c}_predicted" for c, _, _ in chain])


def powerset(labels: Sequence[str]) -> Column:
    """All labels of a row as one class name."""
    return F.concat_ws("|", *[F.col(c).cast("string") for c in labels])


def label_powerset(
    train: DataFrame, labels: Sequence[str], features: Sequence[str], estimator: Estimator
) -> PipelineModel:
    combined = materialize(train.withColumn("__set", powerset(labels)), "powerset")
    return fit_classifier(combined, "__set", estimator, features)


def predict_powerset(model: PipelineModel, df: DataFrame, labels: Sequence[str]) -> DataFrame:
    parts = F.split("__set_predicted", r"\|")
    out = classify_infer(model, df, "__set_predicted")
    return out.withColumns(
        {f"{c}_predicted": parts[i].cast("int") for i, c in enumerate(labels)}
    ).drop("__set_predicted")
