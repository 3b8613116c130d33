"""Trees, forests and balanced bags of them on scaled, encoded features."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Estimator, PipelineModel
from pyspark.ml.classification import DecisionTreeClassifier, RandomForestClassifier
from pyspark.ml.feature import IndexToString, SQLTransformer, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dunlin.features.encoding import one_hot_stages
from dunlin.features.scaling import fit_standard
from dunlin.operators.draws import first_drawn
from dunlin.operators.frame import flag_mismatch
from dunlin.operators.ordering import hash_order, ordered_split, ranked
from dunlin.session import materialize, widen

FEATURES = "__features"
INDEX = "__label"
TASK_ROWS = 1 << 21  # rows of a bag that a task holds while trees grow
MAX_BINS = 256  # split points per feature, and the most categories of an ordinal column


def tree(max_depth: int = 5, seed: int = 42) -> Estimator:
    return DecisionTreeClassifier(
        featuresCol=FEATURES, labelCol=INDEX, maxDepth=max_depth, maxBins=MAX_BINS, seed=seed
    )


def forest(trees: int = 20, max_depth: int = 5, seed: int = 42) -> Estimator:
    return RandomForestClassifier(
        featuresCol=FEATURES, labelCol=INDEX, numTrees=trees, maxDepth=max_depth, maxBins=MAX_BINS,
        seed=seed,
    )


def scale_stage(df: DataFrame, numeric: Sequence[str]) -> SQLTransformer:
    """Population z-scores fitted on ``df``, as a stage that is saved with its pipeline."""
    parts = [
        f"(`{c}` - {mean!r}D) / {(width or 1.0)!r}D AS `__z_{c}`"
        for c, (mean, width) in fit_standard(df, numeric).items()
    ]
    return SQLTransformer(statement=", ".join(["SELECT *", *parts]) + " FROM __THIS__")


def fit_features(
    df: DataFrame, numeric: Sequence[str], categorical: Sequence[str] = (), encoding: str = "one_hot"
) -> PipelineModel:
    """Fitted feature stages ending in the vector column; unseen or null categories are all zero, or the code after the last.

    ``trees.OrdinalTrees`` codes them -1 and has no bound on their number.
    """
    stages, inputs = [], []
    if numeric:
        stages.append(scale_stage(df, numeric))
        inputs += [f"__z_{c}" for c in numeric]
    if categorical and encoding == "one_hot":
        stages.append(one_hot_stages(categorical).fit(df))
        inputs += [f"{c}_hot" for c in categorical]
    elif categorical:
        indexed = [f"{c}_index" for c in categorical]
        stages.append(
            StringIndexer(
                inputCols=list(categorical), outputCols=indexed, stringOrderType="alphabetAsc",
                handleInvalid="keep",
            ).fit(df)
        )
        inputs += indexed
    stages.append(VectorAssembler(inputCols=inputs, outputCol=FEATURES, handleInvalid="keep"))
    return PipelineModel(stages=stages)


def fit_classifier(
    train: DataFrame,
    label: str,
    estimator: Estimator,
    numeric: Sequence[str] = (),
    categorical: Sequence[str] = (),
    encoding: str = "one_hot",
) -> PipelineModel:
    """Features, classifier and label names as one pipeline that adds ``predicted``."""
    prepared = fit_features(train, numeric, categorical, encoding)
    names = StringIndexer(inputCol=label, outputCol=INDEX, stringOrderType="alphabetAsc").fit(train)
    rows = names.transform(prepared.transform(train)).select(FEATURES, INDEX).persist()
    model = estimator.fit(rows)
    rows.unpersist()
    decode = IndexToString(inputCol=model.getPredictionCol(), outputCol="predicted", labels=names.labels)
    return PipelineModel(stages=[prepared, model, decode])


def classify_infer(model: PipelineModel, df: DataFrame, name: str = "predicted") -> DataFrame:
    """Input columns and the prediction of a fitted, possibly reloaded, pipeline."""
    return model.transform(df).select(*df.columns, F.col("predicted").alias(name))


def train_classifier(
    df: DataFrame,
    row_id: str,
    label: str,
    estimator: Estimator,
    numeric: Sequence[str] = (),
    categorical: Sequence[str] = (),
    encoding: str = "one_hot",
    train_factor: float = 0.7,
) -> tuple[PipelineModel, DataFrame]:
    """Ordered split, fit on its head, predict all: ``(model, rows with part, predicted, error)``."""
    rows = materialize(ordered_split(df, [row_id], train_factor).drop("row_id"), "split")
    model = fit_classifier(
        rows.where("part = 'train'"), label, estimator, numeric, categorical, encoding
    )
    out = classify_infer(model, rows)
    return model, out.withColumn("error", flag_mismatch(label, "predicted"))


def balanced_bags(df: DataFrame, row_id: str, label: str, bags: int, seed: int = 42) -> DataFrame:
    """Per bag as many rows of every class as the smallest class has: ``(bag, ...)``.

    Rows are drawn without replacement by the rank of a hash of row and bag, found
    from counts by its leading bits: no row is moved but those at the end of a draw.
    The rows are written once, with their hashes, by all cores.
    """
    mixes = F.array(*[hash_order(row_id, seed + bag) for bag in range(bags)])
    rows = materialize(widen(df).withColumn("__mixes", mixes), "mixed")
    size = rows.groupBy(label).count().agg(F.min("count")).first()[0]
    mixed = rows.select(*df.columns, F.posexplode("__mixes").alias("bag", "__mix"))
    return first_drawn(mixed, "__mix", row_id, [label, "bag"], F.lit(size)).drop("__mix")


class BalancedBagging:
    """Classifiers on balanced bags; the prediction is the class of highest mean probability."""

    def __init__(self, estimator: Estimator, bags: int = 10, seed: int = 42):
        self.estimator, self.bags, self.seed = estimator, bags, seed

    def fit(
        self,
        train: DataFrame,
        row_id: str,
        label: str,
        numeric: Sequence[str] = (),
        categorical: Sequence[str] = (),
        encoding: str = "one_hot",
    ) -> BalancedBagging:
        self.prepared = fit_features(train, numeric, categorical, encoding)
        names = StringIndexer(inputCol=label, outputCol=INDEX, stringOrderType="alphabetAsc").fit(train)
        self.labels = names.labels
        rows = names.transform(self.prepared.transform(train)).select(row_id, FEATURES, INDEX)
        drawn = balanced_bags(rows, row_id, INDEX, self.bags, self.seed)
        tasks = -(-train.count() // TASK_ROWS)  # files pack far more rows than a task can hold as vectors
        few = train.sparkSession.sparkContext.defaultParallelism < tasks
        self.models = []
        for bag in range(self.bags):
            part = drawn.where(F.col("bag") == bag)  # not persisted: a fit keeps the rows in its own, smaller form
            part = part.repartition(tasks, row_id) if few else part
            model = self.estimator.copy({self.estimator.getParam("seed"): self.seed + bag}).fit(part)
            self.models.append(
                model.setProbabilityCol(f"__p{bag}").setRawPredictionCol(f"__r{bag}").setPredictionCol(f"__y{bag}")
            )
        return self

    def transform(self, df: DataFrame) -> DataFrame:
        """All bags score a row in one pass."""
        rows = self.prepared.transform(df)
        for model in self.models:
            rows = model.transform(rows)
        given = [vector_to_array(f"__p{b}") for b in range(self.bags)]
        total = given[0]
        for p in given[1:]:
            total = F.zip_with(total, p, lambda x, y: x + y)
        rows = rows.withColumn("__total", total)
        best = F.array_position("__total", F.array_max("__total")).cast("int")
        return rows.select(*df.columns, F.element_at(F.lit(self.labels), best).alias("predicted"))


def slot_sources(model: PipelineModel, df: DataFrame) -> list[str]:
    """Source column of every slot of the feature vector, in slot order."""
    prepared = model.stages[0].transform(df.limit(1))
    groups = prepared.schema[FEATURES].metadata["ml_attr"]["attrs"]
    slots = sorted((a["idx"], a["name"]) for attrs in groups.values() for a in attrs)
    out = []
    for _, name in slots:
        plain = name[len("__z_"):] if name.startswith("__z_") else name
        hits = [c for c in df.columns if plain == c or plain.startswith((f"{c}_hot", f"{c}_index"))]
        out.append(max(hits, key=len))
    return out


def feature_importance(model: PipelineModel, df: DataFrame) -> DataFrame:
    """Rows ``(column, importance)`` to two places, indicator slots summed by source column."""
    weights = model.stages[1].featureImportances.toArray()
    rows = [(c, float(w)) for c, w in zip(slot_sources(model, df), weights)]
    slots = df.sparkSession.createDataFrame(rows, "column string, importance double")
    return slots.groupBy("column").agg(F.round(F.sum("importance"), 2).alias("importance"))


def importance_rank(model: PipelineModel, df: DataFrame) -> DataFrame:
    """Rows ``(rank, column, importance, spread)``: spread is the deviation over the trees."""
    grown = model.stages[1]
    whole = grown.featureImportances.toArray()
    trees = [(i, t.featureImportances.toArray().tolist()) for i, t in enumerate(grown.trees)]
    slots = df.sparkSession.createDataFrame(trees, "tree int, w array<double>").select(
        F.posexplode("w").alias("slot", "w")
    )
    spread = slots.groupBy("slot").agg(F.stddev_pop("w").alias("spread"))
    named = df.sparkSession.createDataFrame(
        [(i, c, float(w)) for i, (c, w) in enumerate(zip(slot_sources(model, df), whole))],
        "slot int, column string, importance double",
    )
    ordered = named.withColumn("down", -F.col("importance"))
    position = ranked(ordered.join(spread, "slot"), ["down", "slot"], name="rank")
    return position.select((F.col("rank") + 1).alias("rank"), "column", "importance", "spread")
