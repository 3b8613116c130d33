"""Multi-label learning judged on rows it was not fitted on."""

import numpy as np
import pytest

from dunlin.learn import classify, multilabel
from dunlin.operators import ordering
from dunlin.session import materialize

LABELS, FEATURES = ["a", "b"], ["x", "y"]


@pytest.fixture(scope="module")
def rows(spark):
    """``a`` is the sign of x; ``b`` is the sign of y where ``a`` holds, and 0 elsewhere."""
    rng = np.random.default_rng(4)
    points = rng.uniform(-1, 1, (400, 2))
    made = [(i, float(x), float(y), int(x > 0), int(x > 0 and y > 0)) for i, (x, y) in enumerate(points)]
    df = spark.createDataFrame(made, "id long, x double, y double, a int, b int")
    return materialize(ordering.random_split(df, "id", 0.7), "split")


def chained(train, df):
    chain = multilabel.classifier_chain(train, LABELS, FEATURES, classify.tree())
    return multilabel.predict_chain(chain, df)


def by_sets(train, df):
    return multilabel.predict_powerset(multilabel.label_powerset(train, LABELS, FEATURES, classify.tree()), df, LABELS)


@pytest.mark.parametrize("predict", [chained, by_sets])
def test_held_out_rows_are_predicted_without_their_labels(rows, predict):
    train = rows.where("part = 'train'")
    held_out = ordering.test_size(400, 0.7)
    assert train.count() == 400 - held_out
    got = {r.id: r for r in predict(train, rows).collect()}
    held = [r for r in got.values() if r.part == "test"]
    assert len(got) == 400 and len(held) == held_out
    assert sum(r.a == r.a_predicted and r.b == r.b_predicted for r in held) >= 0.95 * len(held)
    # Predictions of held-out rows stay when their labels are turned round.
    turned = rows.where("part = 'test'").selectExpr("id", "x", "y", "1 - a AS a", "1 - b AS b", "part")
    again = predict(train, turned).collect()
    assert {(r.id, r.a_predicted, r.b_predicted) for r in again} == {(r.id, r.a_predicted, r.b_predicted) for r in held}
