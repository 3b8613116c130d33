"""Level-wise trees against a tree grown row by row in plain Python."""

import hashlib
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from dunlin.learn.trees import OrdinalTrees, bin_edges, bin_of, draw_balanced


def plain_tree(rows, depth):
    """``(counts, feature, value, low, high)`` of ``rows`` of (numbers, label); cuts between values."""
    counts = Counter(y for _, y in rows)
    if len(counts) < 2 or depth == 0:
        return counts, None, None, None, None
    best = None
    for f in range(len(rows[0][0])):
        for v in sorted({x[f] for x, _ in rows}):
            low, high = Counter(y for x, y in rows if x[f] <= v), Counter(y for x, y in rows if x[f] > v)
            if high:
                score = sum(sum(c * c for c in side.values()) / sum(side.values()) for side in (low, high))
                if best is None or score > best[0] + 1e-9:
                    best = (score, f, v)
    if best is None:
        return counts, None, None, None, None
    _, f, v = best
    parts = [r for r in rows if r[0][f] <= v], [r for r in rows if r[0][f] > v]
    return counts, f, v, plain_tree(parts[0], depth - 1), plain_tree(parts[1], depth - 1)


def plain_leaf(tree, x):
    while tree[1] is not None:
        tree = tree[3] if x[tree[1]] <= tree[2] else tree[4]
    return tree[0]


def vote(trees, x):
    total = Counter()
    for tree in trees:
        counts = plain_leaf(tree, x)
        for y, n in counts.items():
            total[y] += n / sum(counts.values())
    most = max(round(v, 9) for v in total.values())
    return min(y for y, v in total.items() if round(v, 9) == most)


def sample(seed, n):
    rng = np.random.default_rng(seed)
    words = ["ash", "elm", "fir", "oak", None]
    rows = []
    for i in range(n):
        x, w = int(rng.integers(0, 12)), words[int(rng.integers(0, 5))]
        x = None if rng.random() < 0.1 else float(x)
        a = "up" if (x or 0) + (3 if w == "oak" else 0) + rng.random() * 4 > 8 else "down"
        b = int(rng.integers(0, 3)) if w is None else len(a) % 3
        rows.append((i, x, w, None if i % 17 == 0 else a, b))
    return rows


SCHEMA = "id long, x double, w string, a string, b int"
CODES = {"ash": 0, "elm": 1, "fir": 2, "oak": 3}


def numbers(r):
    return (-np.inf if r[1] is None else r[1], CODES.get(r[2], -1))


def test_tree_equals_plain_tree(spark):
    rows = sample(1, 300)
    model = OrdinalTrees(max_depth=4).fit(spark.createDataFrame(rows, SCHEMA), "id", ["a", "b"], ["x"], ["w"])
    wanted = [plain_tree([(numbers(r), r[3]) for r in rows if r[3] is not None], 4), plain_tree([(numbers(r), r[4]) for r in rows], 4)]
    new = [*sample(2, 80), (900, 99.0, "yew", None, None), (900, float("nan"), "", "z", 7)]
    got = model.transform(spark.createDataFrame(new, SCHEMA)).collect()
    assert sorted((r.id, r.x is None, r.w or "-", r.a or "-") for r in got) == sorted((r[0], r[1] is None, r[2] or "-", r[3] or "-") for r in new)
    for r in got:
        x = numbers((r.id, None if r.x != r.x else r.x, r.w))
        assert (r.a_predicted, r.b_predicted) == (vote(wanted[:1], x), vote(wanted[1:], x)), r
    total = {(r.target, r.column): r.importance for r in model.importance().collect()}
    assert set(total) == {(t, c) for t in "ab" for c in "xw"}
    for t in "ab":
        assert abs(total[t, "x"] + total[t, "w"] - 1) < 1e-9


def test_balanced_bags_equal_plain_trees(spark):
    rows = sample(3, 260)
    model = OrdinalTrees(bags=3, max_depth=3).fit(spark.createDataFrame(rows, SCHEMA), "id", ["b", "a"], ["x"], ["w"])
    held = {}
    for at, name in ((4, "b"), (3, "a")):
        known = [r for r in rows if r[at] is not None]
        size = min(Counter(r[at] for r in known).values())
        held[name] = []
        for bag in range(3):
            mix = lambda r: (int(hashlib.md5(f"{42 + bag}:{r[0]}".encode()).hexdigest()[:8], 16), r[0])  # noqa: B023, E731
            drawn = [r for y in {r[at] for r in known} for r in sorted((r for r in known if r[at] == y), key=mix)[:size]]
            held[name].append(plain_tree([(numbers(r), r[at]) for r in drawn], 3))
    for r in model.transform(spark.createDataFrame(rows, SCHEMA)).collect():
        x = numbers((r.id, r.x, r.w))
        assert (r.a_predicted, r.b_predicted) == (vote(held["a"], x), vote(held["b"], x)), r


def test_many_categories(spark):
    # 3,000 categories, one of them on a third of all rows; every second block of 500 codes is one class.
    code = F.when(F.col("id") < 3000, F.col("id")).otherwise(7)
    rows = spark.range(4500).select(
        "id", F.format_string("c%05d", code.cast("long")).alias("w"),
        F.when(F.floor(code / 500) % 2 == 1, "odd").otherwise("even").alias("y"),
    )
    fine = OrdinalTrees(bins=4096).fit(rows, "id", ["y"], [], ["w"])
    assert fine.transform(rows).where("y <> y_predicted").count() == 0
    assert fine.trees.where("feature is not null").count() == 5
    coarse = OrdinalTrees(bins=16, max_depth=6).fit(rows, "id", ["y"], [], ["w"])  # fits, less exactly
    assert coarse.transform(rows).where("y = y_predicted").count() >= 4000


def test_both_features_needed(spark):
    # No first cut gains anything; the tree goes on all the same.
    rows = spark.range(400).select(
        "id", (F.col("id") % 2).alias("p"), (F.floor(F.col("id") / 2) % 2).alias("q"),
        (F.col("id") % 2 == F.floor(F.col("id") / 2) % 2).alias("same"),
    )
    model = OrdinalTrees().fit(rows, "id", ["same"], ["p", "q"])
    assert model.transform(rows).where("same <> same_predicted").count() == 0


def test_edges_and_bins(spark):
    df = spark.createDataFrame([(float(i % 5),) for i in range(50)] + [(None,), (float("nan"),)], "x double")
    edges = bin_edges(df, ["x"], 8)["x"]
    assert edges == [0.0, 1.0, 2.0, 3.0, 4.0]
    got = {str(r.x): r.b for r in df.distinct().withColumn("b", bin_of("x", edges)).collect()}
    assert got == {"0.0": 0, "1.0": 1, "2.0": 2, "3.0": 3, "4.0": 4, "None": -1, "nan": -1}
    many = spark.range(1000).select(F.col("id").cast("double").alias("x"))
    edges = bin_edges(many, ["x"], 10)["x"]
    assert len(edges) == 9
    sizes = many.withColumn("b", bin_of("x", edges)).groupBy("b").count().collect()
    assert len(sizes) == 10 and max(r["count"] for r in sizes) <= 101


def test_tables_without_rows_or_labels(spark):
    rows = spark.createDataFrame(sample(4, 40), SCHEMA)
    model = OrdinalTrees(bags=2, max_depth=2).fit(rows, "id", ["a"], ["x"], ["w"])
    assert model.transform(rows.limit(0)).columns == [*rows.columns, "a_predicted"]
    assert model.transform(rows.limit(0)).count() == 0
    for bags in (None, 2):
        for none in (rows.limit(0), rows.withColumn("a", F.lit(None).cast("string"))):
            empty = OrdinalTrees(bags=bags, max_depth=2).fit(none, "id", ["a"], ["x"], ["w"])
            assert empty.transform(rows).where("a_predicted is not null").count() == 0
            assert empty.transform(rows).count() == 40


def test_draw_spreads_a_large_class(spark):
    rows = spark.range(1000).select(F.col("id").alias("row"), F.lit(0).alias("target"), (F.col("id") % 10 == 0).cast("int").alias("y"))
    drawn = draw_balanced(rows, 4)
    assert {(r.bag, r.y): r["count"] for r in drawn.groupBy("bag", "y").count().collect()} == {(b, y): 100 for b in range(4) for y in (0, 1)}
    assert drawn.select("bag", "row").distinct().count() == 800
