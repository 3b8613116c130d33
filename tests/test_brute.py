"""Distributed algorithms against direct computation on small random data."""

import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from dunlin.cluster import assign, birch, grid, kmeans, scores, spectral
from dunlin.cluster import dbscan as density
from dunlin.cluster.components import connected_components
from dunlin.cluster.dbscan_grid import dbscan_grid
from dunlin.cluster.gmeans import anderson_darling, gmeans
from dunlin.features import customers, text
from dunlin.functions import times
from dunlin.learn import classify, grouped, knn, recommend
from dunlin.operators import joins, neighbors, sparse
from dunlin.operators.neighbors import cluster_distances, knn_join
from dunlin.operators.ordering import ranked
from dunlin.operators.sparse import sparse_topk
from dunlin.session import new_path
from dunlin.sources import csv


def frame(spark, x, extra=()):
    rows = [(i, [float(v) for v in r]) for i, r in enumerate(x)]
    return spark.createDataFrame(rows, "id long, v array<double>")


def columns(spark, x):
    names = [f"x{i}" for i in range(x.shape[1])]
    rows = [(i, *[float(v) for v in r]) for i, r in enumerate(x)]
    return spark.createDataFrame(rows, "id long, " + ", ".join(f"{n} double" for n in names)), names


def brute_knn(q, r, k, same):
    d = np.round(np.sqrt(((q[:, None] - r[None]) ** 2).sum(2)), 9)
    out = {}
    for i in range(len(q)):
        order = [j for j in np.lexsort((np.arange(len(r)), d[i])) if not (same and i == j)]
        out[i] = order[:k]
    return out


@pytest.mark.parametrize("copies", [False, True])
def test_knn_join(spark, copies):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(700, 5))
    if copies:  # a third of all rows are copies of one
        x[rng.random(700) < 0.34] = x[0]
    df = frame(spark, x)
    got = {}
    for r in knn_join(df, df, 4, "id", "id", "v", exclude_same=True, block_rows=64).collect():
        got.setdefault(r.id, []).append((r.rank, r.neighbor_id))
    got = {i: [j for _, j in sorted(e)] for i, e in got.items()}
    assert got == brute_knn(x, x, 4, True)


def test_cosine_zero_vector(spark):
    df = frame(spark, np.array([[0.0, 0.0], [1.0, 0.0], [2.0, 0.1], [0.0, 3.0]]))
    got = {(r.id, r["rank"]): (r.neighbor_id, round(r.distance, 6)) for r in knn_join(
        df, df, 2, "id", "id", "v", metric="cosine", exclude_same=True).collect()}
    assert got[(0, 1)] == (1, 1.0) and got[(0, 2)] == (2, 1.0)
    assert got[(1, 1)][0] == 2 and got[(3, 1)][0] == 2


@pytest.mark.parametrize("hot_rows", [3, 10, 1000])
def test_sparse_topk(spark, hot_rows):
    rng = np.random.default_rng(2)
    m = rng.integers(1, 6, size=(60, 25)) * (rng.random((60, 25)) < 0.15)
    m[:, 0] = rng.integers(1, 6, size=60)  # one dimension holds every item
    rows = [(i, f"d{j}", float(m[i, j])) for i in range(60) for j in range(25) if m[i, j]]
    df = spark.createDataFrame(rows, "item long, dim string, w double")
    got = {}
    for r in sparse_topk(df, "item", "dim", "w", 5, hot_rows).collect():
        got.setdefault(r.item, []).append((r["rank"], r.other, r.score))
    s = m @ m.T
    for i in range(60):
        order = [j for j in np.lexsort((np.arange(60), -s[i])) if j != i and s[i, j] > 0][:5]
        assert [(j, v) for _, j, v in sorted(got[i])] == [(j, float(s[i, j])) for j in order]


def brute_dbscan(x, eps, m):
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(2))
    near = d <= eps
    core = near.sum(1) >= m
    label, nxt = np.full(len(x), -1), 0
    for i in range(len(x)):
        if label[i] != -1 or not core[i]:
            continue
        stack = [i]
        label[i] = nxt
        while stack:
            p = stack.pop()
            if core[p]:
                for j in np.nonzero(near[p] & (label == -1))[0]:
                    label[j] = nxt
                    stack.append(j)
        nxt += 1
    return label, core


@pytest.mark.parametrize("dims,eps,m", [(1, 0.02, 3), (2, 0.15, 4), (2, 0.4, 12), (3, 0.5, 6), (4, 0.9, 6)])
def test_dbscan(spark, dims, eps, m):
    rng = np.random.default_rng(dims)
    x = np.concatenate([rng.normal(c, 0.4, size=(110, dims)) for c in (-2, 0, 2.2)])
    df, names = columns(spark, x)
    label, core = brute_dbscan(x, eps, m)
    rows = density.dbscan(df, "id", names, eps, m).orderBy("row").collect()
    assert [r.core for r in rows] == core.astype(int).tolist()
    assert [r.clusterId for r in rows] == label.tolist()


def test_dbscan_dense_gap_needs_full_test(spark):
    """Two dense cells whose closest rows are not their outermost ones."""
    rng = np.random.default_rng(5)
    side = 1 / math.sqrt(2)
    a = np.array([[0.05, 0.68], [0.68, 0.05], [0.05, 0.05], [0.4, 0.5], [0.45, 0.45], [0.5, 0.4]])
    b = a + np.array([side * 2 * 0.999, 0.0])
    x = np.concatenate([a, b, rng.random((20, 2)) + 10])
    df, names = columns(spark, x)
    label, _ = brute_dbscan(x, 1.0, 5)
    rows = density.dbscan(df, "id", names, 1.0, 5).orderBy("row").collect()
    assert [r.clusterId for r in rows] == label.tolist()


def test_dbscan_groups_are_independent(spark):
    rng = np.random.default_rng(8)
    x = rng.random((300, 2))
    df, names = columns(spark, x)
    df = df.withColumn("g", (F.col("id") % 2).cast("int"))
    rows = density.dbscan(df, "id", names, 0.08, 4, "g").collect()
    got = {r.row: r.clusterId for r in rows}
    for g in (0, 1):
        ids = np.arange(g, 300, 2)
        label, _ = brute_dbscan(x[ids], 0.08, 4)
        assert [got[i] for i in ids] == label.tolist()


def test_dbscan_full_test_of_open_pairs(spark):
    x = np.array([[0.0, 0.0], [0.1, 0.1], [5.0, 5.0], [5.1, 5.0]])
    core = spark.createDataFrame(
        [(i, [float(v) for v in r], int(i >= 2)) for i, r in enumerate(x)], "row long, x array<double>, cid long"
    )
    pairs = spark.createDataFrame([(0, 1, 2, 2)], "a long, b long, na long, nb long")
    assert density._open_pairs(core, pairs, 6.95).count() == 1
    assert density._open_pairs(core, pairs, 6.9).count() == 0


def test_components(spark):
    edges = [(i, i + 1) for i in range(0, 40)] + [(50, 60), (60, 55), (70, 50)]
    nodes = spark.createDataFrame([(i,) for i in [*range(41), 50, 55, 60, 70, 99]], "node long")
    got = {r.node: r.component for r in connected_components(
        nodes, spark.createDataFrame(edges, "a long, b long")).collect()}
    assert all(got[i] == 0 for i in range(41))
    assert {got[i] for i in (50, 55, 60, 70)} == {50} and got[99] == 99


def test_silhouette_singletons_and_single(spark):
    x = np.array([[0.0], [1.0], [5.0]])
    df = frame(spark, x).withColumn("labels", F.array(F.lit(0), F.col("id").cast("int"), (F.col("id") / 2).cast("int")))
    got = {r.labeling: r.silhouette for r in scores.silhouettes(df, "id", "v", "labels").collect()}
    assert got[0] == -1 and got[1] == -1
    assert got[2] == pytest.approx((4 / 5 + 3 / 4 + 0) / 3)


def test_cluster_distances_in_blocks(spark):
    x = np.random.default_rng(3).normal(size=(90, 3))
    df = frame(spark, x).withColumn("c", F.array((F.col("id") % 3).cast("int")))
    rows = cluster_distances(df, "id", "v", "c", block_rows=20).collect()
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(2))
    assert len(rows) == 270
    for r in rows:
        assert r.dist == pytest.approx(d[r.row, r.cluster :: 3].sum()) and r.n == 30


def test_kmeans_sums_once_a_task(spark):
    """Sums leave a task once, whatever its batches, and count ties and rows without a place as argmin does."""
    rng = np.random.default_rng(6)
    x = rng.integers(0, 4, size=(900, 2)).astype(float)
    x[5, 1] = np.nan
    centers = rng.integers(0, 4, size=(7, 3, 2)).astype(float)
    weight = rng.integers(1, 4, size=900).astype(float)
    got = kmeans._nearest_sums(x, weight, centers)
    for f in range(7):
        near = kmeans.squared_to(x, centers[f])
        at = near.argmin(1)
        for c in range(3):
            own = at == c
            assert got[0, f, c] == weight[own].sum()
            assert got[1, f, c] == pytest.approx((weight * near[np.arange(900), at])[own].sum(), nan_ok=True)
            assert got[2:, f, c] == pytest.approx((weight[:, None] * x)[own].sum(0), nan_ok=True)
    rows = spark.createDataFrame([(i, i % 2, x[i].tolist()) for i in range(900) if i != 5], "row long, grp int, v array<double>")
    fits = [kmeans.Fit(g, c) for g in range(2) for c in centers]
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "10")
    try:
        sums = kmeans._sums(rows.coalesce(1), fits, list(range(14)))
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    own = np.arange(900) % 2 == 1
    at = kmeans.squared_to(x[own & (np.arange(900) != 5)], centers[2]).argmin(1)
    assert sums[9][0].tolist() == np.bincount(at, minlength=3).tolist()


def test_prepared_rows_lie_in_files_for_all_cores(spark):
    df = spark.range(3000).select("id", F.rand(1).alias("x"), F.rand(2).alias("y"))
    rows = grid.prepare(df, "id", ["x", "y"])
    assert len(rows.inputFiles()) >= spark.sparkContext.defaultParallelism


def test_silhouettes_leave_a_task_as_sums(spark):
    """A single cluster, singletons and copies; the sums of a task equal the long way in several passes."""
    rng = np.random.default_rng(8)
    x = rng.normal(size=(400, 2))
    x[10:20] = x[0]
    df = frame(spark, x).withColumn(
        "c", F.array(F.lit(1), F.col("id").cast("int"), (F.col("id") % 3).cast("int"), F.when(F.col("id") < 5, -1).otherwise(4))
    )
    short = scores.squared_silhouettes(df, "v", "c")
    assert "by_task" in short._jdf.queryExecution().optimizedPlan().toString()
    got = {r.labeling: r.silhouette for r in short.collect()}
    long = {r.labeling: r.silhouette for r in scores.squared_silhouettes(df, "v", "c", most_values=30).collect()}
    assert got == pytest.approx(long) and got[0] == -1 and got[1] == -1


def test_dbscan_assign_dense_cell(spark, monkeypatch):
    """First core row in order, nulls first, with cells in several blocks; pairs are tested in tasks."""
    monkeypatch.setattr(density, "ASSIGN_ROWS", 40)
    rng = np.random.default_rng(10)
    p, q = rng.uniform(0, 3, size=(150, 2)), rng.uniform(0, 3, size=(130, 2))
    new = spark.createDataFrame([(i, float(a), float(b)) for i, (a, b) in enumerate(p)] + [(200, None, 1.0)], "id long, x double, y double")
    core = spark.createDataFrame(
        [(f"n{i % 50:02}" if i else None, int(i), float(a), float(b)) for i, (a, b) in enumerate(q)], "core string, clusterId int, x double, y double"
    )
    d = np.sqrt(((p[:, None] - q[None]) ** 2).sum(2))
    order = sorted(range(130), key=lambda i: (i > 0, i % 50, i))
    want = {i: next((j for j in order if d[i, j] < 0.3), -1) for i in range(150)} | {200: -1}
    got = density.dbscan_assign(new, core, "id", "core", ["x", "y"], 0.3)
    assert {r.id: r.clusterId for r in got.collect()} == want
    assert "FlatMapCoGroupsInArrow" in got._jdf.queryExecution().optimizedPlan().toString()


def test_nearest_in_block_of_any_size():
    rng = np.random.default_rng(9)
    for n, k in ((1, 3), (5, 5), (40, 3), (500, 7)):
        q, r = rng.integers(0, 5, size=(60, 3)).astype(float), rng.integers(0, 5, size=(n, 3)).astype(float)
        found = neighbors._nearest_in_block(np.arange(60), q, np.arange(n), r, k)
        want = brute_knn(q, r, k, False)
        assert {i: g["r"].tolist() for i, g in found.groupby("q")} == {i: list(v) for i, v in want.items()}


def test_cluster_distances_tiles(spark):
    """Each tile serves both of its sides, so few rows are shuffled."""
    x = np.random.default_rng(5).normal(size=(600, 3))
    df = frame(spark, x).withColumn("c", F.array((F.col("id") % 3).cast("int"), (F.col("id") % 50).cast("int")))
    rows = cluster_distances(df, "id", "v", "c", block_rows=16)
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(2))
    found = rows.collect()
    assert len(found) == 600 * 53
    for r in found[::37]:
        step = (3, 50)[r.labeling]
        assert r.own == r.row % step and r.n == 600 // step
        assert r.dist == pytest.approx(d[r.row, r.cluster :: step].sum())
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    wide = math.ceil(math.sqrt(4 * spark.sparkContext.defaultParallelism))
    assert f", {wide})" in plan and f", {math.ceil(600 / 16)})" not in plan


def test_anderson_darling(spark):
    rng = np.random.default_rng(4)
    y = {0: rng.normal(size=200), 1: rng.exponential(size=300)}
    rows = [(g, float(v), g * 1000 + i) for g, vs in y.items() for i, v in enumerate(vs)]
    out = {r.g: r for r in anderson_darling(
        spark.createDataFrame(rows, "g int, y double, i long"), "g", "y", "i").collect()}
    for g, vs in y.items():
        w = np.sort((vs - vs.mean()) / vs.std(ddof=1))
        phi = np.array([math.erfc(-v / math.sqrt(2)) / 2 for v in w])
        n, i = len(w), np.arange(1, len(w) + 1)
        a2 = -n - np.sum((2 * i - 1) * (np.log(phi) + np.log(1 - phi[::-1]))) / n
        assert out[g].statistic == pytest.approx(a2, rel=1e-6)
    assert out[0].normal == 1 and out[1].normal == 0


def blobs(spark, per=80):
    rng = np.random.default_rng(6)
    x = np.concatenate([rng.normal(c, 0.3, size=(per, 2)) for c in ((0, 0), (6, 0), (0, 6))])
    return columns(spark, x)


def same_partition(rows, per=80):
    found = {}
    for r in rows:
        found.setdefault(r[0] // per, set()).add(r[1])
    return all(len(s) == 1 for s in found.values()) and len(set.union(*found.values())) == len(found)


def test_clusterings_find_blobs(spark):
    df, names = blobs(spark)
    model, rows = kmeans.kmeans(df, names, 3)
    assert kmeans.kmeans_infer(model, df.limit(5)).select("id", "clusterId").subtract(
        rows.select("id", "clusterId")).count() == 0
    assert same_partition([(r.id, r.clusterId) for r in rows.collect()])
    model, rows = gmeans(df, "id", names)
    assert same_partition([(r.row, r.clusterId) for r in rows.collect()])
    assert sorted(map(tuple, model.infer(df, "id").collect())) == sorted(map(tuple, rows.collect()))
    scaled = kmeans.standard_scale(df, names)
    rows, parts = birch.birch(scaled, "id", names, 3, threshold=0.2)
    assert same_partition([(r.id, r.clusterId) for r in rows.collect()])
    assert parts.agg(F.sum("n")).first()[0] == 240
    assert parts.agg(F.max("radius")).first()[0] <= 0.2 + 1e-9
    new = scaled.select("id", F.array(*names).alias("center"))
    near = assign.nearest_label(new, parts, "id", "row", "center")
    assert same_partition([(r.id, r.clusterId) for r in near.collect()])
    rows = spectral.spectral(scaled, "id", names, 3)
    assert same_partition([(r.row, r.clusterId) for r in rows.collect()])


def test_few_far_rows_beside_many_equal_ones_are_found(spark):
    rows = spark.range(20_000).select("id", F.when(F.col("id") < 3, F.col("id") + 90.0).otherwise(1.0).alias("x"))
    _, labelled = gmeans(rows.withColumn("y", F.lit(0.0)), "id", ["x", "y"])
    far = {r.clusterId for r in labelled.where("row < 3").collect()}
    most = {r.clusterId for r in labelled.where("row >= 3").select("clusterId").distinct().collect()}
    assert len(most) == 1 and not far & most


def test_spread_centers_weighs_all_rows(spark):
    rows = spark.range(6000).selectExpr("id AS row", "0 AS grp", "array(CASE WHEN id = 7 THEN 5D ELSE 1D END) AS v")
    assert sorted(kmeans.spread_centers(rows, 3, 42)[0][:, 0]) == [1.0, 5.0]
    heavy = rows.withColumn("w", F.when(F.col("row") == 7, 1e12).otherwise(1.0))
    assert kmeans.spread_centers(heavy, 1, 42)[0][0, 0] == 5.0


def test_grid_and_auto_choice(spark):
    rng = np.random.default_rng(6)  # rows mixed, since folds are contiguous
    x = np.concatenate([rng.normal(c, 0.3, size=(60, 2)) for c in ((0, 0), (6, 0), (0, 6))])
    df, names = columns(spark, rng.permutation(x))
    rows = grid.prepare(df, "id", names)
    kgrid = {"n_clusters": [2, 3], "n_init": [3], "max_iter": [20], "init": ["k-means++"], "tol": [1e-3]}
    table, best, labels = grid.grid_kmeans(rows, names, kgrid)
    assert best["n_clusters"] == 3 and labels.count() == 180
    assert table.where("score is not null").count() == 2
    assert grid.best_of([None, 2.0, 1.0], "davies_bouldin") == 2
    assert grid.best_of([1.0, 1.0, None], "silhouette") == 0
    with pytest.raises(ValueError):
        grid.best_of([None], "silhouette")
    dgrid = {"min_samples": [3], "eps": [0.3], "algorithm": ["auto", "brute"]}
    scored, name, labels = grid.auto_cluster(rows, names, {"dbscan": dgrid, "kmeans": kgrid})
    assert scored.agg(F.sum("best")).first()[0] == 1 and labels.count() == 180


def test_ranked_groups(spark):
    df = spark.range(500).select("id", (F.col("id") % 3).alias("g"), (F.col("id") * 7919 % 500).alias("k"))
    for r in ranked(df, ["k"], ["g"]).collect():
        assert r.row_id == sum(1 for i in range(500) if i % 3 == r.g and i * 7919 % 500 < r.k)


def test_salted_and_eps_join(spark, monkeypatch):
    monkeypatch.setattr(joins, "TASK_ROWS", 10)
    big = spark.range(900).select("id", F.when(F.col("id") < 600, 1).otherwise(F.col("id")).alias("k"))
    other = spark.range(1, 800).select(F.col("id").alias("k"), (F.col("id") * 2).alias("w"))
    plain = big.join(other, ["k"], "left").select("id", "k", "w")
    salted = joins.salted_join(big, other, ["k"], "left").select("id", "k", "w")
    assert sorted(map(tuple, plain.collect()), key=repr) == sorted(map(tuple, salted.collect()), key=repr)
    x = np.random.default_rng(7).random((200, 4))
    a, names = columns(spark, x)
    b = a.withColumnRenamed("id", "other")
    got = {(r.id, r.other) for r in joins.eps_join(a, b, names, 0.3).collect()}
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(2))
    assert got == {(int(i), int(j)) for i, j in zip(*np.nonzero(d <= 0.3))}


def test_hot_keys_are_split_by_their_size(spark, monkeypatch):
    monkeypatch.setattr(joins, "TASK_ROWS", 10)
    one = spark.range(4000).select("id", F.lit(1).alias("k"))
    assert [tuple(r) for r in joins.hot_keys(one, ["k"]).collect()] == [(1, 400)]
    thin = spark.range(4000).select("id", F.when(F.col("id") % 200 == 0, -1).otherwise(F.col("id")).alias("k"))
    assert [tuple(r) for r in joins.hot_keys(thin, ["k"]).collect()] == [(-1, 2)]
    other = spark.createDataFrame([(1, "a"), (-1, "b")], "k long, w string")
    assert joins.salted_join(one, other, ["k"]).count() == 4000
    assert joins.salted_join(thin, other, ["k"]).count() == 21
    monkeypatch.setattr(joins, "MOST_HOT", 4)
    assert joins.hot_keys(one, ["k"]).first()["__salts"] == 4


def test_spectral_keeps_far_rows_and_rows_alone(spark):
    x = np.concatenate([np.random.default_rng(3).standard_normal((80, 2)), [[6000.0, 0.0]]])
    df, names = columns(spark, x)
    assert spectral.spectral(df, "id", names, 2).select("row").distinct().count() == 81


def test_fine_time_grid_is_distributed(spark):
    rows = spark.range(3).select(F.expr("timestamp_ntz'2024-01-01' + make_dt_interval(0, 0, 0, id * 0.000001)").alias("ts"))
    rows = rows.union(spark.sql("select timestamp_ntz'2024-01-01 00:00:03'"))
    grid = times.infer_step_grid(rows, "ts", F.col("last_ts"))
    assert grid.count() == 3_000_001 and grid.rdd.getNumPartitions() > 1
    assert str(grid.agg(F.max("ts")).first()[0]) == "2024-01-01 00:00:03"


def test_knn_votes_on_text_labels(spark):
    rows = [(i, [float(i), 0.0], "b" if i < 3 else "a") for i in range(6)]
    df = spark.createDataFrame(rows, "id long, v array<double>, y string")
    got = knn.knn_classify(df, df.where("id = 1"), "id", "v", "y", 3).collect()
    assert [r.predicted for r in got] == ["b"]


def test_client_features_follow_the_data(spark):
    rows = [(i % 3, f"p{i % 7}", None, 1.0) for i in range(21)]
    df = spark.createDataFrame(rows, "id long, product string, closed timestamp, balance double")
    out = customers.contract_features(df)
    assert [c for c in out.columns if c.startswith("product_")] == [f"product_{i}" for i in range(7)]


def test_csv_keeps_quotes_and_line_ends(spark):
    rows = [(1, 'a "b", c'), (2, "x\ny"), (3, '[{"id": 1, "name": "A"}, {"id": 2}]'), (4, "back\\slash"), (5, 'end"')]
    path = csv.write_csv(spark.createDataFrame(rows, "id long, t string"), new_path(spark, "csv-test"))
    assert sorted(map(tuple, csv.read_csv(spark, path, "id long, t string", multi_line=True).collect())) == rows


def test_balanced_bags_are_balanced(spark):
    df = spark.range(300).select("id", F.when(F.col("id") < 30, "rare").otherwise("common").alias("y"))
    bags = classify.balanced_bags(df, "id", "y", 2)
    assert {(r.bag, r.y): r["count"] for r in bags.groupBy("bag", "y").count().collect()} == {
        (b, y): 30 for b in (0, 1) for y in ("rare", "common")
    }
    assert bags.select("bag", "id").distinct().count() == 120


def test_grouped_regression(spark):
    rng = np.random.default_rng(9)
    rows = []
    for g in range(4):
        for a, b in rng.random((40, 2)):
            rows.append((g, float(a), float(b), float(g + 2 * a - g * b)))
    df = spark.createDataFrame(rows, "g int, a double, b double, y double")
    models = grouped.train_per_group(df.where("g < 3"), "g", ["a", "b"], "y")
    for r in models.collect():
        assert r.intercept == pytest.approx(r.g, abs=1e-8)
        assert r.coefficients == pytest.approx([2, -r.g], abs=1e-8)
    out = grouped.infer_per_group(df, models, "g", ["a", "b"], "y")
    assert out.count() == 120  # the group without a model is dropped
    assert out.where(F.abs(F.col("predicted(y)") - F.col("y")) > 0.0051).count() == 0


def test_trees_learn(spark):
    df = spark.range(400).select(
        "id", (F.col("id") % 20).cast("double").alias("x"), F.when(F.col("id") % 20 < 7, "lo").otherwise("hi").alias("y"),
        F.when(F.col("id") % 2 == 0, "even").otherwise("odd").alias("c"),
    )
    model, out = classify.train_classifier(df, "id", "y", classify.tree(), ["x"], ["c"])
    assert out.agg(F.sum("error")).first()[0] == 0
    weights = {r.column: r.importance for r in classify.feature_importance(model, df).collect()}
    assert weights == {"x": 1.0, "c": 0.0}
    bagged = classify.BalancedBagging(classify.tree(), 2).fit(df, "id", "y", ["x"], ["c"]).transform(df)
    assert bagged.where("y <> predicted").count() == 0


def test_dbscan_grid_equals_dbscan_per_setting(spark):
    rng = np.random.default_rng(11)
    x = np.concatenate([
        rng.normal(0, 0.04, (150, 2)), rng.normal((0.3, 0.3), 0.05, (80, 2)), np.repeat([[2.0, 2.0]], 40, axis=0),
        rng.uniform(-2, 2, (250, 2)), np.stack([np.linspace(-2, 0, 120), np.full(120, 1.5)], 1),
        # Dense cells whose outermost rows are apart, while inner rows of a third side touch.
        rng.uniform((3.0, 3.0), (3.05, 3.05), (30, 2)), rng.uniform((3.13, 3.0), (3.2, 3.05), (30, 2)),
    ])
    df, names = columns(spark, x)
    df = df.withColumn("fold", (F.col("id") % 2).cast("int"))
    settings = [(e, m) for m in (3, 4, 5) for e in (0.1, 0.2, 0.3)]
    for group, compared in ((None, (2, 6)), ("fold", (0, 4, 8))):  # a plain run takes long
        got = {r.row: r for r in dbscan_grid(df, "id", names, settings, group).collect()}
        assert len(got) == len(x)
        for s in compared:
            eps, m = settings[s]
            want = {r.row: (r.clusterId, r.core) for r in density.dbscan(df, "id", names, eps, m, group).collect()}
            assert {i: (r.labels[s], r.core[s]) for i, r in got.items()} == want, (group, eps, m)
    assert dbscan_grid(df.limit(0), "id", names, settings).count() == 0


def test_dbscan_grid_measures_dense_cells_in_full(spark):
    """Two dense cells whose outermost rows lie apart but whose inner edges touch at the larger setting only."""
    rng = np.random.default_rng(12)
    left = np.stack([rng.uniform(0, 0.069, 60), rng.uniform(0, 0.069, 60)], 1)
    x = np.concatenate([left, left + [0.155, 0.01]])
    df, names = columns(spark, x)
    settings = [(e, 5) for e in (0.1, 0.12)]
    got = {r.row: r.labels for r in dbscan_grid(df, "id", names, settings).collect()}
    for s, (eps, m) in enumerate(settings):
        assert {i: v[s] for i, v in got.items()} == {r.row: r.clusterId for r in density.dbscan(df, "id", names, eps, m).collect()}


@pytest.mark.parametrize("most_values", [1 << 22, 9])
def test_squared_silhouette(spark, most_values):
    rng = np.random.default_rng(13)
    x = rng.normal(100, 1, (90, 3))
    labels = np.stack([rng.integers(0, 4, 90), np.where(np.arange(90) < 89, -1, 7), np.zeros(90, int), np.arange(90)], 1)
    d = ((x[:, None] - x[None]) ** 2).sum(2)
    want = {2: -1.0, 3: -1.0}
    for j in (0, 1):
        c = labels[:, j]
        mean = np.array([[d[i, c == k].sum() / ((c == k).sum() - (c[i] == k) or 1) for k in np.unique(c)] for i in range(90)])
        own = c[:, None] == np.unique(c)
        a, b = mean[own], np.where(own, np.inf, mean).min(1)
        size = np.array([(c == k).sum() for k in c])
        want[j] = float(np.where(size == 1, 0, (b - a) / np.maximum(a, b)).mean())
    rows = [(i, [float(v) for v in r], [int(v) for v in c]) for i, (r, c) in enumerate(zip(x, labels))]
    df = spark.createDataFrame(rows, "id long, v array<double>, labels array<int>")
    got = {r.labeling: r.silhouette for r in scores.squared_silhouettes(df, "v", "labels", most_values).collect()}
    assert got == pytest.approx(want, abs=1e-9)
    assert scores.squared_silhouettes(df.limit(0), "v", "labels").count() == 0


def test_kmeans_paths_hold_every_stop(spark):
    rng = np.random.default_rng(14)
    x = np.concatenate([rng.normal(0, 1, (150, 2)), rng.normal(3, 1.5, (150, 2))])
    df = frame(spark, x).select(F.col("id").alias("row"), (F.col("id") % 2).cast("int").alias("grp"), "v")
    starts = kmeans.parallel_starts(df, [(k, init, s) for k in (2, 5) for init in ("k-means++", "random") for s in (1, 2)], 7)
    assert {g: [len(c) for c in own] for g, own in starts.items()} == {g: [2] * 4 + [5] * 4 for g in (0, 1)}
    scales = kmeans.spreads(df, 2)
    tols, limits = [1e-1, 1e-3, 1e-6], [1, 4, 60]
    paths = [kmeans.Path(g, c, scales[g]) for g, own in starts.items() for c in own]
    kmeans.run_paths(df, paths, tols, limits)
    for tol, limit in ((1e-1, 60), (1e-3, 4), (1e-6, 1), (1e-6, 60)):
        fits = [kmeans.Fit(g, c, tol, limit, scales[g]) for g, own in starts.items() for c in own]
        for path, fit in zip(paths, kmeans.run_fits(df, fits)):
            stop = path.stopped(tol, limit)
            assert stop.rounds == fit.rounds and stop.cost == pytest.approx(fit.cost)
            assert np.allclose(stop.centers, fit.centers)
    for path in paths:  # the last stop is a fixed point of plain Lloyd
        own = x[np.arange(len(x)) % 2 == path.grp]
        near = kmeans.squared_to(own, path.stopped(1e-6, 60).centers).argmin(1)
        again = np.stack([own[near == c].mean(0) for c in range(len(path.centers))])
        assert np.allclose(again, path.stopped(1e-6, 60).centers, atol=1e-2)


def test_parallel_starts_see_all_rows(spark):
    """Three far rows among thousands of equal ones become candidates; fewer different rows than centers repeat one."""
    x = np.concatenate([np.ones((6000, 2)), [[50, 50], [-60, 40], [0, -70]]])
    df = frame(spark, x).select(F.col("id").alias("row"), F.lit(0).alias("grp"), "v")
    found = kmeans.parallel_starts(df, [(4, "k-means++", s) for s in range(5)] + [(6, "k-means++", 9)], 3)[0]
    for centers in found:
        assert len({tuple(c) for c in centers}) == 4
    assert kmeans.parallel_starts(df.limit(0), [(2, "random", 1)], 3) == {}


def test_weighted_starts_follow_the_weight(spark):
    rows = [(0, 0, [0.0], 1.0), (1, 0, [10.0], 1000.0), (2, 0, [10.5], 1000.0), (3, 0, [30.0], 500.0), (4, 1, [7.0], 3.0)]
    df = spark.createDataFrame(rows, "row long, grp int, v array<double>, w double")
    found = kmeans.parallel_starts(df, [(2, "k-means++", s) for s in range(8)], 5)
    assert all(30.0 in c[:, 0] for c in found[0]) and all(c[:, 0].tolist() == [7.0, 7.0] for c in found[1])


def test_salted_join_spreads_rows_without_a_key(spark, monkeypatch):
    monkeypatch.setattr(joins, "TASK_ROWS", 50)
    big = spark.range(600).select("id", F.when(F.col("id") % 2 == 0, F.col("id") % 3).alias("k"))
    other = spark.createDataFrame([(0, "a"), (1, "b"), (None, "x")], "k long, name string")
    plain = {tuple(r) for r in big.join(other, "k", "left").collect()}
    joined = joins.salted_join(big, other, ["k"], "left")
    assert {tuple(r) for r in joined.collect()} == plain and joined.count() == 600
    inner = joins.salted_join(big, other, ["k"])
    assert {tuple(r) for r in inner.collect()} == {r for r in plain if r[2]}


def test_grid_birch_scores_each_threshold_on_its_own_summaries(spark):
    rng = np.random.default_rng(15)
    x = np.concatenate([rng.normal(c, 0.25, size=(40, 2)) for c in ((0, 0), (5, 0), (0, 5))])
    df, names = columns(spark, rng.permutation(x))
    rows = grid.prepare(df, "id", names, folds=2)
    both = {"n_clusters": [2, 3], "threshold": [0.2, 0.4], "branching_factor": [50, 100]}
    table, best, labels = grid.grid_birch(rows, names, both)
    found = table.collect()
    assert best["n_clusters"] == 3 and labels.count() == 120 and {r.grid for r in found} == {8}
    alone = [r.score for t in (0.2, 0.4) for r in grid.grid_birch(rows, names, both | {"threshold": [t]})[0].collect()]
    assert [r.score for r in found] == pytest.approx(alone, abs=0.02)


def brute_topk(rows, k):
    """``(item, rank, other, score)`` by plain sums over shared dimensions."""
    got = set()
    for i in {r[0] for r in rows}:
        score = {}
        for _, d, w in (r for r in rows if r[0] == i):
            for j, e, v in rows:
                if e == d and j != i:
                    score[j] = score.get(j, 0.0) + w * v
        best = sorted(score.items(), key=lambda e: (-round(e[1], 9), e[0]))[:k]
        got |= {(i, n + 1, j, round(s, 9)) for n, (j, s) in enumerate(best)}
    return got


@pytest.mark.parametrize("hot_rows", [3, 1000])
def test_sparse_topk_in_the_task_of_the_item(spark, monkeypatch, hot_rows):
    monkeypatch.setattr(sparse, "LIST_ROWS", 0)  # no blocks for all items
    rng = np.random.default_rng(5)
    rows = [(i, f"d{j}", float(rng.integers(1, 6))) for i in range(40) for j in range(20) if rng.random() < 0.1]
    df = spark.createDataFrame(rows, "item long, dim string, w double")
    found = sparse_topk(df, "item", "dim", "w", 4, hot_rows)
    assert {(r.item, r["rank"], r.other, r.score) for r in found.collect()} == brute_topk(rows, 4)
    if hot_rows == 1000:  # rows to their dimension, lists to the item, nothing after that
        plan = found._jdf.queryExecution().executedPlan().toString()
        final = plan.split("Initial Plan")[-1]
        assert final.count("Exchange") == 2, plan


def test_sparse_topk_scores_copies_once(spark, monkeypatch):
    rng = np.random.default_rng(6)
    kinds = [[(f"d{j}", float(rng.integers(1, 4))) for j in range(8) if rng.random() < 0.5] for _ in range(9)]
    rows = [(i, d, w) for i in range(70) for d, w in kinds[i * i % 9]]
    df = spark.createDataFrame(rows, "item long, dim string, w double")
    given, whole = [], sparse._block_top
    monkeypatch.setattr(sparse, "_block_top", lambda hot, *a, **b: given.append(hot.count()) or whole(hot, *a, **b))
    got = {(r.item, r["rank"], r.other, r.score) for r in sparse_topk(df, "item", "dim", "w", 5).collect()}
    assert got == brute_topk(rows, 5)
    assert given and given[0] <= 9


def test_block_scores_are_held_in_parts(monkeypatch):
    monkeypatch.setattr(sparse, "BLOCK_ITEMS", 16)
    rng = np.random.default_rng(7)
    lists = [np.sort(rng.choice(30, 5, replace=False)) for _ in range(50)]
    x = pd.DataFrame({"item": np.arange(50), "dims": lists, "ws": [rng.integers(1, 4, 5).astype(float) for _ in lists]})
    shapes, whole = [], sparse._products
    monkeypatch.setattr(sparse, "_products", lambda a, b: shapes.append((len(a), len(b))) or whole(a, b))
    rows = [(r.item, d, w) for r in x.itertuples() for d, w in zip(r.dims, r.ws)]
    best = sparse._block_scores(x, x, 3)
    ranks = best.groupby("item").cumcount() + 1
    got = {(i, n, j, s) for i, n, j, s in zip(best["item"], ranks, best["other"], best["score"])}
    assert got == brute_topk(rows, 3)
    assert max(max(s) for s in shapes) <= 16


def test_predicted_ratings_are_shuffled_once_to_the_user(spark, monkeypatch):
    monkeypatch.setattr(recommend, "TARGETS", 2)
    rng = np.random.default_rng(8)
    rated = [(u, i, float(rng.integers(1, 6))) for u in range(12) for i in range(15) if rng.random() < 0.3]
    near = [(i, j, float(rng.random() * 1.2)) for i in range(15) for j in range(15) if i != j and rng.random() < 0.5]
    ratings = spark.createDataFrame(rated, "user long, item long, rating double")
    neighbors = spark.createDataFrame(near, "item long, neighbor long, distance double")
    want, seen = {}, {(u, i) for u, i, _ in rated}
    for u, i, r in rated:
        for target, j, d in near:
            if j == i and 1 - d > 0 and (u, target) not in seen:
                s = want.setdefault((u, target), [0.0, 0.0])
                s[0], s[1] = s[0] + (1 - d) * r, s[1] + 1 - d
    best = recommend.recommend(ratings, neighbors, 100)
    got = {(r.user, r.item): r.predicted for r in best.collect()}
    assert got == {key: pytest.approx(a / b, abs=1e-8) for key, (a, b) in want.items()}
    plan = best._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[-1]
    assert "hashpartitioning(user" in plan and plan.count("hashpartitioning(user") == 1, plan


def test_distances_are_held_in_strips(monkeypatch):
    cells, whole = [], neighbors._squared
    monkeypatch.setattr(neighbors, "_squared", lambda a, b: cells.append(len(a)) or whole(a, b))
    rng = np.random.default_rng(9)
    q, r = rng.integers(0, 5, (700, 3)).astype(float), rng.integers(0, 5, (90, 3)).astype(float)
    found = neighbors._nearest_in_block(np.arange(700), q, np.arange(90), r, 4)
    assert max(cells) <= 256
    exact = np.round(np.sqrt(((q[:, None] - r[None]) ** 2).sum(2)), 9)
    want = [(i, j) for i in range(700) for j in np.lexsort((np.arange(90), exact[i]))[:4]]
    assert list(zip(found["q"], found["r"])) == want


def test_bags_are_counted_in_tasks_of_bounded_text(spark, monkeypatch):
    monkeypatch.setattr(text, "TASK_BYTES", 20)
    df = spark.createDataFrame([(i, f"word{i % 3} word{i % 3} more") for i in range(40)], "id long, t string")
    bags = text.bag_of_words(df, "id", "t", ())
    assert bags.rdd.getNumPartitions() == 40 * 16 // 20
    want = {(i, f"word{i % 3}", 2) for i in range(40)} | {(i, "more", 1) for i in range(40)}
    assert {tuple(r) for r in bags.collect()} == want
