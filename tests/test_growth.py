"""Steps whose time or memory grew faster than their input, or held it twice."""

import time

import corpus_pipeline
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from dunlin.cluster import kmeans, spectral
from dunlin import session
from dunlin.learn import bayes, classify, recommend
from dunlin.llm import ngram_join
from dunlin.operators import draws, joins, sparse
from dunlin.operators.ordering import hash_order


def test_tokens_are_written_before_they_are_decoded(spark):
    docs = spark.createDataFrame([(1, "two words"), (None, None)], "doc_id long, text string")
    out = corpus_pipeline.tokenize(spark, docs, "")
    assert out._jdf.queryExecution().optimizedPlan().toString().count("MapInArrow") == 1  # one Python worker a task
    assert sorted((r.doc_id or 0, r.exact, len(r.ids) == r.n_tokens) for r in out.collect()) == [(0, True, True), (1, True, True)]


def test_kmeans_holds_its_rows_once(spark, monkeypatch):
    given, fit = [], kmeans.KMeans.fit
    monkeypatch.setattr(kmeans.KMeans, "fit", lambda self, df: given.append(df.storageLevel.useMemory) or fit(self, df))
    df = spark.range(40).select((F.col("id") % 2 * 9.0).alias("x"), F.col("id").cast("double").alias("y"))
    _, rows = kmeans.kmeans(df, ["x", "y"], 2)
    assert given == [False] * 3 and rows.select("clusterId").distinct().count() == 2


@pytest.mark.parametrize("size", [0, 1, 37, 5000])
def test_draw_ranks_only_rows_at_its_end(spark, monkeypatch, size):
    ranked, whole = [], draws.ranked
    monkeypatch.setattr(draws, "ranked", lambda df, *a, **b: ranked.append(df.count()) or whole(df, *a, **b))
    df = spark.range(4000).select("id", F.when(F.col("id") % 3 > 0, F.col("id") % 3).alias("g"))
    df = df.withColumn("mix", hash_order("id", 5))
    place = F.row_number().over(Window.partitionBy("g").orderBy("mix", "id"))
    want = df.withColumn("place", place).where(F.col("place") <= size).drop("place")
    got = draws.first_drawn(df, "mix", "id", ["g"], F.lit(size))
    assert sorted(r.id for r in got.collect()) == sorted(r.id for r in want.collect())
    assert len(ranked) == 1 and ranked[0] <= 30  # the leading bits of three groups


def test_a_scored_term_stays_one_row(spark):
    rows = [(d, f"t{i}", 0.1 + (d * 7 + i) % 5) for d in range(12) for i in range(d % 4 + 1)] + [(20, "unseen", 1.0)]
    weights = spark.createDataFrame(rows, "doc_id long, term string, tfidf double")
    truth = spark.createDataFrame(
        [(d, c, v) for d in range(9) for c, v in (("a", d % 2), ("b", d % 3 if d else None))], "doc_id long, label string, class int"
    )
    table, prior = bayes.multinomial_parameters(weights, truth, "doc_id")
    out = bayes.multinomial_predict(weights, table, prior, "doc_id")
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "Aggregate [" in plan[plan.index("Generate"):]  # rows are summed before the classes are told apart
    logp = {(r.label, r["class"], r.term): r.logp for r in table.collect()}
    want = {}
    for p in prior.where("class is not null").collect():
        for d in range(12):
            s = sum(w * logp[p.label, p["class"], t] for e, t, w in rows if e == d)
            want.setdefault((d, p.label), []).append((round(s + p.prior, 9), -p["class"]))
    assert {(r.doc_id, r.label): r.predicted for r in out.collect()} == {k: -max(v)[1] for k, v in want.items()}


def test_bags_of_many_rows_are_dealt_to_more_tasks(spark, monkeypatch):
    df = spark.range(2000).select("id", (F.col("id") % 7).cast("double").alias("x"), (F.col("id") % 2).cast("string").alias("y"))
    parts = []

    class Spy(classify.DecisionTreeClassifier):
        def fit(self, df, params=None):
            parts.append((df.rdd.getNumPartitions(), df.count()))
            return super().fit(df, params)

        def copy(self, extra=None):
            other = super().copy(extra)
            other.__class__ = Spy
            return other

    grown = classify.tree()
    grown.__class__ = Spy
    monkeypatch.setattr(classify, "TASK_ROWS", 100, raising=False)
    model = classify.BalancedBagging(grown, 2).fit(df, "id", "y", ["x"])
    assert parts == [(20, 2000)] * 2
    assert model.transform(df).count() == 2000


def test_near_pairs_are_dealt_by_their_number(spark, monkeypatch):
    monkeypatch.setattr(joins, "TASK_PAIRS", 512, raising=False)
    a = spark.range(300).select("id", (F.col("id") % 7 / 2).alias("x"), F.when(F.col("id") != 9, F.col("id") % 2 * 1.0).alias("y"))
    b = a.select(F.col("id").alias("other"), "x", "y").where("other < 90")
    out = joins.eps_join(a, b, ["x", "y"], 1.1).select("id", "other", "distance", F.spark_partition_id().alias("part"))
    rows = out.collect()
    at = {r.id: (r.x, r.y) for r in a.collect() if r.y is not None}
    near = {(i, j): ((p[0] - q[0]) ** 2 + (p[1] - q[1]) ** 2) ** 0.5 for i, p in at.items() for j, q in at.items() if j < 90}
    assert {(r.id, r.other): r.distance for r in rows} == {k: d for k, d in near.items() if d <= 1.1}
    assert len(rows) == len({(r.id, r.other) for r in rows}) and len({r.part for r in rows}) > 8


def test_rounded_is_round(spark):
    values = [0.0, 2.5, 0.1234565, 1.0000005, 2.4999995, 2.0 / 3, -0.0000015, 1e300, float("nan"), None, *[i / 4096e3 for i in range(3000)]]
    df = spark.createDataFrame([(v,) for v in values], "v double").select(F.round("v", 6).alias("a"), joins.rounded("v", 6).alias("b"))
    assert df.where("not a <=> b").count() == 0


def test_a_spectral_step_sends_borders_only(spark, monkeypatch):
    sent, whole = [], spectral.materialize
    monkeypatch.setattr(spectral, "BLOCK_ROWS", 60, raising=False)
    monkeypatch.setattr(spectral, "materialize", lambda df, label: sent.append((label, whole(df, label))) or sent[-1][1])
    # 100 rows are equal, so the first of them have many links; groups are never linked
    points = [[0.0, 0.0] if i < 100 else [i * 37 % 101 / 50, i % 100 / 40] for i in range(400)]
    df = spark.createDataFrame([(i, i % 2, p) for i, p in enumerate(points)], "row long, grp int, v array<double>")
    df = df.union(spark.sql("SELECT 900L, 7, array(0D, 0D)"))  # alone in its group
    pairs = spectral.neighbours(df, 4)
    got = {r.row: r.v for r in spectral.embed(df, pairs, 1.0, 20).collect()}

    weights = np.zeros((400, 400))
    for r in pairs.collect():
        weights[r.src, r.dst] = weights[r.dst, r.src] = max(np.exp(-r.distance**2), spectral.LEAST_WEIGHT)
    degree = weights.sum(1)
    start = spark.range(400).select("id", *[hash_order("id", i).alias(f"v{i}") for i in (1, 2, 3)]).orderBy("id").collect()
    now, past = np.array([[d, *[h / 2**32 - 0.5 for h in r[1:]]] for d, r in zip(degree, start)]), None
    for _ in range(20):
        new = (2 * (weights / degree[:, None]) @ now - (spectral.DAMPED - 1) * now) / (spectral.DAMPED + 1)
        now, past = (new if past is None else 2 * new - past), now
    for g in (0, 1):
        own = now[g::2]
        want = (own - own.mean(0)) / own.std(0)
        assert np.abs(np.array([got[i] for i in range(g, 400, 2)]) - want).max() < 1e-9
    assert got[900] == [0.0] * 4 and len(got) == 401
    steps = [df.count() for label, df in sent if label == "values"]
    assert len(steps) > 20 and max(steps[:-1]) < 200  # messages between blocks, no row per row or link


def test_shingles_of_few_texts_are_held_at_a_time():
    texts = pa.RecordBatch.from_arrays([pa.array(range(1200))], ["id"])
    parts = list(ngram_join._slices(iter([texts, texts.slice(0, 0), texts.slice(0, 5)])))
    assert [p.num_rows for p in parts] == [512, 512, 176, 5]
    assert [i for p in parts[:3] for i in p.column("id").to_pylist()] == list(range(1200))


def test_a_written_step_leaves_no_shuffle_files(spark):
    disk = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def held():
        return {f for f in disk.getAllFiles().mkString(" ").split() if "shuffle_" in f}

    before = held()
    step = session.materialize(spark.range(5000).repartition(5).groupBy((F.col("id") % 7).alias("g")).count())
    until = time.time() + 20
    while held() - before and time.time() < until:
        time.sleep(0.2)
    assert not held() - before and step.count() == 7
    assert spark.conf.get(session.CLEANUP, None) is None


@pytest.mark.parametrize("large", [0, 1 << 40])
@pytest.mark.parametrize("group", [1, 1 << 18])
def test_pairs_beyond_a_bound_are_not_shuffled(spark, monkeypatch, large, group):
    monkeypatch.setattr(sparse, "SHUFFLED_PAIRS", 0, raising=False)
    monkeypatch.setattr(sparse, "LIST_ROWS", 0)
    monkeypatch.setattr(sparse.scans, "GROUP_PRODUCTS", group)
    monkeypatch.setattr(sparse.scans, "LEAST_PRODUCTS", 50)
    rng = np.random.default_rng(11)
    rows = [(i * 3 - 9 + large, f"d{j}", float(rng.integers(1, 6))) for i in range(50) for j in range(25) if rng.random() < 0.12]
    rows += rows[:9]  # twice
    odd = [(None, "d1", 2.0), (3 + large, None, 2.0), (9000 + large, None, 1.0), (9001 + large, "alone", 1.0), (9002 + large, "d1", None)]
    df = spark.createDataFrame(rows + odd, "item long, dim string, w double")
    found = sparse.sparse_topk(df, "item", "dim", "w", 4)
    want = set()
    for i in {r[0] for r in rows}:
        score = {}
        for _, d, w in (r for r in rows if r[0] == i):
            for j, e, v in rows:
                if e == d and j != i:
                    score[j] = score.get(j, 0.0) + w * v
        best = sorted(score.items(), key=lambda e: (-round(e[1], 9), e[0]))[:4]
        want |= {(i, n + 1, j, s) for n, (j, s) in enumerate(best)}
    assert {(r.item, r["rank"], r.other, r.score) for r in found.collect()} == want
    assert "Exchange" not in found._jdf.queryExecution().executedPlan().toString()


def test_a_few_larger_dimensions_are_lists_too(spark):
    sizes = spark.createDataFrame([("a", 4), ("b", 5), ("c", 6), ("d", 60)], "dim string, n long")
    assert sparse._hot_from(sizes, 5) == 6
    assert sparse._hot_from(sizes, 4) == 4


@pytest.mark.parametrize("user", ["long", "string"])
def test_targets_of_many_ratings_are_not_shuffled(spark, monkeypatch, user):
    monkeypatch.setattr(recommend, "SHUFFLED_RATINGS", 0, raising=False)
    monkeypatch.setattr(recommend, "TARGETS", 2)
    rng = np.random.default_rng(8)
    rated = [(u, i, float(rng.integers(1, 6))) for u in range(12) for i in range(15) if rng.random() < 0.3]
    near = [(i, j, float(rng.random() * 1.2)) for i in range(15) for j in range(15) if i != j and rng.random() < 0.5]
    rated += [(None, 3, 2.0), (None, 4, 5.0), (40, 2, None), (41, None, 3.0)]
    ratings = spark.createDataFrame(rated, "user long, item long, rating double").withColumn("user", F.col("user").cast(user))
    neighbors = spark.createDataFrame(near, "item long, neighbor long, distance double")
    want, seen = {}, {(u, i) for u, i, _ in rated if u is not None}
    for u, i, r in rated:
        for target, j, d in near:
            if j == i and 1 - d > 0 and (u, target) not in seen:
                s = want.setdefault((u, target), [0.0, 0.0, 0])
                s[0], s[1], s[2] = s[0] + (1 - d) * (r or 0.0), s[1] + 1 - d, s[2] + (r is not None)
    want = {key: a / b if n else None for key, (a, b, n) in want.items()}

    def number(u):
        return u if u is None else int(u)

    got = {(number(r.user), r.item): r.predicted for r in recommend.predict_ratings(ratings, neighbors).collect()}
    assert got == {key: v if v is None else pytest.approx(v, abs=1e-9) for key, v in want.items()}
    best = recommend.recommend(ratings, neighbors, 2)
    assert best.columns == ["user", "item", "predicted", "rank"]
    order = {}
    for (u, i), v in want.items():
        order.setdefault(u, []).append((v is None, 0.0 if v is None else -round(v, 9), i))
    assert {(number(r.user), r["rank"]): r.item for r in best.collect()} == {
        (u, n + 1): i for u, e in order.items() for n, (_, _, i) in enumerate(sorted(e)[:2])
    }
    plan = best._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and plan.count("Exchange hashpartitioning(user") <= 2  # the second one is the initial plan


@pytest.mark.parametrize("k", [1, 4, 30])
def test_many_kinds_of_items_meet_by_shared_dimensions(spark, monkeypatch, k):
    monkeypatch.setattr(sparse, "SUBSET_CLASSES", 0, raising=False)
    monkeypatch.setattr(sparse, "PAIR_CELLS", 1e9)
    blocks = []
    monkeypatch.setattr(sparse, "_block_top", lambda *a, **b: blocks.append(a))
    rng = np.random.default_rng(13)
    rows = [(i, f"{c}{rng.integers(0, n)}", w) for i in range(60) for c, n, w in (("a", 2, 1.0), ("b", 3, 0.7), ("c", 4, 0.7), ("d", 9, 1.0)) if rng.random() < 0.9]
    rows += [(i, "a0", 0.3) for i in range(60, 64)] + [(70, "only", 1.0)] + [r for r in rows if r[0] < 3]  # other weights, alone, twice
    df = spark.createDataFrame(rows, "item long, dim string, w double").repartition(3)
    got = {(r.item, r["rank"], r.other): r.score for r in sparse.sparse_topk(df, "item", "dim", "w", k).collect()}
    want = {}
    for i in {r[0] for r in rows}:
        score = {}
        for _, d, w in (r for r in rows if r[0] == i):
            for j, e, v in rows:
                if e == d and j != i:
                    score[j] = score.get(j, 0.0) + w * v
        best = sorted(score.items(), key=lambda e: (-round(e[1], 9), e[0]))[:k]
        want |= {(i, n + 1, j): pytest.approx(s, abs=1e-8) for n, (j, s) in enumerate(best)}
    assert got == want and not blocks
