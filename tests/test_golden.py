"""Small inputs with known answers."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from dunlin.features import encoding, scaling, text
from dunlin.functions import nested, strings, times
from dunlin.learn import metrics, recommend
from dunlin.operators import profile
from dunlin.operators.joins import join_by_position
from dunlin.operators.ordering import exact_quantiles, kfold, ordered_split

HOST = "FSM-GFU-Window2012R2-WIN2012R2-172-30-56-123"


def one(df):
    return df.first()[0]


def text_row(spark, s):
    return spark.createDataFrame([(s,)], "s string")


def test_strings(spark):
    df = text_row(spark, HOST)
    assert one(df.select(strings.keep_word_chars(F.col("s")))) == "FSMGFUWindow2012R2WIN2012R21723056123"
    assert one(df.select(strings.sorted_run_length(F.col("s")))) == "03142832567DF2GI2MN2OR2SUW3"
    assert one(text_row(spark, "").select(strings.sorted_run_length(F.col("s")))) == ""
    assert one(text_row(spark, None).select(strings.sorted_run_length(F.col("s")))) is None
    geeks = text_row(spark, "GeeksforGeeks is best for geeks")
    assert one(geeks.select(strings.before(F.col("s"), "best"))) == "GeeksforGeeks is "
    assert one(geeks.select(strings.after(F.col("s"), "best"))) == " for geeks"
    assert one(geeks.select(strings.before(F.col("s"), "none"))) == "GeeksforGeeks is best for geeks"
    assert one(geeks.select(strings.after(F.col("s"), "none"))) == ""
    assert one(text_row(spark, "123-daxac").select(strings.sorted_chars(F.col("s")))) == list("-123aacdx")
    assert one(text_row(spark, "ä b!").select(strings.keep_word_chars(F.col("s")))) == "äb"


def test_incident_columns_stay_on_their_row(spark):
    df = spark.createDataFrame(
        [
            (1, None, None),
            (2, "hostIpAddr:10.0.0.1,hostName:a:b", '[{"name": "x", "techniqueid": "T1"}, {"techniqueid": "T2"}]'),
            (3, "hostName:c", '[{"name": "x"}]'),
        ],
        "i int, target string, technique string",
    )
    rows = df.withColumns(strings.incident_columns("target", "technique")).orderBy("i").collect()
    assert [(r.hostIpAddr, r.hostName, r.techniqueid) for r in rows] == [
        (None, None, None), ("10.0.0.1", "a:b", "T1,T2"), (None, "c", None),
    ]


def test_time_grids(spark):
    grid = spark.range(1).select(
        F.explode(
            times.time_grid(
                F.expr("timestamp_ntz'2015-03-02 00:00:00'"), F.expr("timestamp_ntz'2015-03-02 03:00:00'"),
                F.expr("interval 15 minutes"),
            )
        )
    )
    assert grid.count() == 13
    start = dt.datetime(2005, 6, 7, 7)
    series = spark.createDataFrame(
        [(start + dt.timedelta(hours=2 * i),) for i in range(616)], "t timestamp_ntz"
    )
    points = [r[0] for r in times.forecast_horizon(series, "t").orderBy("ts").collect()]
    assert len(points) == 613
    assert points[0] == dt.datetime(2005, 7, 28, 13) and points[-1] == dt.datetime(2005, 9, 17, 13)
    assert times.infer_step_grid(series, "t", F.col("last_ts")).count() == 616
    short = series.where(F.col("t") < F.lit(start + dt.timedelta(hours=7)))
    assert [r[0].hour for r in times.forecast_horizon(short, "t").orderBy("ts").collect()] == [13, 15, 17, 19]


def test_profile(spark):
    df = spark.createDataFrame(
        [("A", 5), ("A", 6), ("A", 8), ("B", 10), ("B", 10), ("C", 11), (None, 11)], "team string, points int"
    )
    assert [tuple(r) for r in profile.value_counts(df, "team").collect()] == [("A", 3), ("B", 2), ("C", 1)]
    assert [r[0] for r in df.select("points").distinct().orderBy("points").collect()] == [5, 6, 8, 10, 11]
    ab = spark.createDataFrame([(0, 4, 4), (1, 5, 1), (2, 6, 1)], "i int, A int, B int")
    assert {r[0]: r[1] for r in profile.nunique_columns(ab, ["A", "B"]).collect()} == {"A": 3, "B": 2}
    per_row = ab.select("i", profile.nunique_row("A", "B").alias("n")).orderBy("i").collect()
    assert [r.n for r in per_row] == [1, 2, 2]


def test_quantiles_with_ties(spark):
    df = spark.createDataFrame([(float(v),) for v in [1] * 50 + [2, 3, 4, 7]], "v double")
    got = {r["prob"]: r["value"] for r in exact_quantiles(df, ["v"], [0.0, 0.5, 0.95, 1.0]).collect()}
    assert got[0.0] == 1 and got[0.5] == 1 and got[1.0] == 7
    assert got[0.95] == pytest.approx(2.35)


def test_splits(spark):
    part = ordered_split(spark.range(10), ["id"], 0.7)
    assert part.where("part = 'test'").count() == 4  # 1 - 0.7 is a little above 0.3
    sizes = kfold(spark.range(12), ["id"], 5).groupBy("fold").count().orderBy("fold").collect()
    assert [r["count"] for r in sizes] == [3, 3, 2, 2, 2]


def test_join_by_position(spark):
    a = spark.createDataFrame([("x",), ("y",), ("z",)], "a string")
    rows = join_by_position(a, spark.range(2), ["a"], ["id"]).orderBy("row_id").collect()
    assert [(r.a, r.id) for r in rows] == [("x", 0), ("y", 1), ("z", None)]


def test_lists_and_maps(spark):
    df = spark.createDataFrame([([3, 1, 3, 2], {"x": "123", "y": "", "z": "456"})], "a array<int>, m map<string,string>")
    a, m = F.col("a"), F.col("m")
    row = df.select(
        nested.remove_first(a, 3), nested.remove_first(a, 9), nested.pop_at(a, 1), nested.insert_at(a, 0, 7),
        nested.index_of(a, 9), nested.count_value(a, 3), nested.map_drop_empty(m), nested.map_delete(m, "x"),
        nested.map_upsert(m, F.create_map(F.lit("x"), F.lit("1"))),
    ).first()
    assert list(row)[:4] == [[1, 3, 2], [3, 1, 3, 2], [3, 3, 2], [7, 3, 1, 3, 2]]
    assert row[4] is None and row[5] == 2
    assert row[6] == {"x": "123", "z": "456"} and row[7] == {"y": "", "z": "456"} and row[8]["x"] == "1"


def test_json(spark):
    cast = '[{"id": 1, "name": "Ann"}, {"id": 2, "name": "Bo"}]'
    crew = '[{"job": "Editor", "name": "E"}, {"job": "Director", "name": "D"}, {"job": "Director", "name": "X"}]'
    df = spark.createDataFrame([(cast, crew, "[]")], "cast string, crew string, none string")
    row = df.select(
        nested.json_names(F.col("cast")), nested.json_pick_first(F.col("crew")), nested.json_pick_first(F.col("none"))
    ).first()
    assert list(row) == [["Ann", "Bo"], "D", ""]


def test_tfidf(spark):
    docs = spark.createDataFrame([(0, "The sky is blue."), (1, "The sun is bright.")], "i int, s string")
    got = {(r.i, r.term): r.tfidf for r in text.tfidf(docs, "i", "s").collect()}
    assert set(got) == {(0, "sky"), (0, "blue"), (1, "sun"), (1, "bright")}
    assert all(v == pytest.approx(2**-0.5) for v in got.values())


def test_scaling_and_encoding(spark):
    df = spark.createDataFrame([(1.0, 5.0, "b"), (2.0, 5.0, None), (4.0, 5.0, "a")], "x double, c double, k string")
    rows = scaling.standard_scale(df, ["x", "c"]).collect()
    assert rows[0].x == pytest.approx((1 - 7 / 3) / 1.2472191289) and [r.c for r in rows] == [0, 0, 0]
    assert [r.c for r in scaling.minmax_scale(df, ["c"]).collect()] == [0, 0, 0]
    coded = {r.k: r.n for r in encoding.ordinal_encode(df, "k", "n").collect()}
    assert coded == {"a": 0, "b": 1, None: -1}
    hot = encoding.one_hot(df, "k", ["a"]).orderBy("x").collect()
    assert [r.k_a for r in hot] == [0, 0, 1]
    sparse = encoding.one_hot_stages(["k"]).fit(df.dropna()).transform(df).orderBy("x").collect()
    assert [r.k_hot.toArray().tolist() for r in sparse] == [[0, 1], [0, 0], [1, 0]]


def test_multilabel_confusion(spark):
    # A [[1,1],[0,1]], B [[1,0],[2,0]], C [[1,1],[0,1]]
    df = spark.createDataFrame(
        [(1, 1, 0, 1, 0, 1), (0, 0, 1, 0, 0, 1), (0, 1, 0, 1, 0, 0)],
        "A int, B int, C int, A_predicted int, B_predicted int, C_predicted int",
    )
    got = {r.label: (r.tn, r.fp, r.fn, r.tp) for r in metrics.multilabel_confusion(df, ["A", "B", "C"]).collect()}
    assert got == {"A": (1, 1, 0, 1), "B": (1, 0, 2, 0), "C": (1, 1, 0, 1)}


# Ten items rated by ten users, 0 for no rating.
RATINGS = [
    [0, 0, 3, 4, 2, 1, 2, 0, 5, 1],
    [3, 0, 1, 3, 0, 0, 0, 0, 0, 0],
    [0, 3, 0, 4, 0, 2, 0, 0, 0, 2],
    [5, 2, 3, 2, 0, 4, 3, 3, 0, 0],
    [0, 5, 5, 0, 0, 0, 0, 0, 5, 4],
    [0, 0, 0, 0, 4, 0, 4, 2, 3, 0],
    [4, 4, 0, 0, 4, 4, 3, 4, 0, 4],
    [5, 0, 4, 2, 3, 0, 3, 3, 3, 3],
    [0, 3, 0, 0, 5, 5, 0, 4, 0, 0],
    [2, 0, 0, 0, 0, 0, 0, 0, 4, 0],
]


def test_item_recommendation(spark):
    rows = [(u, i, float(v)) for i, r in enumerate(RATINGS) for u, v in enumerate(r) if v]
    ratings = spark.createDataFrame(rows, "user long, item long, rating double")
    near = recommend.similar_items(ratings, 2)
    first = near.where("item = 0").orderBy("rank").collect()
    assert [(r.neighbor, round(r.distance, 4)) for r in first] == [(7, 0.3196), (5, 0.4034)]
    predicted = recommend.predict_ratings(ratings, near).where("user = 7 and item = 0").first()
    assert predicted.predicted == pytest.approx(2.5328, abs=5e-5)
