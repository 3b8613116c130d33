"""Cluster scores and prediction metrics on given label columns."""

from __future__ import annotations

from pyspark.sql import functions as F

from dunlin.cluster import scores
from dunlin.learn import metrics
from dunlin.plans.registry import query, table

_E = "SELECT vec_id, label AS c, CAST(embedding AS DOUBLE[]) AS v FROM embeddings"
_SILHOUETTE = (
    f"WITH e AS ({_E}), p AS (SELECT a.vec_id, a.c AS own, b.c, sum(list_distance(a.v, b.v)) AS d, "
    "count(*) AS n FROM e a, e b GROUP BY ALL), r AS (SELECT vec_id, max(CASE WHEN own = c THEN d / "
    "greatest(n - 1, 1) END) AS a, min(CASE WHEN own <> c THEN d / n END) AS b, max(CASE WHEN own = c "
    "THEN n END) AS size FROM p GROUP BY 1), sil AS (SELECT avg(CASE WHEN size = 1 THEN 0 ELSE (b - a) / "
    "greatest(a, b) END) AS v FROM r)"
)
_CELLS = (
    f"WITH e AS ({_E}), x AS (SELECT vec_id, c, generate_subscripts(v, 1) AS pos, unnest(v) AS x FROM e)"
)
_CH = (
    ", m AS (SELECT c, pos, avg(x) AS m, count(*) AS n, sum(x * x) - sum(x) * sum(x) / count(*) AS w FROM "
    "x GROUP BY ALL), g AS (SELECT pos, avg(x) AS gm FROM x GROUP BY 1), ch AS (SELECT (sum(n * (m - gm) * "
    "(m - gm)) / (count(DISTINCT c) - 1)) / (sum(w) / ((SELECT count(*) FROM e) - count(DISTINCT c))) AS "
    "v FROM m JOIN g USING (pos))"
)
_DB = (
    ", m2 AS (SELECT c, pos, avg(x) AS m FROM x GROUP BY ALL), d AS (SELECT x.c, x.vec_id, sqrt(sum((x - "
    "m) * (x - m))) AS d FROM x JOIN m2 ON x.c = m2.c AND x.pos = m2.pos GROUP BY ALL), s AS (SELECT c, "
    "avg(d) AS s FROM d GROUP BY 1), q AS (SELECT a.c AS i, b.c AS j, sqrt(sum((a.m - b.m) * (a.m - "
    "b.m))) AS gap FROM m2 a JOIN m2 b ON a.pos = b.pos AND a.c <> b.c GROUP BY ALL), db AS (SELECT "
    "avg(worst) AS v FROM (SELECT i, max((si.s + sj.s) / gap) AS worst FROM q JOIN s si ON si.c = i JOIN "
    "s sj ON sj.c = j GROUP BY 1))"
)


@query(_SILHOUETTE + " SELECT round(v, 6) AS silhouette FROM sil")
def silhouette(spark, sf_dir):
    s = scores.silhouette(table(spark, sf_dir, "embeddings"), "vec_id", "embedding", "label")
    return s.select(F.round("silhouette", 6).alias("silhouette"))


@query(
    f"WITH e AS ({_E}), p AS (SELECT a.vec_id, a.c AS own, b.c, sum(list_distance(a.v, b.v) * list_distance(a.v, "
    "b.v)) AS d, count(*) AS n FROM e a, e b GROUP BY ALL), r AS (SELECT vec_id, max(CASE WHEN own = c THEN d / "
    "greatest(n - 1, 1) END) AS a, min(CASE WHEN own <> c THEN d / n END) AS b, max(CASE WHEN own = c THEN n END) "
    "AS size FROM p GROUP BY 1) SELECT round(avg(CASE WHEN size = 1 THEN 0 ELSE (b - a) / greatest(a, b) END), 6) "
    "AS silhouette FROM r"
)
def squared_silhouette(spark, sf_dir):
    """Silhouette with squared distances, from sums per cluster."""
    s = scores.squared_silhouette(table(spark, sf_dir, "embeddings"), "embedding", "label")
    return s.select(F.round("silhouette", 6).alias("silhouette"))


@query(_CELLS + _CH + " SELECT round(v, 6) AS calinski_harabasz FROM ch")
def calinski_harabasz(spark, sf_dir):
    s = scores.calinski_harabasz(table(spark, sf_dir, "embeddings"), "embedding", "label")
    return s.select(F.round("calinski_harabasz", 6).alias("calinski_harabasz"))


@query(_CELLS + _DB + " SELECT round(v, 6) AS davies_bouldin FROM db")
def davies_bouldin(spark, sf_dir):
    s = scores.davies_bouldin(table(spark, sf_dir, "embeddings"), "embedding", "label")
    return s.select(F.round("davies_bouldin", 6).alias("davies_bouldin"))


@query(
    _SILHOUETTE + ", x AS (SELECT vec_id, c, generate_subscripts(v, 1) AS pos, unnest(v) AS x FROM e)"
    + _CH + _DB + " SELECT 'Silhouette Score' AS metric, round(v, 2) AS value FROM sil UNION ALL SELECT "
    "'Calinski Harabasz Score', round(v, 2) FROM ch UNION ALL SELECT 'Davies Bouldin Score', round(v, 2) "
    "FROM db UNION ALL SELECT 'Clusters Found', CAST(count(DISTINCT c) AS DOUBLE) FROM e WHERE c >= 0"
)
def cluster_report(spark, sf_dir):
    return scores.cluster_report(table(spark, sf_dir, "embeddings"), "vec_id", "embedding", "label")


def _binary(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select(
        (F.col("l_returnflag") == "R").cast("int").alias("truth"),
        (F.col("l_quantity") > 30).cast("int").alias("guess"),
    )


@query(
    "WITH c AS (SELECT count(*) FILTER (WHERE t = 0 AND p = 0) AS tn, count(*) FILTER (WHERE t = 0 AND p "
    "= 1) AS fp, count(*) FILTER (WHERE t = 1 AND p = 0) AS fn, count(*) FILTER (WHERE t = 1 AND p = 1) "
    "AS tp FROM (SELECT CAST(l_returnflag = 'R' AS INTEGER) AS t, CAST(l_quantity > 30 AS INTEGER) AS p "
    "FROM lineitem)) SELECT round((tp + tn) / (tp + tn + fp + fn), 2) AS accuracy, round(2 * tp / (2 * tp "
    "+ fp + fn), 2) AS f1, round(tp / (tp + fn), 2) AS recall, round(tp / (tp + fp), 2) AS precision, "
    "round((tp / (tp + fn) + tn / (tn + fp)) / 2, 2) AS roc_auc, tn, fp, fn, tp FROM c"
)
def binary_report(spark, sf_dir):
    return metrics.binary_report(_binary(spark, sf_dir), "truth", "guess")


def _classes(spark, sf_dir):
    guess = F.when(F.col("l_quantity") < 17, "A").when(F.col("l_quantity") < 34, "N").otherwise("R")
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_returnflag").alias("truth"), guess.alias("guess")
    )


_REPORT = (
    "WITH r AS (SELECT l_returnflag AS t, CASE WHEN l_quantity < 17 THEN 'A' WHEN l_quantity < 34 THEN "
    "'N' ELSE 'R' END AS p FROM lineitem), k AS (SELECT DISTINCT t AS label FROM r), c AS (SELECT label, "
    "count(*) FILTER (WHERE t <> label AND p <> label) AS tn, count(*) FILTER (WHERE t <> label AND p = "
    "label) AS fp, count(*) FILTER (WHERE t = label AND p <> label) AS fn, count(*) FILTER (WHERE t = "
    "label AND p = label) AS tp FROM r, k GROUP BY 1), s AS (SELECT label, tp / (tp + fp) AS precision, tp "
    "/ (tp + fn) AS recall, 2 * tp / (2 * tp + fp + fn) AS f1, tp + fn AS support, tn, fp, fn, tp FROM c) "
)


@query(
    _REPORT + "SELECT label, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS "
    "f1, support, tn, fp, fn, tp FROM s UNION ALL SELECT 'accuracy', a, a, a, n, NULL, NULL, NULL, NULL "
    "FROM (SELECT round(sum(tp) / sum(support), 6) AS a, CAST(sum(support) AS BIGINT) AS n FROM s) UNION "
    "ALL SELECT 'macro avg', round(avg(precision), 6), round(avg(recall), 6), round(avg(f1), 6), "
    "CAST(sum(support) AS BIGINT), NULL, NULL, NULL, NULL FROM s UNION ALL SELECT 'weighted avg', "
    "round(sum(precision * support) / sum(support), 6), round(sum(recall * support) / sum(support), 6), "
    "round(sum(f1 * support) / sum(support), 6), CAST(sum(support) AS BIGINT), NULL, NULL, NULL, NULL FROM s"
)
def multiclass_report(spark, sf_dir):
    out = metrics.multiclass_report(_classes(spark, sf_dir), "truth", "guess")
    return out.withColumns({c: F.round(c, 6) for c in ("precision", "recall", "f1")})


@query(_REPORT + "SELECT round(sum(f1 * support) / sum(support), 6) AS weighted_f1 FROM s")
def weighted_f1(spark, sf_dir):
    out = metrics.weighted_f1(_classes(spark, sf_dir), "truth", "guess")
    return out.select(F.round("weighted_f1", 6).alias("weighted_f1"))


def _multilabel(spark, sf_dir):
    """Known labels beside a rule: long texts are good, web sources 0..4 toxic."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "n_chars", "source")
    return table(spark, sf_dir, "labels").join(docs, "doc_id").select(
        "quality",
        "toxic",
        (F.col("n_chars") > 800).cast("int").alias("quality_predicted"),
        F.col("source").isin("src0", "src1", "src2", "src3").cast("int").alias("toxic_predicted"),
    )


_ML = (
    "WITH m AS (SELECT quality, toxic, CAST(n_chars > 800 AS INTEGER) AS qp, CAST(source IN ('src0', "
    "'src1', 'src2', 'src3') AS INTEGER) AS tp FROM labels JOIN documents USING (doc_id)) "
)


@query(
    _ML + " UNION ALL ".join(
        f"SELECT '{c}' AS label, count(*) FILTER (WHERE {c} = 0 AND {p} = 0) AS tn, count(*) FILTER (WHERE "
        f"{c} = 0 AND {p} = 1) AS fp, count(*) FILTER (WHERE {c} = 1 AND {p} = 0) AS fn, count(*) FILTER "
        f"(WHERE {c} = 1 AND {p} = 1) AS tp FROM m"
        for c, p in (("quality", "qp"), ("toxic", "tp"))
    )
)
def multilabel_confusion(spark, sf_dir):
    return metrics.multilabel_confusion(_multilabel(spark, sf_dir), ["quality", "toxic"])


@query(
    _ML + "SELECT round(avg(CAST(quality = qp AND toxic = tp AS INTEGER)), 6) AS subset_accuracy, "
    "round(avg(CAST(quality <> qp AS INTEGER) + CAST(toxic <> tp AS INTEGER)) / 2, 6) AS hamming_loss FROM m"
)
def multilabel_scores(spark, sf_dir):
    out = metrics.multilabel_scores(_multilabel(spark, sf_dir), ["quality", "toxic"])
    return out.select(*[F.round(c, 6).alias(c) for c in out.columns])


@query(
    _ML + "SELECT 'quality' AS label, round(avg(CAST(quality = qp AS INTEGER)), 6) AS accuracy FROM m UNION "
    "ALL SELECT 'toxic', round(avg(CAST(toxic = tp AS INTEGER)), 6) FROM m"
)
def label_accuracy(spark, sf_dir):
    out = metrics.label_accuracy(_multilabel(spark, sf_dir), ["quality", "toxic"])
    return out.select("label", F.round("accuracy", 6).alias("accuracy"))


@query(
    "WITH r AS (SELECT l_extendedprice AS y, l_quantity * 2100 AS p FROM lineitem) SELECT round(max(abs(y "
    "- p)), 2) AS max_error, round(1 - avg((y - p) * (y - p)) / var_pop(y), 2) AS r2, round(avg(abs(y - "
    "p)), 2) AS mae, round(avg((y - p) * (y - p)), 2) AS mse, round(sqrt(avg((y - p) * (y - p))), 2) AS "
    "rmse FROM r"
)
def regression_report(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").select(
        "l_extendedprice", (F.col("l_quantity") * 2100).alias("guess")
    )
    return metrics.regression_report(rows, "l_extendedprice", "guess")


@query(
    "WITH f AS (SELECT user_id, CASE WHEN value > 150 THEN 1 ELSE 0 END AS a FROM events) SELECT 'Total' "
    "AS id, CAST(sum(a) AS BIGINT) AS anomalies, CAST(sum(1 - a) AS BIGINT) AS normal FROM f UNION ALL "
    "SELECT CAST(user_id AS VARCHAR), CAST(sum(a) AS BIGINT), CAST(sum(1 - a) AS BIGINT) FROM f GROUP BY "
    "user_id"
)
def anomaly_flags(spark, sf_dir):
    rows = table(spark, sf_dir, "events").select(
        "user_id", F.when(F.col("value") > 150, -1).otherwise(1).alias("detected")
    )
    return metrics.anomaly_totals(rows, "detected", "user_id")
