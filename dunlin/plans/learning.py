"""Classification, multi-label learning and per-group models."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from dunlin.features import text
from dunlin.learn import bayes, classify, grouped, multilabel, trees
from dunlin.operators.frame import flag_mismatch
from dunlin.operators.ordering import ordered_split, random_split
from dunlin.plans.features import _BAGS, _IDF
from dunlin.plans.registry import query, table
from dunlin.session import materialize, new_path

NUMERIC = ["o_totalprice", "year", "month"]
CATEGORIES = ["o_orderpriority", "weekday"]
DIMS = [f"x{i}" for i in range(64)]


def _orders(spark, sf_dir):
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        "o_orderstatus",
        "o_orderpriority",
        "o_totalprice",
        F.year("o_orderdate").cast("double").alias("year"),
        F.month("o_orderdate").cast("double").alias("month"),
        F.date_format("o_orderdate", "E").alias("weekday"),
    )


def _vectors(spark, sf_dir):
    e = table(spark, sf_dir, "embeddings")
    wide = [F.col("embedding")[i].cast("double").alias(c) for i, c in enumerate(DIMS)]
    return e.select("vec_id", F.col("label").cast("string").alias("label"), *wide)


@query()
def tree_numeric(spark, sf_dir):
    _, out = classify.train_classifier(_vectors(spark, sf_dir), "vec_id", "label", classify.tree(8), DIMS)
    return out.select("vec_id", "part", "label", "predicted", "error")


@query()
def tree_one_hot(spark, sf_dir):
    _, out = classify.train_classifier(
        _orders(spark, sf_dir), "o_orderkey", "o_orderstatus", classify.tree(), [], CATEGORIES
    )
    return out.select("o_orderkey", "part", "o_orderstatus", "predicted", "error")


@query()
def random_forest(spark, sf_dir):
    _, out = classify.train_classifier(_vectors(spark, sf_dir), "vec_id", "label", classify.forest(20), DIMS)
    return out.select("vec_id", "part", "label", "predicted", "error")


_BAG_SQL = (
    "WITH m AS (SELECT min(n) AS n FROM (SELECT count(*) AS n FROM orders GROUP BY o_orderstatus)), b AS "
    "(SELECT CAST(unnest(range(3)) AS INTEGER) AS bag) SELECT o_orderkey, o_orderstatus, bag FROM (SELECT "
    "*, row_number() OVER (PARTITION BY bag, o_orderstatus ORDER BY ('0x' || substr(md5((42 + bag) || ':' || "
    "o_orderkey), 1, 8))::BIGINT, o_orderkey) AS r FROM orders, b) WHERE r <= (SELECT n FROM m)"
)


@query(_BAG_SQL)
def balanced_bags(spark, sf_dir):
    """Rows drawn for three balanced bags."""
    rows = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    return classify.balanced_bags(rows, "o_orderkey", "o_orderstatus", 3)


def _bagged(spark, sf_dir, estimator, bags, encoding):
    rows = _orders(spark, sf_dir)
    model = classify.BalancedBagging(estimator, bags).fit(
        rows, "o_orderkey", "o_orderstatus", NUMERIC, CATEGORIES, encoding
    )
    out = model.transform(rows).withColumn("error", flag_mismatch("o_orderstatus", "predicted"))
    return out.select("o_orderkey", "o_orderstatus", "predicted", "error")


@query()
def balanced_bagging_tree(spark, sf_dir):
    return _bagged(spark, sf_dir, classify.tree(), 3, "one_hot")


@query()
def balanced_bagging_forest(spark, sf_dir):
    return _bagged(spark, sf_dir, classify.forest(5), 2, "one_hot")


TARGETS = ["o_orderstatus", "o_orderpriority"]
TREE_NUMERIC, TREE_CATEGORIES = ["o_totalprice", "year", "month"], ["weekday"]
TREE_DEPTH = 4


def _split_orders(spark, sf_dir):
    return materialize(ordered_split(_orders(spark, sf_dir), ["o_orderkey"], 0.7).drop("row_id"), "split")


def _tree_sql(targets: list[str], bags: int | None, last: str) -> str:
    """SQL of the best Gini splits, level by level, on the head of the orders; ``last`` reads ``p<depth>`` or ``s<level>``."""
    size = 5  # the most classes of a target
    features = [*TREE_NUMERIC, *TREE_CATEGORIES]
    parts = [
        "o AS (SELECT *, row_number() OVER (ORDER BY o_orderkey) - 1 AS rn, CAST(year(o_orderdate) AS DOUBLE) AS year, "
        "CAST(month(o_orderdate) AS DOUBLE) AS month, strftime(o_orderdate, '%a') AS weekday FROM orders)",
        "r AS (SELECT *, rn < (SELECT count(*) - ceil((1::DOUBLE - 0.7::DOUBLE) * count(*)) FROM o) AS train FROM o)",
        "codes AS (SELECT weekday, row_number() OVER (ORDER BY weekday) - 1 AS code FROM (SELECT DISTINCT weekday FROM r WHERE train "
        "AND weekday IS NOT NULL))",
        "x AS (SELECT o_orderkey AS k, train, o_totalprice, year, month, CAST(coalesce(code, -1) AS DOUBLE) AS weekday FROM r LEFT JOIN "
        "codes USING (weekday))",
        "v AS (" + " UNION ALL ".join(f"SELECT k, train, {i} AS f, {c} AS v FROM x" for i, c in enumerate(features)) + ")",
        f"e AS (SELECT f, CASE WHEN count(DISTINCT v) <= {trees.BINS} THEN list(DISTINCT v) ELSE list_distinct(quantile_cont(v, "
        f"[{', '.join(str(i / trees.BINS) for i in range(1, trees.BINS))}])) END AS es FROM v WHERE train GROUP BY 1)",
        "xb AS MATERIALIZED (SELECT k, f, len(list_filter(es, lambda q: q < v)) AS b FROM v JOIN e USING (f))",
        "l AS (" + " UNION ALL ".join(f"SELECT o_orderkey AS k, train, {i} AS t, {c} AS name FROM r" for i, c in enumerate(targets)) + ")",
        "cl AS (SELECT t, name, row_number() OVER (PARTITION BY t ORDER BY name) - 1 AS y FROM (SELECT DISTINCT t, name FROM l WHERE "
        "train AND name IS NOT NULL))",
        "y AS (SELECT k, train AND y IS NOT NULL AS train, l.t, y FROM l LEFT JOIN cl ON l.t = cl.t AND l.name = cl.name)",
    ]
    if bags is None:
        parts.append("p0 AS MATERIALIZED (SELECT k, t, 0 AS bag, y, train AS held, CAST(1 AS BIGINT) AS node FROM y)")
    else:
        parts += [
            "least AS (SELECT t, min(n) AS n FROM (SELECT t, y, count(*) AS n FROM y WHERE train GROUP BY ALL) GROUP BY 1)",
            f"d AS (SELECT *, row_number() OVER (PARTITION BY bag, t, y, train ORDER BY ('0x' || substr(md5(({42} + bag) || ':' || k), 1, "
            f"8))::BIGINT, k) AS place FROM y, (SELECT CAST(unnest(range({bags})) AS INTEGER) AS bag))",
            "p0 AS MATERIALIZED (SELECT k, t, bag, y, train AND place <= n AS held, CAST(1 AS BIGINT) AS node FROM d JOIN least USING (t))",
        ]
    c = range(size)
    square = lambda s: "(" + " + ".join(f"{s}{i}::DOUBLE * {s}{i}" for i in c) + ") / (" + " + ".join(f"{s}{i}" for i in c) + ")"
    for d in range(TREE_DEPTH):
        parts += [
            f"h{d} AS (SELECT t, bag, node, f, b, " + ", ".join(f"count(*) FILTER (y = {i}) AS n{i}" for i in c)
            + f" FROM p{d} JOIN xb USING (k) WHERE held GROUP BY ALL)",
            f"w{d} AS (SELECT t, bag, node, f, b, " + ", ".join(
                f"CAST(sum(n{i}) OVER (PARTITION BY t, bag, node, f ORDER BY b) AS BIGINT) AS a{i}, CAST(sum(n{i}) OVER (PARTITION BY t, "
                f"bag, node, f) AS BIGINT) AS z{i}" for i in c
            ) + f" FROM h{d})",
            f"g{d} AS (SELECT *, " + ", ".join(f"z{i} - a{i} AS r{i}" for i in c) + f" FROM w{d} WHERE "
            + " + ".join(f"z{i} - a{i}" for i in c) + " > 0 AND " + " + ".join(f"(z{i} > 0)::INT" for i in c) + " > 1)",
            f"q{d} AS (SELECT *, {square('a')} + {square('r')} AS score FROM g{d})",
            f"s{d} AS MATERIALIZED (SELECT t, bag, node, f, b, score - {square('z')} AS gain FROM q{d} QUALIFY row_number() OVER "
            "(PARTITION BY t, bag, node ORDER BY score DESC, f, b) = 1)",
            f"p{d + 1} AS MATERIALIZED (SELECT p.k, p.t, p.bag, p.y, p.held, CASE WHEN s.f IS NULL THEN p.node ELSE 2 * p.node + "
            f"(xb.b > s.b)::INT END AS node FROM p{d} p LEFT JOIN s{d} s USING (t, bag, node) LEFT JOIN xb ON xb.k = p.k AND xb.f = s.f)",
        ]
    parts += [
        f"leaf AS (SELECT t, bag, node, y, n / sum(n) OVER (PARTITION BY t, bag, node) AS share FROM (SELECT t, bag, node, y, count(*) "
        f"AS n FROM p{TREE_DEPTH} WHERE held GROUP BY ALL))",
        f"votes AS (SELECT p.k, p.t, leaf.y, round(sum(share), 9) AS s FROM p{TREE_DEPTH} p JOIN leaf USING (t, bag, node) GROUP BY ALL)",
        "won AS (SELECT k, t, name FROM (SELECT k, t, y FROM votes QUALIFY row_number() OVER (PARTITION BY k, t ORDER BY s DESC, y) = 1) "
        "JOIN cl USING (t, y))",
    ]
    return "WITH " + ", ".join(parts) + " " + last


def _predictions(targets: list[str]) -> str:
    given = ", ".join(f'w{i}.name AS "{c}_predicted", (r.{c} IS DISTINCT FROM w{i}.name)::INT AS "{c}_error"' for i, c in enumerate(targets))
    joins = " ".join(f"LEFT JOIN won w{i} ON w{i}.k = o_orderkey AND w{i}.t = {i}" for i in range(len(targets)))
    return f"SELECT o_orderkey, CASE WHEN train THEN 'train' ELSE 'test' END AS part, {', '.join(targets)}, {given} FROM r {joins}"


def _fit_trees(rows, targets, bags):
    model = trees.OrdinalTrees(bags=bags, max_depth=TREE_DEPTH)
    return model.fit(rows.where("part = 'train'"), "o_orderkey", targets, TREE_NUMERIC, TREE_CATEGORIES)


def _tree_predictions(spark, sf_dir, targets, bags):
    rows = _split_orders(spark, sf_dir)
    out = _fit_trees(rows, targets, bags).transform(rows)
    wrong = [flag_mismatch(c, f"{c}_predicted").alias(f"{c}_error") for c in targets]
    return out.select("o_orderkey", "part", *targets, *[f"{c}_predicted" for c in targets], *wrong)


@query(_tree_sql(TARGETS, 3, _predictions(TARGETS)))
def balanced_bagging_ordinal(spark, sf_dir):
    """Two targets at once on numbers and ordinal codes: fitted on the head of the orders, all predicted."""
    return _tree_predictions(spark, sf_dir, TARGETS, 3)


@query(_tree_sql(TARGETS[:1], None, _predictions(TARGETS[:1])))
def tree_ordinal(spark, sf_dir):
    """One tree on all rows of the head, from level-wise histograms."""
    return _tree_predictions(spark, sf_dir, TARGETS[:1], None)


@query(
    _tree_sql(
        TARGETS, 3,
        "SELECT target, \"column\", round(coalesce(sum(part), 0) / 3, 6) AS importance FROM (SELECT t, bag, f, sum(gain) / sum(sum(gain)) "
        "OVER (PARTITION BY t, bag) AS part FROM ("
        + " UNION ALL ".join(f"SELECT t, bag, f, gain FROM s{d}" for d in range(TREE_DEPTH))
        + ") WHERE gain > 0 GROUP BY t, bag, f) RIGHT JOIN (VALUES "
        + ", ".join(f"({t}, {f}, '{a}', '{c}')" for t, a in enumerate(TARGETS) for f, c in enumerate([*TREE_NUMERIC, *TREE_CATEGORIES]))
        + ") names(t, f, target, \"column\") USING (t, f) GROUP BY target, \"column\"",
    )
)
def tree_importance(spark, sf_dir):
    """Share of the impurity that each column takes away, mean over the bags of a target."""
    model = _fit_trees(_split_orders(spark, sf_dir), TARGETS, 3)
    return model.importance().withColumn("importance", F.round("importance", 6))


@query(
    "WITH x AS (SELECT label, generate_subscripts(embedding, 1) - 1 AS pos, CAST(unnest(embedding) AS DOUBLE) "
    "AS x FROM embeddings) SELECT label, CAST(pos AS INTEGER) AS pos, count(*) AS n, round(avg(x), 6) AS "
    "mean, round(var_pop(x), 6) AS var FROM x GROUP BY ALL"
)
def gaussian_nb(spark, sf_dir):
    out = bayes.gaussian_parameters(table(spark, sf_dir, "embeddings"), "embedding", "label")
    return out.withColumns({c: F.round(c, 6) for c in ("mean", "var")})


_WEIGHTS = (
    "w AS (SELECT doc_id, term, n * idf / sqrt(sum(n * idf * n * idf) OVER (PARTITION BY doc_id)) AS w FROM "
    "bags JOIN idf USING (term)), y AS (SELECT doc_id, 'quality' AS label, quality AS c FROM labels UNION ALL "
    "SELECT doc_id, 'toxic', toxic FROM labels), k AS (SELECT label, c, term, w FROM w JOIN y USING "
    "(doc_id)), tot AS (SELECT label, c, sum(w) AS total FROM k GROUP BY ALL), terms AS (SELECT DISTINCT "
    "label, term FROM k), siz AS (SELECT label, count(*) AS size FROM terms GROUP BY 1), s AS (SELECT label, "
    "c, term, sum(w) AS w FROM k GROUP BY ALL), lp AS (SELECT t.label, t.c, v.term, ln((coalesce(s.w, 0) + 1) "
    "/ (total + size)) AS logp FROM tot t JOIN siz USING (label) JOIN terms v ON v.label = t.label LEFT JOIN s "
    "ON s.label = t.label AND s.c = t.c AND s.term = v.term)"
)


def _doc_weights(spark, sf_dir):
    return materialize(text.tfidf(table(spark, sf_dir, "documents"), "doc_id", "text"), "tfidf")


@query(
    f"WITH {_BAGS}{_IDF}, {_WEIGHTS} SELECT label, CAST(c AS INTEGER) AS class, term, round(logp, 6) AS logp "
    "FROM lp"
)
def multinomial_nb(spark, sf_dir):
    """Log probabilities of all terms for both labels of the documents."""
    truth = bayes.melt_labels(table(spark, sf_dir, "labels"), "doc_id", ["quality", "toxic"])
    found, _ = bayes.multinomial_parameters(_doc_weights(spark, sf_dir), truth, "doc_id")
    return found.withColumn("logp", F.round("logp", 6))


@query(
    f"WITH {_BAGS}{_IDF}, {_WEIGHTS}, pr AS (SELECT label, c, ln(n / sum(n) OVER (PARTITION BY label)) AS "
    "prior FROM (SELECT label, c, count(*) AS n FROM y GROUP BY ALL)), sc AS (SELECT doc_id, lp.label, lp.c, round(sum(w.w * logp) + "
    "any_value(prior), 9) AS s FROM w JOIN lp USING (term) JOIN pr ON pr.label = lp.label AND pr.c = lp.c "
    "GROUP BY ALL), b AS (SELECT doc_id, label, c, row_number() OVER (PARTITION BY doc_id, label ORDER BY s "
    "DESC, c) AS r FROM sc) SELECT doc_id, label, CAST(c AS INTEGER) AS predicted FROM b WHERE r = 1"
)
def binary_relevance(spark, sf_dir):
    """One naive Bayes classifier per label, all fitted and applied in the same jobs."""
    weights = _doc_weights(spark, sf_dir)
    truth = bayes.melt_labels(table(spark, sf_dir, "labels"), "doc_id", ["quality", "toxic"])
    found, prior = bayes.multinomial_parameters(weights, truth, "doc_id")
    return bayes.multinomial_predict(weights, found, prior, "doc_id")


LABELS = ["quality", "toxic"]
TEXT_FEATURES = ["n_chars", "noise", "stops"]


def _labelled(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select(
        "doc_id",
        F.col("n_chars").cast("double").alias("n_chars"),
        text.noise_share(F.col("text")).alias("noise"),
        F.size(text.stopwords_found(F.col("text"))).cast("double").alias("stops"),
    )
    rows = materialize(docs.join(table(spark, sf_dir, "labels"), "doc_id"), "labelled")
    return materialize(random_split(rows, "doc_id", 0.7), "split")


@query()
def classifier_chain(spark, sf_dir):
    """Fitted on seven tenths of the labelled documents; all are predicted, ``part`` says which were held out."""
    rows = _labelled(spark, sf_dir)
    train = rows.where("part = 'train'")
    chain = multilabel.classifier_chain(train, LABELS, TEXT_FEATURES, classify.forest(5))
    return multilabel.predict_chain(chain, rows)


@query()
def label_powerset(spark, sf_dir):
    """Fitted and predicted as the chain."""
    rows = _labelled(spark, sf_dir)
    model = multilabel.label_powerset(rows.where("part = 'train'"), LABELS, TEXT_FEATURES, classify.tree())
    return multilabel.predict_powerset(model, rows, LABELS)


@query("SELECT doc_id, quality || '|' || toxic AS label_set FROM labels")
def label_powerset_classes(spark, sf_dir):
    return table(spark, sf_dir, "labels").select("doc_id", multilabel.powerset(LABELS).alias("label_set"))


@query()
def classify_infer(spark, sf_dir):
    """A saved pipeline, loaded again and applied to all rows."""
    rows = _orders(spark, sf_dir)
    path = new_path(spark, "model")
    classify.fit_classifier(rows, "o_orderstatus", classify.tree(), NUMERIC, CATEGORIES).save(path)
    out = classify.classify_infer(PipelineModel.load(path), rows, "predicted(o_orderstatus)")
    return out.select("o_orderkey", "o_orderstatus", "predicted(o_orderstatus)")


@query()
def feature_importance(spark, sf_dir):
    rows = _orders(spark, sf_dir)
    model = classify.fit_classifier(rows, "o_orderstatus", classify.tree(), NUMERIC, CATEGORIES)
    return classify.feature_importance(model, rows)


@query()
def importance_rank(spark, sf_dir):
    rows = _vectors(spark, sf_dir)
    model = classify.fit_classifier(rows, "label", classify.forest(20), DIMS)
    return classify.importance_rank(model, rows)


def _events(spark, sf_dir):
    k = F.get_json_object("props", "$.k").cast("double")
    return table(spark, sf_dir, "events").select("event_id", "user_id", k.alias("k"), "value")


_K = "SELECT event_id, user_id, CAST(json_extract(props, '$.k') AS DOUBLE) AS k, value FROM events"


@query(
    f"SELECT user_id, count(*) AS n, round(regr_intercept(value, k), 6) AS intercept, round(regr_slope(value, "
    f"k), 6) AS slope FROM ({_K}) GROUP BY 1"
)
def train_per_group(spark, sf_dir):
    models = grouped.train_per_group(_events(spark, sf_dir), "user_id", ["k"], "value")
    return models.select(
        "user_id", "n", F.round("intercept", 6).alias("intercept"), F.round(F.col("coefficients")[0], 6).alias("slope")
    )


@query(
    f"WITH e AS ({_K}), m AS (SELECT user_id, regr_intercept(value, k) AS i, regr_slope(value, k) AS s FROM e "
    'GROUP BY 1) SELECT event_id, user_id, k, value, round(i + s * k, 2) AS "predicted(value)" FROM e JOIN m '
    "USING (user_id)"
)
def infer_per_group(spark, sf_dir):
    rows = _events(spark, sf_dir)
    models = grouped.train_per_group(rows, "user_id", ["k"], "value")
    return grouped.infer_per_group(rows, models, "user_id", ["k"], "value")
