"""Joins, aggregation, profiling, sorting, splits and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from dunlin.operators import ordering, profile
from dunlin.operators.joins import eps_join, full_outer, rounded
from dunlin.operators.joins import join_by_position as side_by_side
from dunlin.plans.registry import query, table


def ratings(spark, sf_dir):
    """User-item ratings: mean quantity of a part over a customer's order lines."""
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_quantity")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return (
        lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .groupBy(F.col("o_custkey").alias("user"), F.col("l_partkey").alias("item"))
        .agg(F.avg("l_quantity").alias("rating"))
    )


RATINGS_SQL = (
    'SELECT o_custkey AS "user", l_partkey AS item, avg(l_quantity) AS rating FROM lineitem '
    "JOIN orders ON l_orderkey = o_orderkey GROUP BY ALL"
)


@query(
    "SELECT l_orderkey, l_linenumber, l_partkey, o_custkey FROM lineitem JOIN orders "
    "ON l_orderkey = o_orderkey"
)
def join_inner(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).drop("o_orderkey")


@query(
    "SELECT c_custkey, o_orderkey, o_totalprice FROM customer LEFT JOIN orders ON c_custkey = o_custkey"
)
def join_left(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_totalprice")
    customers = table(spark, sf_dir, "customer").select("c_custkey")
    return customers.join(orders, F.col("c_custkey") == F.col("o_custkey"), "left").drop("o_custkey")


@query(
    "SELECT coalesce(c.k, s.k) AS nationkey, n_customers, n_suppliers FROM (SELECT c_nationkey k, "
    "count(*) n_customers FROM customer WHERE c_acctbal > 5000 GROUP BY 1) c FULL JOIN (SELECT "
    "s_nationkey k, count(*) n_suppliers FROM supplier WHERE s_acctbal > 5000 GROUP BY 1) s ON c.k = s.k"
)
def join_full_on_index(spark, sf_dir):
    customers = table(spark, sf_dir, "customer").where("c_acctbal > 5000")
    suppliers = table(spark, sf_dir, "supplier").where("s_acctbal > 5000")
    return full_outer(
        customers.groupBy(F.col("c_nationkey").alias("nationkey")).agg(
            F.count("*").alias("n_customers")
        ),
        suppliers.groupBy(F.col("s_nationkey").alias("nationkey")).agg(
            F.count("*").alias("n_suppliers")
        ),
        ["nationkey"],
    )


@query(
    "SELECT coalesce(a.i, b.i) AS row_id, c_custkey, p_partkey FROM (SELECT row_number() OVER (ORDER "
    "BY c_acctbal, c_custkey) - 1 AS i, c_custkey FROM customer) a FULL JOIN (SELECT row_number() "
    "OVER (ORDER BY p_size, p_partkey) - 1 AS i, p_partkey FROM part) b ON a.i = b.i"
)
def join_by_position(spark, sf_dir):
    customers = table(spark, sf_dir, "customer").select("c_acctbal", "c_custkey")
    parts = table(spark, sf_dir, "part").select("p_size", "p_partkey")
    joined = side_by_side(customers, parts, ["c_acctbal", "c_custkey"], ["p_size", "p_partkey"])
    return joined.select("row_id", "c_custkey", "p_partkey")


FIRST_USER = '(SELECT min(o_custkey) FROM orders)'


@query(
    f'WITH r AS ({RATINGS_SQL}) SELECT p_partkey AS item FROM part WHERE p_partkey NOT IN (SELECT item '
    f'FROM r WHERE "user" = {FIRST_USER})'
)
def anti_unseen(spark, sf_dir):
    """Items the first user has not rated."""
    user = table(spark, sf_dir, "orders").agg(F.min("o_custkey")).first()[0]
    seen = ratings(spark, sf_dir).where(F.col("user") == user)
    items = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("item"))
    return items.join(seen, "item", "left_anti")


@query(
    f'WITH r AS ({RATINGS_SQL}) SELECT p_partkey AS item, p_name FROM part WHERE p_partkey IN (SELECT '
    f'item FROM r WHERE "user" = {FIRST_USER} AND rating > 0)'
)
def semi_seen(spark, sf_dir):
    user = table(spark, sf_dir, "orders").agg(F.min("o_custkey")).first()[0]
    seen = ratings(spark, sf_dir).where((F.col("user") == user) & (F.col("rating") > 0))
    items = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("item"), "p_name")
    return items.join(seen, "item", "left_semi")


@query(
    "SELECT c_custkey, s_suppkey, round(sqrt((c_acctbal/100 - s_acctbal/100)*(c_acctbal/100 - "
    "s_acctbal/100) + (c_nationkey - s_nationkey)*(c_nationkey - s_nationkey)), 6) AS distance FROM "
    "customer JOIN supplier ON sqrt((c_acctbal/100 - s_acctbal/100)*(c_acctbal/100 - s_acctbal/100) + "
    "(c_nationkey - s_nationkey)*(c_nationkey - s_nationkey)) <= 2.5"
)
def eps_range_join(spark, sf_dir):
    """Customers and suppliers close in balance and nation number."""
    customers = table(spark, sf_dir, "customer").select(
        "c_custkey",
        (F.col("c_acctbal") / 100).alias("x"),
        F.col("c_nationkey").cast("double").alias("y"),
    )
    suppliers = table(spark, sf_dir, "supplier").select(
        "s_suppkey",
        (F.col("s_acctbal") / 100).alias("x"),
        F.col("s_nationkey").cast("double").alias("y"),
    )
    pairs = eps_join(customers, suppliers, ["x", "y"], 2.5)
    return pairs.select("c_custkey", "s_suppkey", rounded("distance", 6).alias("distance"))


@query("SELECT DISTINCT c_mktsegment FROM customer")
def unique_values(spark, sf_dir):
    return table(spark, sf_dir, "customer").select("c_mktsegment").distinct()


@query(
    " UNION ALL ".join(
        f"SELECT DISTINCT '{c}' AS \"column\", CAST({c} AS VARCHAR) AS value FROM part"
        for c in ("p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice")
    )
)
def unique_all_columns(spark, sf_dir):
    return profile.unique_all_columns(table(spark, sf_dir, "part"))


@query("SELECT DISTINCT p_size FROM part ORDER BY p_size")
def unique_sorted(spark, sf_dir):
    return table(spark, sf_dir, "part").select("p_size").distinct().orderBy("p_size")


@query("SELECT event_type, count(*) AS n FROM events WHERE event_type IS NOT NULL GROUP BY 1")
def value_counts(spark, sf_dir):
    return profile.value_counts(table(spark, sf_dir, "events"), "event_type")


NUNIQUE = ["l_orderkey", "l_partkey", "l_suppkey", "l_quantity", "l_discount", "l_returnflag"]


@query(
    " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", count(DISTINCT {c}) AS value FROM lineitem" for c in NUNIQUE
    )
)
def nunique_columns(spark, sf_dir):
    return profile.nunique_columns(table(spark, sf_dir, "lineitem"), NUNIQUE)


@query(
    "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(len(list_distinct([l_orderkey % 7, "
    "l_linenumber, l_partkey % 7])) AS INTEGER) AS n_unique FROM lineitem"
)
def nunique_rows(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        "l_suppkey",
        (F.col("l_orderkey") % 7).alias("a"),
        F.col("l_linenumber").cast("long").alias("b"),
        (F.col("l_partkey") % 7).alias("c"),
    )
    return lines.withColumn("n_unique", profile.nunique_row("a", "b", "c")).drop("a", "b", "c")


@query(
    "SELECT o_orderpriority, round(avg(o_totalprice), 4) AS mean_price, round(sum(o_totalprice), 2) AS "
    "sum_price FROM orders GROUP BY 1"
)
def group_mean_sum(spark, sf_dir):
    return (
        table(spark, sf_dir, "orders")
        .groupBy("o_orderpriority")
        .agg(
            F.round(F.avg("o_totalprice"), 4).alias("mean_price"),
            F.round(F.sum("o_totalprice"), 2).alias("sum_price"),
        )
    )


@query("SELECT count(DISTINCT user_id) AS n_groups FROM events")
def group_count(spark, sf_dir):
    return table(spark, sf_dir, "events").agg(F.count_distinct("user_id").alias("n_groups"))


SUMS = {
    "returned": "l_returnflag = 'R'",
    "accepted": "l_returnflag = 'A'",
    "none": "l_returnflag = 'N'",
    "open": "l_linestatus = 'O'",
    "filled": "l_linestatus = 'F'",
    "bulk": "l_quantity > 25",
    "discounted": "l_discount > 0",
    "taxed": "l_tax > 0",
    "big": "l_extendedprice > 50000",
    "first_line": "l_linenumber = 1",
}


@query(
    "SELECT l_suppkey, "
    + ", ".join(f"count(*) FILTER (WHERE {c}) AS {n}" for n, c in SUMS.items())
    + ", round(sum(l_quantity), 2) AS quantity, round(sum(l_extendedprice), 2) AS price, "
    "round(sum(l_tax), 2) AS tax, CAST(sum(l_linenumber) AS BIGINT) AS line FROM lineitem GROUP BY 1"
)
def group_sum_many(spark, sf_dir):
    flags = table(spark, sf_dir, "lineitem").withColumns(
        {n: F.expr(c).cast("int") for n, c in SUMS.items()}
    )
    return flags.groupBy("l_suppkey").agg(
        *[F.sum(n).alias(n) for n in SUMS],
        F.round(F.sum("l_quantity"), 2).alias("quantity"),
        F.round(F.sum("l_extendedprice"), 2).alias("price"),
        F.round(F.sum("l_tax"), 2).alias("tax"),
        F.sum("l_linenumber").alias("line"),
    )


@query("SELECT user_id, array_to_string(list_sort(list(DISTINCT event_type)), ',') AS types FROM events GROUP BY 1")
def group_set(spark, sf_dir):
    pairs = table(spark, sf_dir, "events").select("user_id", "event_type").distinct()
    return pairs.groupBy("user_id").agg(F.array_join(F.sort_array(F.collect_set("event_type")), ",").alias("types"))


@query("SELECT label, count(*) AS n FROM embeddings GROUP BY 1")
def label_counts(spark, sf_dir):
    return table(spark, sf_dir, "embeddings").groupBy("label").agg(F.count("*").alias("n"))


@query("SELECT user_id, count(*) AS n_rows, 6 AS n_cols FROM events GROUP BY 1")
def group_profile(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    return events.groupBy("user_id").agg(
        F.count("*").alias("n_rows"), F.lit(len(events.columns)).alias("n_cols")
    )


PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]


@query(
    "SELECT o_custkey, "
    + ", ".join(
        f"coalesce(round(avg(o_totalprice) FILTER (WHERE o_orderpriority = '{p}'), 4), 0) AS \"{p}\""
        for p in PRIORITIES
    )
    + " FROM orders GROUP BY 1"
)
def pivot_mean(spark, sf_dir):
    wide = (
        table(spark, sf_dir, "orders")
        .groupBy("o_custkey")
        .pivot("o_orderpriority", PRIORITIES)
        .agg(F.round(F.avg("o_totalprice"), 4))
    )
    return wide.fillna(0)


@query("SELECT l_returnflag, l_linestatus, count(*) AS n FROM lineitem GROUP BY ALL")
def crosstab(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").groupBy("l_returnflag", "l_linestatus").agg(
        F.count("*").alias("n")
    )


DESCRIBED = ["l_quantity", "l_extendedprice", "l_discount"]


@query(
    " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", count({c}) AS n, round(avg({c}), 6) AS mean, round(stddev_samp("
        f"{c}), 6) AS std, min({c}) AS min, round(quantile_cont({c}, 0.25), 6) AS q25, "
        f"round(quantile_cont({c}, 0.5), 6) AS q50, round(quantile_cont({c}, 0.75), 6) AS q75, "
        f"max({c}) AS max FROM lineitem"
        for c in DESCRIBED
    )
)
def describe(spark, sf_dir):
    out = profile.describe(table(spark, sf_dir, "lineitem"), DESCRIBED)
    return out.withColumns({c: F.round(c, 6) for c in ("mean", "std", "q25", "q50", "q75")})


CORRELATED = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_linenumber"]


@query(
    " UNION ALL ".join(
        f"SELECT '{a}' AS col_a, '{b}' AS col_b, round(corr({a}, {b}), 2) AS corr FROM lineitem"
        for a in CORRELATED
        for b in CORRELATED
    )
)
def correlation_matrix(spark, sf_dir):
    return profile.correlation_matrix(table(spark, sf_dir, "lineitem"), CORRELATED)


@query(
    "SELECT CAST(least(floor((c_acctbal - lo) / (hi - lo) * 80), 79) AS INTEGER) AS bin, count(*) AS n "
    "FROM customer, (SELECT min(c_acctbal) lo, max(c_acctbal) hi FROM customer) GROUP BY 1"
)
def histogram(spark, sf_dir):
    return profile.histogram(table(spark, sf_dir, "customer"), "c_acctbal", 80)


@query(
    "SELECT c_custkey, CASE WHEN c_acctbal <= q1 THEN 1 WHEN c_acctbal <= q2 THEN 2 WHEN c_acctbal <= "
    "q3 THEN 3 ELSE 4 END AS quartile FROM customer, (SELECT quantile_cont(c_acctbal, 0.25) q1, "
    "quantile_cont(c_acctbal, 0.5) q2, quantile_cont(c_acctbal, 0.75) q3 FROM customer)"
)
def quantile_bins(spark, sf_dir):
    rows = table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal")
    return profile.quantile_bins(rows, "c_acctbal", [1, 2, 3, 4], "quartile").drop("c_acctbal")


@query(
    "SELECT user_id, value, event_id, event_type FROM (SELECT *, row_number() OVER (PARTITION BY "
    "user_id ORDER BY value DESC, event_id) r FROM events) WHERE r = 1"
)
def max_score_pick(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    return profile.pick_max(events, ["user_id"], "value", "event_id", ["event_type"])


@query("SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey")
def sort_by(spark, sf_dir):
    picked = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    return picked.orderBy(F.desc("o_totalprice"), "o_orderkey")


@query(
    "SELECT * FROM (SELECT l_partkey, count(*) AS n FROM lineitem GROUP BY 1 ORDER BY n DESC, l_partkey "
    "LIMIT 10) ORDER BY n, l_partkey"
)
def top_k(spark, sf_dir):
    counts = table(spark, sf_dir, "lineitem").groupBy("l_partkey").agg(F.count("*").alias("n"))
    return counts.orderBy(F.desc("n"), "l_partkey").limit(10).orderBy("n", "l_partkey")


@query(
    "SELECT * FROM (SELECT o_custkey, o_orderkey, o_totalprice, CAST(row_number() OVER (PARTITION BY "
    'o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS INTEGER) AS "rank" FROM orders) WHERE '
    '"rank" <= 3'
)
def top_k_per_group(spark, sf_dir):
    picked = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_totalprice")
    order = [F.desc("o_totalprice"), F.col("o_orderkey")]
    return ordering.top_per_group(picked, ["o_custkey"], order, 3)


@query(
    "SELECT c_custkey, c_acctbal, CAST(row_number() OVER (ORDER BY c_acctbal DESC, c_custkey) AS BIGINT)"
    ' AS "rank" FROM customer'
)
def rank_output(spark, sf_dir):
    rows = table(spark, sf_dir, "customer").select(
        "c_custkey", "c_acctbal", (-F.col("c_acctbal")).alias("down")
    )
    numbered = ordering.ranked(rows, ["down", "c_custkey"])
    return numbered.select("c_custkey", "c_acctbal", (F.col("row_id") + 1).alias("rank"))


@query(
    "SELECT c_custkey AS key, c_acctbal AS balance, c_mktsegment AS segment FROM customer UNION ALL "
    "SELECT s_suppkey, s_acctbal, NULL FROM supplier"
)
def union_all(spark, sf_dir):
    customers = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("key"),
        F.col("c_acctbal").alias("balance"),
        F.col("c_mktsegment").alias("segment"),
    )
    suppliers = table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("key"), F.col("s_acctbal").alias("balance")
    )
    return customers.unionByName(suppliers, allowMissingColumns=True)


@query(
    "SELECT o_orderkey, r AS row_id, CASE WHEN r < n - ceil((1.0::DOUBLE - 0.7::DOUBLE) * n) THEN "
    "'train' ELSE 'test' END AS part FROM (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) "
    "- 1 AS r, count(*) OVER () AS n FROM orders)"
)
def ordered_split(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").select("o_orderkey")
    return ordering.ordered_split(rows, ["o_orderkey"], 0.7)


@query(
    "SELECT c_custkey, c_acctbal, CASE WHEN r < n - ceil(0.25 * n) THEN 'train' ELSE 'test' END AS "
    "part FROM (SELECT c_custkey, c_acctbal, row_number() OVER (ORDER BY ('0x' || substr(md5('42:' || "
    "c_custkey), 1, 8))::BIGINT, c_custkey) - 1 AS r, count(*) OVER () AS n FROM customer)"
)
def random_split(spark, sf_dir):
    rows = table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal")
    return ordering.random_split(rows, "c_custkey", 0.75)


@query(
    "SELECT event_id, row_number() OVER (ORDER BY event_id) - 1 AS row_id, CAST(ntile(5) OVER (ORDER "
    "BY event_id) - 1 AS INTEGER) AS fold FROM events"
)
def kfold(spark, sf_dir):
    return ordering.kfold(table(spark, sf_dir, "events").select("event_id"), ["event_id"], 5)


@query(
    "SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)"
)
def column_diff(spark, sf_dir):
    """Keys required but not present."""
    docs = table(spark, sf_dir, "documents").select("doc_id")
    return docs.join(table(spark, sf_dir, "labels"), "doc_id", "left_anti")
