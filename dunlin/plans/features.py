"""Scaling, encoding, client features and text features."""

from __future__ import annotations

from pyspark.sql import functions as F

from dunlin.features import customers, encoding, scaling, text
from dunlin.plans.registry import query, table

MEASURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
_LINE = "l_orderkey, l_linenumber, l_partkey, l_suppkey"


def _lines(spark, sf_dir):
    keys = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
    return table(spark, sf_dir, "lineitem").select(*keys, *MEASURES)


def _rounded(df, columns, digits=6):
    return df.withColumns({c: F.round(c, digits) for c in columns})


@query(
    f"SELECT {_LINE}, "
    + ", ".join(f"round(({c} - avg({c}) OVER ()) / stddev_pop({c}) OVER (), 6) AS {c}" for c in MEASURES)
    + " FROM lineitem"
)
def standard_scale(spark, sf_dir):
    return _rounded(scaling.standard_scale(_lines(spark, sf_dir), MEASURES), MEASURES)


@query(
    f"SELECT {_LINE}, "
    + ", ".join(
        f"round(({c} - min({c}) OVER ()) / (max({c}) OVER () - min({c}) OVER ()), 6) AS {c}" for c in MEASURES
    )
    + " FROM lineitem"
)
def minmax_scale(spark, sf_dir):
    return _rounded(scaling.minmax_scale(_lines(spark, sf_dir), MEASURES), MEASURES)


SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]


@query(
    "SELECT c_custkey, c_mktsegment, "
    + ", ".join(f'CAST(c_mktsegment = \'{s}\' AS INTEGER) AS "c_mktsegment_{s}"' for s in SEGMENTS)
    + " FROM customer"
)
def one_hot(spark, sf_dir):
    return encoding.one_hot(
        table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment"), "c_mktsegment"
    )


@query(
    "WITH b AS (SELECT p_partkey, CASE WHEN p_size <= 45 THEN p_brand END AS brand FROM part), k AS "
    "(SELECT brand, dense_rank() OVER (ORDER BY brand) - 1 AS code FROM (SELECT DISTINCT brand FROM b "
    "WHERE brand IS NOT NULL)) SELECT p_partkey, b.brand, CAST(coalesce(code, -1) AS INTEGER) AS code FROM "
    "b LEFT JOIN k ON b.brand = k.brand"
)
def ordinal_encode(spark, sf_dir):
    rows = table(spark, sf_dir, "part").select(
        "p_partkey", F.when(F.col("p_size") <= 45, F.col("p_brand")).alias("brand")
    )
    return encoding.ordinal_encode(rows, "brand", "code")


@query(
    "WITH k AS (SELECT o_orderpriority AS p, row_number() OVER (ORDER BY o_orderpriority) - 1 AS code FROM "
    "(SELECT DISTINCT o_orderpriority FROM orders)) SELECT o_orderkey, CAST(code AS INTEGER) AS code, "
    + ", ".join(f"CAST(code = {i} AS INTEGER) AS code_{i}" for i in range(5))
    + " FROM orders JOIN k ON o_orderpriority = p"
)
def label_encode(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority")
    coded = encoding.ordinal_encode(rows, "o_orderpriority", "code").drop("o_orderpriority")
    return coded.withColumns(encoding.code_indicators("code", [f"code_{i}" for i in range(5)]))


def _band_sql(column: str, edges, names) -> str:
    low, high = [None, *edges], [*edges, None]
    out = []
    for n, a, b in zip(names, low, high):
        tests = [f"{column} > {a}"] * (a is not None) + [f"{column} <= {b}"] * (b is not None)
        out.append(f"CASE WHEN {' AND '.join(tests)} THEN 1 ELSE 0 END AS {n}")
    return ", ".join(out)


@query(
    "SELECT c_custkey, " + _band_sql("c_acctbal", *customers.INCOME_BANDS) + " FROM customer"
)
def threshold_bands(spark, sf_dir):
    flags = encoding.bands("c_acctbal", *customers.INCOME_BANDS)
    return table(spark, sf_dir, "customer").select(
        "c_custkey", *[c.alias(n) for n, c in flags.items()]
    )


@query(
    "SELECT p_partkey, "
    + ", ".join(f"CAST(p_size = {i} AS INTEGER) AS size_{i}" for i in range(5))
    + " FROM part"
)
def count_bands(spark, sf_dir):
    flags = encoding.count_bands("p_size", "size", 4)
    return table(spark, sf_dir, "part").select("p_partkey", *[c.alias(n) for n, c in flags.items()])


def _clients(spark, sf_dir):
    """Customers as clients: nation number stands in for year of birth and cars."""
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("id"),
        F.col("c_mktsegment").alias("segment"),
        F.expr("make_date(1925 + 3 * c_nationkey, 6, 1)").alias("born"),
        F.col("c_acctbal").alias("income"),
        (F.col("c_nationkey") % 3).alias("cars"),
    )


def _contracts(spark, sf_dir):
    """Orders as contracts: an open order has no closing date."""
    return table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("id"),
        F.col("o_orderpriority").alias("product"),
        F.when(F.col("o_orderstatus") != "O", F.col("o_orderdate")).alias("closed"),
        (F.col("o_totalprice") / 50).alias("balance"),
    )


def _sum_bands(sql: str) -> str:
    return ", ".join(
        f"CAST(sum({e.rsplit(' AS ', 1)[0]}) AS BIGINT) AS {e.rsplit(' AS ', 1)[1]}" for e in sql.split(", ")
    )


_CLIENT = (
    "SELECT c_custkey AS id, CAST(sum(c_nationkey % 3) AS BIGINT) AS cars, "
    + _sum_bands(_band_sql("(2018 - (1925 + 3 * c_nationkey))", *customers.AGE_BANDS))
    + ", "
    + ", ".join(
        f"count(*) FILTER (WHERE c_mktsegment = '{s}') AS segment_{i}" for i, s in enumerate(SEGMENTS)
    )
    + ", "
    + _sum_bands(_band_sql("c_acctbal", *customers.INCOME_BANDS))
    + " FROM customer GROUP BY 1"
)
_PRODUCTS = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
_CONTRACT = (
    "SELECT id, product_0, product_1, product_2, product_3, product_4, "
    + ", ".join(f"CAST(ongoing = {i} AS INTEGER) AS ongoing_{i}" for i in range(5))
    + ", "
    + _band_sql("balance", *customers.BALANCE_BANDS)
    + " FROM (SELECT o_custkey AS id, "
    + ", ".join(
        f"count(*) FILTER (WHERE o_orderpriority = '{p}') AS product_{i}" for i, p in enumerate(_PRODUCTS)
    )
    + ", count(*) FILTER (WHERE o_orderstatus = 'O') AS ongoing, sum(o_totalprice / 50) AS balance FROM "
    "orders GROUP BY 1)"
)


@query(_CLIENT)
def client_features(spark, sf_dir):
    return customers.client_features(_clients(spark, sf_dir))


@query(_CONTRACT)
def contract_features(spark, sf_dir):
    return customers.contract_features(_contracts(spark, sf_dir))


@query(f"SELECT * FROM ({_CONTRACT}) FULL JOIN ({_CLIENT}) USING (id)")
def feature_table(spark, sf_dir):
    return customers.feature_table(_clients(spark, sf_dir), _contracts(spark, sf_dir))


@query(
    "SELECT 'numeric' AS kind, 'o_totalprice' AS \"column\", count(o_totalprice) AS n FROM orders UNION ALL "
    "SELECT 'categorical', 'o_orderstatus', count(o_orderstatus) FROM orders UNION ALL SELECT "
    "'categorical', 'o_orderpriority', count(o_orderpriority) FROM orders UNION ALL SELECT 'numeric', "
    "'o_custkey', count(o_custkey) FROM orders"
)
def split_types(spark, sf_dir):
    """Numeric and categorical columns with their filled rows."""
    orders = table(spark, sf_dir, "orders")
    columns = ["o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority"]
    numeric, _ = encoding.split_types(orders, columns)
    counts = orders.agg(*[F.count(c).alias(c) for c in columns])
    rows = [
        F.struct(
            F.lit("numeric" if c in numeric else "categorical").alias("kind"),
            F.lit(c).alias("column"),
            F.col(c).alias("n"),
        )
        for c in columns
    ]
    return counts.select(F.inline(F.array(*rows)))


# ---- text -------------------------------------------------------------------

_STOP = "[" + ", ".join(f"'{w}'" for w in text.STOP_WORDS) + "]"
_TERMS = (
    r"SELECT doc_id, unnest(regexp_extract_all(lower(text), '[\p{L}\p{N}_]{2,}')) AS term FROM documents"
)
_BAGS = (
    f"bags AS (SELECT doc_id, term, count(*) AS n FROM ({_TERMS}) WHERE NOT list_contains({_STOP}, term) "
    "GROUP BY ALL)"
)
_IDF = (
    ", idf AS (SELECT term, ln((1 + (SELECT count(*) FROM documents)) / (1 + count(*))) + 1 AS idf FROM bags "
    "GROUP BY 1)"
)


@query(
    f"SELECT doc_id, array_to_string(list_filter(string_split(text, ' '), lambda w: NOT list_contains({_STOP}"
    ", lower(w))), ' ') AS text FROM documents"
)
def remove_stopwords(spark, sf_dir):
    return table(spark, sf_dir, "documents").select(
        "doc_id", text.remove_stopwords(F.col("text")).alias("text")
    )


@query(
    "SELECT doc_id, array_to_string(list_sort(list_intersect(list_transform(string_split(text, ' '), lambda "
    f"w: lower(w)), {_STOP})), ' ') AS found FROM documents"
)
def stopwords_found(spark, sf_dir):
    return table(spark, sf_dir, "documents").select(
        "doc_id", F.array_join(text.stopwords_found(F.col("text")), " ").alias("found")
    )


@query(
    r"SELECT doc_id, round(length(regexp_replace(text, '[\p{L}\p{N}\s]', '', 'g')) / length(text), 6) AS noise "
    "FROM documents"
)
def noise_scan(spark, sf_dir):
    return table(spark, sf_dir, "documents").select(
        "doc_id", F.round(text.noise_share(F.col("text")), 6).alias("noise")
    )


@query(f"WITH {_BAGS} SELECT * FROM bags")
def bag_of_words(spark, sf_dir):
    return text.bag_of_words(table(spark, sf_dir, "documents"), "doc_id", "text")


@query(
    f"WITH {_BAGS}{_IDF} SELECT doc_id, term, round(n * idf / sqrt(sum(n * idf * n * idf) OVER (PARTITION BY "
    "doc_id)), 6) AS tfidf FROM bags JOIN idf USING (term)"
)
def tfidf(spark, sf_dir):
    out = text.tfidf(table(spark, sf_dir, "documents"), "doc_id", "text")
    return out.withColumn("tfidf", F.round("tfidf", 6))


@query(
    f"WITH {_BAGS}{_IDF}"
    r", new AS (SELECT item_id, term, count(*) AS n FROM (SELECT item_id, unnest(regexp_extract_all("
    r"lower(text), '[\p{L}\p{N}_]{2,}')) AS term FROM benchmark) GROUP BY ALL) SELECT item_id, term, "
    "round(n * idf / sqrt(sum(n * idf * n * idf) OVER (PARTITION BY item_id)), 6) AS tfidf FROM new JOIN "
    "idf USING (term)"
)
def tfidf_apply(spark, sf_dir):
    """Vocabulary and idf of the documents applied to the benchmark texts."""
    docs = table(spark, sf_dir, "documents")
    idf = text.fit_idf(text.bag_of_words(docs, "doc_id", "text"), docs.count())
    bags = text.bag_of_words(table(spark, sf_dir, "benchmark"), "item_id", "text")
    return text.apply_idf(bags, idf, "item_id").withColumn("tfidf", F.round("tfidf", 6))


@query(
    f"SELECT term, count(*) AS n FROM ({_TERMS}) WHERE NOT list_contains({_STOP}, term) GROUP BY 1 ORDER BY n "
    "DESC, term LIMIT 2000"
)
def token_frequency(spark, sf_dir):
    return text.token_frequency(table(spark, sf_dir, "documents"), "text", 2000)
