"""Sources, sinks, projection, filters, shape and cleaning."""

from __future__ import annotations

from pyspark.sql import functions as F

from dunlin.operators.frame import check_input as input_report
from dunlin.operators.frame import combined_key, table_schema as schema_report, table_shape as shape
from dunlin.operators.frame import flag_mismatch as mismatch
from dunlin.operators.ordering import ranked
from dunlin.plans.registry import query, table
from dunlin.session import new_path
from dunlin.sources.csv import read_csv, write_csv
from dunlin.sources.rows import inline_table as rows_table
from dunlin.sources.rows import random_columns, random_table as coin_table

PART_SCHEMA = (
    "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, "
    "p_retailprice double"
)


@query("SELECT * FROM part")
def scan_csv(spark, sf_dir):
    path = write_csv(table(spark, sf_dir, "part"), new_path(spark, "csv"))
    return read_csv(spark, path, PART_SCHEMA)


@query("SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def scan_csv_sep(spark, sf_dir):
    path = write_csv(table(spark, sf_dir, "customer"), new_path(spark, "csv"), sep=";")
    schema = "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"
    return read_csv(spark, path, schema, sep=";")


@query("SELECT p_partkey, p_retailprice FROM part")
def scan_csv_columns(spark, sf_dir):
    path = write_csv(table(spark, sf_dir, "part"), new_path(spark, "csv"))
    return read_csv(spark, path, PART_SCHEMA, columns=["p_partkey", "p_retailprice"])


@query(
    "SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN o_orderpriority END AS o_orderpriority "
    "FROM orders"
)
def scan_csv_nulls(spark, sf_dir):
    open_orders = table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.when(F.col("o_orderstatus") != "P", F.col("o_orderpriority")).alias("o_orderpriority"),
    )
    path = write_csv(open_orders, new_path(spark, "csv"), null_value="\\N")
    return read_csv(spark, path, "o_orderkey bigint, o_orderpriority string", null_value="\\N")


@query("SELECT doc_id, text, lang FROM documents")
def scan_csv_text(spark, sf_dir):
    """Whole texts with quotes, commas and line ends, out and in."""
    texts = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    path = write_csv(texts, new_path(spark, "csv"))
    return read_csv(spark, path, "doc_id bigint, text string, lang string", multi_line=True)


@query("SELECT event_id, props FROM events")
def scan_csv_json(spark, sf_dir):
    """JSON inside CSV: quotes are doubled."""
    rows = table(spark, sf_dir, "events").select("event_id", "props")
    path = write_csv(rows, new_path(spark, "csv"))
    return read_csv(spark, path, "event_id bigint, props string")


@query("SELECT s_suppkey, s_name, s_acctbal FROM supplier")
def sink_csv(spark, sf_dir):
    out = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_acctbal")
    path = write_csv(out, new_path(spark, "csv"))
    return read_csv(spark, path, "s_suppkey bigint, s_name string, s_acctbal double")


@query(
    "SELECT l_returnflag AS label, CASE WHEN l_returnflag = l_linestatus THEN 0 ELSE 1 END AS error, "
    "count(*) AS n, CAST(sum(l_linenumber) AS BIGINT) AS sum_line FROM lineitem GROUP BY ALL"
)
def sink_csv_by_key(spark, sf_dir):
    """One folder per (label, right or wrong), written in one pass."""
    rows = table(spark, sf_dir, "lineitem").select(
        F.col("l_returnflag").alias("label"),
        mismatch("l_returnflag", "l_linestatus").alias("error"),
        "l_orderkey",
        "l_linenumber",
    )
    path = write_csv(rows, new_path(spark, "csv"), by=["label", "error"])
    back = read_csv(
        spark, path, "l_orderkey bigint, l_linenumber int, label string, error int"
    )
    return back.groupBy("label", "error").agg(
        F.count("*").alias("n"), F.sum("l_linenumber").alias("sum_line")
    )


@query(
    "SELECT o_orderpriority, weight, count(*) AS n FROM orders JOIN (VALUES ('1-URGENT', 5), "
    "('2-HIGH', 4), ('3-MEDIUM', 3), ('4-NOT SPECIFIED', 2), ('5-LOW', 1)) AS w(p, weight) "
    "ON o_orderpriority = p GROUP BY ALL"
)
def inline_table(spark, sf_dir):
    weights = rows_table(
        spark,
        [("1-URGENT", 5), ("2-HIGH", 4), ("3-MEDIUM", 3), ("4-NOT SPECIFIED", 2), ("5-LOW", 1)],
        "o_orderpriority string, weight int",
    )
    joined = table(spark, sf_dir, "orders").join(F.broadcast(weights), "o_orderpriority")
    return joined.groupBy("o_orderpriority", "weight").agg(F.count("*").alias("n"))


def _coin(key: str, seed: int) -> str:
    return f"CAST(('0x' || substr(md5('{seed}:' || {key}), 1, 8))::BIGINT % 2 AS INTEGER)"


@query(
    "SELECT i AS row_id, "
    + ", ".join(f"{_coin('i', 42 + j)} AS {c}" for j, c in enumerate("ABCD"))
    + " FROM range((SELECT count(*) FROM orders)) AS r(i)"
)
def random_table(spark, sf_dir):
    """As many random rows as there are orders."""
    return coin_table(spark, table(spark, sf_dir, "orders").count())


@query(
    "SELECT o_orderkey, o_orderstatus, "
    + ", ".join(f"{_coin('o_orderkey', 7 + j)} AS user_{c}" for j, c in enumerate("ABCD"))
    + " FROM orders"
)
def attach_random_labels(spark, sf_dir):
    base = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    return random_columns(base, "o_orderkey", [f"user_{c}" for c in "ABCD"], seed=7)


@query("SELECT o_orderkey, o_totalprice FROM orders")
def project(spark, sf_dir):
    return table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")


@query("SELECT l_orderkey, l_linenumber, l_partkey, l_quantity FROM lineitem")
def drop_columns(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").drop(
        "l_suppkey", "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus",
        "l_shipdate",
    )


@query("SELECT c_custkey AS ID, c_mktsegment AS CSP, c_acctbal AS REVENUS FROM customer")
def rename_columns(spark, sf_dir):
    picked = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment", "c_acctbal")
    return picked.withColumnsRenamed(
        {"c_custkey": "ID", "c_mktsegment": "CSP", "c_acctbal": "REVENUS"}
    )


@query("SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus = 'F'")
def filter_eq(spark, sf_dir):
    return (
        table(spark, sf_dir, "orders")
        .where(F.col("o_orderstatus") == "F")
        .select("o_orderkey", "o_orderstatus")
    )


@query(
    "SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem "
    "WHERE l_returnflag = 'R' AND l_quantity > 30"
)
def filter_and(spark, sf_dir):
    return (
        table(spark, sf_dir, "lineitem")
        .where((F.col("l_returnflag") == "R") & (F.col("l_quantity") > 30))
        .select("l_orderkey", "l_linenumber", "l_quantity")
    )


@query(
    "SELECT event_id, event_type FROM events WHERE event_type = 'error' OR event_type = 'signup' "
    "OR event_type = 'view'"
)
def filter_or_in(spark, sf_dir):
    return (
        table(spark, sf_dir, "events")
        .where(F.col("event_type").isin("error", "signup", "view"))
        .select("event_id", "event_type")
    )


@query(
    "SELECT l_orderkey, l_linenumber, l_discount, l_linestatus FROM lineitem "
    "WHERE l_discount <> 0 AND l_linestatus <> 'F'"
)
def filter_nonzero(spark, sf_dir):
    return (
        table(spark, sf_dir, "lineitem")
        .where((F.col("l_discount") != 0) & (F.col("l_linestatus") != "F"))
        .select("l_orderkey", "l_linenumber", "l_discount", "l_linestatus")
    )


@query(
    "SELECT p_partkey, p_name FROM part WHERE contains(p_name, 'widget') ORDER BY p_partkey LIMIT 1"
)
def filter_contains(spark, sf_dir):
    """First row, in key order, whose name contains the text."""
    return (
        table(spark, sf_dir, "part")
        .where(F.col("p_name").contains("widget"))
        .select("p_partkey", "p_name")
        .orderBy("p_partkey")
        .limit(1)
    )


@query(
    "SELECT p_partkey, CAST(p_size AS DOUBLE) AS size_d, CAST(p_partkey AS VARCHAR) AS key_s FROM part"
)
def cast_column(spark, sf_dir):
    return table(spark, sf_dir, "part").select(
        "p_partkey",
        F.col("p_size").cast("double").alias("size_d"),
        F.col("p_partkey").cast("string").alias("key_s"),
    )


@query(
    "SELECT c_custkey, coalesce(o.n, 0) AS n FROM customer LEFT JOIN (SELECT o_custkey, count(*) n "
    "FROM orders GROUP BY 1) o ON c_custkey = o_custkey"
)
def fill_null(spark, sf_dir):
    n = table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.count("*").alias("n")
    )
    return table(spark, sf_dir, "customer").select("c_custkey").join(n, "c_custkey", "left").fillna(0)


@query(
    "SELECT d.doc_id, quality FROM documents d JOIN labels l ON d.doc_id = l.doc_id "
    "WHERE quality IS NOT NULL"
)
def drop_null(spark, sf_dir):
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality")
    docs = table(spark, sf_dir, "documents").select("doc_id")
    return docs.join(labels, "doc_id", "left").dropna(subset=["quality"])


@query(
    "SELECT d.doc_id, coalesce(CAST(quality AS VARCHAR), 'nan') || coalesce(CAST(toxic AS VARCHAR), "
    "'nan') AS target FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id"
)
def derive_concat_key(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id")
    joined = docs.join(table(spark, sf_dir, "labels"), "doc_id", "left")
    return joined.select("doc_id", combined_key("quality", "toxic").alias("target"))


@query(
    "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, row_number() OVER ("
    "ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice) - 1 AS new_id "
    "FROM lineitem"
)
def row_number_index(spark, sf_dir):
    keys = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"]
    return ranked(table(spark, sf_dir, "lineitem").select(*keys), keys, name="new_id")


@query(
    "SELECT * FROM (SELECT event_id, ts, row_number() OVER (ORDER BY ts, event_id) - 1 AS row_id "
    "FROM events) WHERE row_id = 3 OR row_id = 160"
)
def nth_row(spark, sf_dir):
    rows = ranked(table(spark, sf_dir, "events").select("event_id", "ts"), ["ts", "event_id"])
    return rows.where(F.col("row_id").isin(3, 160))


@query("SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice, o_orderkey LIMIT 5")
def head(spark, sf_dir):
    picked = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    return picked.orderBy("o_totalprice", "o_orderkey").limit(5)


@query(
    "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey DESC LIMIT 5"
)
def tail(spark, sf_dir):
    picked = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    return picked.orderBy(F.desc("o_totalprice"), F.desc("o_orderkey")).limit(5)


@query(
    "SELECT count(*) AS n_rows, CAST(11 AS BIGINT) AS n_cols, count(*) * 11 AS n_cells FROM lineitem"
)
def table_shape(spark, sf_dir):
    return shape(table(spark, sf_dir, "lineitem"))


@query(
    "SELECT 0 AS pos, 'c_custkey' AS \"column\", 'bigint' AS type, count(c_custkey) AS non_null FROM "
    "customer UNION ALL SELECT 1, 'c_name', 'string', count(c_name) FROM customer UNION ALL SELECT 2, "
    "'c_nationkey', 'int', count(c_nationkey) FROM customer UNION ALL SELECT 3, 'c_acctbal', "
    "'double', count(c_acctbal) FROM customer UNION ALL SELECT 4, 'c_mktsegment', 'string', "
    "count(c_mktsegment) FROM customer"
)
def table_schema(spark, sf_dir):
    return schema_report(table(spark, sf_dir, "customer"))


@query(
    "SELECT 'empty' AS \"check\", CASE WHEN count(*) = 0 THEN 'no rows' ELSE '' END AS problem FROM "
    "customer UNION ALL SELECT 'missing', 'c_age' UNION ALL SELECT 'not_numeric', 'c_mktsegment'"
)
def check_input(spark, sf_dir):
    return input_report(
        table(spark, sf_dir, "customer"), ["c_acctbal", "c_age"], ["c_acctbal", "c_mktsegment"]
    )


@query(
    "SELECT d.doc_id, CASE WHEN quality = toxic THEN 0 ELSE 1 END AS error FROM documents d "
    "LEFT JOIN labels l ON d.doc_id = l.doc_id"
)
def flag_mismatch(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id")
    joined = docs.join(table(spark, sf_dir, "labels"), "doc_id", "left")
    return joined.select("doc_id", mismatch("quality", "toxic").alias("error"))


@query(
    "SELECT d.doc_id, CAST(quality IS NULL AS INTEGER) AS is_null, CAST(quality IS NOT NULL AS "
    "INTEGER) AS is_not_null FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id"
)
def null_predicates(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id")
    joined = docs.join(table(spark, sf_dir, "labels"), "doc_id", "left")
    return joined.select(
        "doc_id",
        F.col("quality").isNull().cast("int").alias("is_null"),
        F.col("quality").isNotNull().cast("int").alias("is_not_null"),
    )
