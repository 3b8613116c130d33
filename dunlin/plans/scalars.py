"""Text, time, list, map and JSON functions on the driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from dunlin.functions import nested, strings, times
from dunlin.plans.registry import query, table


def joined(a, separator: str = ","):
    """A list as text, so that any client compares it the same way."""
    return F.array_join(F.transform(a, lambda x: x.cast("string")), separator)


# ---- text -------------------------------------------------------------------


@query("SELECT p_partkey, upper(p_name) AS up, lower(p_brand) AS low FROM part")
def string_case(spark, sf_dir):
    return table(spark, sf_dir, "part").select(
        "p_partkey", F.upper("p_name").alias("up"), F.lower("p_brand").alias("low")
    )


@query("SELECT doc_id, replace(text, ' ', '') AS joined FROM documents")
def remove_spaces(spark, sf_dir):
    return table(spark, sf_dir, "documents").select(
        "doc_id", strings.remove_spaces(F.col("text")).alias("joined")
    )


@query(r"SELECT doc_id, regexp_replace(text, '[^\p{L}\p{N}_]', '', 'g') AS words FROM documents")
def keep_word_chars(spark, sf_dir):
    return table(spark, sf_dir, "documents").select(
        "doc_id", strings.keep_word_chars(F.col("text")).alias("words")
    )


@query("SELECT s_suppkey, translate(s_name, '#0', '') AS name FROM supplier")
def remove_char_set(spark, sf_dir):
    return table(spark, sf_dir, "supplier").select(
        "s_suppkey", strings.remove_chars(F.col("s_name"), "#0").alias("name")
    )


@query(
    "SELECT page_id, CASE WHEN i > 0 THEN substr(url, 1, i - 1) ELSE url END AS head, CASE WHEN i > 0 "
    "THEN substr(url, i + 8) ELSE '' END AS tail FROM (SELECT *, instr(url, 'example.') AS i FROM pages)"
)
def before_after(spark, sf_dir):
    url = F.col("url")
    return table(spark, sf_dir, "pages").select(
        "page_id",
        strings.before(url, "example.").alias("head"),
        strings.after(url, "example.").alias("tail"),
    )


@query(
    "SELECT c_custkey, array_to_string(list_sort(string_split(c_name, '')), ',') AS chars FROM customer"
)
def sorted_chars(spark, sf_dir):
    return table(spark, sf_dir, "customer").select(
        "c_custkey", joined(strings.sorted_chars(F.col("c_name"))).alias("chars")
    )


@query(
    "WITH c AS (SELECT p_partkey, unnest(string_split(regexp_replace(upper(p_name || p_brand), "
    "'[^A-Z0-9_]', '', 'g'), '')) AS ch FROM part), n AS (SELECT p_partkey, ch, count(*) AS n FROM c "
    "GROUP BY ALL) SELECT p_partkey, string_agg(ch || CASE WHEN n > 1 THEN CAST(n AS VARCHAR) ELSE '' "
    "END, '' ORDER BY ch) AS code FROM n GROUP BY 1"
)
def sorted_run_length(spark, sf_dir):
    return table(spark, sf_dir, "part").select(
        "p_partkey", strings.sorted_run_length(F.concat("p_name", "p_brand")).alias("code")
    )


@query("SELECT p_partkey, replace(p_name, ' ', '|') || '|' || p_brand AS items FROM part")
def strip_split(spark, sf_dir):
    text = F.expr("concat('[''', replace(p_name, ' ', ''', '''), ''', \"', p_brand, '\"]')")
    return table(spark, sf_dir, "part").select("p_partkey", joined(strings.strip_split(text), "|").alias("items"))


def _incidents(spark, sf_dir):
    """Suppliers written as incident records: a target list and a technique list."""
    return table(spark, sf_dir, "supplier").select(
        "s_suppkey",
        F.expr(
            "case when s_nationkey % 5 = 0 then null when s_nationkey % 5 = 1 then concat('hostIpAddr:10.', "
            "s_nationkey, '.0.', s_suppkey % 250) else concat('hostIpAddr:10.', s_nationkey, '.0.', "
            "s_suppkey % 250, ',hostName:', s_name) end"
        ).alias("target"),
        F.expr(
            "case when s_nationkey % 4 = 0 then '[{\"tactic\": \"none\"}]' when s_nationkey % 4 = 1 then "
            "concat('[{\"name\": \"a\", \"techniqueid\": \"T', 1000 + s_nationkey, '\"}]') else "
            "concat('[{\"name\": \"a\", \"techniqueid\": \"T', 1000 + s_nationkey, '\"}, {\"name\": \"b\", "
            "\"techniqueid\": \"T', 2000 + s_suppkey, '\"}]') end"
        ).alias("technique"),
    )


_IP = "CASE WHEN s_nationkey % 5 <> 0 THEN '10.' || s_nationkey || '.0.' || (s_suppkey % 250) END"
_HOST = "CASE WHEN s_nationkey % 5 > 1 THEN s_name END"
_FIRST = "CASE WHEN s_nationkey % 4 <> 0 THEN 'T' || (1000 + s_nationkey) END"
_ALL = (
    "CASE WHEN s_nationkey % 4 = 0 THEN NULL WHEN s_nationkey % 4 = 1 THEN 'T' || (1000 + s_nationkey) "
    "ELSE 'T' || (1000 + s_nationkey) || ',T' || (2000 + s_suppkey) END"
)


@query(f"SELECT s_suppkey, {_IP} AS ip, {_HOST} AS host FROM supplier")
def parse_key_values(spark, sf_dir):
    return _incidents(spark, sf_dir).select(
        "s_suppkey",
        strings.value_of(F.col("target"), "hostIpAddr").alias("ip"),
        strings.value_of(F.col("target"), "hostName").alias("host"),
    )


@query(f"SELECT s_suppkey, {_FIRST} AS techniqueid FROM supplier")
def extract_ids_first(spark, sf_dir):
    return _incidents(spark, sf_dir).select(
        "s_suppkey", strings.first_id(F.col("technique"), "techniqueid").alias("techniqueid")
    )


@query(f"SELECT s_suppkey, {_ALL} AS techniqueid FROM supplier")
def extract_ids_all(spark, sf_dir):
    return _incidents(spark, sf_dir).select(
        "s_suppkey", strings.all_ids(F.col("technique"), "techniqueid").alias("techniqueid")
    )


@query(
    f'SELECT s_suppkey, {_IP} AS "hostIpAddr", {_HOST} AS "hostName", {_ALL} AS techniqueid FROM supplier'
)
def parse_incident(spark, sf_dir):
    parsed = _incidents(spark, sf_dir).withColumns(strings.incident_columns("target", "technique"))
    return parsed.drop("target", "technique")


@query(
    "SELECT d.doc_id, coalesce(CAST(quality AS VARCHAR), '') AS quality FROM documents d LEFT JOIN "
    "labels l ON d.doc_id = l.doc_id"
)
def null_to_empty(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id")
    joined = docs.join(table(spark, sf_dir, "labels"), "doc_id", "left")
    return joined.select("doc_id", strings.null_to_empty(F.col("quality")).alias("quality"))


# ---- time -------------------------------------------------------------------


@query(
    "SELECT event_id, date_trunc('second', ts) AS spaced, date_trunc('second', ts) AS with_t, "
    "CAST(NULL AS TIMESTAMP) AS wrong FROM events"
)
def parse_timestamp(spark, sf_dir):
    text = F.date_format("ts", "yyyy-MM-dd HH:mm:ss")
    return table(spark, sf_dir, "events").select(
        "event_id",
        times.parse_timestamp(text).alias("spaced"),
        times.parse_timestamp(F.replace(text, F.lit(" "), F.lit("T"))).alias("with_t"),
        times.parse_timestamp(F.col("event_type")).alias("wrong"),
    )


@query("SELECT o_orderkey, CAST(o_orderdate AS DATE) AS day FROM orders")
def parse_date(spark, sf_dir):
    text = F.date_format("o_orderdate", "yyyy-MM-dd")
    return table(spark, sf_dir, "orders").select("o_orderkey", times.parse_date(text).alias("day"))


@query(
    "SELECT event_id, ts + INTERVAL 3 DAY AS in_days, ts + INTERVAL 5 HOUR AS in_hours FROM events"
)
def add_interval(spark, sf_dir):
    return table(spark, sf_dir, "events").select(
        "event_id",
        (F.col("ts") + F.expr("interval 3 days")).alias("in_days"),
        (F.col("ts") + F.expr("interval 5 hours")).alias("in_hours"),
    )


@query(
    "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(epoch(l_shipdate) - epoch(o_orderdate)"
    " AS DOUBLE) AS seconds FROM lineitem JOIN orders ON l_orderkey = o_orderkey"
)
def ts_diff(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate"
    )
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    joined = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    gap = times.seconds_between(F.col("l_shipdate"), F.col("o_orderdate"))
    return joined.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", gap.alias("seconds"))


@query("SELECT event_id, epoch_us(ts) // 1000 AS ms FROM events")
def epoch_millis(spark, sf_dir):
    return table(spark, sf_dir, "events").select(
        "event_id", times.epoch_millis(F.col("ts")).alias("ms")
    )


@query("SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS y FROM orders")
def year_of(spark, sf_dir):
    return table(spark, sf_dir, "orders").select("o_orderkey", F.year("o_orderdate").alias("y"))


@query("SELECT o_orderkey, CAST(2018 - year(o_orderdate) AS INTEGER) AS age FROM orders")
def age_at(spark, sf_dir):
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", times.age_at(2018, F.col("o_orderdate")).alias("age")
    )


@query(
    "WITH b AS (SELECT event_type, date_trunc('hour', min(ts)) AS a, date_trunc('hour', max(ts)) AS z FROM "
    "events GROUP BY 1) SELECT event_type, '1h' AS freq, unnest(generate_series(a, z, INTERVAL 1 HOUR)) AS "
    "ts FROM b UNION ALL SELECT event_type, '2h', unnest(generate_series(a, z, INTERVAL 2 HOUR)) FROM b "
    "UNION ALL SELECT event_type, '15min', unnest(generate_series(a, z, INTERVAL 15 MINUTE)) FROM b"
)
def time_grid(spark, sf_dir):
    """Regular grids of three steps over the active span of every event type."""
    spans = (
        table(spark, sf_dir, "events")
        .groupBy("event_type")
        .agg(F.date_trunc("hour", F.min("ts")).alias("a"), F.date_trunc("hour", F.max("ts")).alias("z"))
        .withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("a", "z")})
    )
    steps = {"1h": "interval 1 hour", "2h": "interval 2 hours", "15min": "interval 15 minutes"}
    grids = F.array(
        *[
            F.struct(
                F.lit(n).alias("freq"),
                times.time_grid(F.col("a"), F.col("z"), F.expr(s)).alias("points"),
            )
            for n, s in steps.items()
        ]
    )
    return spans.select("event_type", F.inline(grids)).select(
        "event_type", "freq", F.explode("points").alias("ts")
    )


_BOUNDS = (
    "WITH p AS (SELECT DISTINCT date_trunc('hour', ts) AS t FROM events), b AS (SELECT min(t) AS t1, "
    "max(t) AS tz FROM p), s AS (SELECT t1, (SELECT min(t) FROM p WHERE t > t1) AS t2, tz FROM b) "
)


def _hours(spark, sf_dir):
    return table(spark, sf_dir, "events").select(
        F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("t")
    )


@query(_BOUNDS + "SELECT unnest(generate_series(t1, tz, t2 - t1)) AS ts FROM s")
def infer_step_grid(spark, sf_dir):
    return times.infer_step_grid(_hours(spark, sf_dir), "t", F.col("last_ts"))


@query(
    _BOUNDS + "SELECT unnest(generate_series(tz, tz + to_days(CAST(floor((epoch(tz) - epoch(t1)) / 86400) "
    "AS INTEGER)), t2 - t1)) AS ts FROM s"
)
def forecast_horizon(spark, sf_dir):
    return times.forecast_horizon(_hours(spark, sf_dir), "t")


@query(
    "SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 0 ELSE 1 END AS ongoing FROM orders"
)
def is_open_flag(spark, sf_dir):
    closed = F.when(F.col("o_orderstatus") == "F", F.col("o_orderdate"))
    return table(spark, sf_dir, "orders").select("o_orderkey", times.is_open(closed).alias("ongoing"))


# ---- lists ------------------------------------------------------------------


def _lists(spark, sf_dir):
    """Quantities of an order in line order."""
    lines = table(spark, sf_dir, "lineitem")
    entry = F.struct("l_linenumber", "l_partkey", "l_suppkey", F.col("l_quantity").cast("int").alias("q"))
    grouped = lines.groupBy("l_orderkey").agg(F.sort_array(F.collect_list(entry)).alias("e"))
    return grouped.select("l_orderkey", F.transform("e", lambda x: x["q"]).alias("a"))


_LISTS = (
    "WITH l AS (SELECT l_orderkey, list(CAST(l_quantity AS INTEGER) ORDER BY l_linenumber, l_partkey, "
    "l_suppkey, l_quantity) AS a FROM lineitem GROUP BY 1) "
)


def _list_query(name: str, sql: dict[str, str], make):
    def run(spark, sf_dir):
        made = make(F.col("a"))
        return _lists(spark, sf_dir).select("l_orderkey", *[joined(c).alias(n) for n, c in made.items()])

    run.__doc__ = f"Order quantities: {name.replace('_', ' ')}."
    columns = ", ".join(f"array_to_string({e}, ',') AS {n}" for n, e in sql.items())
    query(_LISTS + f"SELECT l_orderkey, {columns} FROM l", name=name)(run)


_list_query(
    "array_map",
    {"plus": "list_transform(a, lambda x: x + 1)", "by_index": "list_transform(a, lambda x, i: x + i - 1)"},
    lambda a: {"plus": F.transform(a, lambda x: x + 1), "by_index": F.transform(a, lambda x, i: x + i)},
)
_list_query("array_append", {"b": "list_append(a, 99)"}, lambda a: {"b": F.array_append(a, 99)})
_list_query("array_sorted", {"b": "list_sort(a)"}, lambda a: {"b": F.array_sort(a)})
_list_query("array_reverse", {"b": "list_reverse(a)"}, lambda a: {"b": F.reverse(a)})
_list_query(
    "array_count_value",
    {"b": "[len(list_filter(a, lambda x: x = 25))]"},
    lambda a: {"b": F.array(nested.count_value(a, 25))},
)
_list_query(
    "array_index",
    {"b": "CASE WHEN list_contains(a, 25) THEN [list_position(a, 25) - 1] ELSE a[1:0] END"},
    lambda a: {"b": F.array_compact(F.array(nested.index_of(a, 25)))},
)
_list_query(
    "array_remove_first",
    {
        "b": "CASE WHEN list_contains(a, 25) THEN list_concat(a[:list_position(a, 25) - 1], "
        "a[list_position(a, 25) + 1:]) ELSE a END"
    },
    lambda a: {"b": nested.remove_first(a, 25)},
)
_list_query(
    "array_insert",
    {"b": "list_concat(list_concat(a[:1], [77]), a[2:])"},
    lambda a: {"b": nested.insert_at(a, 1, 77)},
)
_list_query("array_pop", {"b": "a[2:]"}, lambda a: {"b": nested.pop_at(a, 0)})
_list_query(
    "array_extend",
    {"b": "list_concat(a, list_reverse(a))", "cleared": "a[1:0]"},
    lambda a: {"b": F.concat(a, F.reverse(a)), "cleared": F.array().cast("array<int>")},
)
_list_query("array_head", {"b": "a[1:4]"}, lambda a: {"b": F.slice(a, 1, 4)})


def _tagged(spark, sf_dir):
    return table(spark, sf_dir, "part").select("p_partkey", F.split("p_name", " ").alias("tags"))


_WORDS = "SELECT p_partkey, unnest(string_split(p_name, ' ')) AS item FROM part"


@query(f"SELECT item, count(*) AS n FROM ({_WORDS}) GROUP BY 1 ORDER BY n DESC, item LIMIT 10")
def explode_count(spark, sf_dir):
    return nested.explode_count(_tagged(spark, sf_dir), "tags", 10)


@query(
    "WITH w AS (SELECT p_partkey, unnest(string_split(p_name, ' ')) AS item, generate_subscripts("
    "string_split(p_name, ' '), 1) AS place FROM part), f AS (SELECT item, min(p_partkey * 100 + place) AS f "
    "FROM w GROUP BY 1) SELECT row_number() OVER (ORDER BY f) - 1 AS position, item FROM f"
)
def explode_vocab(spark, sf_dir):
    return nested.explode_vocab(_tagged(spark, sf_dir), "tags", "p_partkey")


@query(
    f"WITH v AS (SELECT list(item ORDER BY item) AS vocab FROM (SELECT DISTINCT item FROM ({_WORDS}))) "
    "SELECT p_partkey, array_to_string(list_transform(vocab, lambda w: CAST(list_contains(string_split("
    "p_name, ' '), w) AS INTEGER)), ',') AS bits FROM part, v"
)
def multi_hot(spark, sf_dir):
    tagged = _tagged(spark, sf_dir)
    vocabulary = nested.vocabulary_list(tagged, "tags")
    return tagged.select("p_partkey", joined(nested.multi_hot(F.col("tags"), vocabulary)).alias("bits"))


# ---- maps -------------------------------------------------------------------


def _maps(spark, sf_dir):
    """Part attributes as a map of numbers."""
    return table(spark, sf_dir, "part").select(
        "p_partkey",
        F.create_map(
            F.lit("size"), "p_size", F.lit("name"), F.length("p_name"), F.col("p_type"), F.lit(7)
        ).alias("m"),
    )


def _entries(*pairs: str) -> str:
    texts = ", ".join(f"{k} || '=' || {v}" for k, v in (p.split("=") for p in pairs))
    return f"array_to_string(list_sort([{texts}]), ',')"


def _map_out(m):
    texts = F.transform(F.map_entries(m), lambda e: F.concat_ws("=", e["key"], e["value"].cast("string")))
    return F.array_join(F.sort_array(texts), ",").alias("entries")


@query(
    "SELECT p_partkey, concat_ws(',', p_size + 1, length(p_name) + 1, 8) AS plus, 'size,name,' || p_type "
    "AS keys, " + _entries("'size'=p_size", "'name'=CAST(length(p_name) AS INTEGER)", "p_type=7")
    + " AS entries FROM part"
)
def map_values_plus(spark, sf_dir):
    m = F.col("m")
    return _maps(spark, sf_dir).select(
        "p_partkey",
        joined(F.transform(F.map_values(m), lambda v: v + 1)).alias("plus"),
        joined(F.map_keys(m)).alias("keys"),
        _map_out(m),
    )


@query(
    "SELECT p_partkey, 0 AS pos, 'size' AS key FROM part UNION ALL SELECT p_partkey, 1, 'name' FROM part "
    "UNION ALL SELECT p_partkey, 2, p_type FROM part"
)
def map_enumerate(spark, sf_dir):
    return _maps(spark, sf_dir).select("p_partkey", F.posexplode(F.map_keys("m")).alias("pos", "key"))


@query(
    "SELECT p_partkey, p_size AS size, CASE WHEN p_type = 'SMALL' THEN 7 END AS small, p_type = 'SMALL' "
    "AS has_small, p_size = 9 OR length(p_name) = 9 AS has_nine FROM part"
)
def map_get_contains(spark, sf_dir):
    m = F.col("m")
    return _maps(spark, sf_dir).select(
        "p_partkey",
        F.try_element_at(m, F.lit("size")).alias("size"),
        F.try_element_at(m, F.lit("SMALL")).alias("small"),
        F.map_contains_key(m, "SMALL").alias("has_small"),
        F.array_contains(F.map_values(m), 9).alias("has_nine"),
    )


@query(
    "SELECT p_partkey, " + _entries("'size'=100", "'name'=CAST(length(p_name) AS INTEGER)", "p_type=7",
                                    "'extra'=1") + " AS entries FROM part"
)
def map_upsert(spark, sf_dir):
    new = F.create_map(F.lit("size"), F.lit(100), F.lit("extra"), F.lit(1))
    return _maps(spark, sf_dir).select("p_partkey", _map_out(nested.map_upsert(F.col("m"), new)))


@query(
    "SELECT p_partkey, " + _entries("'name'=CAST(length(p_name) AS INTEGER)", "p_type=7")
    + " AS entries FROM part"
)
def map_delete(spark, sf_dir):
    return _maps(spark, sf_dir).select("p_partkey", _map_out(nested.map_delete(F.col("m"), "size")))


@query(
    "SELECT s_suppkey, 'name=' || s_name || CASE WHEN s_nationkey % 3 = 2 THEN ',note=n' || s_nationkey "
    "ELSE '' END AS entries FROM supplier"
)
def map_drop_empty(spark, sf_dir):
    note = F.expr(
        "case when s_nationkey % 3 = 0 then '' when s_nationkey % 3 = 2 then concat('n', s_nationkey) end"
    )
    m = F.create_map(F.lit("name"), F.col("s_name"), F.lit("note"), note)
    return table(spark, sf_dir, "supplier").select("s_suppkey", _map_out(nested.map_drop_empty(m)))


@query(
    "SELECT c_custkey, 'segment=' || c_mktsegment || ',nation=' || c_nationkey || ',name=' || c_name AS to_end, "
    "'nation=' || c_nationkey || ',name=' || c_name || ',segment=' || c_mktsegment AS to_front FROM customer"
)
def entries_move(spark, sf_dir):
    entries = F.array(
        *[
            F.struct(F.lit(k).alias("k"), F.col(c).cast("string").alias("v"))
            for k, c in (("name", "c_name"), ("segment", "c_mktsegment"), ("nation", "c_nationkey"))
        ]
    )
    shown = lambda e: joined(F.transform(e, lambda x: F.concat_ws("=", x["k"], x["v"])))
    return table(spark, sf_dir, "customer").select(
        "c_custkey",
        shown(nested.move_entry(entries, "name")).alias("to_end"),
        shown(nested.move_entry(entries, "nation", last=False)).alias("to_front"),
    )


# ---- JSON -------------------------------------------------------------------


@query("SELECT p_partkey, replace(p_name, ' ', ',') AS names FROM part")
def json_names(spark, sf_dir):
    tags = F.transform(
        F.split("p_name", " "), lambda w, i: F.struct(i.alias("id"), w.alias("name"))
    )
    text = table(spark, sf_dir, "part").select("p_partkey", F.to_json(tags).alias("j"))
    return text.select("p_partkey", joined(nested.json_names(F.col("j"))).alias("names"))


@query(
    "SELECT p_partkey, CASE WHEN p_size <= 40 THEN p_brand ELSE '' END AS director FROM part"
)
def json_pick_first(spark, sf_dir):
    crew = F.array(
        F.struct(F.lit("Editor").alias("job"), F.col("p_type").alias("name")),
        F.struct(
            F.when(F.col("p_size") <= 40, "Director").otherwise("Writer").alias("job"),
            F.col("p_brand").alias("name"),
        ),
        F.struct(F.when(F.col("p_size") <= 40, "Director").otherwise("Cook").alias("job"),
                 F.col("p_name").alias("name")),
    )
    text = table(spark, sf_dir, "part").select("p_partkey", F.to_json(crew).alias("j"))
    return text.select("p_partkey", nested.json_pick_first(F.col("j")).alias("director"))
