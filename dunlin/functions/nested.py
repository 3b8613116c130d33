"""Lists, maps and JSON arrays inside a row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

NAMED = "array<struct<name string>>"
CREW = "array<struct<job string, name string>>"


def count_value(a: Column, value) -> Column:
    return F.size(F.filter(a, lambda x: x == value))


def index_of(a: Column, value) -> Column:
    """0-based first position; null if absent."""
    at = F.array_position(a, value)
    return F.when(at > 0, at - 1)


def remove_first(a: Column, value) -> Column:
    """Without the first occurrence of ``value``; unchanged if absent."""
    at = F.array_position(a, value).cast("int")
    return F.when(at > 0, pop_at(a, at - 1)).otherwise(a)


def insert_at(a: Column, position: int, value) -> Column:
    return F.array_insert(a, position + 1, value)


def pop_at(a: Column, position) -> Column:
    """Without the element at the 0-based position."""
    position = position if isinstance(position, Column) else F.lit(position)
    return F.concat(F.slice(a, F.lit(1), position), F.slice(a, position + 2, F.size(a)))


def map_upsert(m: Column, new: Column) -> Column:
    """Entries of ``new`` replace or extend those of ``m``, whatever the dedup policy."""
    kept = F.map_filter(m, lambda k, _: ~F.map_contains_key(new, k))
    return F.map_concat(kept, new)


def map_delete(m: Column, key) -> Column:
    return F.map_filter(m, lambda k, _: k != key)


def map_drop_empty(m: Column) -> Column:
    return F.map_filter(m, lambda _, v: v.isNotNull() & (v != ""))


def move_entry(entries: Column, key, last: bool = True) -> Column:
    """Move the entry of ``key`` of an ``array<struct<k, v>>`` to the end or the front."""
    hit = F.filter(entries, lambda e: e["k"] == key)
    rest = F.filter(entries, lambda e: e["k"] != key)
    return F.concat(rest, hit) if last else F.concat(hit, rest)


def json_names(c: Column) -> Column:
    return F.transform(F.from_json(c, NAMED), lambda x: x["name"])


def json_pick_first(c: Column, job: str = "Director") -> Column:
    """Name of the first member with the job; empty text if there is none."""
    hits = F.filter(F.from_json(c, CREW), lambda x: x["job"] == job)
    return F.coalesce(F.try_element_at(hits, F.lit(1))["name"], F.lit(""))


def explode_count(df: DataFrame, items: str, k: int) -> DataFrame:
    """The ``k`` most frequent list items ``(item, n)``."""
    counts = df.select(F.explode(items).alias("item")).groupBy("item").agg(F.count("*").alias("n"))
    return counts.orderBy(F.desc("n"), "item").limit(k)


def explode_vocab(df: DataFrame, items: str, row_id: str) -> DataFrame:
    """List items in the order they are first seen: ``(position, item)``.

    The minimum of (row, place in list) is an aggregate, so a frequent item is
    reduced before the shuffle.
    """
    from dunlin.operators.ordering import ranked

    places = df.select(row_id, F.posexplode(items).alias("place", "item"))
    firsts = places.groupBy("item").agg(F.min(F.struct(row_id, "place")).alias("f"))
    flat = firsts.select("item", F.col(f"f.{row_id}").alias("__row"), F.col("f.place").alias("__at"))
    return ranked(flat, ["__row", "__at"], name="position").select("position", "item")


def vocabulary_list(df: DataFrame, items: str, limit: int = 10_000) -> list:
    """Sorted distinct list items, refused if there are more than ``limit``."""
    words = df.select(F.explode(items).alias("item")).distinct().limit(limit + 1).collect()
    if len(words) > limit:
        raise ValueError(f"more than {limit} words: keep the token lists instead of dense 0/1 lists")
    return sorted(r["item"] for r in words)


def multi_hot(items: Column, vocabulary: list) -> Column:
    """0/1 list over a vocabulary whose size ``vocabulary_list`` has checked."""
    return F.transform(F.lit(vocabulary), lambda w: F.array_contains(items, w).cast("int"))
