"""Text column expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def remove_spaces(c: Column) -> Column:
    return F.replace(c, F.lit(" "), F.lit(""))


def keep_word_chars(c: Column) -> Column:
    """Drop all but letters, digits and underscore, in any script."""
    return F.regexp_replace(c, r"[^\p{L}\p{N}_]", "")


def remove_chars(c: Column, chars: str) -> Column:
    return F.translate(c, chars, "")


def before(c: Column, separator: str) -> Column:
    """Text before the first separator; the whole text if it is absent."""
    return F.substring_index(c, separator, 1)


def after(c: Column, separator: str) -> Column:
    """Text after the first separator; empty if it is absent."""
    at = F.instr(c, separator)
    rest = F.substring(c, at + len(separator), F.length(c))
    return F.when(at > 0, rest).when(c.isNotNull(), F.lit(""))


def sorted_chars(c: Column) -> Column:
    return F.when(c == "", F.array().cast("array<string>")).otherwise(F.array_sort(F.split(c, "")))


def sorted_run_length(c: Column) -> Column:
    """Upper-cased word characters in order, each followed by its count if above 1."""
    chars = sorted_chars(keep_word_chars(F.upper(c)))

    def run(ch: Column) -> Column:
        n = F.size(F.filter(chars, lambda x: x == ch))
        return F.concat(ch, F.when(n > 1, n.cast("string")).otherwise(""))

    return F.when(
        c.isNotNull(), F.concat_ws("", F.transform(F.array_distinct(chars), run))
    )


def strip_split(c: Column) -> Column:
    """Items of a bracketed list text, without quotes and spaces."""
    inner = F.btrim(c, F.lit("[]"))
    return F.split(F.translate(inner, "'\" ", ""), ",")


def value_of(c: Column, key: str) -> Column:
    """Value of the last ``key:value`` element of a comma list; null if there is none."""
    hits = F.filter(F.split(c, ","), lambda x: x.contains(key))
    return after(F.try_element_at(hits, F.lit(-1)), ":")


def ids_of(c: Column, key: str, drop: str = '"}] ') -> Column:
    """Values of all ``key`` elements of a JSON-like list, in order."""
    hits = F.filter(F.split(c, ","), lambda x: x.contains(key))
    return F.transform(hits, lambda x: F.translate(after(x, ":"), drop, ""))


def first_id(c: Column, key: str) -> Column:
    return F.try_element_at(ids_of(c, key), F.lit(1))


def all_ids(c: Column, key: str) -> Column:
    """Comma-joined values of all ``key`` elements; null if there is none."""
    ids = ids_of(c, key)
    return F.when(F.size(ids) > 0, F.concat_ws(",", ids))


def incident_columns(target: str, technique: str) -> dict[str, Column]:
    """Host address, host name and technique ids parsed from two text columns, row by row."""
    return {
        "hostIpAddr": value_of(F.col(target), "hostIpAddr"),
        "hostName": value_of(F.col(target), "hostName"),
        "techniqueid": all_ids(F.col(technique), "techniqueid"),
    }


def null_to_empty(c: Column) -> Column:
    return F.coalesce(c.cast("string"), F.lit(""))


def text_list(words: Sequence[str]) -> Column:
    return F.array(*[F.lit(w) for w in words])
