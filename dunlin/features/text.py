"""Stop words, token counts and TF-IDF in long form ``(row, term, weight)``."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dunlin.operators.joins import lookup_join
from dunlin.session import materialize, shuffle_width

TASK_BYTES = 4 << 20  # bytes of text whose tokens one task counts
TOKEN = r"[\p{L}\p{N}_]{2,}"  # runs of two or more word characters

# Default stop words, replaceable by a parameter everywhere.
STOP_WORDS = (
    "a about above after again all am an and any are as at be because been before being below "
    "between both but by can did do does doing down during each few for from further had has have "
    "having he her here hers him his how i if in into is it its just me more most my no nor not now "
    "of off on once only or other our out over own same she so some such than that the their them "
    "then there these they this those through to too under until up very was we were what when where "
    "which while who whom why will with you your"
).split()


def remove_stopwords(c: Column, words: Sequence[str] = STOP_WORDS) -> Column:
    """Text without its stop words; words are parted by blanks."""
    kept = F.filter(F.split(c, " "), lambda w: ~F.lower(w).isin(list(words)))
    return F.array_join(kept, " ")


def stopwords_found(c: Column, words: Sequence[str] = STOP_WORDS) -> Column:
    """The different stop words of a text, sorted."""
    lowered = F.transform(F.split(c, " "), lambda w: F.lower(w))
    return F.array_sort(F.array_intersect(lowered, F.lit(list(words))))


def noise_share(c: Column) -> Column:
    """Share of characters that are neither letter, digit nor white space."""
    noise = F.length(F.regexp_replace(c, r"[\p{L}\p{N}\s]", ""))
    return F.when(F.length(c) > 0, noise / F.length(c)).otherwise(0.0)


def tokens(c: Column) -> Column:
    return F.regexp_extract_all(F.lower(c), F.lit(TOKEN), F.lit(0))


def bag_of_words(
    df: DataFrame, row_id: str, text: str, words: Sequence[str] = STOP_WORDS
) -> DataFrame:
    """Rows ``(row_id, term, n)``.

    Texts are placed by row id before they are cut into tokens, so counting,
    and a later norm per row, need no second shuffle. Tasks grow in number with
    the bytes of the texts, not in size.
    """
    size = df.agg(F.sum(F.octet_length(text))).first()[0] or 0
    tasks = max(shuffle_width(df.sparkSession), math.ceil(size / TASK_BYTES))
    placed = df.select(row_id, text).repartition(tasks, row_id)
    terms = placed.select(row_id, F.explode(tokens(F.col(text))).alias("term"))
    if words:
        terms = terms.where(~F.col("term").isin(list(words)))
    return terms.groupBy(row_id, "term").agg(F.count("*").alias("n"))


def fit_idf(bags: DataFrame, n_rows: int) -> DataFrame:
    """Rows ``(term, idf)`` with idf = ln((1 + n) / (1 + df)) + 1."""
    found = bags.groupBy("term").agg(F.count("*").alias("df"))
    return found.select("term", (F.log(F.lit(1.0 + n_rows) / (F.col("df") + 1)) + 1).alias("idf"))


def apply_idf(bags: DataFrame, idf: DataFrame, row_id: str) -> DataFrame:
    """Rows ``(row_id, term, tfidf)`` with unit length per row; unknown terms are left out."""
    weighted = lookup_join(bags, idf, ["term"]).withColumn("w", F.col("n") * F.col("idf"))
    length = F.sqrt(F.sum(F.col("w") * F.col("w")).over(Window.partitionBy(row_id)))
    return weighted.select(row_id, "term", (F.col("w") / length).alias("tfidf"))


def tfidf(df: DataFrame, row_id: str, text: str, words: Sequence[str] = STOP_WORDS) -> DataFrame:
    bags = materialize(bag_of_words(df, row_id, text, words), "bags")
    return apply_idf(bags, fit_idf(bags, df.count()), row_id)


def token_frequency(
    df: DataFrame, text: str, k: int = 2000, words: Sequence[str] = STOP_WORDS
) -> DataFrame:
    """The ``k`` most frequent tokens ``(term, n)``."""
    terms = df.select(F.explode(tokens(F.col(text))).alias("term"))
    kept = terms.where(~F.col("term").isin(list(words)))
    counts = kept.groupBy("term").agg(F.count("*").alias("n"))
    return counts.orderBy(F.desc("n"), "term").limit(k)
