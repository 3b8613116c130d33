"""Preparing a training corpus: five stages over ``documents``, each written before the next."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dunlin.llm.bpe import decode_ids, encode_texts
from dunlin.llm.mixing import mix_schedule, token_count
from dunlin.llm.ngram_join import ngram_jaccard_components
from dunlin.llm.quality_classifier import fit_quality, score_quality
from dunlin.llm.quality_rules import passing_rows
from dunlin.llm.queries import LEAST_SCORE, public_codec
from dunlin.operators.joins import lookup_join
from dunlin.session import materialize

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def keep_by_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules.

    Each row is judged by its own text: a null or empty one is rejected, repeated rows and rows
    without id are kept or rejected alike. No rows give no rows; further columns are dropped.
    """
    return passing_rows(docs, COLUMNS)


def keep_by_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that their labelled neighbours call good.

    Each row is scored by its own text, null and empty ones too; without any usable label all
    are kept. Repeated rows and rows without id count like others.
    """
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = fit_quality(docs, labels)
    return score_quality(docs.select(*COLUMNS), model).where(F.col("score") >= LEAST_SCORE).select(*COLUMNS)


def keep_one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each component, that of smallest id (rows without id come last).

    Rows are told apart by their place in the input, not by ``doc_id``: different texts of one id
    and rows without id are documents like others. A text without words is linked with
    nothing, so all such rows stay. Of equal rows that have words one stays.
    """
    placed = docs.select(*COLUMNS, F.monotonically_increasing_id().alias("row"))  # files and their splits stay as they are
    found = ngram_jaccard_components(placed, "row").select(F.col("id").alias("row"), "component_id")
    named = found.join(placed.select("row", "doc_id"), "row")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row")).getField("row")
    stay = named.groupBy("component_id").agg(first.alias("row")).select("row")
    return placed.join(materialize(stay, "stay"), "row", "left_semi").select(*COLUMNS)


def with_own_key(docs: DataFrame) -> DataFrame:
    """``docs`` with ``copy``, null where ``doc_id`` names one row, else a number of the row's own."""
    repeated = docs.groupBy("doc_id").count().where("count > 1").select("doc_id", F.lit(True).alias("again"))
    numbered = docs.select(*COLUMNS, F.monotonically_increasing_id().alias("row"))
    marked = lookup_join(numbered, repeated.where("doc_id is not null"), ["doc_id"], "left")
    own = F.when(F.col("doc_id").isNull() | F.col("again"), F.col("row"))
    return marked.select(*COLUMNS, own.alias("copy"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in the order of the mix, as often as it reads them: repeated, or left out.

    A document stands where the slots have its first token; files and their rows are in
    order of the slots. The mix reads a source over and over up to its target, so only the
    document at the target is read in part; it counts if at least half of it is. Texts without
    words are never read, so null and empty ones leave. Rows that share an id, and rows
    without one, are read as rows of their own. A null source is a source like others.
    """
    keyed = with_own_key(docs)
    pieces = mix_schedule(keyed, token_count(F.col("text")), keep=("doc_id", "copy"))
    begun = pieces.where("doc_from = 0 and 2 * read >= size")
    begun = begun.select(F.struct("doc_id", "copy").alias("key"), "slot", "block_from")
    rows = keyed.select(*COLUMNS, F.struct("doc_id", "copy").alias("key"))
    return rows.join(begun, "key").orderBy("slot", "block_from").select(*COLUMNS)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document of the mix, and whether they decode to its text.

    A null text has no tokens and counts as empty; every row is encoded, repeated or without id.
    """
    codec = public_codec(spark)
    text = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    named = docs.select("text", F.struct("doc_id", F.sha2(text, 256).alias("sha256")).alias("name"))
    # Written in between, so that the workers that encoded also decode: a task needs one, with one vocabulary.
    back = decode_ids(materialize(encode_texts(named, codec, "name"), "ids"), codec)
    return back.select(
        F.col("id.doc_id").alias("doc_id"),
        F.size("ids").cast("long").alias("n_tokens"),
        "ids",
        (F.sha2("decoded", 256) == F.col("id.sha256")).alias("exact"),
    )


STAGES = [
    ("quality_rules", keep_by_rules),
    ("quality_classifier", keep_by_classifier),
    ("ngram_jaccard_join", keep_one_of_near_copies),
    ("mix_sources", mix),
    ("byte_bpe", tokenize),
]

# The classifier, the near copies and the tokens are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
