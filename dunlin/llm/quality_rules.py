"""Rule-based quality filter: a table of thresholds compiled into Spark columns.

Only built-in functions run. The expressions of one row look at that row alone, so
nothing is shuffled, however the rows are spread.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPACE = r"\x20\x09-\x0D"

# Frequent function words of the four languages of the corpus.
STOP_WORDS = (
    "the be to of and that have with for a in is it was on are as by at from this or an "
    "der die das und in zu den von ist mit für im dem nicht ein eine des auf "
    "le la les de des et un une que qui en du dans est pour sur au par il "
    "el los las y que en un una por con para es se del al lo no"
).split()

# (measure, least, most): a text outside one of the ranges is rejected. None is no limit.
RULES = (
    ("word_length", 2.5, 9.0),
    ("symbol_share", None, 0.05),
    ("dup_line_share", None, 0.5),
    ("stop_word_share", 0.02, None),
    ("capital_share", None, 0.5),
)


def words_of(text: Column) -> Column:
    """Runs of characters other than space and \\x09-\\x0D."""
    return F.filter(F.split(text, f"[{SPACE}]+"), lambda w: w != "")


def _repeat_words(windows: Column) -> Column:
    """Words covered by 3-word windows that occur twice, from windows sorted by content.

    ``windows`` is a sorted array of (hash, position); a neighbour of equal hash
    marks a repeated window. A run of marked positions covers its gaps up to 3.
    """
    last = F.size(windows) - 1

    def repeated(w: Column, i: Column) -> Column:
        before = F.get(windows, i - 1).getField("h").eqNullSafe(w.getField("h"))
        after = (i < last) & F.get(windows, i + 1).getField("h").eqNullSafe(w.getField("h"))
        return before | after

    return F.array_sort(F.transform(F.filter(windows, repeated), lambda w: w.getField("i")))


def measures(docs: DataFrame, text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """Columns ``keep`` and the measures of each text.

    ``n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words`` are longs, the
    shares doubles. Columns other than ``keep`` are dropped.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    kept = F.struct(*[F.col(c) for c in keep]) if keep else F.lit(1)
    # Helper names are only met with each other: what is kept travels in one struct.
    base = docs.select(kept.alias("kept"), text.alias("text")).withColumn("words", words_of(F.col("text")))
    lines = F.filter(F.split("text", "\n"), lambda line: line.rlike(f"[^{SPACE}]"))
    n = F.size("words")
    window = F.transform(
        F.sequence(F.lit(0), n - 3),
        lambda i: F.struct(
            F.xxhash64(F.get("words", i), F.get("words", i + 1), F.get("words", i + 2)).alias("h"), i.alias("i")
        ),
    )
    counted = base.select(
        "kept",
        n.cast("long").alias("n_words"),
        F.length(F.regexp_replace("text", f"[{SPACE}]+", "")).cast("long").alias("word_chars"),
        (F.length("text") - F.length(F.translate("text", "#*$%&|<>", ""))).cast("long").alias("n_symbols"),
        F.size(F.filter("words", lambda w: F.lower(w).isin(STOP_WORDS))).alias("stops"),
        F.length(F.regexp_replace("text", r"[^\p{Lu}]+", "")).alias("capitals"),
        lines.alias("lines"),
        F.when(n >= 3, F.array_sort(window)).alias("windows"),
    )
    marked = counted.withColumn("starts", _repeat_words(F.col("windows")))
    covered = F.aggregate(
        "starts",
        F.struct(F.lit(0).cast("long").alias("sum"), F.lit(-3).alias("last")),
        lambda acc, i: F.struct(
            (acc.getField("sum") + F.least(F.lit(3), i - acc.getField("last"))).alias("sum"), i.alias("last")
        ),
        lambda acc: acc.getField("sum"),
    )
    found = marked.select(
        "*",
        F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words"),
        F.size("lines").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
    )

    def share(part: str, whole: str) -> Column:
        return F.when(F.col(whole) > 0, F.col(part) / F.col(whole)).otherwise(0.0)

    return found.select(
        *[F.col("kept").getField(c).alias(c) for c in keep],
        "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        share("word_chars", "n_words").alias("word_length"),
        share("n_symbols", "word_chars").alias("symbol_share"),
        share("n_dup_lines", "n_lines").alias("dup_line_share"),
        share("stops", "n_words").alias("stop_word_share"),
        share("capitals", "word_chars").alias("capital_share"),
    )


def compile_rules(rules=RULES) -> Column:
    """One boolean column: every measure is inside its range."""
    verdict = F.lit(True)
    for measure, least, most in rules:
        if least is not None:
            verdict &= F.col(measure) >= least
        if most is not None:
            verdict &= F.col(measure) <= most
    return verdict


def quality_rules(
    docs: DataFrame, text_col: str = "text", keep: tuple[str, ...] = (), rules=RULES, least_words: int = 50
) -> DataFrame:
    """Columns ``keep``, the measures, ``base_failed`` and ``kept`` for each row of ``docs``.

    ``base_failed``: fewer than ``least_words`` words, or more than half of the words in
    repeated 3-word windows. ``kept``: not so, and inside every range of ``rules``.

    A null text counts as empty: 0 words, all measures 0, failed. Repeated rows are judged
    one by one and give equal rows. An empty table gives no rows. Columns not named in
    ``keep`` are dropped, so their names cannot clash; ``keep`` must not name a measure.
    """
    failed = (F.col("n_words") < least_words) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    judged = measures(docs, text_col, keep).withColumn("base_failed", failed)
    return judged.withColumn("kept", ~F.col("base_failed") & compile_rules(rules))


def passing_rows(
    docs: DataFrame, columns: tuple[str, ...], text_col: str = "text", rules=RULES, least_words: int = 50
) -> DataFrame:
    """The ``columns`` of the rows that ``quality_rules`` keeps.

    A filter on ``kept`` would be pushed below the projections and repeat their expressions
    inside each other. An outer generator stops that: it gives the row or null.
    """
    judged = quality_rules(docs, text_col, columns, rules, least_words)
    row = F.filter(F.array(F.struct(*columns)), lambda _: F.col("kept"))
    rows = judged.select(F.explode_outer(row).alias("row")).where("row is not null")
    return rows.select(*[F.col("row").getField(c).alias(c) for c in columns])
