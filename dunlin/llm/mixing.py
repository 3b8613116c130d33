"""Mixing sources to target weights by a low-discrepancy schedule, in Spark columns only.

The mix is a row of slots. Slot ``i`` has the point ``frac(i * golden ratio)``, which falls
into the source whose share of the cumulative targets covers it. The slots of a source are
ranked, and slot rank ``r`` takes block ``r`` of the source: its documents in shuffled order,
read as often as its target asks, cut into blocks of equal token counts.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dunlin.session import materialize

WEIGHTS = (5.0, 2.0, 1.0)
BLOCK_TOKENS = 4096
MOST_REPEATS = 3
BUCKET_ROWS = 4096  # rows whose running sum is made in one window
SLOT_BUCKET = 65536

# Fixed value: 2 ** 32 divided by the golden ratio, odd.
_GOLDEN = 2654435769


def running_start(
    df: DataFrame, group: Sequence[str], bucket: str, order: Sequence[str], size: str, name: str
) -> DataFrame:
    """Add the sum of ``size`` over the earlier rows of the group.

    Rows are in order of ``bucket``, then ``order``. A group of any length is cut into
    its buckets: each is summed, the sums are run over, and only the rows of one bucket
    meet in one window.
    """
    keys = [*group, bucket]
    sums = df.groupBy(*keys).agg(F.sum(size).alias("__sum"))
    earlier = Window.partitionBy(*group).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.withColumn("__base", F.coalesce(F.sum("__sum").over(earlier), F.lit(0))).drop("__sum")
    inside = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    part = df.withColumn("__part", F.coalesce(F.sum(size).over(inside), F.lit(0)))
    return part.join(sums, keys).withColumn(name, F.col("__base") + F.col("__part")).drop("__base", "__part")


def source_targets(
    sources: DataFrame, weights: Sequence[float] = WEIGHTS, most_repeats: int = MOST_REPEATS
) -> DataFrame:
    """Add ``target`` to rows ``(source, source_size)``, one per source.

    Sources in order of code points, null last, get the weights in turn and share the sum
    of all sizes. A share above ``most_repeats`` times the source's size stops there, and
    what is over is shared again by weight among the others, until none is above.
    """
    # The order is needed for the turn of weights only: count the sources before in ranges.
    ordered = materialize(
        sources.withColumns({"__null": F.col("source").isNull().cast("int"), "__name": F.coalesce("source", F.lit(""))})
        .repartitionByRange("__null", "__name")
        .sortWithinPartitions("__null", "__name")
        .withColumn("__at", F.monotonically_increasing_id()),
        "mix-sources",
    ).withColumn("__p", F.shiftrightunsigned("__at", 33))
    parts = ordered.groupBy("__p").agg(F.count("*").alias("n"), F.min("__at").alias("first"))
    before = Window.orderBy("__p").rowsBetween(Window.unboundedPreceding, -1)  # a row per partition
    parts = parts.withColumn("start", F.coalesce(F.sum("n").over(before), F.lit(0)))
    turn = F.pmod(F.col("start") + F.col("__at") - F.col("first"), F.lit(len(weights))).cast("int")
    placed = ordered.join(F.broadcast(parts.drop("n")), "__p").select(
        "source",
        "source_size",
        F.get(F.array(*[F.lit(float(w)) for w in weights]), turn).alias("weight"),
        (F.col("source_size") * most_repeats).cast("double").alias("cap"),
    )
    placed = materialize(placed, "mix-weights")
    total = placed.agg(F.sum("source_size").cast("double")).first()[0] or 0.0
    # Two numbers per round come to the driver: what the capped take, what the others weigh.
    level = 0.0
    while True:
        capped = F.col("weight") * level > F.col("cap")
        taken, left = placed.agg(
            F.sum(F.when(capped, F.col("cap")).otherwise(0.0)), F.sum(F.when(capped, 0.0).otherwise(F.col("weight")))
        ).first()
        if not left:
            break
        raised = (total - taken) / left
        if raised <= level * (1 + 1e-12):  # sums of doubles may differ in the last place
            break
        level = raised
    target = F.when(F.col("weight") * level > F.col("cap"), F.col("cap")).otherwise(F.col("weight") * level)
    return placed.select("source", "source_size", target.alias("target"))


def slot_schedule(spark, blocks: DataFrame, slots: int) -> DataFrame:
    """Rows ``(slot, sid, block)``: which block of which source each slot takes.

    ``blocks`` has ``sid, share_from, share_to, n_blocks``: the source's part of [0, 1) and
    how many blocks it needs, ``slots`` in all. A source's points past ``n_blocks`` leave
    their slots to the sources with too few points. Then the slots of a source are ranked:
    each of the ``slots`` slots takes one block, and a source's blocks come in order.
    """
    cells = max(1, min(slots, 1 << 20))
    # A point and the shares meet in cells, so no slot is compared with all sources.
    low = F.floor(F.col("share_from") * cells).cast("long")
    high = F.least(F.floor(F.col("share_to") * cells), F.lit(cells - 1)).cast("long")
    ranges = blocks.where("n_blocks > 0").withColumn("cell", F.explode(F.sequence(low, F.greatest(low, high))))
    point = F.pmod(F.pmod(F.col("id"), F.lit(1 << 31)) * F.lit(_GOLDEN), F.lit(1 << 32)) / F.lit(float(1 << 32))
    points = spark.range(slots).select(F.col("id").alias("slot"), point.alias("u"))
    points = points.withColumn("cell", F.floor(F.col("u") * cells).cast("long"))
    hit = points.join(ranges, "cell").where("u >= share_from and u < share_to").select("slot", "sid", "n_blocks")
    hit = materialize(_ranked_slots(hit), "mix-points")
    had = hit.groupBy("sid").agg(F.count("*").alias("had"))
    lacking = blocks.select("sid", "n_blocks").join(had, "sid", "left").fillna(0, ["had"]).where("had < n_blocks")
    lacking = lacking.select(
        "sid", (F.col("n_blocks") - F.col("had")).alias("lacks"), F.pmod("sid", F.lit(SLOT_BUCKET)).alias("bucket")
    )
    lacking = running_start(lacking, [], "bucket", ["sid"], "lacks", "from")
    lacking = lacking.select("sid", F.explode(F.sequence("from", F.col("from") + F.col("lacks") - 1)).alias("hole"))
    free = hit.where("block >= n_blocks").select("slot", "bucket", "one")
    free = running_start(free, [], "bucket", ["slot"], "one", "hole")
    kept = hit.where("block < n_blocks").select("slot", "sid")
    filled = kept.unionByName(free.join(lacking, "hole").select("slot", "sid"))
    return _ranked_slots(filled).select("slot", "sid", "block")


def _ranked_slots(slots: DataFrame) -> DataFrame:
    """Add ``block``, how many earlier slots the source has."""
    parts = {"bucket": F.floor(F.col("slot") / SLOT_BUCKET), "one": F.lit(1)}
    return running_start(slots.withColumns(parts), ["sid"], "bucket", ["slot"], "one", "block")


def _pieces(
    docs: DataFrame,
    size: Column,
    source_col: str,
    keep: Sequence[str],
    weights: Sequence[float],
    most_repeats: int,
    block_tokens: int,
    seed: int,
) -> tuple[DataFrame, DataFrame]:
    """Rows of size 0, and for each other row the pieces that the blocks hold of it.

    A piece has the ``slot`` of its block; a row that no block reads has one without a slot.
    """
    spark = docs.sparkSession
    kept = F.struct(*[F.col(c) for c in keep]) if keep else F.struct(F.lit(1))
    rows = docs.select(
        kept.alias("kept"), F.col(source_col).cast("string").alias("source"), F.coalesce(size, F.lit(0)).cast("long").alias("size")
    )
    rows = rows.withColumn("mix", F.xxhash64(F.lit(seed), "kept", "source", "size"))
    rows = materialize(rows, "mix-rows")  # sizes without texts
    sources = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    sources = materialize(source_targets(sources, weights, most_repeats), "mix-targets")
    # A source's number stands for its name in what follows.
    sources = sources.withColumns(
        {"sid": F.xxhash64(F.col("source").isNull(), F.coalesce("source", F.lit(""))), "take": F.floor("target")}
    )
    sources = materialize(sources.withColumn("n_blocks", F.ceil(F.col("take") / block_tokens).cast("long")), "mix-sids")
    slots = sources.agg(F.sum("n_blocks")).first()[0] or 0
    buckets = max(1, rows.count() // BUCKET_ROWS)
    bucket = F.pmod(F.shiftrightunsigned("mix", 20), F.lit(buckets))
    sid = F.xxhash64(F.col("source").isNull(), F.coalesce("source", F.lit("")))
    some = rows.where("size > 0").select("kept", sid.alias("sid"), "size", "mix", bucket.alias("bucket"))
    placed = running_start(some, ["sid"], "bucket", ["mix", "kept"], "size", "start")
    plan = sources.select("sid", "source", "source_size", "target", "take")
    # Each source is one row: hot sources are split by the bucket of the row.
    placed = _with_source(placed, plan, buckets)
    # The row's places in the source read over and over: one per repeat that begins early enough.
    last = F.floor((F.col("take") - 1 - F.col("start")) / F.col("source_size"))
    turns = F.when(F.col("take") > F.col("start"), F.sequence(F.lit(0).cast("long"), last))
    read = placed.withColumn("turn", F.explode_outer(turns))
    begin = F.col("start") + F.col("turn") * F.col("source_size")
    read = read.withColumns({"begin": begin, "end": F.least(begin + F.col("size"), F.col("take"))})
    first, stop = F.floor(F.col("begin") / block_tokens), F.floor((F.col("end") - 1) / block_tokens)
    pieces = read.withColumn("block", F.explode_outer(F.when(F.col("turn").isNotNull(), F.sequence(first, stop))))
    at = F.col("block") * block_tokens
    low, high = F.greatest("begin", at), F.least("end", at + block_tokens)
    pieces = pieces.withColumns({"block_from": low - at, "block_to": high - at, "doc_from": low - F.col("begin")})
    # Sources lie on [0, 1) in order of code points, so that slots do not depend on partitions.
    shares = sources.withColumns({"__null": F.col("source").isNull().cast("int"), "__name": F.coalesce("source", F.lit(""))})
    shares = shares.repartitionByRange("__null", "__name").sortWithinPartitions("__null", "__name")
    shares = shares.withColumn("__at", F.monotonically_increasing_id()).select("sid", "n_blocks", "__at")
    shares = materialize(shares, "mix-shares").withColumn("__p", F.shiftrightunsigned("__at", 33))
    weights_to = Window.orderBy("__p").rowsBetween(Window.unboundedPreceding, -1)
    parts = shares.groupBy("__p").agg(F.sum("n_blocks").alias("n"))
    parts = parts.withColumn("start", F.coalesce(F.sum("n").over(weights_to), F.lit(0))).drop("n")
    inside = Window.partitionBy("__p").orderBy("__at").rowsBetween(Window.unboundedPreceding, -1)
    start = F.col("start") + F.coalesce(F.sum("n_blocks").over(inside), F.lit(0))
    shares = shares.join(F.broadcast(parts), "__p").withColumn("from", start)  # a row per partition
    shares = shares.select(
        "sid",
        "n_blocks",
        (F.col("from") / max(slots, 1)).alias("share_from"),
        ((F.col("from") + F.col("n_blocks")) / max(slots, 1)).alias("share_to"),
    )
    schedule = slot_schedule(spark, materialize(shares, "mix-ranges"), slots)
    rest = rows.where("size = 0").select("kept", sid.alias("sid"), "size", bucket.alias("bucket"))
    return _with_source(rest, plan, buckets), pieces.join(schedule, ["sid", "block"], "left")


def mix_schedule(
    docs: DataFrame,
    size: Column,
    source_col: str = "source",
    keep: Sequence[str] = (),
    weights: Sequence[float] = WEIGHTS,
    most_repeats: int = MOST_REPEATS,
    block_tokens: int = BLOCK_TOKENS,
    seed: int = 42,
) -> DataFrame:
    """The mix itself: ``keep``, ``source, size, slot, block, block_from, block_to, doc_from, turn, read``.

    A row is a piece of a row of ``docs``: tokens ``block_from`` to before ``block_to`` of the
    source's block, which the slot takes, are the document's from ``doc_from`` on. Slots count
    from 0 without gaps; the stream is the pieces in order of ``slot``, ``block_from``.
    ``turn`` numbers the readings of the document, each with a piece of ``doc_from`` 0;
    ``read`` is how many of its tokens that reading has. The rest is as in ``mix_sources``;
    ``keep`` must not name an output column.
    """
    _, pieces = _pieces(docs, size, source_col, keep, weights, most_repeats, block_tokens, seed)
    columns = [F.col("kept").getField(c).alias(c) for c in keep]
    return pieces.where(F.col("slot").isNotNull()).select(
        *columns, "source", "size", "slot", "block", "block_from", "block_to", "doc_from", "turn",
        (F.col("end") - F.col("begin")).alias("read"),
    )


def mix_sources(
    docs: DataFrame,
    size: Column,
    source_col: str = "source",
    keep: Sequence[str] = (),
    weights: Sequence[float] = WEIGHTS,
    most_repeats: int = MOST_REPEATS,
    block_tokens: int = BLOCK_TOKENS,
    seed: int = 42,
) -> DataFrame:
    """Columns ``keep``, ``size, source_size, target, taken`` for each row of ``docs``.

    ``taken`` sums the tokens of the row in the slots of ``mix_schedule``, repeats included. The blocks
    of a source hold ``floor(target)`` tokens in all, the last one fewer than the others, so
    what a source gives misses its target by less than one token, and no row is read more
    than ``most_repeats`` times. The shuffle is a hash of ``keep``, ``source`` and the size:
    reruns agree, and ties between equal rows change nothing.

    A null source is a source of its own, last in order. Rows of size 0 or null are taken 0
    times. Repeated rows are separate rows of the shuffle. If all sizes are 0 every target is
    0. An empty table gives no rows. Columns not in ``keep`` are dropped, so they cannot
    clash; ``keep`` must not name an output column.
    """
    rest, pieces = _pieces(docs, size, source_col, keep, weights, most_repeats, block_tokens, seed)
    tokens = F.when(F.col("slot").isNotNull(), F.col("block_to") - F.col("block_from"))
    taken = F.coalesce(F.sum(tokens), F.lit(0)).cast("long")
    columns = [F.col("kept").getField(c).alias(c) for c in keep]
    out = pieces.groupBy("kept", "sid", "size", "start", "source_size", "target").agg(taken.alias("taken"))
    out = out.select(*columns, "size", "source_size", "target", "taken")
    rest = rest.select(*columns, "size", "source_size", "target", F.lit(0).cast("long").alias("taken"))
    return out.unionByName(rest)


def _with_source(rows: DataFrame, plan: DataFrame, buckets: int, parts: int = 64) -> DataFrame:
    """Join the source's row; a source's rows are spread over ``parts`` by their bucket."""
    parts = max(1, min(parts, buckets))
    spread = plan.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
    return rows.withColumn("part", F.pmod("bucket", F.lit(parts)).cast("int")).join(spread, ["sid", "part"]).drop("part")


def token_count(text: Column) -> Column:
    """Number of runs of characters other than space and \\x09-\\x0D; 0 for null."""
    flat = F.trim(F.regexp_replace(text, r"[\x20\x09-\x0D]+", " "))
    spaces = F.length(flat) - F.length(F.replace(flat, F.lit(" "), F.lit("")))
    return F.when(F.length(flat) > 0, spaces + 1).otherwise(0).cast("long")
