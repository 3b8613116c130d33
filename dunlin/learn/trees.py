"""Classification trees grown level by level from histograms, all trees of a job together.

A tree is a *fit*: a bag, a target, a fold, or any other choice of rows and labels. One
aggregate per level counts classes by (fit, node, feature, bin) for every fit at once, so
bags times depth jobs become depth jobs. Trees are tables, one row per node; the driver
sees only whether nodes are left to split.

Features are cut into bins first: one per value where a feature has few, else at quantiles.
Categories are ordered by their code and cut the same way, so their number has no bound.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dunlin.features.encoding import categories, ordinal_encode
from dunlin.operators.draws import first_drawn
from dunlin.operators.joins import lookup_join
from dunlin.operators.ordering import exact_quantiles, hash_order
from dunlin.session import materialize, widen

BINS = 256
DEEPEST = 60  # a node's children are 2n and 2n + 1, in a long
LEVELS_PER_WRITE = 4


def bin_edges(df: DataFrame, features: Sequence[str], bins: int = BINS) -> dict[str, list[float]]:
    """Upper ends of the bins per feature: its values if at most ``bins``, else quantiles; nulls have none."""
    pairs = ", ".join(f"'{c}', nanvl(cast(`{c}` as double), null)" for c in features)
    values = df.select(F.expr(f"stack({len(features)}, {pairs}) as (column, value)"))
    values = materialize(values.where(F.col("value").isNotNull()).distinct(), "values")
    counts = {r["column"]: r["count"] for r in values.groupBy("column").count().collect()}
    few = [c for c in features if 0 < counts.get(c, 0) <= bins]
    many = [c for c in features if counts.get(c, 0) > bins]
    found: dict[str, set] = {c: set() for c in features}
    for r in values.where(F.col("column").isin(few)).collect():  # at most bins rows a feature
        found[r["column"]].add(r["value"])
    if many:
        known = df.select([F.nanvl(F.col(c).cast("double"), F.lit(None)).alias(c) for c in many])
        for r in exact_quantiles(known, many, [i / bins for i in range(1, bins)]).collect():
            found[r["column"]].add(r["value"])
    return {c: sorted(found[c]) for c in features}


def bin_of(column: str, edges: Sequence[float]) -> Column:
    """Number of edges below the value, by binary search; -1 for null and NaN."""
    x = F.nanvl(F.col(column).cast("double"), F.lit(None))
    if not edges:
        return F.when(x.isNull(), -1).otherwise(0)
    table = F.expr("array(" + ", ".join(f"double('{float(e)!r}')" for e in edges) + ")")  # one call, not one per edge
    steps = F.array(*[F.lit(1 << i) for i in reversed(range(len(edges).bit_length()))])
    below = F.aggregate(
        steps, F.lit(0), lambda at, s: F.when(F.get(table, at + s - 1) < x, at + s).otherwise(at)
    )
    return F.when(x.isNull(), -1).otherwise(below)


def grow(members: DataFrame, classes: int, max_depth: int | None = None) -> DataFrame:
    """Trees ``(fit, node, counts, feature, bin, gain)`` of rows ``(fit, y, bins)``.

    ``y`` is a class from 0, ``bins`` the array of bin numbers. A node with a ``feature`` sends
    rows with a larger bin to ``2 node + 1``, others to ``2 node``; without one it is a leaf.
    ``counts`` holds its rows by class. The split is the one with the lowest Gini impurity,
    of equal ones that of the first feature and bin; a node is split until it is pure, cannot
    be cut or lies at ``max_depth``. ``gain`` is the impurity it takes away, times rows.

    Rows without a class are left out. An empty table gives no trees.
    """
    depth = DEEPEST if max_depth is None else min(max_depth, DEEPEST)
    n = [f"n{c}" for c in range(classes)]
    counted = [F.count(F.when(F.col("y") == c, 1)).alias(n[c]) for c in range(classes)]
    members = members.where(F.col("y").isNotNull()).select("fit", F.lit(1).cast("long").alias("node"), "y", "bins")
    open_nodes = materialize(
        members.groupBy("fit", "node").agg(*counted).select("fit", "node", F.array(*n).alias("counts")), "roots"
    )
    impure = lambda counts: F.size(F.filter(counts, lambda c: c > 0)) > 1
    members = members.join(F.broadcast(open_nodes.where(impure(F.col("counts"))).select("fit")), "fit")  # a row a fit
    trees = open_nodes.where(F.lit(False)).select(
        "*", *[F.lit(None).cast(t).alias(c) for c, t in (("feature", "int"), ("bin", "int"), ("gain", "double"))]
    )
    for level in range(depth):
        if open_nodes.where(impure(F.col("counts"))).isEmpty():
            break
        splits = materialize(best_splits(members, counted, n), f"splits{level}")
        trees = trees.unionByName(
            open_nodes.join(splits.select("fit", "node", "feature", "bin", "gain"), ["fit", "node"], "left")
        )
        # Only rows of children that are still mixed go on.
        way = splits.select("fit", "node", "feature", "bin", impure(F.col("left")).alias("l"), impure(F.col("right")).alias("r"))
        over = F.get("bins", F.col("feature")) > F.col("bin")
        routed = lookup_join(members, way, ["fit", "node"]).where(F.when(over, F.col("r")).otherwise(F.col("l")))
        members = routed.select("fit", (2 * F.col("node") + over.cast("long")).alias("node"), "y", "bins")
        if level % LEVELS_PER_WRITE == LEVELS_PER_WRITE - 1:
            members = materialize(members, "members")
        sides = F.array(
            F.struct((2 * F.col("node")).alias("node"), F.col("left").alias("counts")),
            F.struct((2 * F.col("node") + 1).alias("node"), F.col("right").alias("counts")),
        )
        open_nodes = splits.select("fit", F.inline(sides))
    rest = open_nodes.select("*", *[F.lit(None).cast(trees.schema[c].dataType).alias(c) for c in ("feature", "bin", "gain")])
    return materialize(trees.unionByName(rest), "trees")


def best_splits(members: DataFrame, counted: Sequence[Column], n: Sequence[str]) -> DataFrame:
    """Best cut of every node that can be cut: ``(fit, node, feature, bin, gain, left, right)``."""
    each = members.select("fit", "node", "y", F.posexplode("bins").alias("feature", "bin"))
    hist = each.groupBy("fit", "node", "feature", "bin").agg(*counted)
    group = Window.partitionBy("fit", "node", "feature")  # a row a bin
    upto = group.orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)
    sums = hist.select(
        "fit", "node", "feature", "bin",
        F.array(*[F.sum(c).over(upto) for c in n]).alias("left"), F.array(*[F.sum(c).over(group) for c in n]).alias("whole"),
    )
    sums = sums.withColumn("right", F.zip_with("whole", "left", lambda a, b: a - b))

    def square(counts: str) -> Column:
        total = F.aggregate(counts, F.lit(0).cast("long"), lambda a, c: a + c)
        squares = F.aggregate(counts, F.lit(0.0), lambda a, c: a + c.cast("double") * c)
        return squares / total

    cuts = sums.where(F.exists("right", lambda c: c > 0)).withColumn("score", square("left") + square("right"))
    choice = F.struct("score", (-F.col("feature")).alias("f"), (-F.col("bin")).alias("b"), "left", "right", "whole")
    best = cuts.groupBy("fit", "node").agg(F.max(choice).alias("c")).select("fit", "node", "c.*")
    return best.select(
        "fit", "node", (-F.col("f")).alias("feature"), (-F.col("b")).alias("bin"),
        (F.col("score") - square("whole")).alias("gain"), "left", "right",
    )


def leaves(rows: DataFrame, trees: DataFrame) -> DataFrame:
    """Rows with ``fit`` and ``bins``, and the ``counts`` of the leaf that each reaches."""
    inner = trees.where(F.col("feature").isNotNull()).select("fit", "node", "feature", "bin")
    deepest = inner.agg(F.max("node")).first()[0] or 0
    rows = rows.withColumn("node", F.lit(1).cast("long"))
    for level in range(int(deepest).bit_length()):
        here = inner.where((F.col("node") >= 1 << level) & (F.col("node") < 1 << (level + 1)))
        over = F.get("bins", F.col("feature")) > F.col("bin")
        child = F.when(F.col("feature").isNull(), F.col("node")).otherwise(2 * F.col("node") + over.cast("long"))
        rows = lookup_join(rows, here, ["fit", "node"], "left").withColumn("node", child).drop("feature", "bin")
        if level % LEVELS_PER_WRITE == LEVELS_PER_WRITE - 1:
            rows = materialize(rows, "routed")
    return lookup_join(rows, trees.select("fit", "node", "counts"), ["fit", "node"]).drop("node")


def draw_balanced(rows: DataFrame, bags: int, seed: int = 42) -> DataFrame:
    """Of rows ``(row, target, y)`` per target and bag as many of every class as the rarest has: adds ``bag``.

    Rows are drawn without replacement by the rank of a hash of row and bag, found from counts by
    its leading bits for all bags at once: no row is moved but those at the end of a draw.
    """
    sizes = rows.groupBy("target", "y").count().groupBy("target").agg(F.min("count").alias("size"))
    mixes = F.array(*[hash_order("row", seed + bag) for bag in range(bags)])
    held = materialize(widen(rows).withColumn("mixes", mixes), "mixed")
    mixed = held.select(*rows.columns, F.posexplode("mixes").alias("bag", "mix")).join(F.broadcast(sizes), "target")  # a row a target
    return first_drawn(mixed, "mix", "row", ["target", "bag", "y"], F.col("size")).select(*rows.columns, "bag")


class OrdinalTrees:
    """Trees on numbers and ordered categories, for several targets, plain or on balanced bags.

    ``bags=None`` grows one tree per target on all rows; a number grows that many, each on a
    balanced draw, and the prediction is the class of highest mean probability, of equal ones
    the first. Categories get their place in sorted order; a null category, or one not seen
    in training, is -1. A null number lies below all others.

    ``row_id`` must be unique among the training rows and not null. Rows without a target's label do not train
    it, but are predicted. A target without any label is predicted null. An empty table to
    predict gives no rows; repeated ids there are judged row by row, other columns are kept.
    A column must not be called ``<target>_predicted``.
    """

    def __init__(self, bags: int | None = None, max_depth: int | None = None, bins: int = BINS, seed: int = 42):
        self.bags, self.max_depth, self.bins, self.seed = bags, max_depth, bins, seed

    def _numbers(self, df: DataFrame, own: Sequence[Column]) -> DataFrame:
        """``own`` columns and one number ``f0, f1, ...`` per feature."""
        rows = df.select(*own, *[F.col(c).alias(f"f{i}") for i, c in enumerate(self.features)])
        for name, codes in self.codes.items():
            rows = ordinal_encode(rows, name, "code_", codes).drop(name).withColumnRenamed("code_", name)
        return rows

    def _binned(self, df: DataFrame, own: Sequence[Column]) -> DataFrame:
        rows = self._numbers(df, own)
        names = [c for c in rows.columns if c not in self.edges]
        return rows.select(*names, F.array(*[bin_of(c, e).cast("int") for c, e in self.edges.items()]).alias("bins"))

    def fit(
        self, train: DataFrame, row_id: str, targets: Sequence[str], numeric: Sequence[str] = (), categorical: Sequence[str] = ()
    ) -> OrdinalTrees:
        self.targets, self.features = list(targets), [*numeric, *categorical]
        held = {f"f{i}": c for i, c in enumerate(self.features) if c in categorical}
        self.codes = {
            name: materialize(categories(train.select(F.col(c).alias(name)), name), "codes") for name, c in held.items()
        }
        labels = [F.col(t).alias(f"y{i}") for i, t in enumerate(self.targets)]
        rows = materialize(self._numbers(widen(train), [F.col(row_id).alias("row"), *labels]), "numbers")
        self.edges = bin_edges(rows, [f"f{i}" for i in range(len(self.features))], self.bins)
        self.classes = [
            sorted(r[0] for r in rows.where(F.col(f"y{i}").isNotNull()).select(f"y{i}").distinct().collect())
            for i in range(len(self.targets))
        ]
        code = [
            (F.array_position(F.array(*[F.lit(v) for v in own]), F.col(f"y{i}")) - 1).cast("int") if own else F.lit(None).cast("int")
            for i, own in enumerate(self.classes)
        ]
        bins = F.array(*[bin_of(c, e).cast("int") for c, e in self.edges.items()]).alias("bins")
        ready = materialize(rows.select("row", F.array(*code).alias("ys"), bins), "binned")
        if self.bags is None:
            fits = ready.select(F.posexplode("ys").alias("fit", "y"), "bins")
        else:
            again = not ready.where(F.col("row").isNotNull()).groupBy("row").count().where("count > 1").isEmpty()
            own = ["row"] if again else ["row", "bins"]  # rows of one id each stand for all of them
            melted = ready.select(*own, F.posexplode("ys").alias("target", "y")).where(F.col("y").isNotNull())
            drawn = draw_balanced(melted, self.bags, self.seed).where(F.col("row").isNotNull())
            drawn = drawn.join(ready.select("row", "bins"), "row") if again else drawn
            fits = drawn.select((F.col("target") * self.bags + F.col("bag")).alias("fit"), "y", "bins")
        fits = materialize(fits, "members")
        self.trees = grow(fits, max(1, *map(len, self.classes)), self.max_depth)
        return self

    def transform(self, df: DataFrame) -> DataFrame:
        """Input columns and ``<target>_predicted`` for every target."""
        whole = F.struct(*[F.col(c) for c in df.columns])
        rows = materialize(self._binned(df, [whole.alias("whole")]).withColumn("at", F.monotonically_increasing_id()), "binned")
        per = self.bags or 1
        every = F.explode(F.sequence(F.lit(0), F.lit(len(self.targets) * per - 1))).alias("fit")
        routed = leaves(rows.select("at", "bins", every), self.trees)
        total = F.aggregate("counts", F.lit(0).cast("long"), lambda a, c: a + c)
        votes = routed.select("at", F.floor(F.col("fit") / per).cast("int").alias("target"), "counts", total.alias("n"))
        size = max(1, *map(len, self.classes))
        shares = [
            F.round(F.sum(F.when(F.col("target") == t, F.get("counts", F.lit(c)) / F.col("n"))), 9)
            for t in range(len(self.targets)) for c in range(size)
        ]
        summed = votes.groupBy("at").agg(F.array(*shares).alias("shares"))
        out = rows.join(summed, "at", "left")
        given = []
        for t, (target, own) in enumerate(zip(self.targets, self.classes)):
            part = F.slice("shares", t * size + 1, size)
            best = F.array_position(part, F.array_max(part)).cast("int")
            name = F.element_at(F.array(*[F.lit(v) for v in own]), best) if own else F.lit(None).cast("string")
            given.append(name.alias(f"{target}_predicted"))
        return out.select("whole.*", *given)

    def importance(self) -> DataFrame:
        """Rows ``(target, column, importance)``: mean over trees of a column's share of the impurity taken away."""
        per = self.bags or 1
        inner = self.trees.where(F.col("gain") > 0)
        gains = inner.groupBy("fit", "feature").agg(F.sum("gain").alias("gain"))
        totals = inner.groupBy("fit").agg(F.sum("gain").alias("all"))
        share = gains.join(totals, "fit").select(
            F.floor(F.col("fit") / per).cast("int").alias("t"), "feature", (F.col("gain") / F.col("all")).alias("share")
        )
        used = share.groupBy("t", "feature").agg((F.sum("share") / per).alias("share"))
        names = [(t, f, target, c) for t, target in enumerate(self.targets) for f, c in enumerate(self.features)]
        every = self.trees.sparkSession.createDataFrame(names, "t int, feature int, target string, column string")
        joined = every.join(used, ["t", "feature"], "left")
        return joined.select("target", "column", F.coalesce("share", F.lit(0.0)).alias("importance"))
