"""Merkle manifest of a data set: lag and lead windows supply siblings, first children hash parents.

Rows are leaves of one tree per group; the groups' roots are leaves of the last tree. A level is
a table ``tree, pos, n, digest``. A window over whole runs of children gives every node the
digests ``lag`` and ``lead`` find at fixed offsets, masked by its slot and by the length of its
run; the row at slot 0 hashes itself and what follows it to the parent. Windows are cut into
blocks of ``BLOCK`` positions, a multiple of a run, so no group meets in one task. On the way
down every node takes over the steps of its parent by a join on position.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dunlin.operators.joins import lookup_join
from dunlin.operators.ordering import ranked
from dunlin.session import materialize

FAN = 8
BLOCK = 512  # positions of a window, a multiple of FAN

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
STEPS = "array<struct<left:string,right:string>>"


def digest(*parts: Column) -> Column:
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def field(value: Column) -> Column:
    """``-`` for null, else the byte length, ``:`` and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def _with_siblings(nodes: DataFrame) -> DataFrame:
    """Nodes with ``left`` and ``right``, the digests of their siblings on either side."""
    run = Window.partitionBy("tree", F.floor(F.col("pos") / BLOCK)).orderBy("pos")
    slot = F.col("pos") % FAN
    width = F.least(F.lit(FAN), F.col("n") - F.col("pos") + slot)
    before = [F.when(slot >= k, F.lag("digest", k).over(run)) for k in range(FAN - 1, 0, -1)]
    after = [F.when(slot + k < width, F.lead("digest", k).over(run)) for k in range(1, FAN)]
    return nodes.withColumns({"left": F.concat_ws("", *before), "right": F.concat_ws("", *after)})


def _parents(level: DataFrame) -> DataFrame:
    """The next level, hashed by the first child of every run."""
    first = level.where(F.col("pos") % FAN == 0)
    up, width = F.floor(F.col("pos") / FAN), F.ceil(F.col("n") / FAN)
    return first.select("tree", up.alias("pos"), width.alias("n"), digest(F.col("digest"), F.col("right")).alias("digest"))


def _grow(leaves: DataFrame, most: int) -> tuple[list[DataFrame], list[DataFrame]]:
    """Levels with siblings, and per level the roots ``tree, pos, n, digest`` found there.

    ``most`` is the largest number of leaves of a tree; it gives the number of levels.
    """
    levels, roots, nodes = [], [], leaves
    while True:
        roots.append(nodes.where("n = 1"))
        if most <= 1:
            return levels, roots
        levels.append(materialize(_with_siblings(nodes.where("n > 1")), "merkle-level"))
        nodes = _parents(levels[-1])
        most = -(-most // FAN)


def _descend(levels: list[DataFrame], roots: list[DataFrame]) -> DataFrame:
    """Leaves with ``steps``, the siblings on their way up to the root of their tree."""
    own, none = F.array(F.struct("left", "right")).cast(STEPS), F.array().cast(STEPS)
    known = None
    for height in reversed(range(len(roots))):
        found = roots[height].withColumn("steps", none)
        if height < len(levels):
            above = known.select("tree", F.col("pos").alias("up"), F.col("steps").alias("rest"))
            level = levels[height].withColumn("up", F.floor(F.col("pos") / FAN))
            # At most FAN rows share a key.
            down = level.join(above, ["tree", "up"]).withColumn("steps", F.concat(own, "rest"))
            found = down.select(*found.columns).unionByName(found)
        known = found if height == 0 else materialize(found, "merkle-path")
    return known


def _sized(leaves: DataFrame) -> tuple[DataFrame, int]:
    """``leaves`` with ``n``, the leaves of their tree, and the largest ``n``."""
    sizes = materialize(leaves.groupBy("tree").agg(F.count("*").alias("n")), "merkle-sizes")
    most = sizes.agg(F.max("n")).first()[0] or 0
    return lookup_join(leaves, sizes, ["tree"]), most


def merkle_manifest(
    rows: DataFrame, id_col: str, group_col: str, fields: Sequence[str], changed: dict[str, Column] | None = None
) -> DataFrame:
    """Rows ``(id, leaf, subroot, root, steps, folded_root)``, one per row of ``rows``.

    A leaf hashes ``fields`` (nulls and lengths kept apart). Per value of ``group_col`` leaves
    stand in order of id, null first, then of leaf; the groups' roots stand in order of
    ``group_col``, null first, bytewise. ``steps`` lists the digests ``left`` and ``right`` of
    the path at every level up to ``root``; ``folded_root`` walks them from the leaf of the
    row with the columns in ``changed`` in place of its own, so it equals ``root`` only if
    nothing that ``fields`` cover differs.

    Repeated rows are leaves of their own. An empty table has no rows and no root. Columns
    that are not named here are ignored, whatever their names.
    """
    group = F.col(group_col).cast("string")
    tree = F.when(group.isNull(), "").otherwise(F.concat(F.lit("+"), group))
    new = [(changed or {}).get(c, F.col(c)) for c in fields]
    leaves = rows.select(
        F.col(id_col).cast("long").alias("id"),
        tree.alias("tree"),
        digest(*[field(F.col(c)) for c in fields]).alias("digest"),
        digest(*[field(c) for c in new]).alias("folded"),
    )
    leaves = materialize(leaves, "merkle-leaves")  # the range sort reads its input twice
    placed, most = _sized(ranked(leaves, ["id", "digest"], ["tree"], "pos"))
    levels, roots = _grow(placed, most)
    subroots = None
    for found in roots:
        found = found.select("tree", "digest")
        subroots = found if subroots is None else subroots.unionByName(found)
    subroots = materialize(subroots, "merkle-subroots")

    top = ranked(subroots.select(F.lit("").alias("tree"), F.col("tree").alias("id"), "digest"), ["id"], name="pos")
    top, groups = _sized(top)
    top_levels, top_roots = _grow(top, groups)
    paths = _descend(top_levels, top_roots)
    last = top_roots[-1].select("tree", F.col("digest").alias("root"))  # one row
    ends = paths.join(last, "tree").select(F.col("id").alias("tree"), F.col("digest").alias("subroot"), "root", "steps")

    found = lookup_join(_descend(levels, roots), ends.withColumnRenamed("steps", "rest"), ["tree"])
    found = found.withColumn("steps", F.concat("steps", "rest"))
    walk = F.aggregate("steps", F.col("folded"), lambda at, s: digest(s["left"], at, s["right"]))
    return found.select(
        "id",
        F.col("digest").alias("leaf"),
        "subroot",
        "root",
        "steps",
        walk.alias("folded_root"),
    )


def lowered(text: Column) -> Column:
    """``text`` with A-Z in lower case and all else as it is."""
    return F.translate(text, UPPER, LOWER)
