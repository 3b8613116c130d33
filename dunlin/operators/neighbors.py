"""Exact k-nearest-neighbour joins and cluster-distance sums on vectors.

The reference side is cut into cells around a bounded number of pivot rows,
and a large cell into blocks of bounded size. A query visits only the cells
that can hold one of its neighbours: the triangle inequality gives an upper
bound for its k-th distance and a lower bound for every cell. The distance
matrix of a query chunk and a block stays inside one task, which returns at
most ``k`` rows per query.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dunlin.operators.joins import salted_join
from dunlin.operators.ordering import top_per_group
from dunlin.session import materialize

BLOCK_ROWS = 4096  # rows per side of one task's blocks
STRIP = 256  # queries whose distances to a block are held at a time
FOLD = 16  # references whose smallest distance stands for them in the bound of a query
TILE_ROWS = 32_768  # rows per side of a tile of distance sums, at most
TILE_VALUES = 1 << 22  # numbers that a side of a tile holds and returns
PAIRS = 20_000  # pairs measured exactly, or visits sent, at a time
MAX_PIVOTS = 256
DIGITS = 9  # distances equal to this many places are ties, broken by id


def vector_of(*columns: str) -> Column:
    return F.array(*[F.col(c).cast("double") for c in columns])


def as_double(vector: str) -> Column:
    return F.col(vector).cast("array<double>")


def norm(v: Column) -> Column:
    return F.sqrt(F.aggregate(v, F.lit(0.0), lambda s, x: s + x * x))


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)


def euclidean(a: Column, b: Column) -> Column:
    squares = F.zip_with(a, b, lambda x, y: (x - y) * (x - y))
    return F.sqrt(F.aggregate(squares, F.lit(0.0), lambda s, x: s + x))


def cosine_distance(a: Column, b: Column) -> Column:
    """1 - cosine; a zero vector is at distance 1 from everything."""
    scale = norm(a) * norm(b)
    return F.when(scale == 0, 1.0).otherwise(F.lit(1.0) - dot(a, b) / scale)


def _unit(v: Column, query: bool) -> Column:
    """Unit vector in two more dimensions; they keep zero vectors apart from all others."""
    zero = F.array(F.lit(0.0), F.lit(0.0))
    own = F.array(F.lit(1.0), F.lit(0.0)) if query else F.array(F.lit(0.0), F.lit(1.0))
    size = norm(v)
    return F.when(size == 0, F.concat(v, own)).otherwise(
        F.concat(F.transform(v, lambda x: x / size), zero)
    )


def _matrix(column: pd.Series) -> np.ndarray:
    return np.stack(column.to_numpy()).astype(float) if len(column) else np.zeros((0, 1))


def _squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    d = (a * a).sum(1)[:, None] + (b * b).sum(1)[None, :] - 2.0 * (a @ b.T)
    return np.maximum(d, 0.0)


def _nearest_in_block(ids, q, refs, r, k) -> pd.DataFrame:
    """The k nearest rows of one block for every query, with exactly computed distances."""
    most, kk = (r * r).sum(1).max(), min(k, len(r))
    found = []
    for start in range(0, len(q), STRIP):
        part = q[start : start + STRIP]
        d = _squared(part, r)
        # The kk-th of the smallest distances of disjoint groups is no less than the kk-th of all.
        fold = max(1, min(FOLD, len(r) // kk))
        least = d[:, : len(r) // fold * fold].reshape(len(d), fold, -1).min(1) if fold > 1 else d
        kth = np.partition(least, kk - 1, axis=1)[:, kk - 1]
        noise = 1e-14 * ((part * part).sum(1) + most)
        bound = kth + noise + 1e-8 * np.sqrt(kth) + 1e-15
        i, j = np.nonzero(d <= bound[:, None])
        near = []
        for at in range(0, len(i), PAIRS):
            a, b = i[at : at + PAIRS] + start, j[at : at + PAIRS]
            exact = np.round(np.sqrt(((q[a] - r[b]) ** 2).sum(1)), DIGITS)
            out = pd.DataFrame({"q": ids[a], "r": refs[b], "d": exact})
            near.append(out.sort_values(["q", "d", "r"]).groupby("q").head(k))
        found.append(pd.concat(near).sort_values(["q", "d", "r"]).groupby("q").head(k))
    return pd.concat(found)


def knn_join(
    queries: DataFrame,
    refs: DataFrame,
    k: int,
    q_id: str,
    r_id: str,
    vector: str,
    metric: str = "euclidean",
    exclude_same: bool = False,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """The ``k`` nearest reference rows of each query: ``(q_id, r_id, distance, rank)``.

    ``metric`` is ``euclidean`` or ``cosine``. ``exclude_same`` leaves out the
    pair of a row with itself. Ids are integers, unique on each side.

    Copies cost little: of equal reference vectors only the ``k`` lowest ids
    can be among the nearest, and equal queries are searched once.
    """
    v = as_double(vector)
    qv, rv = (_unit(v, True), _unit(v, False)) if metric == "cosine" else (v, v)
    q_rows = queries.select(F.col(q_id).cast("long").alias("q"), qv.alias("v"))
    r_rows = refs.select(F.col(r_id).cast("long").alias("r"), rv.alias("v"))
    q_rows = q_rows.withColumn("h", F.xxhash64("v"))
    r_rows = r_rows.withColumn("h", F.xxhash64("v"))

    kk = k + 1 if exclude_same else k
    r_rows = materialize(top_per_group(r_rows, ["h", "v"], [F.col("r")], kk).select("r", "v"), "refs")
    apart = q_rows.groupBy("h", "v").agg(F.min("q").alias("q"), F.count("*").alias("copies"))
    apart = materialize(apart, "queries")
    copies, distinct = apart.agg(F.sum("copies"), F.count("*")).first()
    found = _search(apart.select("q", "v"), r_rows, kk, distinct, block_rows)
    if copies != distinct:
        hits = found.groupBy("q").agg(F.collect_list(F.struct("d", "r")).alias("hits"))
        lists = apart.join(hits, "q").select("h", "v", "hits")  # at most kk hits per vector
        found = salted_join(q_rows, lists, ["h", "v"]).select("q", F.inline("hits"))
    if exclude_same:
        found = found.where(F.col("q") != F.col("r"))
    best = top_per_group(found, ["q"], [F.col("d"), F.col("r")], k)
    d = F.col("d") * F.col("d") / 2 if metric == "cosine" else F.col("d")
    other = r_id if r_id != q_id else f"neighbor_{r_id}"
    return best.select(F.col("q").alias(q_id), F.col("r").alias(other), d.alias("distance"), "rank")


def _search(
    q_rows: DataFrame, r_rows: DataFrame, kk: int, n_queries: int, block_rows: int
) -> DataFrame:
    """Rows ``(q, r, d)`` with the ``kk`` nearest of ``r_rows`` for each of ``q_rows``."""
    spark = r_rows.sparkSession
    n_refs = r_rows.count()
    want = max(1, min(MAX_PIVOTS, int(math.sqrt(n_refs) / 4)))
    sample = r_rows.orderBy(F.xxhash64("r"), "r").limit(want).collect()
    if not sample:
        return spark.createDataFrame([], "q long, r long, d double")
    pivots = np.array([row["v"] for row in sample], dtype=float)

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            d = _squared(_matrix(pdf["v"]), pivots)
            cell = d.argmin(1) if len(pdf) else np.zeros(0, int)
            away = np.sqrt(d[np.arange(len(pdf)), cell])
            yield pdf.assign(cell=cell.astype("int32"), away=away)

    placed = materialize(
        r_rows.mapInPandas(place, "r long, v array<double>, cell int, away double"), "cells"
    )
    # At most MAX_PIVOTS rows, and MAX_PIVOTS * k rows, reach the driver.
    cells = placed.groupBy("cell").agg(F.count("*").alias("n"), F.max("away").alias("radius")).collect()
    inner = top_per_group(placed.select("cell", "away", "r"), ["cell"], [F.col("away"), F.col("r")], kk)
    radius = np.full(len(pivots), -np.inf)
    blocks = [1] * len(pivots)
    for row in cells:
        radius[row["cell"]] = row["radius"]
        blocks[row["cell"]] = max(1, math.ceil(row["n"] / block_rows))
    near = [(row["cell"], row["away"]) for row in inner.select("cell", "away").collect()]
    near_cell = np.array([c for c, _ in near])
    near_away = np.array([a for _, a in near])
    between = np.sqrt(_squared(pivots, pivots))

    def route(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for whole in batches:
            for start in range(0, len(whole), STRIP):
                pdf = whole.iloc[start : start + STRIP]
                to_pivot = np.sqrt(_squared(_matrix(pdf["v"]), pivots))
                if len(near) >= kk:
                    reach = np.empty(len(pdf))
                    for at in range(0, len(pdf), 32):
                        upper = to_pivot[at : at + 32, near_cell] + near_away[None, :]
                        reach[at : at + 32] = np.partition(upper, kk - 1, axis=1)[:, kk - 1]
                else:
                    reach = np.full(len(pdf), np.inf)
                reach = reach * (1 + 1e-9) + 1e-7
                home = to_pivot.argmin(1)
                closest = to_pivot[np.arange(len(pdf)), home]
                apart = between[home]
                with np.errstate(divide="ignore", invalid="ignore"):
                    plane = np.where(
                        apart > 0, (to_pivot**2 - closest[:, None] ** 2) / (2 * apart), 0.0
                    )
                visit = (to_pivot - radius[None, :] <= reach[:, None]) & (
                    plane <= reach[:, None] + 1e-7
                )
                visit &= np.isfinite(radius)[None, :]
                every, cells_hit = np.nonzero(visit)
                for at in range(0, len(every), PAIRS):
                    i, cell = every[at : at + PAIRS], cells_hit[at : at + PAIRS]
                    yield pd.DataFrame(
                        {
                            "q": pdf["q"].to_numpy()[i],
                            "v": pdf["v"].to_numpy()[i],
                            "cell": cell.astype("int32"),
                        }
                    )

    routed = q_rows.mapInPandas(route, "q long, v array<double>, cell int")
    if n_refs > block_rows:
        visits = {r["cell"]: r["n"] for r in routed.groupBy("cell").agg(F.count("*").alias("n")).collect()}
    else:  # every cell sees each query at most once
        visits = dict.fromkeys(range(len(pivots)), n_queries)
    chunks = [max(1, math.ceil(visits.get(c, 0) / block_rows)) for c in range(len(pivots))]

    def count_for(values: list[int]) -> Column:
        return F.element_at(F.lit(values), F.col("cell") + 1)

    def upto(n: Column) -> Column:
        return F.explode(F.sequence(F.lit(0), n - 1))

    q_side = routed.withColumn(
        "chunk", F.pmod(F.xxhash64("q"), count_for(chunks)).cast("int")
    ).withColumn("block", upto(count_for(blocks)))
    r_side = placed.drop("away").withColumn(
        "block", F.pmod(F.xxhash64("r"), count_for(blocks)).cast("int")
    ).withColumn("chunk", upto(count_for(chunks)))

    def search(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if not len(left) or not len(right):
            return pd.DataFrame({"q": [], "r": [], "d": []})
        return _nearest_in_block(
            left["q"].to_numpy(), _matrix(left["v"]), right["r"].to_numpy(), _matrix(right["v"]), kk
        )

    keys = ["cell", "block", "chunk"]
    found = (
        q_side.groupBy(*keys)
        .cogroup(r_side.groupBy(*keys))
        .applyInPandas(search, "q long, r long, d double")
    )
    return top_per_group(found, ["q"], [F.col("d"), F.col("r")], kk).drop("rank")


def cluster_distances(
    df: DataFrame, row_id: str, vector: str, labels: str, block_rows: int = BLOCK_ROWS
) -> DataFrame:
    """Sum of distances of each row to each cluster, for several labelings at once.

    ``labels`` is an array with one cluster id per labeling. Returns
    ``(row, labeling, own, cluster, dist, n)``. The work is quadratic by
    definition; it is cut into tiles, each for both of its sides, and only sums leave a task.
    A tile has as many rows as keep its vectors and sums within ``TILE_VALUES``, and no fewer
    than ``block_rows`` unless cores would idle.
    """
    rows = df.select(
        F.col(row_id).cast("long").alias("row"),
        as_double(vector).alias("v"),
        F.col(labels).cast("array<int>").alias("c"),
    )
    total, dims, labelings = rows.agg(F.count("*"), F.max(F.size("v")), F.max(F.size("c"))).first()
    clusters = rows.select(F.explode("c").alias("c")).agg(F.count_distinct("c")).first()[0]
    values = max(1, (dims or 0) + (labelings or 0) * (1 + 6 * clusters))
    tile = max(block_rows, min(TILE_ROWS, TILE_VALUES // values))
    wide = math.ceil(math.sqrt(4 * df.sparkSession.sparkContext.defaultParallelism))
    blocks = max(1, math.ceil(total / tile), min(wide, math.ceil(total / block_rows)))
    part = F.pmod(F.xxhash64("row"), F.lit(blocks)).cast("int")
    left = rows.withColumn("a", part).withColumn("b", F.explode(F.sequence(F.col("a"), F.lit(blocks - 1))))
    right = rows.select(F.col("row").alias("row2"), F.col("v").alias("v2"), F.col("c").alias("c2"), part.alias("b"))
    right = right.withColumn("a", F.explode(F.sequence(F.lit(0), F.col("b"))))

    def grouped_sums(d: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Clusters of the columns of ``d``, their columns, and the sums of each row over them."""
        order = np.argsort(c, kind="stable")
        names, first, n = np.unique(c[order], return_index=True, return_counts=True)
        return names, n, np.add.reduceat(d[:, order], first, axis=1)

    def table(ids: np.ndarray, own: np.ndarray, labeling: int, names, n, dist: np.ndarray) -> pd.DataFrame:
        return pd.DataFrame(
            {
                "row": np.repeat(ids, len(names)), "labeling": labeling, "own": np.repeat(own, len(names)),
                "cluster": np.tile(names, len(ids)), "dist": dist.ravel(), "n": np.tile(n, len(ids)),
            }
        )

    def sums(x: pd.DataFrame, y: pd.DataFrame) -> pd.DataFrame:
        if not len(x) or not len(y):
            return pd.DataFrame({c: [] for c in ["row", "labeling", "own", "cluster", "dist", "n"]})
        same = x["a"].iloc[0] == x["b"].iloc[0]
        ids, others = x["row"].to_numpy(), y["row2"].to_numpy()
        v, w = _matrix(x["v"]), _matrix(y["v2"])
        own, other = _matrix(x["c"]).astype("int32"), _matrix(y["c2"]).astype("int32")
        out, back = [], []
        for j in range(0 if same else own.shape[1]):
            names, at, n = np.unique(own[:, j], return_inverse=True, return_counts=True)
            back.append((names, at, n, np.zeros((len(names), len(others)))))
        strip = max(16, BLOCK_ROWS * STRIP // len(w))
        for start in range(0, len(v), strip):
            part = slice(start, start + strip)
            d = np.sqrt(_squared(v[part], w))
            if same:  # a row is in one block only
                d[ids[part, None] == others[None, :]] = 0.0
            for j in range(other.shape[1]):
                out.append(table(ids[part], own[part, j], j, *grouped_sums(d, other[:, j])))
            for _, at, _, found in back:
                for cluster in np.unique(at[part]):
                    found[cluster] += d[at[part] == cluster].sum(0)
        for j, (names, _, n, found) in enumerate(back):
            out.append(table(others, other[:, j], j, names, n, found.T))
        return pd.concat(out)

    parts = (
        left.groupBy("a", "b")
        .cogroup(right.groupBy("a", "b"))
        .applyInPandas(sums, "row long, labeling int, own int, cluster int, dist double, n long")
    )
    return parts.groupBy("row", "labeling", "own", "cluster").agg(
        F.sum("dist").alias("dist"), F.sum("n").alias("n")
    )
