"""Nearest neighbours by inner product over balanced posting lists.

Vectors get one more coordinate that makes all norms equal, which turns the largest inner
product into the smallest distance. Centroids of a bounded sample, with crowded ones split,
name the posting lists; a vector near a border goes to several lists. A query walks a graph
of the centroids, which fits in memory, and reads the lists whose distance is within a ratio
of the nearest. Lists are read in blocks of rows, so none has to fit in a task.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dunlin.operators.ordering import top_per_group
from dunlin.session import materialize

SAMPLE = 20_000  # vectors the index is fitted on
LIST_ROWS = 128  # vectors that a posting list should hold
MOST_LISTS = 4096
REPLICAS = 4  # lists a border vector may be in
REPLICA_RATIO = 1.15
READ_RATIO = 1.6  # lists up to this multiple of the nearest centroid's distance are read,
LEAST_LISTS = 16  # and these many nearest ones, also where a query lies on a centroid
WALK = 64  # centroids kept by the graph walk at least,
WALK_SHARE = 1 / 6  # and this share of them, so that recall holds as lists grow in number
LINKS = 12
BLOCK = 2048  # rows of a list that meet in one task
QUERY_BLOCK = 1024


def _distances(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    d = (x * x).sum(axis=1)[:, None] + (y * y).sum(axis=1)[None, :] - 2 * (x @ y.T)
    return np.sqrt(np.maximum(d, 0))


class CentroidGraph:
    """Centroids and their neighbours; its size is bounded by ``MOST_LISTS``."""

    def __init__(self, sample: np.ndarray, lists: int, seed: int = 0):
        rng = np.random.default_rng(seed)
        lists = max(1, min(lists, len(sample)))
        centers = sample[rng.choice(len(sample), lists, replace=False)]
        for _ in range(12):
            own = self._nearest(sample, centers)
            sums = np.zeros_like(centers)
            np.add.at(sums, own, sample)
            n = np.bincount(own, minlength=len(centers))
            centers = np.where(n[:, None] > 0, sums / np.maximum(n, 1)[:, None], centers)
        own = self._nearest(sample, centers)
        # Balance: a crowded cluster is halved across its widest direction.
        most = 2 * max(1, -(-len(sample) // lists))
        todo = [np.flatnonzero(own == c) for c in range(len(centers))]
        done = []
        while todo:
            rows = todo.pop()
            if not len(rows):
                continue
            part = sample[rows]
            if len(rows) > most:
                wide = part - part.mean(axis=0)
                direction = wide[np.argmax((wide * wide).sum(axis=1))]
                side = np.argsort(wide @ direction, kind="stable")
                todo += [rows[side[: len(rows) // 2]], rows[side[len(rows) // 2 :]]]
            else:
                done.append(part.mean(axis=0))
        self.centers = np.array(done)
        self.width = max(WALK, round(WALK_SHARE * len(done)))
        k = min(LINKS, len(done) - 1)
        links: list[set[int]] = [set() for _ in done]
        for at in range(0, len(done), 512):
            d = _distances(self.centers[at : at + 512], self.centers)
            for i, row in enumerate(np.argsort(d, axis=1, kind="stable")[:, 1 : k + 1], at):
                for j in row.tolist():
                    links[i].add(j)
                    links[j].add(i)
        for i in range(1, len(done)):  # no part of the graph stays out of reach
            links[i].add((i - 1) // 2)
            links[(i - 1) // 2].add(i)
        self.links = [np.array(sorted(s - {i}), dtype=int) for i, s in enumerate(links)]

    @staticmethod
    def _nearest(x: np.ndarray, centers: np.ndarray) -> np.ndarray:
        return np.concatenate([_distances(x[i : i + 2048], centers).argmin(axis=1) for i in range(0, len(x), 2048)])

    def walk(self, q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ``width`` centroids nearest to ``q`` that a best-first walk finds, nearest first."""
        start = float(np.linalg.norm(self.centers[0] - q))
        seen, open_, best = {0}, [(start, 0)], [(-start, 0)]
        while open_:
            d, i = heapq.heappop(open_)
            if len(best) >= self.width and d > -best[0][0]:
                break
            fresh = [j for j in self.links[i].tolist() if j not in seen]
            if not fresh:
                continue
            seen.update(fresh)
            gaps = np.sqrt(((self.centers[fresh] - q) ** 2).sum(axis=1)).tolist()
            for gap, j in zip(gaps, fresh):
                if len(best) < self.width or gap < -best[0][0]:
                    heapq.heappush(open_, (gap, j))
                    heapq.heappush(best, (-gap, j))
                    if len(best) > self.width:
                        heapq.heappop(best)
        found = sorted((-d, j) for d, j in best)
        return np.array([d for d, _ in found]), np.array([j for _, j in found])

    def lists_to_read(self, q: np.ndarray) -> list[int]:
        gap, found = self.walk(q)
        near = gap <= READ_RATIO * gap[0]
        near[:LEAST_LISTS] = True
        return found[near].tolist()

    def lists_to_join(self, x: np.ndarray) -> list[list[int]]:
        """The nearest list of every row, and others about as near."""
        d = _distances(x, self.centers)
        k = min(REPLICAS, d.shape[1])
        near = np.argsort(d, axis=1, kind="stable")[:, :k]
        gap = np.take_along_axis(d, near, axis=1)
        return [row[g <= REPLICA_RATIO * g[0]].tolist() for row, g in zip(near, gap)]


def _usable(df: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """Distinct rows ``(id, vec array<double>)`` of finite vectors that are not all zero."""
    rows = df.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast("array<double>").alias("vec"))

    def fine(x):
        return x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))

    rows = rows.where("id is not null and vec is not null and size(vec) > 0")
    return rows.where(F.forall("vec", fine) & F.exists("vec", lambda x: x != 0)).distinct()


def _matrix(vectors) -> np.ndarray:
    return np.stack([np.frombuffer(v, np.float64) for v in vectors]) if len(vectors) else np.zeros((0, 1))


def _packed(df: DataFrame) -> DataFrame:
    """Vectors as bytes of doubles."""

    @F.pandas_udf("binary")
    def pack(vecs: pd.Series) -> pd.Series:
        return vecs.map(lambda v: np.asarray(v, np.float64).tobytes())

    return df.withColumn("vec", pack("vec"))


def nearest_neighbours(
    vectors: DataFrame, queries: DataFrame, k: int = 20, id_col: str = "vec_id", vec_col: str = "embedding"
) -> DataFrame:
    """Rows ``(query_id, rank, vec_id, score)``: the ``k`` nearest rows found for each query.

    ``vectors`` and ``queries`` have the columns ``id_col`` and ``vec_col``; a query does not
    find rows of its own id. ``score`` is the inner product in double precision; ties go to
    the smaller id. All rows are indexed; equal vectors are kept once with the ids that can
    be among the first ``k``, which are the ``k + 1`` smallest.

    Rows with a null id, or a vector that is null, empty, all zero or holds null or non-finite
    components, take no part, nor do vectors of another length than most. Repeated rows count
    once. Queries whose lists hold fewer than ``k`` rows are compared with all lists. Without
    usable vectors the result has no rows. Other columns are ignored.
    """
    spark = vectors.sparkSession
    kinds = "query_id long, rank int, vec_id long, score double"
    usable = _usable(vectors, id_col, vec_col)
    dims = usable.groupBy(F.size("vec").alias("d")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "d").first()
    if dims is None:
        return spark.createDataFrame([], kinds)
    usable = usable.where(F.size("vec") == dims["d"])
    # Equal vectors once: a hot vector keeps k + 1 ids per task before the shuffle.
    few = top_per_group(usable, ["vec"], [F.col("id")], k + 1)
    classes = few.groupBy("vec").agg(F.sort_array(F.collect_list("id")).alias("ids"))
    norm = F.sqrt(F.aggregate("vec", F.lit(0.0), lambda a, x: a + x * x))
    classes = _packed(classes.withColumn("norm", norm)).withColumn("cid", F.monotonically_increasing_id())
    classes = materialize(classes, "ann-classes")
    n, top = classes.agg(F.count("*"), F.max("norm")).first()
    sample = classes.orderBy(F.xxhash64("vec"), "vec").limit(SAMPLE).select("vec").collect()
    lifted = _lifted(_matrix([r["vec"] for r in sample]), top)
    graph = spark.sparkContext.broadcast(CentroidGraph(lifted, min(MOST_LISTS, -(-n // LIST_ROWS))))

    def join_lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists: list[list[int]] = []
            x = _matrix(batch.column("vec").to_pylist())
            for at in range(0, len(x), 512):
                lists += graph.value.lists_to_join(_lifted(x[at : at + 512], top))
            yield _with_lists(batch.select(["cid", "vec"]), lists)

    posted = classes.select("cid", "vec").mapInArrow(join_lists, "cid long, vec binary, list int")
    posted = materialize(posted, "ann-lists")
    asked = _packed(_usable(queries, id_col, vec_col).where(F.size("vec") == dims["d"]))
    asked = materialize(asked.select(F.monotonically_increasing_id().alias("q"), F.col("id").alias("query_id"), "vec"), "ann-queries")

    def read_lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch.column("vec").to_pylist())
            x = np.concatenate([x, np.zeros((len(x), 1))], axis=1) if len(x) else x
            yield _with_lists(batch.select(["q", "vec"]), [graph.value.lists_to_read(row) for row in x])

    probes = asked.select("q", "vec").mapInArrow(read_lists, "q long, vec binary, list int")
    found = _ranked(_scores(posted, probes, k), classes, asked, k)
    found = materialize(found, "ann-found")
    # The exact way for queries whose lists were too small: all lists.
    had = found.groupBy("q").agg(F.count("*").alias("had"))
    lacking = asked.join(had, "q", "left").where(F.coalesce("had", F.lit(0)) < k).select("q", "query_id", "vec")
    lacking = materialize(lacking, "ann-lacking")
    if lacking.limit(1).count():
        lists = posted.select("list").distinct()
        everywhere = lacking.select("q", "vec", F.explode(F.sequence(F.lit(0), F.lit(len(graph.value.centers) - 1))).alias("list"))
        more = _ranked(_scores(posted, everywhere.join(lists, "list", "left_semi"), k), classes, lacking, k)
        found = found.join(lacking.select("q"), "q", "left_anti").unionByName(more)
    return found.select("query_id", "rank", "vec_id", "score")


def _lifted(x: np.ndarray, top: float) -> np.ndarray:
    """Add the coordinate that makes every norm ``top``."""
    rest = np.maximum(top * top - (x * x).sum(axis=1), 0)
    return np.concatenate([x, np.sqrt(rest)[:, None]], axis=1)


def _with_lists(batch: pa.RecordBatch, lists: list[list[int]]) -> pa.RecordBatch:
    row = np.repeat(np.arange(len(lists)), [len(x) for x in lists])
    flat = np.array([i for x in lists for i in x], np.int32)
    taken = batch.take(pa.array(row, pa.int64()))
    return pa.RecordBatch.from_arrays([*taken.columns, pa.array(flat)], [*batch.schema.names, "list"])


def _scores(posted: DataFrame, probes: DataFrame, k: int) -> DataFrame:
    """Rows ``(q, cid, score)``: per query and block the ``k + 1`` best classes, from blocks of both sides."""
    probes = materialize(probes, "ann-probes")
    sizes = posted.groupBy("list").agg(F.count("*").alias("n"))
    asks = probes.groupBy("list").agg(F.count("*").alias("m"))
    cut = sizes.join(asks, "list").select(
        "list", F.ceil(F.col("n") / BLOCK).cast("int").alias("vbs"), F.ceil(F.col("m") / QUERY_BLOCK).cast("int").alias("qbs")
    )
    cut = F.broadcast(materialize(cut, "ann-blocks"))  # a row per list: at most some 2 * MOST_LISTS
    left = posted.join(cut, "list").withColumn("vb", F.pmod(F.xxhash64("cid"), F.col("vbs")).cast("int"))
    left = left.withColumn("qb", F.explode(F.sequence(F.lit(0), F.col("qbs") - 1)))
    right = probes.join(cut, "list").withColumn("qb", F.pmod(F.xxhash64("q"), F.col("qbs")).cast("int"))
    right = right.withColumn("vb", F.explode(F.sequence(F.lit(0), F.col("vbs") - 1)))
    task = ["list", "vb", "qb"]

    def best(rows: pd.DataFrame, asks: pd.DataFrame) -> pd.DataFrame:
        if not len(rows) or not len(asks):
            return pd.DataFrame({"q": [], "cid": [], "score": []}).astype({"q": "int64", "cid": "int64"})
        score = _matrix(asks["vec"].tolist()) @ _matrix(rows["vec"].tolist()).T
        keep = min(k + 1, score.shape[1])
        near = np.argpartition(-score, keep - 1, axis=1)[:, :keep]
        # Classes that tie with the last one kept may hold smaller ids.
        low = np.take_along_axis(score, near, axis=1).min(axis=1)
        i, j = np.nonzero(score >= low[:, None])
        return pd.DataFrame({"q": asks["q"].to_numpy()[i], "cid": rows["cid"].to_numpy()[j], "score": score[i, j]})

    sides = left.select(*task, "cid", "vec").groupBy(*task).cogroup(right.select(*task, "q", "vec").groupBy(*task))
    return sides.applyInPandas(best, "q long, cid long, score double")


def _ranked(scores: DataFrame, classes: DataFrame, asked: DataFrame, k: int) -> DataFrame:
    """The ``k`` best rows per query: classes once, then their ids without the query's own."""
    once = scores.groupBy("q", "cid").agg(F.max("score").alias("score"))
    rows = once.join(classes.select("cid", "ids"), "cid").select("q", "score", F.explode("ids").alias("vec_id"))
    rows = rows.join(asked.select("q", "query_id"), "q").where("vec_id <> query_id")
    return top_per_group(rows, ["q"], [F.desc("score"), F.col("vec_id")], k)
