"""Item-based and content-based recommendation on long tables."""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dunlin.features.encoding import category_list
from dunlin.features.scaling import apply_scale, fit_standard
from dunlin.operators import scans
from dunlin.operators.joins import lookup_join, salted_join
from dunlin.operators.neighbors import knn_join, vector_of
from dunlin.operators.ordering import top_per_group
from dunlin.operators.sparse import sparse_topk, unit_rows
from dunlin.session import materialize, shuffle_width

TARGETS = 64  # items that one row of a rating may take along
USER_ROWS = 100_000  # ratings per task, on average
SHUFFLED_RATINGS = 500_000  # ratings that may take their targets along; the targets of more are read by every task
DIGITS = 9


def similar_items(ratings: DataFrame, k: int) -> DataFrame:
    """The ``k`` nearest other items of each item by cosine distance over users.

    ``ratings`` has ``user, item, rating`` with an absent row for a missing
    rating. Returns ``(item, neighbor, distance, rank)``.
    """
    best = sparse_topk(unit_rows(ratings, "item", "rating"), "item", "user", "rating", k)
    return best.select(
        "item", F.col("other").alias("neighbor"), (F.lit(1.0) - F.col("score")).alias("distance"), "rank"
    )


def _targets(neighbors: DataFrame) -> DataFrame:
    seen, target, sim = F.col("neighbor").alias("seen"), F.col("item").alias("target"), (1 - F.col("distance")).alias("sim")
    return neighbors.select(seen, target, sim).where(F.col("sim") > 0)


def _whole_numbers(ratings: DataFrame, neighbors: DataFrame) -> bool:
    kinds = [dict(ratings.dtypes)["item"], *[dict(neighbors.dtypes)[c] for c in ("item", "neighbor")]]
    return set(kinds) <= {"tinyint", "smallint", "int", "bigint"}


def _scanned_predictions(ratings: DataFrame, near: DataFrame, n: int | None = None) -> DataFrame:
    """Rows ``(user, item, predicted, rank)``, the ``n`` best of each user or all with rank 0.

    Ratings are shuffled to a task of their user, which reads all of ``near`` past them: of the
    targets of a rating, some tens of times its size, nothing is shuffled.
    """
    near = near.where("seen is not null and target is not null").select(F.col("seen").cast("long"), F.col("target").cast("long"), "sim")
    near = materialize(near, "targets")
    counts = near.groupBy(F.col("seen").alias("item")).agg(F.count("*").alias("targets"))
    raters = ratings.groupBy("item").agg(F.count("*").alias("raters"))
    met = raters.join(counts, "item").agg(F.sum(F.col("raters") * F.col("targets"))).first()[0] or 0
    written = near.repartition(scans.scan_files(near, near.count()), "seen").sortWithinPartitions("seen")
    files = materialize(written, "targets").inputFiles()

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        batches = list(batches)
        if not batches:
            return
        own = pa.Table.from_batches(batches).combine_chunks()
        del batches
        users = pa.concat_arrays(own["user"].chunks).dictionary_encode("encode")
        user, item = users.indices.to_numpy(), own["item"].to_numpy()
        rating = own["rating"].to_numpy(zero_copy_only=False) if own["rating"].null_count == 0 else None
        if rating is None:
            rating = pc.if_else(own["rating"].is_null(), float("nan"), own["rating"]).to_numpy()
        order = np.argsort(item, kind="stable")
        user, item, rating = user[order], item[order], rating[order].astype(float)
        held = scans.Products()
        named = np.flatnonzero(users.dictionary.is_valid().to_numpy(zero_copy_only=False)[user])
        held.add(user[named], np.ones(len(named), int), rating[named], item[named], np.full(len(named), -1.0))
        for table in scans.tables(files):
            seen, first, size = np.unique(table["seen"].to_numpy(), return_index=True, return_counts=True)
            if not len(seen):
                continue
            at = np.minimum(np.searchsorted(seen, item), len(seen) - 1)
            met = np.flatnonzero(seen[at] == item)
            at = at[met]
            run = scans.runs(first[at], size[at])
            held.add(user[met], size[at], rating[met], table["target"].to_numpy()[run], table["sim"].to_numpy()[run])
        for owners, owner, own, other, sim in held.by_owner():
            rated, unknown = sim < 0, np.isnan(own)  # a user's own item; a rating that is null
            sim = np.where(rated, 0.0, sim)
            terms = np.where(unknown | rated, 0.0, sim * np.where(unknown, 0.0, own))
            owner, other, total, weight, known, rated = scans.summed(
                owner, other, terms, sim, (~unknown & ~rated).astype(float), rated.astype(float)
            )
            kept = rated == 0
            owner, other, known = owner[kept], other[kept], known[kept] > 0
            value = total[kept] / weight[kept]
            rank = np.zeros(len(owner), int)
            if n is not None:
                score = np.round(value, DIGITS)
                score[~known] = score[known].min(initial=0.0) - 1  # no prediction comes last
                at, rank = scans.best_of_each(owner, score, n, DIGITS)
                owner, other, value, known = owner[at], other[at], value[at], known[at]
            names = users.dictionary.take(pa.array(owners[owner]))
            columns = names, pa.array(other), pa.array(value, mask=~known), pa.array(rank.astype("int32"))
            yield pa.RecordBatch.from_arrays(list(columns), ["user", "item", "predicted", "rank"])

    rated = ratings.where("item is not null").select("user", F.col("item").cast("long"), F.col("rating").cast("double"))
    kind = ratings.schema["user"].dataType.simpleString()
    rated = rated.repartition(scans.scan_tasks(rated, met), "user")
    return rated.mapInArrow(predict, f"user {kind}, item long, predicted double, rank int")


def predict_ratings(ratings: DataFrame, neighbors: DataFrame) -> DataFrame:
    """Similarity-weighted mean over the rated neighbours of every unseen item.

    Rows ``(user, item, predicted)`` for items with a rated neighbour of
    positive similarity; all other unseen items have prediction 0.
    """
    near = _targets(neighbors)
    n_ratings = ratings.count()
    if n_ratings > SHUFFLED_RATINGS and _whole_numbers(ratings, neighbors):
        return _scanned_predictions(ratings, near).drop("rank")
    # A rating takes its item's targets along in lists of bounded length; they part at the user's task.
    place = F.row_number().over(Window.partitionBy("seen").orderBy("target"))
    lists = near.withColumn("part", F.floor((place - 1) / TARGETS)).groupBy("seen", "part")
    lists = lists.agg(F.collect_list(F.struct("target", "sim")).alias("e"))
    lists = lists.select("seen", F.col("e.target").alias("targets"), F.col("e.sim").alias("sims"))
    rated = ratings.select(F.col("item").alias("seen"), "user", "rating")
    sent = salted_join(rated, lists, ["seen"]).select("user", "rating", "targets", "sims", F.lit(False).alias("own"))
    own = ratings.where("user is not null and item is not null").select(
        "user", F.lit(None).cast("double").alias("rating"), F.array("item").alias("targets"),
        F.array(F.lit(None).cast("double")).alias("sims"), F.lit(True).alias("own"),
    )
    tasks = max(shuffle_width(ratings.sparkSession), math.ceil(n_ratings / USER_ROWS))
    at_user = sent.unionByName(own).repartition(tasks, "user")
    pairs = at_user.select("user", "rating", "own", F.inline(F.arrays_zip("targets", "sims")))
    sums = pairs.groupBy("user", F.col("targets").alias("item")).agg(
        (F.sum(F.col("sims") * F.col("rating")) / F.sum("sims")).alias("predicted"), F.max("own").alias("own")
    )
    return sums.where("not own").drop("own")


def recommend(ratings: DataFrame, neighbors: DataFrame, n: int) -> DataFrame:
    """The ``n`` unseen items with the highest prediction for every user."""
    if _whole_numbers(ratings, neighbors) and ratings.count() > SHUFFLED_RATINGS:
        best = _scanned_predictions(ratings, _targets(neighbors), n)
        return best.withColumn("predicted", F.round("predicted", DIGITS))
    predicted = predict_ratings(ratings, neighbors).withColumn("predicted", F.round("predicted", DIGITS))
    return top_per_group(predicted, ["user"], [F.desc("predicted"), F.col("item")], n)


def predict_on_encoded(
    df: DataFrame, row_id: str, features: Sequence[str], user: str, k: int
) -> DataFrame:
    """Fill a 0 in column ``user`` from the nearest encoded rows.

    Features are one-hot encoded and standardised; similarity is 1 minus the
    Euclidean distance; ``k`` neighbours with the row itself, so ``k - 1``
    others. Returns ``(row_id, predicted)`` for the rows with 0.
    """
    indicators = {}
    for c in features:
        for i, v in enumerate(category_list(df, c)):
            indicators[f"__{c}_{i}"] = F.when(F.col(c) == v, 1.0).otherwise(0.0)
    encoded = df.withColumns(indicators)
    scaled = apply_scale(encoded, fit_standard(encoded, list(indicators)))
    rows = scaled.select(row_id, user, vector_of(*indicators).alias("v"))
    missing = rows.where(F.col(user) == 0)
    pairs = knn_join(missing, rows, k - 1, row_id, row_id, "v", exclude_same=True)
    known = rows.select(F.col(row_id).alias(f"neighbor_{row_id}"), F.col(user).alias("__r"))
    joined = lookup_join(pairs, known, [f"neighbor_{row_id}"])
    rated = F.col("__r") != 0
    sim = 1 - F.col("distance")
    weight = F.sum(F.when(rated, sim))
    value = F.when(weight > 0, F.sum(F.when(rated, sim * F.col("__r"))) / weight).otherwise(0.0)
    return joined.groupBy(row_id).agg(value.alias("predicted"))


def content_rows(df: DataFrame, row_id: str, parts: dict[str, Column]) -> DataFrame:
    """Token sets as sparse rows of length 1 per part: ``(row_id, token, weight)``."""

    def entries(name: str, tokens: Column) -> Column:
        words = F.array_distinct(F.array_compact(tokens))
        return F.transform(
            words,
            lambda w: F.struct(
                F.concat(F.lit(f"{name}:"), w).alias("token"),
                (1 / F.sqrt(F.size(words))).alias("weight"),
            ),
        )

    sets = [entries(name, tokens) for name, tokens in parts.items()]
    return df.select(row_id, F.inline(F.concat(*sets)))


def content_neighbors(df: DataFrame, row_id: str, parts: dict[str, Column], k: int) -> DataFrame:
    """Nearest rows by the sum over parts of the cosine distance of their token sets.

    Each part has length 1, so the sum is the number of parts minus one dot
    product. Rows ``(item, neighbor, distance, rank)``.
    """
    best = sparse_topk(content_rows(df, row_id, parts), row_id, "token", "weight", k)
    return best.select(
        "item",
        F.col("other").alias("neighbor"),
        (F.lit(float(len(parts))) - F.col("score")).alias("distance"),
        "rank",
    )


def content_predict(
    df: DataFrame, row_id: str, parts: dict[str, Column], score: str, k: int = 10
) -> DataFrame:
    """Mean score of the ``k`` nearest rows beside the actual score."""
    near = materialize(content_neighbors(df, row_id, parts, k), "near")  # counted before it is joined
    known = df.select(F.col(row_id).alias("neighbor"), F.col(score).alias("__s"))
    means = lookup_join(near, known, ["neighbor"]).groupBy("item").agg(F.avg("__s").alias("predicted"))
    actual = df.select(F.col(row_id).alias("item"), F.col(score).alias("actual"))
    return actual.join(means, "item")
