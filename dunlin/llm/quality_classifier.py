"""Quality classifier: nearest-neighbour voting among latent-semantic vectors.

A text is a row of a term matrix: hashed words, weighted by their rarity over all documents,
its bytes below 128, and a few shape numbers spread over buckets. A truncated SVD of labelled
rows turns terms into a short vector. The labelled vectors, bounded in number, go to all
tasks; every document meets all of them in exact blocked cosine products. Votes lean to the
larger class; each labelled row's vote by the others shows where the classes part, and a
monotone map moves that vote to ``CUT``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dunlin.llm.shingles import shingle_sets, word_codes
from dunlin.session import materialize

LABELLED = 2048  # labelled rows of either class that are voted with: the bound of the fit
WORDS = 2048  # buckets of the hashed words
LATENT = 48
NEIGHBOURS = 25
CUT = 0.3  # scores from here on are called good
SHARPNESS = 8  # a neighbour's weight is its similarity to this power
BLOCK = 512  # documents multiplied at a time

_BUCKETS = 9
_SHAPES = 5
WIDTH = WORDS + 128 + _SHAPES * _BUCKETS


def _spread(x: float) -> np.ndarray:
    """A number from 0 to 1 as weights of the two nearest of ``_BUCKETS`` marks."""
    at = min(max(x, 0.0), 1.0) * (_BUCKETS - 1)
    low = min(int(at), _BUCKETS - 2)
    out = np.zeros(_BUCKETS, np.float32)
    out[low : low + 2] = 1 - (at - low), at - low
    return out


def _terms(texts: list[bytes | None], rarity: np.ndarray | None) -> np.ndarray:
    """Rows of the term matrix; with no ``rarity`` just 0/1 for the hashed words."""
    out = np.zeros((len(texts), WORDS if rarity is None else WIDTH), np.float32)
    if rarity is None:
        for row, text in zip(out, texts):
            row[np.unique(word_codes(text) % np.uint64(WORDS)).astype(int)] = 1
        return out
    for row, text, triples in zip(out, texts, shingle_sets(texts, 3)):
        codes = word_codes(text)
        n = len(codes)
        counts = np.bincount((codes % np.uint64(WORDS)).astype(int), minlength=WORDS)
        words = np.log1p(counts) * rarity
        row[:WORDS] = 0.3 * words / max(float(np.linalg.norm(words)), 1e-9)
        raw = np.frombuffer(text or b"", np.uint8)
        histogram = np.sqrt(np.bincount(raw[raw < 128], minlength=128))
        row[WORDS : WORDS + 128] = histogram / max(float(np.linalg.norm(histogram)), 1e-9)
        lines = [line for line in (text or b"").split(b"\n") if line.strip()]
        shapes = (
            len(triples) / max(n - 2, 1),
            len(np.unique(codes)) / max(n, 1),
            np.log1p(n) / 12,
            len(set(lines)) / max(len(lines), 1),
            len(raw) / max(n, 1) / 16,
        )
        row[WORDS + 128 :] = 0.5 * np.concatenate([_spread(float(s)) for s in shapes])
    return out


def _texts(batch: pa.RecordBatch) -> list[bytes | None]:
    return batch.column("text").cast(pa.binary()).to_pylist()


def document_rarity(texts: DataFrame) -> np.ndarray:
    """Inverse document frequency of the word buckets over all documents.

    Tasks return one vector each; Spark adds them up, one row per bucket.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = np.zeros(WORDS, np.int64), 0
        for batch in batches:
            rows = _texts(batch)
            n += len(rows)
            for at in range(0, len(rows), BLOCK):
                held += _terms(rows[at : at + BLOCK], None).sum(axis=0).astype(np.int64)
        buckets = pa.array(np.arange(-1, WORDS), pa.int32())
        yield pa.RecordBatch.from_arrays([buckets, pa.array(np.append(n, held), pa.int64())], ["bucket", "n"])

    sums = texts.mapInArrow(count, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    found = np.zeros(WORDS + 1, np.float64)
    for r in sums.collect():  # WORDS + 1 rows
        found[r["bucket"] + 1] = r["n"]
    return np.log((1 + found[0]) / (1 + found[1:])) + 1


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-9)


def _latent_basis(rows: np.ndarray, width: int, seed: int = 0) -> np.ndarray:
    """Leading right singular vectors, by subspace iteration."""
    rng = np.random.default_rng(seed)
    width = min(width, *rows.shape)
    basis = np.linalg.qr(rng.standard_normal((rows.shape[1], width)).astype(np.float32))[0]
    for _ in range(8):
        basis = np.linalg.qr(rows.T @ (rows @ basis))[0]
    return basis


class NeighbourModel:
    """Labelled latent vectors, the projection and the word rarities: bounded in size."""

    def __init__(self, rarity: np.ndarray, terms: np.ndarray, labels: np.ndarray, says: np.ndarray | None = None):
        """``says`` is how many labelled rows each of these stands for; 1 if absent."""
        self.rarity, self.labels = rarity, labels.astype(np.float32)
        self.says = np.ones(len(labels)) if says is None else says
        self.basis = _latent_basis(terms, LATENT) if len(terms) else np.zeros((WIDTH, 1), np.float32)
        self.vectors = _unit(terms @ self.basis)
        self.cut = best_cut(self._left_out_votes(), self.labels) if len(terms) else CUT

    def _votes(self, cosine: np.ndarray, voters: np.ndarray | None = None) -> np.ndarray:
        """Weighted label of the nearest voters; row ``i`` of ``voters`` numbers those of row ``i``, else all vote."""
        k = min(NEIGHBOURS, cosine.shape[1])
        near = np.argpartition(-cosine, k - 1, axis=1)[:, :k]
        weight = np.maximum(np.take_along_axis(cosine, near, axis=1), 1e-3).astype(np.float64) ** SHARPNESS
        voter = near if voters is None else np.take_along_axis(voters, near, axis=1)
        weight *= self.says[voter]
        return np.clip((weight * self.labels[voter]).sum(axis=1) / weight.sum(axis=1), 0.0, 1.0)

    def _left_out_votes(self) -> np.ndarray:
        """The vote on each labelled row by all the others."""
        n = len(self.labels)
        if n < 2:
            return self.labels.astype(np.float64)
        votes = np.zeros(n)
        for at in range(0, n, BLOCK):
            rows = np.arange(at, min(at + BLOCK, n))
            others = np.arange(n - 1)[None, :]
            others = others + (others >= rows[:, None])  # every number but the row's own
            votes[rows] = self._votes(np.take_along_axis(self.vectors[rows] @ self.vectors.T, others, axis=1), others)
        return votes

    def scores(self, texts: list[bytes | None]) -> np.ndarray:
        if not len(self.labels):
            return np.full(len(texts), 0.5)
        votes = self._votes(_unit(_terms(texts, self.rarity) @ self.basis) @ self.vectors.T)
        return np.interp(votes, [0.0, self.cut, 1.0], [0.0, CUT, 1.0])


def best_cut(votes: np.ndarray, labels: np.ndarray) -> float:
    """The vote that parts the labels best, both classes counting alike; ``CUT`` if none is better than it.

    Among equally good cuts the one in the widest gap is taken, in its middle.
    """
    good = labels > 0.5
    if good.all() or not good.any():
        return CUT
    order = np.argsort(votes, kind="stable")
    sorted_votes, ones = votes[order], good[order]
    below = np.cumsum(~ones) / (~ones).sum()
    above = 1 - np.cumsum(ones) / ones.sum()
    gap = np.diff(sorted_votes)
    right = np.where(gap > 0, (below + above)[:-1], 0.0)
    now = (votes[~good] < CUT).mean() + (votes[good] >= CUT).mean()
    if not len(right) or right.max() <= now + 1e-9:
        return CUT
    best = np.flatnonzero(right >= right.max() - 1e-9)
    at = best[np.argmax(gap[best])]
    return float(np.clip((sorted_votes[at] + sorted_votes[at + 1]) / 2, 1e-6, 1 - 1e-6))


def held_out(id_col: str = "doc_id"):
    """Rows whose id has a CRC-32 divisible by 5: never learned from."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def fit_quality(docs: DataFrame, labels: DataFrame, per_class: int = LABELLED) -> NeighbourModel:
    """Fit on at most ``per_class`` labelled rows of either quality, chosen by a hash of the id.

    ``docs`` has ``doc_id, text``, ``labels`` has ``doc_id, quality``. Null ids and labels and
    held-out rows are left out, and labels without a document, before any are chosen. A chosen row
    votes for as many as its class has labelled rows per chosen one, so the bound does not
    change the share of a class. Word rarities come from all documents. Texts are not shuffled:
    ids are, and the chosen ids go to the tasks. Of several texts under one labelled id the
    smallest votes. Empty tables give a model without votes.
    """
    texts = docs.select(F.col("text").cast("string").alias("text"))
    rarity = document_rarity(texts)
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality"))
    known = known.where(~held_out() & F.col("doc_id").isNotNull() & F.col("quality").isin(0, 1)).distinct()
    ids = docs.select(F.col("doc_id").cast("long").alias("doc_id")).where("doc_id is not null").distinct()
    known = materialize(known.join(ids, "doc_id", "left_semi"), "labelled")
    counted = {r["quality"]: r["count"] for r in known.groupBy("quality").count().collect()}  # 2 rows
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    chosen = [r for q in (0, 1) for r in known.where(F.col("quality") == q).orderBy(*order).limit(per_class).collect()]
    if not chosen:
        return NeighbourModel(rarity, np.zeros((0, WIDTH), np.float32), np.zeros(0))
    wanted = docs.sparkSession.createDataFrame(chosen, known.schema)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    picked = rows.join(F.broadcast(wanted), "doc_id")  # at most 2 * per_class rows
    # At most a row per id and task: one text of a repeated id, the same one on every run.
    picked = picked.groupBy("doc_id", "quality").agg(F.min("text").alias("text"))

    def terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [r.tobytes() for r in _terms(_texts(batch), rarity)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("quality"), pa.array(rows, pa.binary())], ["doc_id", "quality", "row"]
            )

    found = picked.mapInArrow(terms, "doc_id long, quality int, row binary").orderBy("doc_id", "quality").collect()
    matrix = np.stack([np.frombuffer(r["row"], np.float32) for r in found]) if found else np.zeros((0, WIDTH), np.float32)
    voters = np.array([r["quality"] for r in found])
    says = np.ones(len(voters))
    for q, n in counted.items():
        says[voters == q] = n / max(1, (voters == q).sum())
    return NeighbourModel(rarity, matrix, voters, says)


def score_quality(docs: DataFrame, model: NeighbourModel, text_col: str = "text") -> DataFrame:
    """All columns of ``docs`` and ``score``, 0 to 1, higher for likelier good texts.

    Every document is compared with all labelled vectors. A null or empty text has the
    vector of its length and is scored like others. With no labelled rows all scores are
    0.5. Repeated rows get equal scores. A column ``score`` of ``docs`` is replaced.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def score(texts):
        import pandas as pd

        rows = [t.encode() if isinstance(t, str) else None for t in texts]
        parts = [sent.value.scores(rows[i : i + BLOCK]) for i in range(0, len(rows), BLOCK)]
        return pd.Series(np.concatenate(parts) if parts else np.zeros(0))

    return docs.withColumn("score", score(F.col(text_col).cast("string")))
