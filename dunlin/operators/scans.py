"""Products too many to be shuffled: a task of some owners reads the whole other table and keeps their products.

The other table is written once in chunks of plain arrays. Every task streams it past its own
share, so that nothing but results leaves a task and the disk holds no copies of either side.
Owners and products are numbers in arrays: one *entry* is an owner with a run of products.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.fs
import pyarrow.parquet as pq
from pyspark.sql import DataFrame

FILE_VALUES = 800_000  # rows of the other table in a file, which a task holds at a time
TASK_PRODUCTS = 3_500_000  # products that a task holds, on average
LEAST_PRODUCTS = 200_000  # products that are worth a task of their own
GROUP_PRODUCTS = 1 << 18  # products that are sorted at a time, but for an owner of more
GROUP_OWNERS = 1 << 12


def scan_tasks(df: DataFrame, products: float) -> int:
    """Tasks to deal ``products`` to; a task is a whole reading of the other table."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return max(1, math.ceil(products / TASK_PRODUCTS), min(2 * cores, math.ceil(products / LEAST_PRODUCTS)))


def scan_files(df: DataFrame, rows: int) -> int:
    """Files in which ``rows`` are written for tasks to read."""
    return max(df.sparkSession.sparkContext.defaultParallelism, math.ceil(rows / FILE_VALUES))


def tables(files: Sequence[str]) -> Iterator[pa.Table]:
    """The Parquet files of a written table one after the other; the shared folder must be one that Arrow can open."""
    for uri in files:
        system, path = pa.fs.FileSystem.from_uri(uri)
        with system.open_input_file(path) as file:
            yield pq.read_table(file, use_threads=False)


def runs(first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Places ``first .. first + size - 1`` of all runs, one after the other."""
    return np.repeat(first - (size.cumsum() - size), size) + np.arange(size.sum())


def places(major: np.ndarray, minor: np.ndarray) -> np.ndarray:
    """Order of rows by two whole numbers, ``major`` from 0; equal ones as they stand."""
    if not len(major):
        return np.zeros(0, int)
    low, bits = int(minor.min()), len(major).bit_length()
    span = int(minor.max()) - low + 1
    if (int(major.max()) + 1) * span < 1 << (63 - bits):  # in one number with the place, which sorts fast
        packed = (major.astype("int64") * span + (minor - low) << bits) | np.arange(len(major))
        packed.sort()
        return packed & ((1 << bits) - 1)
    return np.lexsort((minor, major))


class Products:
    """Products held by a task, as entries ``(owner, size, *own values)`` with runs of ``(other, value)``."""

    def __init__(self) -> None:
        self.parts: list[tuple] = []

    def add(self, owner: np.ndarray, size: np.ndarray, own: np.ndarray, other: np.ndarray, value: np.ndarray) -> None:
        if len(other):
            self.parts.append((owner, size, own, other, value))

    def by_owner(self) -> Iterator[tuple[np.ndarray, ...]]:
        """Groups of whole owners: ``(owners, owner's place, own value, other, value)``, a row per product."""
        if not self.parts:
            return
        columns = [list(c) for c in zip(*self.parts)]
        self.parts = []
        owner, size, own, other, value = (np.concatenate([columns[i], columns.__setitem__(i, None)][0]) for i in range(5))
        first = size.cumsum() - size
        names, at = np.unique(owner, return_inverse=True)
        order = np.argsort(at, kind="stable")
        ends = np.bincount(at, weights=size, minlength=len(names)).cumsum().astype("int64")
        entries = np.bincount(at, minlength=len(names)).cumsum()
        start = 0
        while start < len(names):
            done = ends[start - 1] if start else 0
            stop = min(max(start + 1, int(np.searchsorted(ends, done + GROUP_PRODUCTS, "right"))), start + GROUP_OWNERS)
            e = order[entries[start - 1] if start else 0 : entries[stop - 1]]
            line = np.repeat(e, size[e])
            run = runs(first[e], size[e])
            yield names[start:stop], at[line] - start, own[line], other[run], value[run]
            start = stop


def summed(owner: np.ndarray, other: np.ndarray, *values: np.ndarray) -> tuple[np.ndarray, ...]:
    """Sums of ``values`` by owner and other, in this order."""
    order = places(owner, other)
    owner, other = owner[order], other[order]
    new = np.ones(len(owner), bool)
    new[1:] = (owner[1:] != owner[:-1]) | (other[1:] != other[:-1])
    first = np.flatnonzero(new)
    return owner[first], other[first], *[np.add.reduceat(v[order], first) if len(first) else v for v in values]


def best_of_each(owner: np.ndarray, score: np.ndarray, k: int, digits: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and ranks of the ``k`` rows of highest score of each owner; of equal ones those that stand first."""
    if not len(owner):
        return np.zeros(0, int), np.zeros(0, int)
    if np.abs(score).max() < 1e6:
        order = places(owner, -np.rint(score * 10**digits).astype("int64"))
    else:
        order = np.lexsort((-score, owner))
    ordered = owner[order]
    new = np.ones(len(owner), bool)
    new[1:] = ordered[1:] != ordered[:-1]
    rank = np.arange(len(owner)) - np.maximum.accumulate(np.where(new, np.arange(len(owner)), 0))
    return order[rank < k], rank[rank < k] + 1
