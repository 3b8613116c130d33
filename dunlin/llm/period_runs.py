"""Runs of periodic words, found with a dictionary of basic factors.

Level ``k`` of the dictionary names every factor of ``2 ** k`` words; equal factors of a text have
equal names, and a factor that stands once has none. Factors of level ``k + 1`` are pairs of
names, so only places where both halves are repeated go on. Where an occurrence, its
successor and the next one are equally far apart, by at most twice the length, they form an
arithmetic progression, which proposes its difference as a period. The dictionary extends each
proposal to both ends; a stretch that several periods propose belongs to the smallest.

A run of period q has 4 q words or more. At the level with ``2 ** k / 2 < q <= 2 ** k`` a factor
inside the run has its successor exactly q words on (a smaller distance would be a smaller
period), three times at least, so every run is proposed.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LEAST_WORDS = 6  # words of the shortest run
LEAST_REPEATS = 4  # periods of the shortest run
BATCH_WORDS = 1 << 18  # texts are searched together up to so many words

_MIX = np.uint64(0x9E3779B97F4A7C15)


def _names(codes: np.ndarray) -> np.ndarray:
    """A number from 0 for every code that occurs twice or more, -1 for the others."""
    _, inverse, counts = np.unique(codes, return_inverse=True, return_counts=True)
    fresh = np.where(counts > 1, np.cumsum(counts > 1) - 1, -1).astype(np.int32)
    return fresh[inverse]


def _levels(words: np.ndarray, text: np.ndarray, longest: int) -> list[np.ndarray]:
    """The dictionary: per level a name for each place, -1 where the factor is unique or leaves its text.

    The arrays are longer than ``words`` by one entry of -1 per text, which ends it.
    """
    size = len(words) + int(text[-1]) + 1 if len(words) else 0
    place = np.arange(len(words)) + text
    with np.errstate(over="ignore"):
        codes = (words.view(np.uint64) ^ (text.astype(np.uint64) * _MIX)) * _MIX
    first = np.full(size, -1, np.int32)
    first[place] = _names(codes)
    out, at, length = [], np.flatnonzero(first >= 0), 1
    level = first
    # Periods are at most a quarter of a text: longer factors propose none.
    while len(at):
        out.append(level)
        if length * LEAST_REPEATS >= longest:
            break
        at = at[at + length < size]
        at = at[level[at + length] >= 0]
        pair = level[at].astype(np.int64) * size + level[at + length]
        after = np.full(size, -1, np.int32)
        after[at] = _names(pair)
        at, level, length = at[after[at] >= 0], after, 2 * length
    return out


def _proposals(level: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and periods of the progressions among the factors of one level, the first place of each stretch."""
    at = np.flatnonzero(level >= 0)
    size = len(level)
    order = np.sort(level[at].astype(np.int64) * size + at)
    name, at = order // size, order % size
    gap = np.where(name[1:] == name[:-1], at[1:] - at[:-1], 0)
    found = (gap[:-1] == gap[1:]) & (gap[1:] > 0) & (gap[1:] <= 2 * length)
    period = np.zeros(size + 1, np.int64)
    period[at[:-2][found]] = gap[:-1][found]
    start = np.flatnonzero((period > 0) & (period != np.roll(period, 1)))
    return start, period[start]


def _equal_length(levels: list[np.ndarray], a: np.ndarray, b: np.ndarray, step: int) -> np.ndarray:
    """How many words from ``a`` and ``b`` on are equal, forwards or (``step`` -1) before them backwards."""
    done = np.zeros(len(a), np.int64)
    for k in reversed(range(len(levels))):
        length, level = 1 << k, levels[k]
        back = length if step < 0 else 0
        going = np.arange(len(a))
        while len(going):
            x, y = a[going] + step * done[going] - back, b[going] + step * done[going] - back
            fit = (x >= 0) & (y < len(level))
            going, x, y = going[fit], x[fit], y[fit]
            going = going[(level[x] >= 0) & (level[x] == level[y])]
            done[going] += length
            if k < len(levels) - 1:  # a second step would have been one of the level above
                break
    return done


def find_runs(words: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Text, start, length and period of every run, by text, start and period.

    ``words`` holds 64-bit codes of the words of several texts, text ``i`` at
    ``bounds[i]:bounds[i + 1]``.
    """
    none = np.zeros(0, np.int64)
    sizes = np.diff(bounds)
    text = np.repeat(np.arange(len(sizes)), sizes)
    levels = _levels(words, text, int(sizes.max(initial=0)))
    found = [_proposals(level, 1 << k) for k, level in enumerate(levels)]
    at = np.concatenate([none, *(f[0] for f in found)])
    period = np.concatenate([none, *(f[1] for f in found)])
    if not len(at):
        return none, none, none, none
    start = at - _equal_length(levels, at, at + period, -1)
    length = at - start + period + _equal_length(levels, at, at + period, 1)
    long = length >= np.maximum(LEAST_WORDS, LEAST_REPEATS * period)
    start, length, period = start[long], length[long], period[long]
    order = np.lexsort((period, length, start))
    start, length, period = start[order], length[order], period[order]
    new = np.ones(len(start), bool)
    new[1:] = (start[1:] != start[:-1]) | (length[1:] != length[:-1])
    start, length, period = start[new], length[new], period[new]
    owner = np.searchsorted(bounds[1:] + np.arange(len(sizes)), start, side="right")
    start = start - bounds[owner] - owner
    order = np.lexsort((period, start, owner))
    return owner[order], start[order], length[order], period[order]


def collapsed(words: list[bytes], start: np.ndarray, length: np.ndarray, period: np.ndarray) -> bytes:
    """The words that no run holds after its first period, joined by one space."""
    if not len(start):
        return b" ".join(words)
    depth = np.zeros(len(words) + 1, np.int64)
    np.add.at(depth, start + period, 1)
    np.add.at(depth, start + length, -1)
    return b" ".join(itertools.compress(words, (np.cumsum(depth)[:-1] == 0).tolist()))


def _batches(texts: list[bytes | None]) -> Iterator[list[list[bytes]]]:
    held, n = [], 0
    for text in texts:
        words = (text or b"").split()  # bytes split at \x20 and \x09-\x0D
        if n and n + len(words) > BATCH_WORDS:
            yield held
            held, n = [], 0
        held.append(words)
        n += len(words)
    if held:
        yield held


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows ``(id, n_words, runs, collapsed)``, one per row of ``docs``.

    Words are runs of characters other than space and \\x09-\\x0D. A run ``(start, length,
    period)`` is a stretch of at least 6 words and 4 periods in which words one period apart
    are equal, with its smallest period, that neither neighbour extends. Runs stand in order of
    start and period. ``collapsed`` keeps of each run the first period.

    A null or empty text has no words and no runs. Texts are whole; one text is one task's
    work and needs a few numbers per word and level of its repeats. Words are compared by
    64-bit codes. Repeated rows are searched one by one, a null id is like any other, other
    columns are ignored. An empty table gives no rows.
    """
    kind = "id long, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string"
    run = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            for held in _batches(batch.column("text").cast(pa.binary()).to_pylist()):
                sizes = np.array([len(w) for w in held], np.int64)
                bounds = np.append(0, np.cumsum(sizes))
                every = itertools.chain.from_iterable(held)
                codes = np.fromiter(map(hash, every), np.int64, int(bounds[-1]))
                owner, *spans = find_runs(codes, bounds)
                ends = np.searchsorted(owner, np.arange(len(held) + 1))
                texts = [collapsed(w, *(s[a:b] for s in spans)) for w, a, b in zip(held, ends[:-1], ends[1:])]
                found = pa.StructArray.from_arrays([pa.array(s, pa.int64()) for s in spans], fields=list(run))
                columns = [
                    batch.column("id").slice(at, len(held)),
                    pa.array(sizes),
                    pa.ListArray.from_arrays(pa.array(ends, pa.int32()), found),
                    pa.array(texts, pa.binary()).cast(pa.string()),
                ]
                at += len(held)
                yield pa.RecordBatch.from_arrays(columns, ["id", "n_words", "runs", "collapsed"])

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(search, kind)
