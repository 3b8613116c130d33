"""Byte-level BPE by tree reduction.

Encoding is a reduction over a tree of halves. On the outer level the halves of a text are
split into pieces (matches of the pattern); on the inner level the halves of a piece are
encoded into tokens. Two neighbours are joined by redoing a window around their border,
which grows until what lies outside provably stays:

* pieces: a match depends on the text from its start on, no further than one character
  past its end and three past its start, so all but the last two pieces of the left half
  stay; the right half stays from the first place where the new split meets the old one;
* tokens: a row of tokens is the encoding of its bytes if and only if that holds for every
  two neighbours, so the window may stop as soon as its ends fit the tokens outside.

Decoding concatenates up the same tree.
"""

from __future__ import annotations

import base64
import heapq
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LEAF_CHARS = 1 << 14  # texts up to this length are split at once
LEAF_BYTES = 24  # pieces up to this length are merged at once
LEAF_TOKENS = 1 << 16
CACHE = 300_000  # pieces and pairs remembered per worker


class _Pieces(dict):
    """Tokens of a piece as packed 32-bit numbers, worked out when first asked for."""

    def __init__(self, tokens):
        self.tokens = tokens

    def __missing__(self, piece: str) -> bytes:
        packed = np.array(self.tokens(piece.encode()), np.int32).tobytes()
        if len(piece) <= 64:
            if len(self) >= CACHE:
                self.clear()
            self[piece] = packed
        return packed


class Codec:
    """Ranks (bytes to id) and a pattern; encodes one text after the other."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks = ranks
        self.bytes_of = {i: b for b, i in ranks.items()}
        self.pattern = regex.compile(pattern)
        self.pieces = _Pieces(self._tokens)
        self.pairs: dict[tuple[int, int], bool] = {}

    def encode(self, text: str) -> np.ndarray:
        return np.frombuffer(b"".join(map(self.pieces.__getitem__, self._split(text))), np.int32)

    def decode(self, ids: np.ndarray) -> bytes:
        if len(ids) <= LEAF_TOKENS:
            return b"".join(map(self.bytes_of.__getitem__, ids.tolist()))
        half = len(ids) // 2
        return self.decode(ids[:half]) + self.decode(ids[half:])

    def _split(self, text: str) -> list[str]:
        return self._pieces_of(text, 0, len(text))

    def _pieces_of(self, text: str, low: int, high: int) -> list[str]:
        """The pieces of ``text[low:high]``."""
        if high - low <= LEAF_CHARS:
            return self.pattern.findall(text, low, high)
        middle = (low + high) // 2
        left, right = self._pieces_of(text, low, middle), self._pieces_of(text, middle, high)
        sure, window = left[:-2], []
        i, start = 0, middle  # a piece of the right half and where it begins
        for match in self.pattern.finditer(text, middle - sum(map(len, left[-2:])), high):
            at = match.start()
            while start < at:
                start += len(right[i])
                i += 1
            if start == at:
                return sure + window + right[i:]
            window.append(match[0])
        return sure + window

    def _tokens(self, piece: bytes) -> list[int]:
        whole = self.ranks.get(piece)
        if whole is not None:
            return [whole]
        if len(piece) <= LEAF_BYTES:
            return self._merge(piece)
        half = len(piece) // 2
        return self._join(self._tokens(piece[:half]), self._tokens(piece[half:]))

    def _join(self, left: list[int], right: list[int]) -> list[int]:
        if self._fit(left[-1], right[0]):
            return left + right
        i, j = 1, 1  # tokens of either side inside the window
        while True:
            inside = self._merge(b"".join([self.bytes_of[t] for t in left[-i:] + right[:j]]))
            grow_left = i < len(left) and not self._fit(left[-i - 1], inside[0])
            grow_right = j < len(right) and not self._fit(inside[-1], right[j])
            if not grow_left and not grow_right:
                return left[: len(left) - i] + inside + right[j:]
            if grow_left:
                i = min(2 * i, len(left))
            if grow_right:
                j = min(2 * j, len(right))

    def _fit(self, a: int, b: int) -> bool:
        """Whether the bytes of two tokens side by side are encoded as these tokens."""
        fit = self.pairs.get((a, b))
        if fit is None:
            if len(self.pairs) >= CACHE:
                self.pairs.clear()
            fit = self.pairs[a, b] = self._merge(self.bytes_of[a] + self.bytes_of[b]) == [a, b]
        return fit

    def _merge(self, data: bytes) -> list[int]:
        """Merge the pair of lowest rank, the leftmost first, until there is none."""
        ranks = self.ranks
        if len(data) > 64:
            return self._merge_long(data)
        parts = [data[i : i + 1] for i in range(len(data))]
        found = [ranks.get(data[i : i + 2]) for i in range(len(data) - 1)]
        while True:
            best, at = None, -1
            for i, r in enumerate(found):
                if r is not None and (best is None or r < best):
                    best, at = r, i
            if best is None:
                return [ranks[p] for p in parts]
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
            del found[at]
            if at < len(found):
                found[at] = ranks.get(parts[at] + parts[at + 1])
            if at:
                found[at - 1] = ranks.get(parts[at - 1] + parts[at])

    def _merge_long(self, data: bytes) -> list[int]:
        """The same with a heap, for windows of many bytes."""
        ranks, n = self.ranks, len(data)
        ends = list(range(1, n + 1))  # end of the part that starts here, 0 once merged away
        before = list(range(-1, n - 1))
        heap = [(r, i, i + 2) for i in range(n - 1) if (r := ranks.get(data[i : i + 2])) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, stop = heapq.heappop(heap)
            middle = ends[i]
            if not middle or middle >= n or ends[middle] != stop:
                continue
            ends[i], ends[middle] = stop, 0
            if stop < n:
                before[stop] = i
                if (r := ranks.get(data[i : ends[stop]])) is not None:
                    heapq.heappush(heap, (r, i, ends[stop]))
            h = before[i]
            if h >= 0 and (r := ranks.get(data[h:stop])) is not None:
                heapq.heappush(heap, (r, h, stop))
        out, i = [], 0
        while i < n:
            out.append(ranks[data[i : ends[i]]])
            i = ends[i]
        return out


def read_ranks(path: str) -> dict[bytes, int]:
    """Ranks from a file of lines ``base64 id``."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


_CODECS: dict[int, Codec] = {}  # of this worker, so that tasks share what they have learned


class SharedCodec:
    """A vocabulary sent to the tasks once; its size does not depend on the texts."""

    def __init__(self, spark, path: str, pattern: str):
        self.key = uuid.uuid4().hex  # an address could be used again by another vocabulary
        self.sent = spark.sparkContext.broadcast((read_ranks(path), pattern))

    def codec(self) -> Codec:
        if self.key not in _CODECS:
            _CODECS.clear()
            _CODECS[self.key] = Codec(*self.sent.value)
        return _CODECS[self.key]


def _lists(values: list[np.ndarray]) -> pa.ListArray:
    offsets = np.concatenate([[0], np.cumsum([len(v) for v in values])]).astype(np.int32)
    flat = np.concatenate(values) if values else np.empty(0, np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))


def encode_texts(docs: DataFrame, vocabulary: SharedCodec, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows ``(id, ids array<int>)``, one per row of ``docs``.

    Special tokens are ordinary text. A null or empty text gives an empty list; repeated
    rows and null ids are kept; other columns are ignored. An empty table gives no rows.
    Each row is encoded where it lies: nothing is shuffled.
    """

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = vocabulary.codec()
        for batch in batches:
            for part in _slices(batch, 2000):
                ids = [codec.encode(t or "") for t in part.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column("id"), _lists(ids)], ["id", "ids"])

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(encode, f"id {rows.schema['id'].dataType.simpleString()}, ids array<int>")


def decode_ids(encoded: DataFrame, vocabulary: SharedCodec) -> DataFrame:
    """Add ``decoded``, the bytes that ``ids`` stand for, to rows ``(id, ids)``; null counts as empty."""

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = vocabulary.codec()
        for batch in batches:
            for part in _slices(batch, 2000):
                ids = part.column("ids").fill_null([])
                flat, ends = ids.flatten().to_numpy(zero_copy_only=False), np.cumsum(ids.value_lengths().to_numpy(zero_copy_only=False))
                starts = np.append(0, ends)
                out = [codec.decode(flat[a:b]) for a, b in zip(starts.tolist(), ends.tolist())]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(out, pa.binary())], ["id", "ids", "decoded"])

    rows = encoded.select("id", "ids")
    return rows.mapInArrow(decode, f"id {rows.schema['id'].dataType.simpleString()}, ids array<int>, decoded binary")


def _slices(batch: pa.RecordBatch, rows: int) -> Iterator[pa.RecordBatch]:
    for at in range(0, batch.num_rows, rows):
        yield batch.slice(at, rows)
