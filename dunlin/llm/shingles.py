"""Word shingles of texts as sorted 64-bit numbers; numpy only, used inside tasks."""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np

CHUNK = 1 << 20  # bytes hashed at a time: bounds the 8-byte arrays made from a text

_SPACES = b"\x09\x0a\x0b\x0c\x0d\x20"
_STEP = 0x9E3779B97F4A7C15
_MASK = (1 << 64) - 1
_MIX = np.uint64(0xBF58476D1CE4E5B9)


def _byte_table() -> np.ndarray:
    """A 64-bit number for each byte: A-Z as a-z, 0 for white space."""
    raw = b"".join(hashlib.blake2b(bytes([b]).lower(), digest_size=8).digest() for b in range(256))
    table = np.frombuffer(raw, np.uint64).copy()
    table[list(_SPACES)] = 0
    return table


def _powers(base: int) -> np.ndarray:
    out = np.full(CHUNK + 1, base & _MASK, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


_TABLE = _byte_table()
_IS_WORD = np.ones(258, bool)
_IS_WORD[list(_SPACES)] = False
_POWERS, _INVERSES = _powers(_STEP), _powers(pow(_STEP, -1, 1 << 64))


def _mixed(x: np.ndarray) -> np.ndarray:
    x ^= x >> np.uint64(32)
    x *= _MIX
    x ^= x >> np.uint64(29)
    return x


def _codes(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and code of every word in at most ``CHUNK + 1`` bytes."""
    word = np.zeros(len(data) + 1, bool)
    word[1:] = _IS_WORD[data]
    starts = np.flatnonzero(word[1:] & ~word[:-1])
    if not len(starts):
        return starts, np.empty(0, np.uint64)
    terms = _TABLE[data]
    terms *= _POWERS[: len(data)]
    return starts, _mixed(np.add.reduceat(terms, starts) * _INVERSES[starts])


def word_codes(text: bytes | None) -> np.ndarray:
    """A 64-bit code for each word: a run of bytes other than space and \\x09-\\x0D.

    A-Z count as a-z. A word longer than ``CHUNK`` bytes is coded by its digest.
    """
    if not text:
        return np.empty(0, np.uint64)
    if len(text) <= CHUNK:
        return _codes(np.frombuffer(text, np.uint8))[1]
    parts, at = [], 0
    while at < len(text):
        end = min(at + CHUNK, len(text))
        if end < len(text):
            cut = max(text.rfind(bytes([s]), at, end + 1) for s in _SPACES)
            if cut < 0:  # one word fills the chunk
                after = [i for s in _SPACES if (i := text.find(bytes([s]), end)) >= 0]
                stop = min(after, default=len(text))
                start = at + len(text[at:end]) - len(text[at:end].lstrip(_SPACES))
                digest = hashlib.blake2b(text[start:stop].lower(), digest_size=8).digest()
                parts.append(np.frombuffer(digest, np.uint64))
                at = stop
                continue
            end = cut + 1
        parts.append(_codes(np.frombuffer(text, np.uint8, end - at, at))[1])
        at = end
    return np.concatenate(parts)


def _sets(codes: np.ndarray, bounds: np.ndarray, size: int) -> Iterator[np.ndarray]:
    """Shingle sets of the texts whose words are ``codes[bounds[i]:bounds[i + 1]]``."""

    def combined(width: int, part: np.ndarray) -> np.ndarray:
        count = len(part) - width + 1
        total = np.full(count, width, np.uint64)
        for i in range(width):
            total *= np.uint64(_STEP)
            total += part[i : i + count]
        return _mixed(total)

    whole = combined(size, codes) if len(codes) >= size else codes[:0]
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
        n = b - a
        if not n:
            yield codes[:0]
        elif n < size:
            yield combined(n, codes[a:b])
        else:
            values = np.sort(whole[a : b - size + 1])
            keep = np.empty(len(values), bool)
            keep[0] = True
            np.not_equal(values[1:], values[:-1], out=keep[1:])
            yield values[keep]


def shingle_sets(texts: Iterable[bytes | None], size: int = 5) -> Iterator[np.ndarray]:
    """Per text the distinct shingles of ``size`` words, sorted.

    A text with fewer words is one shingle; null or no word gives an empty set.
    Short texts are hashed together, about ``CHUNK`` bytes at a time.
    """
    held: list[bytes] = []
    room = CHUNK
    for text in texts:
        text = text or b""
        if len(text) >= room:
            yield from _together(held, size)
            held, room = [], CHUNK
            if len(text) >= CHUNK:
                codes = word_codes(text)
                yield from _sets(codes, np.array([0, len(codes)]), size)
                continue
        held.append(text)
        room -= len(text) + 1
    yield from _together(held, size)


def _together(texts: list[bytes], size: int) -> Iterator[np.ndarray]:
    if texts:
        joined = b" ".join(texts)
        starts, codes = _codes(np.frombuffer(joined, np.uint8))
        ends = np.cumsum([0] + [len(t) + 1 for t in texts])
        yield from _sets(codes, np.searchsorted(starts, ends), size)


def set_key(shingles: np.ndarray) -> int:
    """Signed 64-bit key of a whole set."""
    digest = hashlib.blake2b(shingles.tobytes(), digest_size=8).digest()
    return int.from_bytes(digest, "little", signed=True)
