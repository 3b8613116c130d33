"""Bit-parallel wildcard automaton over URLs (multiword Shift-And).

All glob patterns are laid one after the other into the bits of a few 64-bit words. One
step per character moves every pattern of every URL of a batch at once. Rules read host
and path as they stand; the blocking globs read the canonical form, so that escapes,
capitals, ports or dot segments hide nothing.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from urllib.parse import unquote_to_bytes

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# (host/path, verdict): fits the host and its subdomains if the path starts so.
RULES = (
    ("net/", "block"),
    ("example.net/en/", "allow"),
    ("example.com/de/", "block"),
    ("org/fr/", "allow"),
)
# Globs over ``.host`` and path, both canonical, for URLs that no rule fits; any match blocks.
BLOCKED_GLOBS = (
    "*spam*", "*cheap-pills*", "*casino*", "*free-bets*", "*ads-track*", "*viagra*", "*lottery*", "*jackpot*", "*betting*", "*porn*",
    "*.xxx\xff*", "*torrent*", "*warez*", "*free-money*", "*payday*loan*", "*replica*watch*", "*adult*cams*",
    "*clickbait*", "*malware*", "*phish*", "*\xff/ads/*", "*\xff/track/*click*",
)
DIVIDER = 0xFF  # stands between host and path; no byte of UTF-8 text equals it
STATE_WORDS = 1 << 20  # of 64 bits, for the urls that are read side by side


class ShiftAnd:
    """Globs (``*`` matches any bytes) compiled to masks.

    Bit ``j`` of a state is set when the first ``j + 1`` characters of a pattern have been
    read. ``stay`` holds the bits followed by ``*``.
    """

    def __init__(self, globs: Sequence[bytes]):
        bits = sum(max(1, len(g.replace(b"*", b""))) for g in globs)
        words = max(1, -(-bits // 64))
        self.step = np.zeros((256, words), np.uint64)
        self.first = np.zeros(words, np.uint64)  # bits that start a pattern
        self.free = np.zeros(words, np.uint64)  # of those, the ones after a leading star
        self.stay = np.zeros(words, np.uint64)
        self.final: list[tuple[int, np.uint64]] = []
        self.always = [not g.strip(b"*") and b"*" in g for g in globs]
        at = 0
        for glob in globs:
            start = at
            for i, byte in enumerate(glob):
                word, bit = divmod(at - 1, 64)
                if byte == 0x2A:
                    if at > start:
                        self.stay[word] |= np.uint64(1 << bit)
                    continue
                word, bit = divmod(at, 64)
                one = np.uint64(1 << bit)
                self.step[byte, word] |= one
                if at == start:
                    self.first[word] |= one
                    if i:
                        self.free[word] |= one
                at += 1
            at = max(at, start + 1)
            word, bit = divmod(at - 1, 64)
            self.final.append((word, np.uint64(1 << bit)))

    def match(self, texts: Sequence[bytes]) -> np.ndarray:
        """Boolean matrix: text by pattern; memory for states does not grow with the texts."""
        many = max(1, STATE_WORDS // len(self.first))
        parts = [self._match(texts[i : i + many]) for i in range(0, len(texts), many)]
        return np.concatenate(parts) if parts else np.zeros((0, len(self.final)), bool)

    def _match(self, texts: Sequence[bytes]) -> np.ndarray:
        """Short texts leave the loop first."""
        order = sorted(range(len(texts)), key=lambda i: -len(texts[i]))
        lengths = np.array([len(texts[i]) for i in order])
        state = np.zeros((len(texts), len(self.first)), np.uint64)
        ends = np.concatenate([[0], np.cumsum(lengths)])[:-1]
        data = np.frombuffer(b"".join(texts[i] for i in order), np.uint8)
        one, top = np.uint64(1), np.uint64(63)
        for t in range(int(lengths[0]) if len(lengths) else 0):
            n = int(np.searchsorted(-lengths, -t, "left"))  # texts longer than t
            own = state[:n]
            moved = own << one
            moved[:, 1:] |= own[:, :-1] >> top
            moved &= ~self.first  # a pattern does not run into the next one
            moved |= self.free if t else self.first
            state[:n] = (moved & self.step[data[ends[:n] + t]]) | (own & self.stay)
        out = np.zeros((len(texts), len(self.final)), bool)
        for j, (word, bit) in enumerate(self.final):
            out[order, j] = (state[:, word] & bit) != 0
            if self.always[j]:
                out[:, j] = True
        return out


def host_and_path(url: str | None) -> tuple[str, str]:
    """Host with A-Z in lower case and path; both empty for null or without ``://``."""
    _, mark, rest = (url or "").partition("://")
    if not mark:
        return "", ""
    stops = [i for c in "/?#" if (i := rest.find(c)) >= 0]
    host = rest[: min(stops, default=len(rest))]
    path = rest[len(host) :].partition("?")[0].partition("#")[0]
    return host.encode().lower().decode(), path


def _unescaped(text: bytes) -> bytes:
    """Percent escapes decoded until none is left; each round shortens the text."""
    while (plain := unquote_to_bytes(text)) != text:
        text = plain
    return text


def canonical(host: str, path: str) -> bytes:
    """What the globs read: a dot, the canonical host, ``DIVIDER`` and the canonical path.

    Escapes are decoded, also repeated ones, and tabs and line ends dropped. The host loses user
    info, port and dots at its ends; repeated dots are one. In the path repeated slashes are one
    and ``.`` and ``..`` are resolved; what escaped ``?`` and ``#`` bring in stays. A-Z become
    lower case, bytes that UTF-8 does not use are dropped.
    """
    drop = bytes([9, 10, 13, *range(0xF8, 0x100)])
    name = _unescaped(host.encode()).translate(None, drop).rpartition(b"@")[2]
    name = re.sub(rb"\.+", b".", re.sub(rb":[0-9]*\Z", b"", name)).strip(b".")
    steps: list[bytes] = []
    parts = _unescaped(path.encode()).translate(None, drop).split(b"/")
    for part in parts:
        if part == b"..":
            del steps[-1:]
        elif part not in (b"", b"."):
            steps.append(part)
    whole = b"".join(b"/" + step for step in steps)
    if parts[-1] in (b"", b".", b"..") and len(parts) > 1:
        whole += b"/"
    return b"." + name.lower() + bytes([DIVIDER]) + whole.lower()


def _glob(rule: str) -> bytes:
    host, slash, path = rule.partition("/")
    return b"*." + host.encode() + bytes([DIVIDER]) + (slash + path).encode() + b"*"


def url_verdicts(
    pages: DataFrame, id_col: str = "page_id", url_col: str = "url", rules=RULES, blocked=BLOCKED_GLOBS
) -> DataFrame:
    """Rows ``(id, host, path, rule, verdict)`` for each row of ``pages``.

    The longest fitting rule decides; of rules of equal length the first in ``rules``.
    Without one, ``block`` if a glob of ``blocked`` matches the canonical url, else ``allow``;
    ``rule`` is then null. Literal ``*`` cannot occur in rules.

    A null url, or one without ``://``, has an empty host and path, fits nothing and is
    allowed. Null ids and repeated rows are kept. Long urls cost one step per character
    for themselves only. Other columns are ignored; an empty table gives no rows.
    """
    globs = [_glob(r) for r, _ in rules] + [g.encode("latin-1") for g in blocked]
    machine = ShiftAnd(globs)
    rank = sorted(range(len(rules)), key=lambda j: (-len(rules[j][0]), j))

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = [host_and_path(u) for u in batch.column("url").to_pylist()]
            given = [b"." + h.encode() + bytes([DIVIDER]) + p.encode() for h, p in parts]
            whole = [canonical(h, p) for h, p in parts]
            hit = machine.match(whole)
            verdict = np.where(hit[:, len(rules) :].any(axis=1), "block", "allow").tolist()
            changed = [i for i, (a, b) in enumerate(zip(given, whole)) if a != b]
            hit[changed] = machine.match([given[i] for i in changed])
            rule = [None] * len(parts)
            for j in reversed(rank):
                for i in np.flatnonzero(hit[:, j]).tolist():
                    rule[i], verdict[i] = rules[j]
            text = pa.string()
            arrays = [batch.column("id"), pa.array([h for h, _ in parts], text), pa.array([p for _, p in parts], text)]
            arrays += [pa.array(rule, text), pa.array(verdict, text)]
            yield pa.RecordBatch.from_arrays(arrays, ["id", "host", "path", "rule", "verdict"])

    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).cast("string").alias("url"))
    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(judge, f"id {kind}, host string, path string, rule string, verdict string")
