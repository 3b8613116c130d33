"""Plain Python versions of the operators, for small inputs."""

import base64
import collections
import hashlib
import itertools
import re
import zlib

import numpy as np
import xxhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SMALL = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return WORD.findall(text or "")


def quality(text):
    text = text or ""
    w = words(text)
    windows = collections.Counter(zip(w, w[1:], w[2:]))
    hit = set()
    for i in range(len(w) - 2):
        if windows[tuple(w[i : i + 3])] > 1:
            hit |= {i, i + 1, i + 2}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    n = len(w)
    failed = n < 50 or 100 * len(hit) > 50 * n
    return n, sum(map(len, w)), sum(text.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(hit), failed


def shingles(text, size=5):
    w = words((text or "").translate(SMALL))
    if not w:
        return frozenset()
    return frozenset(zip(*[w[i:] for i in range(size)])) if len(w) >= size else frozenset([tuple(w)])


def components(rows, percent=80):
    """``[(id, n_shingles, component_id)]`` sorted, of rows ``(id, text)``."""
    sets = [shingles(t) for _, t in rows]
    by_set = collections.defaultdict(list)
    for i, s in enumerate(sets):
        if s:
            by_set[s].append(i)
    up = list(range(len(rows)))

    def find(x):
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    for same in by_set.values():
        for i in same:
            up[find(i)] = find(same[0])
    grams = collections.defaultdict(list)
    for s, same in by_set.items():
        for g in s:
            grams[g].append(same[0])
    common = collections.Counter()
    for held in grams.values():
        common.update(itertools.combinations(sorted(held), 2))
    for (i, j), c in common.items():
        if 100 * c >= percent * (len(sets[i]) + len(sets[j]) - c):
            up[find(i)] = find(j)
    least = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            least[find(i)] = min(doc, least.get(find(i), doc))
    key = lambda r: tuple((x is None, x) for x in r)
    return sorted(((doc, len(sets[i]), least.get(find(i))) for i, (doc, _) in enumerate(rows)), key=key)


def targets(sizes, weights=(5, 2, 1), most=3):
    """Target by source, of ``{source: size}``; a null source is last."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    left, open_, out = float(sum(sizes.values())), set(order), {}
    while open_:
        level = left / sum(weight[s] for s in open_)
        above = {s for s in open_ if weight[s] * level > most * sizes[s]}
        if not above:
            out |= {s: weight[s] * level for s in open_}
            break
        for s in above:
            out[s] = float(most * sizes[s])
            left -= out[s]
        open_ -= above
    return out


def license(text):
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(SMALL))
    base = (("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved"))
    spots, labels = [], set()
    for phrase, label in base:
        p = phrase.split()
        for i in range(len(w) - len(p) + 1):
            if w[i : i + len(p)] == p:
                spots.append(i)
                labels.add(label)
    return len(w), len(spots), min(spots, default=None), max(spots, default=None), ",".join(sorted(labels))


def host_path(url):
    m = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url or "")
    return (m[1].translate(SMALL), m[2]) if m else ("", "")


def url_rule(url, rules):
    host, path = host_path(url)
    fits = []
    for rule, verdict in rules:
        name, _, rest = rule.partition("/")
        if (host == name or host.endswith("." + name)) and path.startswith("/" + rest):
            fits.append((len(rule), rule, verdict))
    return (host, path, *max(fits)[1:]) if fits else (host, path, None, None)


def warc(rows):
    """Rows ``(id, bytes, digest, type, refers_to)`` of ``(id, html)``."""
    last = {}
    for page, html in rows:
        if page is not None:
            last[html or ""] = max(page, last.get(html or "", page))
    out = []
    for page, html in rows:
        body = (html or "").encode()
        target = last.get(html or "", page)
        again = page != target
        digest = base64.b32encode(hashlib.sha1(body).digest()).decode()
        out.append((page, len(body), digest, "revisit" if again else "response", target if again else None))
    return out


def chat(rows):
    """``{conv_id: (n_turns, turns_sha256, loss_chars, loss_sha256)}`` of ``(conv, turn, role, text)``."""
    held = collections.defaultdict(list)
    for conv, turn, role, text in rows:
        held[conv].append(((turn is not None, turn or 0), role or "", text or ""))
    out = {}
    for conv, turns in held.items():
        turns.sort()
        sha = hashlib.sha256("".join(f"{r}\n{t}\n" for _, r, t in turns).encode()).hexdigest()
        loss = "".join(t for _, r, t in turns if r == "assistant")
        out[conv] = len(turns), sha, len(loss), hashlib.sha256(loss.encode()).hexdigest()
    return out


def nearest(rows, every=20, k=20):
    """``{query_id: [(vec_id, score)]}`` of ``(id, vector)``."""
    fine = []
    for i, v in rows:
        if v is not None and all(x is not None and np.isfinite(x) for x in v) and any(v):
            fine.append((i, np.array(v, np.float64)))
    ids = np.array([i for i, _ in fine])
    matrix = np.stack([v for _, v in fine])
    out = {}
    for i, v in fine:
        if i % every == 0:
            score = matrix @ v
            order = np.lexsort((ids, -score))
            out[i] = [(int(ids[j]), float(score[j])) for j in order if ids[j] != i][:k]
    return out


def held_out(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 5 == 0


def planted(doc_id, words):
    if doc_id is None or not words:
        return words
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    if h % 10:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[a + (i - a) % p] if i >= a else words[i] for i in range(n)]


def runs(w):
    """``[(start, length, period)]`` of a list of words, and the words kept."""
    n, spans = len(w), {}
    ids = np.unique(np.array(w, object), return_inverse=True)[1] if w else np.zeros(0, int)
    for q in range(1, n // 4 + 1):
        same = np.concatenate([[False], ids[:-q] == ids[q:], [False]])
        ends = np.flatnonzero(same[1:] != same[:-1])
        for start, stop in zip(ends[::2].tolist(), ends[1::2].tolist()):
            length = stop - start + q
            if length >= max(6, 4 * q):
                spans.setdefault((start, length), q)
    found = sorted((s, length, q) for (s, length), q in spans.items())
    dropped = {i for s, length, q in found for i in range(s + q, s + length)}
    return found, [x for i, x in enumerate(w) if i not in dropped]


def run_row(doc_id, text):
    found, kept = runs(planted(doc_id, words(text)))
    best = max(found, key=lambda r: (r[1], -r[0], -r[2]), default=(None, None, None))
    milli = best[1] * 1000 // best[2] if found else None
    lines = "".join("%d,%d,%d\n" % r for r in found)
    sha = [hashlib.sha256(x.encode()).hexdigest() for x in (lines, " ".join(kept))]
    return (doc_id, len(found), *best, milli, *sha)


def merkle(rows):
    """Rows of the manifest of ``(doc_id, source, lang, n_chars, text)``, sorted."""

    def sha(x):
        return hashlib.sha256(x.encode()).hexdigest()

    def leaf(row):
        return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))

    def tree(leaves):
        """Root, and for each leaf its list of siblings before and after."""
        paths, spots, level = [[] for _ in leaves], list(range(len(leaves))), leaves
        while len(level) > 1:
            for i, at in enumerate(spots):
                run = level[at // 8 * 8 : at // 8 * 8 + 8]
                paths[i].append((run[: at % 8], run[at % 8 + 1 :]))
                spots[i] = at // 8
            level = [sha("".join(level[i : i + 8])) for i in range(0, len(level), 8)]
        return level[0], paths

    groups = collections.defaultdict(list)
    for r in rows:
        groups[r[2]].append((r[0] is not None, r[0] or 0, leaf(r), r))
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    built = {g: (sorted(groups[g], key=lambda x: x[:3]),) for g in order}
    built = {g: (held, *tree([x[2] for x in held])) for g, (held,) in built.items()}
    root, above = tree([built[g][1] for g in order]) if order else (None, [])
    out = []
    for g, last in zip(order, above):
        held, subroot, paths = built[g]
        for (_, _, own, r), path in zip(held, paths):
            at = own
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0 and r[4] is not None:
                at = leaf((*r[:4], r[4].translate(SMALL)))
            for left, right in path + last:
                at = sha("".join([*left, at, *right]))
            proof = sha("".join("".join(left + right) for left, right in path + last))
            out.append((r[0], own, subroot, root, proof, at, at == root))
    return sorted(out, key=lambda r: tuple((x is None, x) for x in r))


def simhash(text):
    w = words((text or "").translate(SMALL))
    grams = [" ".join(w[i : i + 3]) for i in range(len(w) - 2)] or ([" ".join(w)] if w else [])
    ones = [0] * 64
    for g in grams:
        h = xxhash.xxh64_intdigest(g.encode(), 42)
        for b in range(64):
            ones[b] += h >> b & 1
    return sum(1 << b for b in range(64) if 2 * ones[b] > len(grams))


def simhash_components(rows, radius=2):
    """``[(id, fingerprint, component_id)]`` sorted, of rows ``(id, text)``."""
    codes = np.array([simhash(t) for _, t in rows], np.uint64)
    up = list(range(len(rows)))

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for i in range(len(rows)):
        for j in np.flatnonzero(np.bitwise_count(codes[:i] ^ codes[i]) <= radius):
            a, b = find(i), find(int(j))
            up[max(a, b)] = min(a, b)
    least = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            least[find(i)] = min(doc, least.get(find(i), doc))
    key = lambda r: tuple((x is None, x) for x in r)
    return sorted(((doc, f"{int(codes[i]):016x}", least.get(find(i))) for i, (doc, _) in enumerate(rows)), key=key)
