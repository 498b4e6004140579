"""Plain Python versions of the operators, for small tables."""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left
from collections import Counter, defaultdict

import numpy as np
import xxhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def statistics(text):
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    text = text or ""
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    windows = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    count = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if count[w] > 1 for k in range(3)}
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)),
            len(covered))


def base_failed(s):
    return s[0] < 50 or 100 * s[4] > 50 * s[0]


FLOORS = np.array([150, 250, 150, 150.0])


def vector(s):
    n, chars, symbols, dup, repeat = map(float, s)
    parts = [chars / n, np.log1p(20 * symbols / n), np.log1p(dup) / 2, np.sqrt(repeat / n) * 2]
    return [np.floor(1000 * min(x, 100.0) + 0.5) for x in parts]


def _fit(x):
    cov = (x.T @ x / len(x) - np.outer(x.mean(0), x.mean(0))) * 1.485
    np.fill_diagonal(cov, np.maximum(np.diag(cov), 0) + FLOORS ** 2)
    return x.mean(0), np.linalg.cholesky(cov)


def _distance(x, centre, factor):
    return (np.linalg.solve(factor, (x - centre).T) ** 2).sum(0)


def mcd(x, steps=6, alpha=0.75):
    """Centre and Cholesky factor of the better of two starts."""
    def median(v):
        return np.sort(v, axis=0)[(len(v) + 1) // 2 - 1]
    mad = median(abs(x - median(x)))
    best = None
    for name, (centre, factor) in (("classical", _fit(x)),
                                   ("robust", (median(x), np.diag(np.sqrt((1.4826 * mad) ** 2 + FLOORS ** 2))))):
        for _ in range(steps):
            bins = np.floor(40 * np.log(_distance(x, centre, factor) + 0.001))
            below = np.array([(bins < b).sum() for b in bins])
            centre, factor = _fit(x[below < alpha * len(x)])
        key = (np.log(np.diag(factor)).sum(), name)
        if best is None or key < best[0]:
            best = key, centre, factor
    return best[1:]


def quality(rows, min_group=50, cutoff=60.0):
    """Kept or not, of rows (lang, source, text)."""
    stats = [statistics(t) for _, _, t in rows]
    groups = defaultdict(list)
    for i, (lang, source, _) in enumerate(rows):
        if not base_failed(stats[i]):
            for key in ((lang, source), (lang,), ()):
                groups[key].append(vector(stats[i]))
    models = {k: mcd(np.array(v)) for k, v in groups.items() if len(v) >= min_group}
    out = []
    for (lang, source, _), s in zip(rows, stats):
        model = models.get((lang, source)) or models.get((lang,)) or models.get(())
        good = not base_failed(s)
        if good and model:
            good = bool(_distance(np.array([vector(s)]), *model)[0] <= cutoff)
        out.append(good)
    return out


def chain(values):
    """A longest rising subsequence, by the quadratic program."""
    best = []
    for i, v in enumerate(values):
        best.append(max([b for j, b in enumerate(best) if values[j] < v], default=[], key=len) + [i])
    return max(best, default=[], key=len)


def line_places(text):
    seen, out, ordinal = Counter(), [], 0
    for pos, line in enumerate(text.split("\n")):
        words = line.encode().split()
        if words:
            key = line.encode().strip()
            seen[key] += 1
            out.append((key, seen[key], ordinal, pos, len(words)))
            ordinal += 1
    return out


def dedup_lines(docs, min_words=3):
    """Remaining text and number of deleted lines by doc_id, each document aligned with every earlier one that shares a
    line; ``docs`` maps doc_id to text."""
    holders = defaultdict(list)
    out = {}
    for i in sorted(docs):
        partners = defaultdict(list)
        for key, occ, ordinal, pos, n in line_places(docs[i]):
            for earlier, place in holders[key, occ]:
                partners[earlier].append((ordinal, place, pos, n))
            holders[key, occ].append((i, ordinal))
        doomed = set()
        for anchors in partners.values():
            blocks, last = [], None
            picked = [anchors[k] for k in patience([a[1] for a in anchors])]
            for a in picked:
                if last is None or (a[0], a[1]) != (last[0] + 1, last[1] + 1):
                    blocks.append([])
                blocks[-1].append(a)
                last = a
            for b in blocks:
                if sum(a[3] for a in b) >= min_words:
                    doomed |= {a[2] for a in b}
        out[i] = "\n".join(x for k, x in enumerate(docs[i].split("\n")) if k not in doomed), len(doomed)
    return out


def patience(values):
    piles, back = [], {}
    for i, v in enumerate(values):
        at = bisect_left([values[p[-1]] for p in piles], v)
        back[i] = piles[at - 1][-1] if at else None
        if at == len(piles):
            piles.append([i])
        else:
            piles[at].append(i)
    out = []
    i = piles[-1][-1] if piles else None
    while i is not None:
        out.append(i)
        i = back[i]
    return out[::-1]


def simhash(text, shingle=4):
    words = [w.translate({c: c + 32 for c in range(65, 91)}) for w in WORD.findall(text or "")]
    if not words:
        return 0
    parts = [" ".join(words[i:i + shingle]) for i in range(max(1, len(words) - shingle + 1))]
    hashes = [xxhash.xxh64_intdigest(p.encode(), 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def near_components(rows, shingle=4, distance=4):
    """(fingerprint, component_id) of rows (doc_id, text)."""
    prints = [simhash(t, shingle) for _, t in rows]
    root = {p: p for p in prints}

    def find(p):
        while root[p] != p:
            p = root[p]
        return p

    keys = list(root)
    for i, a in enumerate(keys):
        for b in keys[:i]:
            if (a ^ b).bit_count() <= distance:
                root[find(a)] = find(b)
    least = {}
    for (i, _), p in zip(rows, prints):
        r = find(p)
        least[r] = min(least.get(r, i), i)
    return [(p, least[find(p)]) for p in prints]


def without_repeats(texts, window=400):
    """(n_bytes, n_removed, n_spans, sha256 of the rest) of each text."""
    data = [(t or "").encode() for t in texts]
    count = Counter(d[i:i + window] for d in data for i in range(len(d) - window + 1))
    out = []
    for d in data:
        covered = bytearray(len(d))
        for i in range(len(d) - window + 1):
            if count[d[i:i + window]] > 1:
                covered[i:i + window] = b"\1" * window
        spans = len(re.findall(rb"\x01+", bytes(covered)))
        rest = bytes(b for b, c in zip(d, covered) if not c)
        out.append((len(d), len(d) - len(rest), spans, hashlib.sha256(rest).hexdigest()))
    return out
