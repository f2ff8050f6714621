"""Plain restatements of what the operators compute, for small inputs.

Nothing here imports the operators; values that must agree are restated.
"""

import hashlib
import re
from collections import Counter, defaultdict

import numpy as np
import xxhash
import zstandard

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall(text or "")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def clusters(n, linked):
    """Smallest index reachable from each of n items, ``linked(i, j)`` given."""
    root = list(range(n))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(n):
        for j in range(i):
            if linked(i, j):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


def fingerprint(text):
    w = words("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    if not w:
        return 0
    shingles = [" ".join(w[i:i + 3]) for i in range(max(len(w) - 2, 1))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def near_duplicates(docs):
    """(doc_id, fingerprint, component) of (doc_id, text) rows, sorted."""
    fps = [fingerprint(t) for _, t in docs]
    root = clusters(len(docs), lambda i, j: (fps[i] ^ fps[j]).bit_count() <= 2)
    least = defaultdict(lambda: None)
    for (d, _), r in zip(docs, root):
        if d is not None:
            least[r] = d if least[r] is None else min(least[r], d)
    return [(d, f"{f:016x}", least[r]) for (d, _), f, r in zip(docs, fps, root)]


def substring_dedup(docs, window=50):
    """(doc_id, n_words, n_removed, kept words) of (doc_id, text) rows."""
    first = {}
    split = [words(t) for _, t in docs]
    for (d, _), w in zip(docs, split):
        for i in range(len(w) - window + 1):
            key = tuple(w[i:i + window])
            if d is not None:
                first[key] = min(first.get(key, d), d)
    out = []
    for (d, _), w in zip(docs, split):
        gone = set()
        for i in range(len(w) - window + 1):
            if d is not None and first[tuple(w[i:i + window])] < d:
                gone.update(range(i, i + window))
        out.append((d, len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone)))
    return out


#: (bytes below which, lowest, highest ratio), then the lowest and highest ratio of a chunk.
WIDE = (((128, 0.30, 1.30), (256, 0.33, 1.00), (512, 0.30, 0.90), (768, 0.28, 0.85), (1024, 0.26, 0.80), (1536, 0.24, 0.75),
         (2048, 0.24, 0.70), (3072, 0.22, 0.66), (4096, 0.22, 0.64), (5120, 0.20, 0.62), (6144, 0.20, 0.61), (8192, 0.20, 0.60),
         (12288, 0.20, 0.59), (16384, 0.20, 0.58), (32768, 0.18, 0.57), (1 << 62, 0.15, 0.56)), (0.15, 0.64))


def ratios(text):
    """The ratio of the whole text, and those of its chunks: every 4,096 bytes, the last one the last 4,096."""
    raw, pack = (text or "").encode(), zstandard.ZstdCompressor(level=3)
    starts = list(range(0, len(raw) - 4096, 4096)) + [len(raw) - 4096] if len(raw) > 4096 else []
    return len(pack.compress(raw)) / max(len(raw), 1), [len(pack.compress(raw[i:i + 4096])) / 4096 for i in starts]


def base_failed(text):
    w = words(text)
    windows = Counter(tuple(w[i:i + 3]) for i in range(len(w) - 2))
    repeat = {j for i in range(len(w) - 2) if windows[tuple(w[i:i + 3])] > 1 for j in (i, i + 1, i + 2)}
    return len(w) < 50 or 100 * len(repeat) > 50 * len(w), len(repeat)


def quality(text, bands=WIDE):
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept)."""
    text = text or ""
    w, (failed, repeat) = words(text), base_failed(text)
    lines = [x for x in text.split("\n") if words(x)]
    ratio, chunks = ratios(text)
    low, high = next(b[1:] for b in bands[0] if len(text.encode()) < b[0])
    good = low <= ratio <= high and all(bands[1][0] <= x <= bands[1][1] for x in chunks)
    return (len(w), sum(map(len, w)), sum(text.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), repeat,
            failed, not failed and good)


def fit_bands(docs, labels):
    """Bands of (doc_id, text) rows for {doc_id: quality}: the clean texts' 1st and
    99th percentiles per class of 20 or more, less 60 and plus 25 per cent."""
    clean = [t or "" for d, t in docs if labels.get(d) == 1 and not base_failed(t)[0]]
    whole, chunks = [], []
    for i, (top, low, high) in enumerate(WIDE[0]):
        inside = [ratios(t)[0] for t in clean if (WIDE[0][i - 1][0] if i else 0) <= len(t.encode()) < top]
        if len(inside) >= 20:
            low, high = np.percentile(inside, 1) * (1 - 0.6), np.percentile(inside, 99) * (1 + 0.25)
        whole.append((top, low, high))
    chunks = [x for x in (ratios(t)[1] for t in clean) if x]
    if len(chunks) < 20:
        return tuple(whole), WIDE[1]
    return tuple(whole), (np.percentile([min(x) for x in chunks], 1) * (1 - 0.6), np.percentile([max(x) for x in chunks], 99) * (1 + 0.25))


def line_dedup(docs, min_sites):
    """(doc_id, text, removed positions) of (doc_id, text, site) rows with unique ids."""
    sites, first = defaultdict(set), {}
    for d, text, site in docs:
        for i, line in enumerate((text or "").split("\n")):
            if words(line):
                if site is not None:
                    sites[line].add(site)
                at = (d is None, d or 0, i)
                first[line] = min(first.get(line, at), at)
    out = []
    for d, text, _ in docs:
        lines = (text or "").split("\n")
        gone = [i for i, x in enumerate(lines) if len(sites[x]) >= min_sites and words(x) and first[x] != (d is None, d or 0, i)]
        out.append((d, "\n".join(x for i, x in enumerate(lines) if i not in gone) if gone else text, gone))
    return out


def targets(sizes, weights=(5, 2, 1), most=3):
    """Target words of {source: words}."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    total, capped = sum(sizes.values()), set()
    while True:
        rest = total - sum(most * sizes[s] for s in capped)
        left = sum(weight[s] for s in order if s not in capped)
        more = {s for s in order if s not in capped and most * sizes[s] * left < weight[s] * rest}
        if not more:
            return {s: float(most * sizes[s]) if s in capped else weight[s] * rest / max(left, 1) for s in order}
        capped |= more


def mix(docs):
    """(doc_id, size, source_size, target, taken) of (doc_id, text, source) rows."""
    md5 = lambda s: hashlib.md5(s.encode()).hexdigest()
    rows = sorted((md5(("" if d is None else str(d)) + ":" + md5(t or "")), len(words(t)), s, d) for d, t, s in
                  ((d, t, s) for d, t, s in docs if s is not None))
    rows += sorted((md5(("" if d is None else str(d)) + ":" + md5(t or "")), len(words(t)), None, d) for d, t, s in docs if s is None)
    sizes = defaultdict(int)
    for _, n, s, _ in rows:
        sizes[s] += n
    aim, seen, out = targets(dict(sizes)), defaultdict(int), []
    for _, n, s, d in rows:
        goal = -int(-aim[s] // 1)
        taken = sum(max(0, min(goal - seen[s] - e * sizes[s], n)) for e in range(3))
        out.append((d, n, sizes[s], aim[s], taken))
        seen[s] += n
    return out


def top_k(vectors, k, is_query):
    """(query_id, rank, vec_id, score) of (id, whole numbers) rows."""
    out = []
    for q, v in vectors:
        if is_query(q):
            scores = sorted((-sum(a * b for a, b in zip(v, w)), c) for c, w in vectors if c != q)
            out += [(q, i + 1, c, -s) for i, (s, c) in enumerate(scores[:k])]
    return out
