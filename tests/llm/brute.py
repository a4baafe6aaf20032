"""Plain Python statements of what the operators must return."""

import hashlib
import math
import zlib
from collections import Counter

import xxhash


def sha(data):
    return hashlib.sha256(data if isinstance(data, bytes) else data.encode()).hexdigest()


def lower(text):
    return bytes(b + 32 if 65 <= b <= 90 else b for b in (text or "").encode())


def words(text):
    return (text or "").encode().split()


def simhash(text):
    found = lower(text).split()
    if not found:
        return 0
    shingles = [b" ".join(found[i:i + 3]) for i in range(len(found) - 2)] or [b" ".join(found)]
    hashes = [xxhash.xxh64(s, seed=42).intdigest() for s in shingles]
    return sum(1 << k for k in range(64) if 2 * sum(h >> k & 1 for h in hashes) > len(hashes))


def linked(prints, radius):
    """Least doc_id of the component of each row of (doc_id, fingerprint)."""
    parent = list(range(len(prints)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, (_, a) in enumerate(prints):
        for j in range(i):
            if (a ^ prints[j][1]).bit_count() <= radius:
                parent[root(i)] = root(j)
    groups = {}
    for i, (doc, _) in enumerate(prints):
        groups.setdefault(root(i), []).append(doc)
    least = {r: min((d for d in ids if d is not None), default=None)
             for r, ids in groups.items()}
    return [least[root(i)] for i in range(len(prints))]


def cut(docs, size=13):
    """(n_words, n_removed, kept) of each (doc_id, text)."""
    first = {}
    order = math.inf
    for doc, text in docs:
        w = words(text)
        for i in range(len(w) - size + 1):
            key = tuple(w[i:i + size])
            own = order if doc is None else doc
            first[key] = min(first.get(key, order), own)
    out = []
    for doc, text in docs:
        w = words(text)
        gone = [False] * len(w)
        for i in range(len(w) - size + 1):
            if first[tuple(w[i:i + size])] < (order if doc is None else doc):
                gone[i:i + size] = [True] * size
        out.append((len(w), sum(gone), b" ".join(x for x, g in zip(w, gone) if not g)))
    return out


def targets(sizes):
    """Target of each source: shares by weight, capped at three times its size, again and again."""
    names = sorted(s for s in sizes if s is not None) + [None] * (None in sizes)
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    capped = {}
    while True:
        free = [s for s in names if s not in capped]
        rest = sum(sizes.values()) - sum(capped.values())
        share = {s: rest * weight[s] / sum(weight[x] for x in free) for s in free}
        over = [s for s in free if share[s] > 3 * sizes[s]]
        if not over:
            return capped | share
        capped |= {s: 3.0 * sizes[s] for s in over}


def base_scores(docs):
    """(held_out, n_tokens, n_known, train_tokens, base_score) of each (doc_id, text)."""
    def held(doc):
        return zlib.crc32(("" if doc is None else str(doc)).encode()) % 7 == 2

    counts = Counter()
    for doc, text in docs:
        if not held(doc):
            counts.update([*lower(text).split(), None])
    n, v = sum(counts.values()), len(counts)
    out = []
    for doc, text in docs:
        tokens = [*lower(text).split(), None]
        out.append((held(doc), len(tokens), sum(counts[t] > 0 for t in tokens), n,
                    sum(math.log10((counts[t] + 1) / (n + v + 1)) for t in tokens)))
    return out


def quality_base(text):
    w = words(text)
    spots = {}
    for i in range(len(w) - 2):
        spots.setdefault(tuple(w[i:i + 3]), []).append(i)
    repeated = {i + k for at in spots.values() if len(at) > 1 for i in at for k in range(3)}
    seen, lines = set(), 0
    for line in (text or "").split("\n"):
        lines += bool(line in seen and line.encode().split())
        seen.add(line)
    return (len(w), sum(len(x.decode()) for x in w),
            sum((text or "").count(c) for c in "#*$%&|<>"), lines, len(repeated))
