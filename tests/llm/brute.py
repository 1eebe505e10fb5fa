"""Plain Python forms of the operators, for small tables."""

from __future__ import annotations

import hashlib
import re
from collections import Counter, defaultdict

LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
SPACED = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def low(text):
    return (text or "").translate(LOWER)


def shingles(text, n=5):
    w = SPACED.findall(low(text))
    if len(w) < n:
        return {tuple(w)} if w else set()
    return {tuple(w[i : i + n]) for i in range(len(w) - n + 1)}


def near(docs):
    """docs: (doc_id, text) -> {doc_id: (n_shingles, component_id, kept)}"""
    sets = {d: shingles(t) for d, t in docs}
    where = defaultdict(list)
    for d, s in sets.items():
        for x in s:
            where[x].append(d)
    parent = {d: d for d in sets}

    def root(d):
        while parent[d] != d:
            parent[d] = parent[parent[d]]
            d = parent[d]
        return d

    for d, s in sets.items():
        common = Counter(o for x in s for o in where[x] if o < d)
        for o, c in common.items():
            if 100 * c >= 75 * (len(s) + len(sets[o]) - c):
                a, b = sorted((root(d), root(o)))
                parent[b] = a
    return {d: (len(s), root(d), root(d) == d) for d, s in sets.items()}


def windows(text, size=10):
    w = ALNUM.findall(low(text))
    n = min(size, len(w))
    return {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if n else set()


def contamination(docs, items, size=10):
    """-> {doc_id: (n_words, n_hit, n_items, items_sha256, contaminated)}"""
    grams = defaultdict(set)
    for item, text in items:
        for g in windows(text, size):
            grams[g].add(item)
    sizes = {len(g) for g in grams}
    out = {}
    for d, text in docs:
        w = ALNUM.findall(low(text))
        hit, found = set(), set()
        for n in sizes:
            for i in range(len(w) - n + 1):
                if (g := tuple(w[i : i + n])) in grams:
                    hit |= set(range(i, i + n))
                    found |= {str(x) for x in grams[g] if x is not None}
        ids = sorted(found)
        out[d] = (len(w), len(hit), len(ids), hashlib.sha256(",".join(ids).encode()).hexdigest(), bool(hit))
    return out


def targets(sizes, weights=(3, 1, 2), budget=1.5, most=2):
    """sizes: {source: words} -> {source: target}, handing on what is above a limit until none is above."""
    order = sorted(sizes, key=lambda s: (s is None, s))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    left, open_, out = budget * sum(sizes.values()), set(order), {}
    while open_:
        total = sum(weight[s] for s in open_)
        above = {s for s in open_ if left * weight[s] / total > most * sizes[s]}
        if not above:
            out |= {s: left * weight[s] / total for s in open_}
            break
        for s in above:
            out[s] = most * sizes[s]
        left -= sum(out[s] for s in above)
        open_ -= above
    return out


def exact(docs):
    """-> [(doc_id, keep_id, group_size, kept, sha)] one per row"""
    strip = lambda t: re.sub(r"[\x20\x09-\x0D]", "", t or "")
    groups = defaultdict(list)
    for d, t in docs:
        groups[strip(t)].append((-len(t or ""), d is None, d))
    out = []
    for d, t in docs:
        g = groups[strip(t)]
        best = min(g, key=lambda x: (x[0], x[1], x[2] or 0))
        out.append((d, best[2], len(g), d == best[2] and -len(t or "") == best[0], hashlib.sha256(strip(t).encode()).hexdigest()))
    return out
