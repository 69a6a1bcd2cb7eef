"""Plain single-process versions of what the operators answer."""

from __future__ import annotations

import hashlib
from collections import defaultdict

SPACE = " \t\n\x0b\x0c\r"


def bare(text: str | None) -> str:
    return "".join(c for c in text or "" if c not in SPACE)


def exact(rows):
    groups = defaultdict(list)
    for i, t in rows:
        groups[bare(t)].append((-len(t or ""), i is None, i))
    out = []
    for i, t in rows:
        best = min(groups[bare(t)])
        out.append((i, best[2], len(groups[bare(t)]), i == best[2], hashlib.sha256(bare(t).encode()).hexdigest()))
    return out


def passages(rows, window=50):
    first = {}
    for i, t in sorted((r for r in rows if r[0] is not None), key=lambda r: r[0]):
        w = (t or "").encode().split()
        for k in range(len(w) - window + 1):
            first.setdefault(tuple(w[k : k + window]), i)
    out = []
    for i, t in rows:
        w = (t or "").encode().split()
        gone = [False] * len(w)
        for k in range(len(w) - window + 1):
            if i is not None and first[tuple(w[k : k + window])] < i:
                gone[k : k + window] = [True] * window
        kept = b" ".join(x for x, g in zip(w, gone, strict=True) if not g)
        out.append((i, len(w), sum(gone), hashlib.sha256(kept).hexdigest()))
    return out


def near(rows, size, num, den):
    sets, posted = {}, defaultdict(list)
    for i, t in rows:
        w = "".join(chr(ord(c) | 32) if "A" <= c <= "Z" else c for c in t or "").encode().split()
        sets[i] = {tuple(w[a : a + size]) for a in range(max(1, len(w) - size + 1))} if w else set()
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in sorted(sets):
        shared = defaultdict(int)
        for s in sets[i]:
            for j in posted[s]:
                shared[j] += 1
            posted[s].append(i)
        for j, n in shared.items():
            if den * n >= num * (len(sets[i]) + len(sets[j]) - n):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [(i, len(s), find(i), find(i) == i) for i, s in sets.items()]
