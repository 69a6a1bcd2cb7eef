"""Plain single-process versions of the operators on aligned tokens and on conversation prefixes."""

from __future__ import annotations

import hashlib
import zlib
from collections import Counter, defaultdict


def measured(text, a_tokens, b_tokens):
    """Groups and links of one text from its tokens, each an (id, bytes) pair; None without tokens."""
    raw = (" " + (text or "")).encode()
    if not text or b"".join(t for _, t in a_tokens) != raw or b"".join(t for _, t in b_tokens) != raw:
        return None

    def spans(tokens):
        at, out = 0, []
        for i, t in tokens:
            out.append((i, at, at + len(t)))
            at += len(t)
        return out

    a, b = spans(a_tokens), spans(b_tokens)
    links = Counter((i, j) for i, p, q in a for j, r, s in b if max(p, r) < min(q, s))
    cuts, groups, low = sorted({q for _, _, q in a} & {s for _, _, s in b}), [], 0
    for cut in cuts:
        inside = [[str(i) for i, _, end in side if low < end <= cut] for side in (a, b)]
        groups.append("|".join(",".join(x) for x in inside))
        low = cut
    return len(a), len(b), groups, links


def alignment(rows, tokens_a, tokens_b):
    each = [(i, measured(t, tokens_a(t), tokens_b(t)) if t else None) for i, t in rows]
    total = Counter()
    for _, m in each:
        if m:
            total.update(m[3])
    best = defaultdict(int)
    for (_, j), n in total.items():
        best[j] = max(best[j], n)
    out = []
    for i, m in each:
        if not m:
            out.append((i, 0, 0, 0, 0, 0, 0, ""))
            continue
        n_best = sum(k for p, k in m[3].items() if total[p] == best[p[1]])
        count = sum(k * total[p] for p, k in m[3].items())
        out.append((i, m[0], m[1], len(m[2]), sum(m[3].values()), n_best, count, hashlib.sha256(";".join(m[2]).encode()).hexdigest()))
    return out


def rebuilt(rows):
    """Turns (role, text) of every conversation; rows are (conv_id, turn, role, text) without equal turn numbers."""
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append((turn is not None, turn, role or "", text or ""))
    own = {c: [x[2:] for x in sorted(v, key=lambda x: x[:2] if x[0] else (False, 0))] for c, v in own.items()}
    out = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 9
        out[c] = own.get(c - (abs(c) % 5) * (1 if c >= 0 else -1), [])[:h] + own[c][h:]
    return out


def trie(rows):
    found = rebuilt(rows)
    members = defaultdict(list)
    for c, turns in found.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    kids = defaultdict(int)
    for node in members:
        if node:
            kids[node[:-1]] += 1
    leaves, saved = defaultdict(int), defaultdict(int)
    for node, of in members.items():
        for d in range(len(node) + 1):
            leaves[node[:d]] += kids[node] == 0
            saved[node[:d]] += (len(of) - 1) * len(node[-1][1].encode()) if node else 0
    out = []
    for node, of in members.items():
        ends = ",".join(str(c) for c in sorted(c for c in of if len(found[c]) == len(node)))
        parent = min(members[node[:-1]]) if node else None
        out.append((min(of), len(node), parent, len(of), kids[node], leaves[node], saved[node], hashlib.sha256(ends.encode()).hexdigest()))
    return out
