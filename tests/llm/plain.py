"""Brute-force versions of the operators, on plain rows."""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from math import log

import numpy as np

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall(text or "")


def lowered(text):
    return (text or "").translate({i: i + 32 for i in range(65, 91)})


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def components(nodes, linked):
    """Smallest node reachable from each, by repeated sweeps over the links."""
    low = {n: n for n in nodes}
    changed = True
    while changed:
        changed = False
        for a, b in linked:
            least = min(low[a], low[b])
            changed |= low[a] != least or low[b] != least
            low[a] = low[b] = least
    return low


def shingles(text, size=3):
    w = words(lowered(text))
    return {tuple(w[i : i + size]) for i in range(max(1, len(w) - size + 1))} if w else set()


def jaccard(docs, percent=90, size=3):
    """docs: (doc_id, text) with unique ids."""
    sets = {d: shingles(t, size) for d, t in docs}
    ids = sorted(sets)
    links = []
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                links.append((a, b))
    low = components(ids, links)
    return sorted((d, len(sets[d]), low[d]) for d in ids)


def captures(pages):
    first = {}
    for p, h in pages:
        first[h or ""] = min(p, first.get(h or "", p))
    out = []
    for p, h in pages:
        data = (h or "").encode()
        head = first[h or ""]
        out.append((p, len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(), "response" if head == p else "revisit", None if head == p else head))
    return sorted(out)


def near(vectors, cosine=0.93):
    """vectors: (vec_id, vector or None, label)."""
    unit = {}
    for v, e, label in vectors:
        if e and label is not None and all(x is not None and np.isfinite(x) for x in e) and any(e):
            x = np.array(e, float)
            unit[v] = (label, x / np.linalg.norm(x))
    ids = [v for v, _, _ in vectors]
    links = [
        (a, b) for i, a in enumerate(ids) for b in ids[i + 1 :]
        if a in unit and b in unit and unit[a][0] == unit[b][0] and len(unit[a][1]) == len(unit[b][1]) and float(unit[a][1] @ unit[b][1]) >= cosine
    ]
    low = components(ids, links)
    return sorted((v, sum(v in x for x in links), low[v], low[v] == v) for v in ids)


def best_split(piece, counts, total, longest):
    """All splits of a short piece, by recursion."""
    if not piece:
        return 0.0, []
    best = None
    for k in range(1, min(longest, len(piece)) + 1):
        tail = piece[-k:]
        n = counts.get(tail)
        chance = log(n / total) if n else log(10 / (total + 10)) - k * log(10)
        cost, before = best_split(piece[:-k], counts, total, longest)
        if best is None or cost - chance <= best[0]:
            best = (cost - chance, before + [tail])
    return best
