"""Plain versions of the operators, for small inputs."""
from __future__ import annotations

import re
import zlib
from collections import Counter

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall((text or "").translate(LOW))


def jump(key: int, shards: int) -> int:
    key &= (1 << 64) - 1
    b, j = -1, 0
    while j < shards:
        b = j
        key = (key * 2862933555777941757 + 1) & ((1 << 64) - 1)
        j = int(float(b + 1) * (float(1 << 31) / float((key >> 33) + 1)))
    return b


def crc(text) -> int:
    return zlib.crc32((text or "").encode())


def bag(text, size=5):
    w = words(text)
    return Counter(tuple(w[i:i + size]) for i in range(len(w) - size + 1)) if len(w) >= size else Counter([tuple(w)] if w else [])


def near_classes(rows, threshold=0.8):
    """doc_id -> smallest doc_id of its class, by comparing all pairs."""
    bags = {d: bag(t) for d, t in rows}
    parent = {d: d for d in bags}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(bags)
    for i, a in enumerate(ids):
        for b in ids[i + 1:]:
            shared = sum((bags[a] & bags[b]).values())
            if shared and shared >= threshold * sum((bags[a] | bags[b]).values()):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {d: find(d) for d in ids}


def hits(doc, items, window=10):
    """(number of hit words, ids of the items that occur)."""
    w = words(doc)
    hit, found = set(), set()
    for item, text in items:
        x = words(text)
        m = min(window, len(x))
        if not m:
            continue
        grams = {tuple(x[i:i + m]) for i in range(len(x) - m + 1)}
        for i in range(len(w) - m + 1):
            if tuple(w[i:i + m]) in grams:
                hit.update(range(i, i + m))
                found.add(str(item))
    return len(hit), sorted(found)


def greedy(pieces, word, prefix=b" "):
    s, i, n = prefix + word.encode(), 0, 0
    while i < len(s):
        for j in range(len(s), i, -1):
            if s[i:j] in pieces:
                break
        else:
            return -1
        i, n = j, n + 1
    return n
