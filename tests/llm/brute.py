"""The operators in plain Python, for small inputs."""

import hashlib
from collections import Counter

import numpy as np
import xxhash

from tallyspan.llm import decontaminate as D


def removed_bytes(texts, width=100):
    """texts: (doc_id, text) in order of doc_id; the removal mask of each."""
    seen, out = set(), {}
    for doc, text in texts:
        body = (text or "").encode()
        gone = np.zeros(len(body), bool)
        for k in range(len(body) - width + 1):
            if body[k : k + width] in seen:
                gone[k : k + width] = True
            seen.add(body[k : k + width])
        out[doc] = (body, gone)
    return out


def removed_words(rows, width=35):
    """rows: texts; the words and the removal mask of each row."""
    words = [(t or "").encode().split() for t in rows]
    counts = Counter(tuple(w[k : k + width]) for w in words for k in range(len(w) - width + 1))
    out = []
    for w in words:
        gone = np.zeros(len(w), bool)
        for k in range(len(w) - width + 1):
            if counts[tuple(w[k : k + width])] > 1:
                gone[k : k + width] = True
        out.append((w, gone))
    return out


def fingerprint(text, shingle=3):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    grams = [b" ".join(words[i : i + shingle]) for i in range(max(1, len(words) - shingle + 1))]
    hashes = [xxhash.xxh64_intdigest(g, seed=42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups(fps, radius=2):
    """fps: id to fingerprint; id to the smallest id reachable."""
    ids = sorted(fps)
    root = {i: i for i in ids}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            if (fps[a] ^ fps[b]).bit_count() <= radius:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: find(i) for i in ids}


def leaks(docs, items):
    """(doc, item) pairs with a window of similarity 0.8, and the best similarity."""
    out = {}
    for doc, text in docs:
        words = (text or "").lower().encode().split()
        for item, passage in items:
            own = (passage or "").lower().encode().split()
            if not own or not words:
                continue
            size, n = min(D.SHINGLE, len(own)), min(len(own), len(words))
            count = lambda w: Counter(tuple(w[k : k + size]) for k in range(len(w) - size + 1))
            mine = count(own)
            shared = {k for k in range(len(words) - size + 1) if tuple(words[k : k + size]) in mine}
            if not shared:
                continue
            best = max(D.similarity(count(words[s : s + n]), mine) for s in range(len(words) - n + 1)) if n >= size else 0
            if best >= D.SIMILAR:
                out[doc, item] = best
    return out


def sha(data):
    return hashlib.sha256(data).hexdigest()
