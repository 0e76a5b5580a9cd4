"""Suffix arrays by induced sorting, and permuted common prefixes.

The bytes are handled bucket by bucket with numpy: a bucket (all suffixes that begin with
one byte) induces its predecessors in a few vector steps.  The reduced strings of the
recursion have large alphabets and are a third as long at most each time; they are induced
suffix by suffix.
"""

from __future__ import annotations

import numpy as np


def suffix_array(text: np.ndarray, alphabet: int) -> np.ndarray:
    """Order of all suffixes of ``text`` (whole numbers below ``alphabet``)."""
    n = len(text)
    if n < 2:
        return np.arange(n)
    s = text.astype(np.int64)
    is_s = small_types(s)
    lms = np.nonzero(is_s & ~np.concatenate([[True], is_s[:-1]]))[0]
    induce = induce_buckets if alphabet <= 1024 else induce_one_by_one
    if not len(lms):
        return induce(s, is_s, lms, alphabet)
    order = induce(s, is_s, lms, alphabet)
    is_lms = np.zeros(n, bool)
    is_lms[lms] = True
    sorted_lms = order[is_lms[order]]
    names, count = name_substrings(s, sorted_lms, lms)
    if count == len(lms):
        ranked = sorted_lms
    else:
        reduced = names[lms]
        ranked = lms[suffix_array(reduced, count)]
    return induce(s, is_s, ranked, alphabet)


def small_types(s: np.ndarray) -> np.ndarray:
    """Whether each suffix is smaller than the next one; the last counts as larger."""
    n = len(s)
    step = np.sign(np.diff(s))
    place = np.where(step != 0, np.arange(n - 1), n - 1)
    following = np.minimum.accumulate(place[::-1])[::-1]  # where a run of equal values ends
    rises = np.append(step, -1)
    out = np.zeros(n, bool)
    out[:-1] = rises[following] > 0
    return out


def name_substrings(s: np.ndarray, ordered: np.ndarray, lms: np.ndarray) -> tuple[np.ndarray, int]:
    """Numbers equal leftmost-smaller substrings alike, in order."""
    n = len(s)
    end = np.full(n, n - 1)
    end[lms[:-1]] = lms[1:]
    size = end[ordered] - ordered
    a, b = ordered[:-1], ordered[1:]
    same = (size[:-1] == size[1:]) & (end[a] != n - 1) & (end[b] != n - 1)
    open_ = np.nonzero(same)[0]
    k = 0
    while len(open_):
        differ = s[a[open_] + k] != s[b[open_] + k]
        same[open_[differ]] = False
        open_ = open_[~differ]
        k += 1
        open_ = open_[k <= size[open_]]
    rank = np.concatenate([[0], np.cumsum(~same)])
    names = np.zeros(n, np.int64)
    names[ordered] = rank
    return names, int(rank[-1]) + 1


def induce_buckets(s: np.ndarray, is_s: np.ndarray, seeds: np.ndarray, alphabet: int) -> np.ndarray:
    """Orders all suffixes from ordered leftmost-smaller ones, a bucket at a time."""
    n = len(s)
    sizes = np.bincount(s, minlength=alphabet)
    ends = np.cumsum(sizes)
    begins = ends - sizes
    out = np.full(n, -1, np.int64)
    head = begins.copy()
    seed_char = s[seeds]
    by_char = np.argsort(seed_char, kind="stable")
    seed_lists = np.split(seeds[by_char], np.searchsorted(seed_char[by_char], np.arange(1, alphabet)))

    def place_up(found: np.ndarray) -> None:
        """Larger-type predecessors go to the fronts of their buckets, in order."""
        prev = found[found > 0] - 1
        prev = prev[~is_s[prev]]
        _append(prev, s[prev], head, out, alphabet, 1)

    # the last suffix counts as induced by the end of the text
    out[head[s[n - 1]]] = n - 1
    head[s[n - 1]] += 1
    for c in range(alphabet):
        done = begins[c]
        while done < head[c]:
            upto = head[c]
            place_up(out[done:upto])
            done = upto
        if len(seed_lists[c]):
            place_up(seed_lists[c])
    tail = ends.copy()

    def place_down(found: np.ndarray) -> None:
        """Smaller-type predecessors go to the backs of their buckets, from the back."""
        prev = found[found > 0] - 1
        prev = prev[is_s[prev]]
        _append(prev, s[prev], tail, out, alphabet, -1)

    for c in range(alphabet - 1, -1, -1):
        done = ends[c]
        while done > tail[c]:
            upto = tail[c]
            place_down(out[upto:done][::-1])
            done = upto
        if head[c] > begins[c]:
            place_down(out[begins[c] : head[c]][::-1])
    return out


def _append(found: np.ndarray, chars: np.ndarray, edge: np.ndarray, out: np.ndarray, alphabet: int, way: int) -> None:
    if not len(found):
        return
    order = np.argsort(chars.astype(np.uint16), kind="stable")
    sorted_chars = chars[order]
    at = np.nonzero(np.diff(sorted_chars, prepend=-1))[0]
    count = np.diff(at, append=len(order))
    within = np.arange(len(order)) - np.repeat(at, count)
    kinds = sorted_chars[at]
    if way > 0:
        out[np.repeat(edge[kinds], count) + within] = found[order]
        edge[kinds] += count
    else:
        out[np.repeat(edge[kinds], count) - 1 - within] = found[order]
        edge[kinds] -= count


def induce_one_by_one(s: np.ndarray, is_s: np.ndarray, seeds: np.ndarray, alphabet: int) -> np.ndarray:
    """The same for large alphabets."""
    n = len(s)
    ends = np.cumsum(np.bincount(s, minlength=alphabet))
    tail = ends.tolist()
    chars, small = s.tolist(), is_s.tolist()
    out = [-1] * n
    for i in reversed(seeds.tolist()):
        c = chars[i]
        tail[c] -= 1
        out[tail[c]] = i
    head = [0, *ends.tolist()[:-1]]
    c = chars[n - 1]
    out[head[c]] = n - 1
    head[c] += 1
    for i in out:  # also sees what is placed further on
        if i > 0 and not small[i - 1]:
            c = chars[i - 1]
            out[head[c]] = i - 1
            head[c] += 1
    tail = ends.tolist()
    for k in range(n - 1, -1, -1):
        i = out[k]
        if i > 0 and small[i - 1]:
            c = chars[i - 1]
            tail[c] -= 1
            out[tail[c]] = i - 1
    return np.array(out, np.int64)


def common_prefixes(text: np.ndarray, order: np.ndarray, first: np.ndarray, size: np.ndarray, limit: int) -> np.ndarray:
    """Permuted common prefixes: for the first ``size`` places of each piece (they begin at
    ``first``), how much the suffix there shares with the one before it in ``order``, up to
    ``limit``; 0 elsewhere.

    Along a text the value falls by at most one from place to place.  The walk goes through
    all pieces side by side, one place at a time, and compares four values at once.
    """
    n = len(text)
    before = np.full(n, -1, np.int64)
    before[order[1:]] = order[:-1]
    padded = np.concatenate([text, np.full(limit + 8, 65535)]).astype(np.uint64)
    four = padded[:-3] | padded[1:-2] << np.uint64(16) | padded[2:-1] << np.uint64(32) | padded[3:] << np.uint64(48)
    out = np.zeros(n, np.int64)
    held = np.zeros(len(first), np.int64)
    by_size = np.argsort(-size, kind="stable")
    first, falling = first[by_size], -size[by_size]
    for t in range(int(-falling[0]) if len(size) else 0):
        live = int(np.searchsorted(falling, -t, "left"))
        place = first[:live] + t
        other = before[place]
        length = np.maximum(held[:live] - 1, 0)
        length[other < 0] = 0
        going = np.nonzero(other >= 0)[0]
        for values, step in ((four, 4), (padded, 1)):
            rest = going
            while len(rest):
                along = length[rest]
                same = (along + step <= limit) & (
                    values[np.minimum(place[rest] + along, n)] == values[np.minimum(other[rest] + along, n + 1)]
                )
                rest = rest[same]
                length[rest] += step
        held[:live] = length
        out[place] = length
    return out
