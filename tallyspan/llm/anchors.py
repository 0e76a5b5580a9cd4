"""Anchors: places that equal windows of text pick alike.

A window of ``width`` units (bytes or words) picks the leftmost of its ``gram``-unit
substrings whose hash is smallest.  The choice depends on the window's content alone, so
equal windows, wherever they stand, pick equal anchors at equal offsets.  Consecutive
windows mostly pick the same place; all windows of one anchor place form a segment.
Windows can only be equal if their anchors are, and if whole segments are equal, all their
windows are.  So repeated windows are found by looking at about one row for every
(width - gram) / 2 units instead of one for each.

Nothing is sampled: every window of every text belongs to exactly one segment.
"""

from __future__ import annotations

from functools import cache

import numpy as np

# Window starts handled at once; small enough to stay in cache, bounded for any text.
CHUNK = 1 << 17
PLACE_BITS = 24
# Odd multipliers of two rolling hashes and of the mixing steps.
BASES = (0x9E3779B97F4A7C15, 0xD1B54A32D192ED03)
MIX = (0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53)
PLACES = np.uint64((1 << PLACE_BITS) - 1)


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(MIX[0])
    x = (x ^ (x >> np.uint64(33))) * np.uint64(MIX[1])
    return x ^ (x >> np.uint64(33))


@cache
def byte_codes() -> np.ndarray:
    return mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(BASES[0]))


@cache
def powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """base^i and base^-i modulo 2^64 for i < n."""
    out = []
    for b in (base, pow(base, -1, 1 << 64)):
        steps = np.full(n, b, np.uint64)
        steps[0] = 1
        out.append(np.multiply.accumulate(steps))
    return out[0], out[1]


def rolling(codes: np.ndarray, base: int) -> tuple[np.ndarray, np.ndarray]:
    """Prefix sums from which the hash of any substring follows, and the inverse powers."""
    size = 1 << int(len(codes)).bit_length()
    up, down = powers(base, size)
    sums = np.empty(len(codes) + 1, np.uint64)
    sums[0] = 0
    np.cumsum(codes * up[: len(codes)], out=sums[1:])
    return sums, down


def sliding_least(x: np.ndarray, width: int) -> np.ndarray:
    covered = 1
    while covered * 2 <= width:
        x = np.minimum(x[:-covered], x[covered:])
        covered *= 2
    rest = width - covered
    return np.minimum(x[:-rest], x[rest:]) if rest else x


def segments(codes: np.ndarray, text_of: np.ndarray, ends: np.ndarray, width: int, gram: int, whole: bool = True) -> dict[str, np.ndarray]:
    """Segments of concatenated texts.  ``text_of``: the text of each unit; ``ends``: where
    each text ends.  Gives the anchor's hash and, if ``whole``, text, first (window start in the
    concatenation), n (windows), place (the anchor's, from first), content (hash of the segment)
    and cores (two hashes of 32 bits, see ``repeats``)."""
    out = {k: [] for k in (("text", "first", "n", "place", "anchor", "content", "cores") if whole else ("anchor",))}
    total, split = len(codes), (width - gram) // 2
    for begin in range(0, total - width + 1, CHUNK):
        part = codes[begin : begin + CHUNK + width - 1]
        sums, down = rolling(part, BASES[0])
        grams = mix((sums[gram:] - sums[:-gram]) * down[: len(part) - gram + 1])
        keyed = (grams & ~PLACES) | np.arange(len(grams), dtype=np.uint64)
        place = (sliding_least(keyed, width - gram + 1) & PLACES).astype(np.int64)
        start = np.arange(len(place))
        valid = start + begin + width <= ends[text_of[begin : begin + len(place)]]
        start, place = start[valid], place[valid]
        if not len(start):
            continue
        new = np.ones(len(start), bool)
        new[1:] = (place[1:] != place[:-1]) | (start[1:] != start[:-1] + 1)
        at = np.nonzero(new)[0]
        first, anchor = start[at], place[at]
        if not whole:
            out["anchor"].append(grams[anchor])
            continue
        n = np.diff(at, append=len(start))
        # a core that no window of the segment holds may reach beyond the text; nothing reads its hash
        left, right = np.maximum(anchor - split, 0), np.minimum(anchor + width - split + 1, len(part))
        upper = mix((sums[anchor + gram] - sums[left]) * down[left])
        lower = mix((sums[right] - sums[anchor]) * down[anchor])
        cores = ((upper >> np.uint64(32)) << np.uint64(32)) | (lower >> np.uint64(32))
        sums2, down2 = rolling(part ^ (part >> np.uint64(29)), BASES[1])
        content = mix((sums2[first + n - 1 + width] - sums2[first]) * down2[first])
        content = mix(content + ((anchor - first) * 65536 + n).astype(np.uint64))
        for k, v in zip(out, (text_of[begin + first], begin + first, n, anchor - first, grams[anchor], content, cores)):
            out[k].append(v)
    return {k: np.concatenate(v) if v else np.zeros(0, np.int64) for k, v in out.items()}
