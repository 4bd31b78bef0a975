"""Edit distance of two sequences within a band, by the bit-parallel recurrence of Myers and Hyyrö on long integers."""

from __future__ import annotations

from bisect import bisect_left
from collections import Counter, defaultdict

#: Symbols in more places than this get a bit mask of all their places; others are put together from the places in the band.
MANY = 48


def distance_within(a: list, b: list, most: int) -> int | None:
    """Edit distance of a and b if it is at most `most`, else None. Only cells within the band |i - j| <= most count."""
    if abs(len(a) - len(b)) > most:
        return None
    begin, least = 0, min(len(a), len(b))
    while begin < least and a[begin] == b[begin]:
        begin += 1
    end = 0
    while end < least - begin and a[-1 - end] == b[-1 - end]:
        end += 1
    a, b = a[begin : len(a) - end], b[begin : len(b) - end]
    m, n = len(a), len(b)
    if not m or not n:
        return max(m, n) if max(m, n) <= most else None
    ca, cb = Counter(a), Counter(b)
    if max((ca - cb).total(), (cb - ca).total()) > most:  # each of these costs an edit
        return None
    band = most
    places: dict = defaultdict(list)
    for i, x in enumerate(a):
        places[x].append(i)
    masks = {}
    for x, at in places.items():
        if len(at) > MANY:
            whole = bytearray(m // 8 + 1)
            for i in at:
                whole[i >> 3] |= 1 << (i & 7)
            masks[x] = int.from_bytes(whole, "little")
    width = 2 * band + 1
    full = (1 << width) - 1
    up, down = ((1 << band + 1) - 1) << band, 0
    score, edge = min(band, m), 1 << width - 1  # of the last row that the band reaches
    for j in range(1, n + 1):
        low = j - band - 1  # the place of a that the lowest bit stands for
        x = b[j - 1]
        if x in masks:
            same = (masks[x] >> low if low >= 0 else masks[x] << -low) & full
        elif at := places.get(x):
            same = 0
            for k in range(bisect_left(at, low), len(at)):
                if at[k] - low >= width:
                    break
                same |= 1 << at[k] - low
        else:
            same = 0
        diagonal = ((((same & up) + up) ^ up) | same | down) & full
        right, left = (down | ~(diagonal | up)) & full, diagonal & up
        if j <= m - band:
            score += not diagonal & edge
        else:
            at_last = 1 << m - j + band
            score += bool(right & at_last) - bool(left & at_last)
        if score - (n - max(j, m - band)) > most:  # along the last row it can fall by one a step
            return None
        up = (left | ~((diagonal >> 1) | right)) & full
        down = (diagonal >> 1) & right
    return score if score <= most else None
