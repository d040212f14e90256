"""String functions in plain Python, which workers import without making a UDF."""

from __future__ import annotations

import unicodedata

import numpy as np

#: Texts this long are compared with all windows of another at once.
COMBED = 32


def latin_fold(x: str) -> str:
    out, latin = [], False
    for c in unicodedata.normalize("NFD", x):
        if unicodedata.combining(c):
            if latin:
                continue
        else:
            latin = "LATIN" in unicodedata.name(c, "")
        out.append(c)
    return unicodedata.normalize("NFC", "".join(out))


def lcs(a: str, b: str) -> int:
    """Length of the longest common subsequence: ends that agree count as they are, and each character of the rest of the shorter text is one word operation."""
    if len(a) < len(b):
        a, b = b, a
    if a == b:
        return len(a)
    n = same(a, b)
    a, b = a[n:], b[n:]
    m = same(a[::-1], b[::-1])
    a, b = a[: len(a) - m], b[: len(b) - m]
    where: dict[str, int] = {}
    bits: dict[str, list[int]] = {}
    for i, ch in enumerate(a):
        bits.setdefault(ch, []).append(i)
    for ch in set(b) & bits.keys():
        row = bytearray(len(a) // 8 + 1)
        for i in bits[ch]:
            row[i >> 3] |= 1 << (i & 7)
        where[ch] = int.from_bytes(row, "little")
    full = (1 << len(a)) - 1
    s = full
    for ch in b:
        if u := s & where.get(ch, 0):
            s = ((s + u) | (s - u)) & full
    return n + m + len(a) - s.bit_count()


def same(a: str, b: str) -> int:
    """Length of the common beginning."""
    low, high = 0, min(len(a), len(b))
    while low < high:
        mid = (low + high + 1) // 2
        if a[low:mid] == b[low:mid]:
            low = mid
        else:
            high = mid - 1
    return low


def ratio(a: str, b: str) -> float:
    return 100.0 if not a and not b else 200.0 * lcs(a, b) / (len(a) + len(b))


def sort_ratio(a: str, b: str) -> float:
    return ratio(" ".join(sorted(a.split())), " ".join(sorted(b.split())))


def set_ratio(a: str, b: str) -> float:
    x, y = set(a.split()), set(b.split())
    if not x or not y:
        return 0.0
    both = " ".join(sorted(x & y))
    if both and (x <= y or y <= x):
        return 100.0
    left, right = (" ".join(filter(None, [both, " ".join(sorted(d))])) for d in (x - y, y - x))
    best = ratio(left, right)
    # both begins left and right, and is the longest common subsequence with each
    return max(best, *(200.0 * len(both) / (len(both) + len(d)) for d in (left, right))) if both else best


def by_windows(short: str, long: str) -> float:
    """Best ratio of a text with the windows of another, from the seaweeds of one comb over both (Tiskin's semi-local longest common subsequence).

    A strand enters at each row and each column; at a cell two strands cross unless its characters agree or they have crossed before. A window's characters
    that are in no common subsequence are as many as the strands that enter and leave within it.
    """
    m, n = len(short), len(long)
    a, b = (np.frombuffer(x.encode("utf-32-le", "surrogatepass"), np.uint32) for x in (short[::-1], long))
    h, v = np.arange(m, dtype=np.int32), np.arange(m, m + n, dtype=np.int32)
    for d in range(m + n - 1):  # the cells of a diagonal at once, rows from the last to the first
        j = max(0, d - m + 1)
        k = j - d + m - 1
        size = min(d + 1, n) - j
        x, y = h[k : k + size], v[j : j + size]
        match = a[k : k + size] == b[j : j + size]
        low, high = np.minimum(x, y), np.maximum(x, y)
        np.copyto(low, y, where=match)
        np.copyto(high, x, where=match)
        x[:], y[:] = low, high
    end = np.flatnonzero(v >= m)
    start = v[end] - m
    heads = n - np.arange(n)  # characters of the windows that begin at each place
    heads[: max(n - m, 0)] = m
    within = (end - m + 1 <= start).nonzero()[0]
    steps = np.bincount(np.maximum(end[within] - m + 1, 0), minlength=n + 1) - np.bincount(start[within] + 1, minlength=n + 1)
    lengths = heads - np.cumsum(steps)[:n]
    first = np.arange(1, min(m, n + 1))  # windows cut at the beginning
    common = first - np.cumsum(v >= m)[: len(first)]
    return max(float((200.0 * lengths / (m + heads)).max()), float((200.0 * common / (m + first)).max(initial=0.0)))


def partial_ratio(a: str, b: str) -> float:
    """Best ratio of the shorter string with any window of the longer, also shorter windows at its ends."""
    if not a or not b:
        return 0.0

    def best(short: str, long: str) -> float:
        n = len(short)
        if short in long:
            return 100.0
        if n >= COMBED:
            return by_windows(short, long)
        windows = {long[max(0, i) : i + n] for i in range(1 - n, len(long))}
        return max(ratio(short, w) for w in windows if w)

    if len(a) == len(b):
        return max(best(a, b), best(b, a))
    return best(a, b) if len(a) < len(b) else best(b, a)


def jaro_winkler(a: str, b: str) -> float:
    if not a or not b:
        return 0.0
    if a == b:
        return 1.0
    reach = max(max(len(a), len(b)) // 2 - 1, 0)
    taken, hits = [False] * len(b), []
    # places of each character not yet passed, the next one last: a match is the first free place within reach, and what reach leaves behind stays behind
    left: dict[str, list[int]] = {}
    for j in range(len(b) - 1, -1, -1):
        left.setdefault(b[j], []).append(j)
    for i, ch in enumerate(a):
        places = left.get(ch)
        while places and places[-1] < i - reach:
            places.pop()
        if places and places[-1] <= i + reach:
            taken[places.pop()] = True
            hits.append(ch)
    m = len(hits)
    if not m:
        return 0.0
    moved = sum(x != y for x, y in zip(hits, (b[j] for j in range(len(b)) if taken[j]))) // 2
    jaro = (m / len(a) + m / len(b) + (m - moved) / m) / 3
    prefix = 0
    while prefix < min(4, len(a), len(b)) and a[prefix] == b[prefix]:
        prefix += 1
    return jaro + prefix * 0.1 * (1 - jaro) if jaro > 0.7 else jaro
