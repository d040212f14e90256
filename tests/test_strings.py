"""String distances of long texts against their definitions."""

import random

from lakelink.functions import strings as S


def lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        old, row = row, [0]
        for j, y in enumerate(b):
            row.append(old[j] + 1 if x == y else max(old[j + 1], row[j]))
    return row[-1]


def test_common_subsequence_and_windows():
    r = random.Random(5)
    for n in (3, 20, 33, 60):
        for alphabet in ("ab ", "abcdefé "):
            a, b = ("".join(r.choices(alphabet, k=k)) for k in (n, n + r.randint(0, 25)))
            assert S.lcs(a, b) == S.lcs(b, a) == lcs(a, b)
            both = [(a, b), (b, a)] if len(a) == len(b) else [(a, b)]
            want = max(200.0 * lcs(x, w) / (len(x) + len(w)) for x, y in both for i in range(1 - len(x), len(y)) if (w := y[max(0, i) : i + len(x)]))
            assert S.partial_ratio(a, b) == want


def test_long_texts_end_soon():
    """Two names of 4,000 letters, as documents without line breaks have them: window by window this takes minutes."""
    r = random.Random(6)
    a, b = ("".join(r.choices("abcdefgh ", k=4000)) for _ in range(2))
    assert 40 < S.partial_ratio(a, b) < 100 and 0 < S.jaro_winkler(a, b) < 1
    assert S.by_windows(a[:1000], a) == 100.0
