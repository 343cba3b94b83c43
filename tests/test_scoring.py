import random

import pandas as pd
from hypothesis import given, settings
from hypothesis import strategies as st

from certwatch.functions.scoring import bag_batch, bits_batch, lcs_batch


def lcs_table(a: str, b: str) -> int:
    row = [0] * (len(b) + 1)
    for ca in a:
        prev = 0
        for j, cb in enumerate(b, 1):
            prev, row[j] = row[j], prev + 1 if ca == cb else max(row[j], row[j - 1])
    return row[-1]


strings = st.text(alphabet="abc é漢😀\0", max_size=200)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(strings, strings), min_size=1, max_size=20))
def test_lcs_equals_textbook(pairs):
    a, b = (pd.Series(list(s)) for s in zip(*pairs))
    got = lcs_batch(a, b)
    assert got.tolist() == [lcs_table(x, y) for x, y in pairs]
    assert got.tolist() == lcs_batch(b, a).tolist()


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.text(alphabet="abcdef 0é", max_size=150), st.text(alphabet="abcdef 0é", max_size=150)),
                min_size=1, max_size=20))
def test_bags_never_exceed_the_distance(pairs):
    a, b = (bag_batch(pd.Series(list(s))) for s in zip(*pairs))
    for i, (x, y) in enumerate(pairs):
        differing = sum(((int(a[w][i]) ^ int(b[w][i])) & (2**64 - 1)).bit_count() for w in ("bag0", "bag1"))
        assert differing <= len(x) + len(y) - 2 * lcs_table(x, y)


def test_very_long_strings_among_short_ones():
    a, b = pd.Series(["ab" * 3000, "", "abc"]), pd.Series(["ba" * 2000, "x", "ac"])
    assert lcs_batch(a, b).tolist() == [4000, 0, 2]
    assert bag_batch(pd.Series([], dtype=str)).shape == (0, 2)


def test_pair_bits_flip_three_times_an_edit():
    rng = random.Random(9)
    texts = ["".join(rng.choice("ab 1é") for _ in range(rng.randint(0, 40))) for _ in range(400)]
    cuts = [(s, rng.randrange(len(s) + 1)) for s in texts]
    edited = [s[:p] + rng.choice("ab1") + s[p:] if rng.random() < 0.5 else s[:p] + s[p + 1:] for s, p in cuts]
    a, b = (bits_batch(pd.Series(t)) for t in (texts, edited))
    for i in range(len(texts)):
        flips = sum(((int(a[w][i]) ^ int(b[w][i])) & (2**64 - 1)).bit_count() for w in ("two0", "two1"))
        assert flips <= 3
