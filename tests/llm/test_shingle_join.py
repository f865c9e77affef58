"""The join's work on groups of near copies, and its parity test."""

from __future__ import annotations

import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings, strategies as st

from tallyhouse.llm import packing, rolling, shingle_join
from tallyhouse.llm.shingle_join import fewest_differences, folded, parity_bitmap
from tests.llm.test_corpus import components


def near_copies(k, words=60, original=True):
    choice = random.Random(3)
    base = [f"w{x}" for x in range(words)]
    rows = [(0, " ".join(base))] if original else []
    for i in range(1, k + 1):
        changed = list(base)
        changed[choice.randrange(words)] = f"other{i}"
        rows.append((i, " ".join(changed)))
    return rows


def verified(spark, monkeypatch, rows):
    """The result, and how many pairs of texts were compared."""
    counts, real = [], shingle_join._verified

    def counting(pairs, texts, percent):
        counts.append(pairs.count())
        return real(pairs, texts, percent)

    with monkeypatch.context() as patch:
        patch.setattr(shingle_join, "_verified", counting)
        frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
        got = shingle_join.link_components(frame).drop("digest").collect()
    return Counter(map(tuple, got)), sum(counts)


@pytest.mark.parametrize("original", [True, False])
def test_pairs_grow_with_the_group_not_its_square(spark, monkeypatch, original):
    compared = {}
    for k in (300, 600, 1200):
        rows = near_copies(k, original=original)
        got, compared[k] = verified(spark, monkeypatch, rows)
        assert {c for (_, _, c) in got} == {0 if original else 1}  # chains of neighbouring changes join them all
    assert compared[1200] <= 5 * compared[300] and compared[1200] < 30 * 1200


def test_unlinked_texts_that_share_one_shingle(spark, monkeypatch):
    """A list of many texts without links is tested to its end, by bitmaps alone."""
    rows = [(k, "one two three four five " + " ".join(f"t{k}x{x}" for x in range(12))) for k in range(120)]
    rows += [(500, rows[7][1] + " more"), (501, rows[90][1] + " words")]
    got, compared = verified(spark, monkeypatch, rows)
    assert got == components(rows) and compared < 40


def test_same_prefix_different_rest(spark, monkeypatch):
    """Groups of several nodes: links inside and between groups are all found."""
    choice = random.Random(5)
    rows = []
    for family in range(6):
        base = [f"f{family}w{x}" for x in range(40)]
        for i in range(25):
            changed = list(base)
            for _ in range(choice.randint(0, 3)):
                changed[choice.randrange(40)] = f"c{choice.randrange(9)}"
            rows.append((100 * family + i, " ".join(changed)))
    got, _ = verified(spark, monkeypatch, rows)
    assert got == components(rows)


@settings(max_examples=200, deadline=None)
@given(st.sets(st.integers(0, 2**64 - 1), min_size=1, max_size=80), st.sets(st.integers(0, 2**64 - 1), max_size=200), st.integers(0, 80))
def test_parity_never_counts_too_many_differences(one, more, kept):
    other = set(sorted(one)[:kept]) | more or {1}
    x, y = (np.array(sorted(v), dtype=np.uint64) for v in (one, other))
    low = fewest_differences(parity_bitmap(x), parity_bitmap(y))
    assert low <= len(one ^ other) and (low - len(one ^ other)) % 2 == 0
    assert low == fewest_differences(parity_bitmap(y), parity_bitmap(x))
    short = sum((a ^ b).bit_count() if (a ^ b) >= 0 else ((a ^ b) + (1 << 64)).bit_count()
                for a, b in zip(folded(parity_bitmap(x)), folded(parity_bitmap(y))))
    assert short <= low


def test_verified_rows_are_cut_by_bytes():
    """Pairs of very long texts are hashed one by one, short ones together; every row is in one slice."""
    texts = [b"a" * n for n in (10, 2 * shingle_join.VERIFIED_BYTES, 5, 7, 0)]
    column = pa.array([packing.squeeze(t) for t in texts])
    assert list(shingle_join._slices(column, column)) == [slice(0, 1), slice(1, 2), slice(2, 5)]
    assert list(shingle_join._slices(column[:0], column[:0])) == []


def test_powers_of_a_very_long_text_are_not_kept(monkeypatch):
    monkeypatch.setattr(rolling, "MOST_POWERS", 1 << 19)
    long = rolling._powers(5, (1 << 19) + 9)
    assert int(long[-1]) == pow(5, (1 << 19) + 8, 1 << 64) and 5 not in rolling._POWERS
    assert int(rolling._powers(5, 300_000)[-1]) == pow(5, 299_999, 1 << 64) and len(rolling._POWERS[5]) == 1 << 19
