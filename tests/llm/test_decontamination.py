"""Passages with long words in them: what the fingerprints lose, against brute force."""

from __future__ import annotations

import random
from collections import Counter

import pytest

from tallyhouse.llm import decontamination
from tests.llm.test_corpus import passages

SCHEMA = "doc_id long, text string"


def likeness(a: list[str], b: list[str]) -> float:
    def weights(words):
        made = Counter(tuple(words[k : k + 5]) for k in range(len(words) - 4))
        return made, sum(n * sum(map(len, s)) for s, n in made.items())

    (x, wx), (y, wy) = weights(a), weights(b)
    common = sum(n * sum(map(len, s)) for s, n in (x & y).items())
    return common / (wx + wy - common)


def planted(words: int, n: int, seed: int):
    """Items, and for each a document with a passage in which one or two words became much longer ones, at a likeness
    of 0.80 to 0.90."""
    rng = random.Random(seed)
    items, rows = [], []
    for k in range(n):
        item = [f"{rng.choice('abcdefgh')}{rng.randrange(10 ** rng.randint(1, 6))}" for _ in range(words)]
        changed: list[str] = []
        while not 0.80 <= likeness(item, changed) < 0.90:
            changed = list(item)
            for at in rng.sample(range(words), rng.randint(1, 2)):
                changed[at] = "z" * rng.randint(5, 3 * words) + str(k)
        items.append((k, " ".join(item)))
        rows.append((k, "before it " + " ".join(changed) + " and after"))
    return items, rows


@pytest.mark.parametrize("words", [50, 100, 200])
def test_long_words_do_not_turn_a_fingerprint(spark, words):
    items, rows = planted(words, 150, words)
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {(r.doc_id, r.item_id) for r in decontamination.find_passages(spark.createDataFrame(rows, SCHEMA), bench).collect()}
    want = set().union(*(passages([row], [item]) for row, item in zip(rows, items)))
    print(f"{words} words: {len(got)} of {len(want)}")
    assert len(want) == 150 and got <= want and len(got) >= 0.98 * len(want)


def test_fingerprints_follow_the_weight_in_common(spark):
    """Equal multisets have equal fingerprints; one repeated shingle more changes few bits."""
    base = " ".join(f"w{k}" for k in range(60))
    rows = [(1, base), (2, base), (3, base + " w55 w56 w57 w58 w59"), (4, " ".join(f"v{k}" for k in range(60)))]
    made = decontamination._fingerprint(decontamination._shingles(spark.createDataFrame(rows, SCHEMA)))
    bits = {r.doc_id: (r.high % 2**64) << 64 | r.low % 2**64 for r in made.collect()}
    distance = lambda a, b: (bits[a] ^ bits[b]).bit_count()
    assert distance(1, 2) == 0 and 0 < distance(1, 3) <= 31 and 40 < distance(1, 4) < 88


def test_blocks_find_every_pair_within_the_radius(spark):
    """Pairs at each distance up to the radius meet in a block, whichever bits differ."""
    rng = random.Random(5)
    signed = lambda x: x - 2**64 if x >= 2**63 else x
    left, right = [], []
    for k in range(640):
        bits, turned = rng.getrandbits(128), rng.sample(range(128), k % (decontamination.RADIUS + 1))
        if k < 32:  # as even as it can be: one bit of the last block, two of every other
            turned = [8 * block + bit for block in range(16) for bit in (0, 5)][: decontamination.RADIUS]
        other = bits ^ sum(1 << bit for bit in turned)
        left.append((k, signed(bits >> 64), signed(bits % 2**64)))
        right.append((k, signed(other >> 64), signed(other % 2**64)))
    a = decontamination._blocks(spark.createDataFrame(left, "k long, high long, low long"))
    b = decontamination._blocks(spark.createDataFrame(right, "k long, high long, low long"), nearby=True)
    met = a.join(b.select("k", "block", "value"), ["k", "block", "value"]).select("k").distinct().count()
    assert met == 640


def test_empty_tables(spark):
    bench = spark.createDataFrame([(1, "one two three four five six")], "item_id long, text string")
    none = spark.createDataFrame([], SCHEMA)
    assert decontamination.find_passages(none, bench).count() == 0
    assert decontamination.find_passages(none, bench.where("false")).count() == 0
