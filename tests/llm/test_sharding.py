"""Hash-tree placement: contract, even shares, and what moves when the tree changes."""

from __future__ import annotations

import hashlib
import math
import zlib
from collections import Counter, defaultdict

import duckdb
import pytest
from pyspark.sql import functions as F

from tallyhouse.llm import common, sharding
from tallyhouse.llm.sharding import TREE, Shard, grown, levels, shard_of
from tallyhouse.session import fresh_path
from tests.conftest import TEST_FOLDER

WORDS = [(k, f"text {k}") for k in range(4000)]
AWKWARD = [(1, None), (2, ""), (3, "é🙂"), (None, "x"), (None, "x"), (None, None), (7, "same"), (7, "same"), (7, "other"),
           (-(1 << 63), "least"), ((1 << 63) - 1, "most"), (9, "long " * 60_000)]


def brute(key, tree):
    """Descend the tree by hand."""
    name = ""
    live = [s for s in tree if s.weight > 0]
    for depth in range(3):
        below = defaultdict(float)
        for s in live:
            path = [s.region, s.rack, str(s.shard)][: depth + 1]
            if "/".join(path[:-1]) == name:
                below["/".join(path)] += s.weight

        def draw(node):
            bits = int(hashlib.md5(f"{node}:{key}".encode()).hexdigest()[:13], 16)
            return -math.log((bits + 0.5) / 2**52) / below[node]

        name = min(sorted(below), key=draw)
    return int(name.rsplit("/", 1)[1])


def shards(spark, tree, n=4000):
    frame = spark.range(n).select("id", shard_of(F.col("id").cast("string"), tree).alias("shard"))
    return dict(map(tuple, frame.collect()))


@pytest.fixture(scope="module")
def before(spark):
    return shards(spark, TREE)


def test_contract_on_awkward_rows(spark):
    rows = [(i, t, "clash", 1) for i, t in AWKWARD + WORDS[100:300]]
    frame = spark.createDataFrame(rows, "doc_id long, text string, shard string, size int").repartition(5)
    got = sharding.placed(frame).collect()
    larger = grown(TREE, 8)
    expected = Counter()
    for i, t, *_ in rows:
        key, data = "" if i is None else str(i), (t or "").encode()
        expected[i, len(data) + 1, zlib.crc32(data), "key", brute(key, TREE), brute(key, larger)] += 1
    assert Counter((r.doc_id, r.size, r.text_crc32, r.law, r.shard, r.grown_shard) for r in got) == expected
    slots = defaultdict(list)
    for r in got:
        slots[r.shard].append((r.slot, float("inf") if r.doc_id is None else r.doc_id))
    for held in slots.values():
        held.sort()
        assert [s for s, _ in held] == list(range(len(held))) and [i for _, i in held] == sorted(i for _, i in held)
    assert all(r.grown_shard in (r.shard, 8) for r in got)


def test_empty_table(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert sharding.placed(none).count() == 0 and sharding.moves(none, TREE, grown(TREE, 8)).count() == 0


def test_shares_follow_weights(spark, before):
    counts = Counter(before.values())
    assert set(counts) == set(range(8)) and all(abs(n - 500) < 90 for n in counts.values())
    heavy = [s._replace(weight=3.0) if s.shard == 0 else s for s in TREE]
    assert abs(Counter(shards(spark, heavy).values())[0] - 1200) < 130
    none = [s._replace(weight=0.0) if s.shard == 5 else s for s in TREE]
    assert 5 not in shards(spark, none).values()


def test_one_more_shard_takes_rows_only_into_itself(spark, before):
    tree, now = TREE, before
    for new in (8, 9, 10):
        tree = grown(tree, new)
        after = shards(spark, tree)
        assert all(after[k] in (s, new) for k, s in now.items())
        assert abs(Counter(after.values())[new] - 4000 / (new + 1)) < 100
        now = after


def test_movement_stays_in_subtrees_whose_weight_changed(spark, before):
    """A weight in rack 0 changes: within region 1, and within rack 1, no row moves."""
    after = shards(spark, [s._replace(weight=2.0) if s.shard == 0 else s for s in TREE])
    moved = {(s, after[k]) for k, s in before.items() if after[k] != s}
    assert moved and not any(a >= 4 and b >= 4 for a, b in moved)
    assert not any({a, b} == {2, 3} for a, b in moved)
    gone = shards(spark, [s._replace(weight=0.0) if s.shard == 7 else s for s in TREE])
    assert not any(a < 4 and b < 4 and a != b for a, b in ((s, gone[k]) for k, s in before.items()))


def test_moves_and_written_shards(spark, before):
    docs = spark.createDataFrame(WORDS, "doc_id long, text string").withColumn("lang", F.lit("en"))
    larger = grown(TREE, 8)
    after = shards(spark, larger)
    expected = Counter((s, after[k]) for k, s in before.items() if after[k] != s)
    assert {(r.shard, r.to_shard): r.n_rows for r in sharding.moves(docs, TREE, larger).collect()} == expected
    path = fresh_path(spark, "shards")
    sharding.write_shards(docs, path)
    back = spark.read.parquet(path)
    assert {r.doc_id: r.shard for r in back.collect()} == before
    assert sorted((r.doc_id, r.text) for r in back.collect()) == WORDS


def test_rejects_bad_trees():
    with pytest.raises(ValueError, match="no shard"):
        levels([Shard("a", "b", 0, 0.0)])
    with pytest.raises(ValueError, match="twice"):
        levels([Shard("a", "b", 0), Shard("a", "c", 0)])
    with pytest.raises(ValueError, match="in the tree"):
        grown(TREE, 3)


def test_against_sql(spark):
    got = sharding.op13(spark, TEST_FOLDER)
    con = duckdb.connect()
    con.execute(f"create view documents as select * from read_parquet('{TEST_FOLDER}/documents.parquet')")
    names = sorted(got.columns)
    expected = con.execute(f"select {', '.join(names)} from ({common.SQL['op13_sharding']})").fetchall()
    assert Counter(map(tuple, got.select(*names).collect())) == Counter(expected)
