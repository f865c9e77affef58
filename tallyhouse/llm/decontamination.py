"""Benchmark passages in documents (op3), with DataFrame functions only.

A benchmark item of n words is compared with windows of n words. Texts are lower-cased and split
at white space and punctuation; a shingle is five words and weighs as many as its words have letters, each
time it occurs.

1. Every shingle of every document is looked up among the items' shingles. A window that is similar enough
   to an item holds item shingles worth 80 % of the item's weight, so only windows whose hits add up
   to that are kept; no other window could pass step 4.
2. Each kept window and each item gets a 128-bit SimHash. The k-th occurrence of a shingle adds the square root of
   its weight, with the sign of its own hash: the expected product of two such sums is the weight in common, so the share
   of differing bits is arccos(weight in common / root of the product of both weights) / pi, whatever words hold the weight.
3. Fingerprints are cut into ``BLOCKS`` blocks of 8 bits. With ``RADIUS`` = 2 * BLOCKS - 1, two fingerprints within the
   radius differ in at most one bit of some block. Items are indexed under each block's value and the eight values
   one bit away, windows look up their values: the join on (size, block, value) finds all pairs within the radius.
4. Exact similarity, the weight in common over the weight of both, decides.

At a similarity of 0.80 a bit differs with probability 0.15, so the distance is 19 of 128 with a deviation of 4 and about one
such pair in 400 lies beyond the radius and is lost; at 0.82 it is one in 1,000, at 0.85 one in 6,000.

The item shingles are broadcast up to ``MOST_BROADCAST`` rows, beyond that the lookup is a shuffle join. Items of
fewer than five words have no shingle and are never found; a document shorter than an item is compared as a
whole. NULL texts and empty tables give no rows; repeated rows give one result for each doc_id
and text; NULL doc_ids and item_ids are reported as NULL. Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tallyhouse.llm.common import documents, load, query, stored, typed

SHINGLE, BLOCKS, BLOCK_BITS, PERCENT, MOST_BROADCAST = 5, 16, 8, 80, 200_000
RADIUS = 2 * BLOCKS - 1
SEPARATORS = r"""[\x09-\x0D\x20.,;:!?"'()]+"""


def _words(df: DataFrame) -> DataFrame:
    words = df.withColumn("words", F.filter(F.split(F.lower("text"), SEPARATORS, -1), lambda x: x != ""))
    return words.withColumn("n_words", F.size("words")).where(f"n_words >= {SHINGLE}").drop("text")


_AT = "sequence(0, greatest(size(z.h) - {}, 0))".format(SHINGLE)
_HASH = "xxhash64({})".format(", ".join(f"get(z.h, i + {k})" for k in range(SHINGLE)))


def _hashes(df: DataFrame) -> DataFrame:
    """Adds ``n_words`` and ``hashes`` of the shingles by position. Word hashes are bound to a lambda
    variable, so no position computes them again."""
    made = F.expr(f"""
        element_at(transform(array(struct(transform(words, x -> xxhash64(x)) as h)), z -> transform({_AT}, i -> {_HASH})), 1)""")
    return _words(df).withColumn("hashes", made).drop("words")


def _shingles(df: DataFrame) -> DataFrame:
    """Adds ``n_words`` and ``shingles``, an array of (h, w) by position."""
    made = F.expr(f"""
        element_at(transform(array(struct(
            transform(words, x -> xxhash64(x)) as h, transform(words, x -> char_length(x)) as c)), z ->
          transform({_AT}, i -> struct({_HASH} as h, {" + ".join(f"get(z.c, i + {k})" for k in range(SHINGLE))} as w))), 1)""")
    return _words(df).withColumn("shingles", made).drop("words")


def _weight(shingles: str) -> Column:
    return F.aggregate(shingles, F.lit(0), lambda total, x: total + x["w"])


def _half(signed: str, part: int) -> Column:
    """64 bits: the sign, for each bit of the hashes, of the roots for and against it."""
    value = "x.h" if not part else "xxhash64(x.h, 1)"
    return F.expr(f"""
        aggregate(transform(sequence(0, 63), b -> if(aggregate(
            transform({signed}, x -> if((shiftright({value}, b) & 1L) = 1L, x.r, -x.r)), 0L, (t, v) -> t + v) > 0,
            shiftleft(1L, b), 0L)), 0L, (t, v) -> t | v)""")


def _fingerprint(df: DataFrame, shingles: str = "shingles") -> DataFrame:
    """Adds ``high`` and ``low``. In a sorted list the place of an equal shingle's first occurrence numbers the others;
    roots are whole numbers, so equal multisets have equal sums in any order."""
    signed = F.expr(f"""
        element_at(transform(array(array_sort({shingles})), z -> transform(z, (x, i) -> struct(
            xxhash64(x.h, i + 1 - array_position(z, x)) as h, bigint(round(1000 * sqrt(x.w))) as r))), 1)""")
    df = df.withColumn("signed", signed)
    return df.withColumn("high", _half("signed", 0)).withColumn("low", _half("signed", 1)).drop("signed")


def _blocks(df: DataFrame, nearby: bool = False) -> DataFrame:
    """One row per block of the fingerprint, ``nearby`` also one for each value a bit away."""
    each, mask = 64 // BLOCK_BITS, (1 << BLOCK_BITS) - 1
    parts = [
        F.expr(f"shiftright({half}, {BLOCK_BITS * k}) & {mask}L").cast("int")
        for half in ("high", "low") for k in range(each)
    ][:BLOCKS]
    rows = df.select("*", F.posexplode(F.array(*parts)).alias("block", "value"))
    if not nearby:
        return rows
    flips = F.array(F.lit(0), *[F.lit(1 << bit) for bit in range(BLOCK_BITS)])
    return rows.withColumn("flip", F.explode(flips)).withColumn("value", F.expr("value ^ flip")).drop("flip")


def _lookup(table: DataFrame, rows: int) -> DataFrame:
    return F.broadcast(table) if rows <= MOST_BROADCAST else table


def find_passages(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``doc_id, digest, item_id, start_word, n_words, similarity``: the best window of each document
    and item that are similar. Runs jobs over the benchmark and writes it to the scratch folder."""
    items = typed(benchmark, item_id="long", text="string").dropDuplicates()
    items = _shingles(items.withColumn("item", F.xxhash64("item_id", "text")))
    items = _fingerprint(stored(items.withColumn("item_weight", _weight("shingles")), "shingles"))
    items = stored(items.withColumnRenamed("n_words", "size"), "items")
    hits = items.select("item", "size", "item_weight", F.explode("shingles").alias("s")).select(
        "item", "size", "item_weight", F.col("s.h").alias("h"), F.col("s.w").alias("w")
    ).distinct()
    n_hits, n_items = hits.count(), items.count()

    texts = typed(docs, doc_id="long", text="string").withColumn("digest", F.xxhash64("text"))
    places = _hashes(texts).select("doc_id", "digest", "n_words", F.posexplode_outer("hashes").alias("pos", "h"))
    found = places.join(_lookup(hits, n_hits), "h")
    starts = F.expr(f"sequence(greatest(0, pos - size + {SHINGLE}), least(pos, greatest(n_words - size, 0)))")
    windows = found.select("doc_id", "digest", "item", "size", "item_weight", "w", "pos", F.explode(starts).alias("start"))
    # A repeated row holds the same hits again: only distinct positions count.
    windows = windows.groupBy("doc_id", "digest", "item", "size", "item_weight", "start", "pos").agg(F.max("w").alias("w"))
    windows = windows.groupBy("doc_id", "digest", "item", "size", "item_weight", "start").agg(F.sum("w").alias("got"))
    windows = windows.where(f"100 * got >= {PERCENT} * item_weight").groupBy("doc_id", "digest").agg(
        F.collect_set(F.struct("size", "start")).alias("windows")
    )
    windows = stored(windows, "windows").toDF("owner", "owner_digest", "windows")
    held = texts.join(
        windows, F.col("doc_id").eqNullSafe(F.col("owner")) & (F.col("digest") == F.col("owner_digest"))
    ).drop("owner", "owner_digest").dropDuplicates(["doc_id", "digest"])
    cut = _shingles(held).select("doc_id", "digest", "n_words", "shingles", F.explode_outer("windows").alias("window")).select(
        "doc_id", "digest", F.col("window.start").alias("start_word"), F.col("window.size").alias("size"),
        F.expr(f"slice(shingles, window.start + 1, window.size - {SHINGLE - 1})").alias("inside"),
    )
    cut = stored(_fingerprint(cut, "inside"), "cut")
    index = _blocks(items.select("item", "size", "high", "low"), nearby=True).select(
        "item", "size", F.col("high").alias("item_high"), F.col("low").alias("item_low"), "block", "value"
    )
    near = _blocks(cut).join(_lookup(index, n_items * BLOCKS * (BLOCK_BITS + 1)), ["size", "block", "value"]).where(
        f"bit_count(high ^ item_high) + bit_count(low ^ item_low) <= {RADIUS}"
    )
    near = near.groupBy("doc_id", "digest", "start_word", "size", "item").agg(F.first("inside").alias("inside"))
    known = items.select("item", "item_id", "item_weight", F.col("shingles").alias("wanted"))
    both = near.join(_lookup(known, n_hits), "item")
    common = F.expr("""
        aggregate(transform(array_intersect(inside, wanted), x -> x.w * least(
            size(filter(inside, y -> y.h = x.h)), size(filter(wanted, y -> y.h = x.h)))), 0, (t, v) -> t + v)""")
    exact = both.withColumn("common", common).withColumn(
        "similarity", F.expr("common / double({} + item_weight - common)".format("aggregate(inside, 0, (t, x) -> t + x.w)"))
    ).where(f"100 * similarity >= {PERCENT}")
    return exact.groupBy("doc_id", "digest", "item_id").agg(
        F.max(F.struct("similarity", (-F.col("start_word")).alias("back"), "size")).alias("best")
    ).select(
        "doc_id", "digest", "item_id", (-F.col("best.back")).alias("start_word"),
        F.col("best.size").alias("n_words"), F.col("best.similarity").alias("similarity"),
    )


@query("op3_decontamination")
def op3(spark, folder):
    return find_passages(documents(spark, folder), load(spark, folder, "benchmark")).drop("digest")
