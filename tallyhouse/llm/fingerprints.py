"""Winnowed document fingerprints (op7), with DataFrame functions only.

Units are words, runs without ``[\\x20\\x09-\\x0D]``. Every run of ``K`` words has a hash; of each
``WINDOW`` hashes in a row the smallest is chosen, the rightmost of equal ones, and a choice that
several windows share is kept once, with its position. So two texts with ``K + WINDOW - 1`` words in a row in common
share a fingerprint, and nothing shorter than ``K`` words can match. A text with fewer than ``K``
words has one hash of all its words; with fewer than ``WINDOW`` hashes the smallest is chosen once.

The likeness of two fingerprints is the Jaccard similarity of their hash sets, 1 for two empty
ones. NULL text is an empty text. Documents follow each other by descending doc_id, NULL ids last,
rows with equal ids by a digest of the text; after the last comes the first. Other columns are ignored. An
empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tallyhouse.llm.common import documents, query, typed

K, WINDOW, ROWS_PER_BUCKET, MOST_BUCKETS = 3, 4, 2000, 4096
SPACES = r"[\x20\x09-\x0D]+"
LAST = (1 << 31) - 1


def winnow(text: str) -> Column:
    """The chosen (hash, position) pairs in order, as numbers: hash * 2**31 + (2**31 - 1 - position).

    The smallest number is the smallest hash, and of equal hashes the rightmost.
    """
    grams = ", ".join(f"get(h, i + {k})" for k in range(K))
    least = ", ".join(f"get(p, i + {k})" for k in range(WINDOW))
    packed = "shiftleft(shiftrightunsigned({hash}, 32), 31) + ({last} - {at})"
    every = packed.format(hash=f"xxhash64({grams})", last=LAST, at="i")
    whole = packed.format(hash="xxhash64(h)", last=LAST, at="0")
    return F.expr(f"""
        element_at(transform(array(transform(filter(split({text}, '{SPACES}', -1), x -> x <> ''), x -> xxhash64(x))), h ->
          case when size(h) = 0 then array() when size(h) < {K} then array({whole})
          else element_at(transform(array(transform(sequence(0, size(h) - {K}), i -> {every})), p ->
            if(size(p) <= {WINDOW}, array(array_min(p)),
               array_distinct(transform(sequence(0, size(p) - {WINDOW}), i -> least({least}))))), 1) end), 1)
    """)


def fingerprint(packed: str) -> Column:
    """``hash:position`` of every choice, hash in hexadecimal, joined by commas."""
    return F.expr(f"array_join(transform({packed}, x -> concat(hex(shiftright(x, 31)), ':', {LAST} - (x & {LAST}))), ',')")


def hashes(packed: str) -> Column:
    return F.expr(f"array_distinct(transform({packed}, x -> shiftright(x, 31)))")


def likeness(one: str, other: str) -> Column:
    common = F.size(F.array_intersect(one, other))
    total = F.size(one) + F.size(other) - common
    return F.when(total == 0, F.lit(1.0)).otherwise(common / total)


def with_next(docs: DataFrame) -> DataFrame:
    """``doc_id, text, next_text`` by descending doc_id, with one shuffle of the texts.

    Ids are cut into buckets of about ROWS_PER_BUCKET rows at percentiles (at most MOST_BUCKETS, so
    that the cuts stay a bounded list); each bucket also gets a copy of the row that follows its last one.
    """
    rows = typed(docs, doc_id="long", text="string").select(
        "doc_id", F.coalesce("text", F.lit("")).alias("text")
    ).withColumn("digest", F.xxhash64("text"))
    n = rows.count()
    cuts = min(max(n // ROWS_PER_BUCKET, 1), MOST_BUCKETS)
    found = rows.agg(F.percentile_approx("doc_id", [k / cuts for k in range(cuts)], 100 * cuts)).first()[0] or []
    bounds = F.array(*[F.lit(x).cast("long") for x in sorted(set(found))]) if found else F.array().cast("array<long>")
    bucket = F.when(F.col("doc_id").isNull(), F.lit(cuts + 1)).otherwise(
        F.size(F.filter(bounds, lambda b: b > F.col("doc_id")))
    )
    placed = rows.withColumn("bucket", bucket)
    # One row per bucket: at most MOST_BUCKETS rows meet in this window.
    order = Window.orderBy("bucket")
    first = placed.groupBy("bucket").agg(F.min(F.struct(
        (-F.coalesce("doc_id", F.lit(0))).alias("back"), "digest", "doc_id")).alias("first"))
    first = first.select(
        F.coalesce(F.lag("bucket").over(order), F.max("bucket").over(Window.orderBy("bucket").rowsBetween(
            Window.unboundedPreceding, Window.unboundedFollowing))).alias("goes_to"),
        F.col("first.doc_id").alias("first_id"), F.col("first.digest").alias("first_digest"),
    )
    copies = rows.join(F.broadcast(first), F.col("doc_id").eqNullSafe(F.col("first_id")) & (F.col("digest") == F.col("first_digest")))
    copies = copies.dropDuplicates(["doc_id", "digest", "goes_to"]).select(
        "doc_id", "text", "digest", F.col("goes_to").alias("bucket"), F.lit(True).alias("copy"))
    inside = Window.partitionBy("bucket").orderBy("copy", F.col("doc_id").desc_nulls_last(), "digest")
    both = placed.withColumn("copy", F.lit(False)).unionByName(copies)
    return both.withColumn("next_text", F.lead("text").over(inside)).where("not copy").select("doc_id", "text", "next_text")


def edited(text: str, other: str) -> Column:
    """The text with its last half replaced by the beginning of the other text."""
    n = F.char_length(text)
    half = F.floor(n / 2).cast("int")
    return F.concat(F.substring(text, F.lit(1), n - half), F.substring(other, F.lit(1), half))


@query("op7_fingerprints")
def op7(spark, folder):
    rows = with_next(documents(spark, folder)).withColumn("edited", edited("text", "next_text"))
    rows = rows.select(
        "doc_id", F.char_length("text").cast("long").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"),
        winnow("text").alias("own"), winnow("edited").alias("changed"), winnow("next_text").alias("following"),
    )
    rows = rows.select(
        "doc_id", "n_chars", "edited_sha256", fingerprint("own").alias("fingerprint"),
        fingerprint("changed").alias("edited_fingerprint"),
        hashes("own").alias("a"), hashes("changed").alias("b"), hashes("following").alias("c"),
    )
    return rows.select(
        "doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
        likeness("a", "b").alias("near_edited"), likeness("a", "c").alias("near_next"),
    )
