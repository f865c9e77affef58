"""Removal of lines found in many documents (op10), with DataFrame functions only.

Lines travel as 128-bit hashes of their keys, never as text. Hashes are range-partitioned with
document and position as the rest of the sort key, so the lines of one key lie next to each other in
document order and a key held by a third of all documents spreads over as many partitions as its
rows need. One stream over the sorted rows gives each key's first occurrences (one row per key and
document). Counts of documents are folded per partition before they are shuffled. What comes back
to a document is a sparse bitmap: 32 lines per word, only words with a dropped line.

A line's key is the line without ``[\\x20\\x09-\\x0D]`` at its ends, A-Z lower-cased. NULL text is one
empty line. Empty keys are never dropped while ``min_chars`` is at least 1. Rows with one doc_id count
as one document, and so do all rows without a doc_id; each row gets its own result. Other columns are
ignored. An empty table gives an empty result.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, functions as F

from tallyhouse.llm.common import documents, query, stored, typed

STRIPPED = " \t\n\x0b\f\r"
WORD = 32


def line_key(line: Column) -> Column:
    return F.translate(F.btrim(line, F.lit(STRIPPED)), string.ascii_uppercase, string.ascii_lowercase)


def _lines() -> Column:
    return F.split(F.coalesce(F.col("text"), F.lit("")), "\n", -1)


def _rows(docs: DataFrame, **extra: str) -> DataFrame:
    """Rows with a digest of the text, so that repeated doc_ids with other texts stay apart."""
    return typed(docs, doc_id="long", text="string", **extra).withColumn("digest", F.xxhash64("text"))


def first_occurrences(docs: DataFrame, min_chars: int = 1) -> DataFrame:
    """One row per key and document, sorted by key, document and position, with all positions."""
    lines = _rows(docs).select("doc_id", "digest", F.posexplode(_lines()).alias("pos", "line"))
    keys = lines.withColumn("key", line_key("line")).where(F.char_length("key") >= min_chars)
    hashed = keys.select(
        F.xxhash64("key").alias("high"), F.xxhash64(F.lit(1), "key").alias("low"), "doc_id", "digest", "pos"
    )
    place = ["high", "low", "doc_id", "digest"]
    streamed = hashed.repartitionByRange(*place).sortWithinPartitions(*place, "pos")
    return streamed.groupBy(*place).agg(F.collect_list("pos").alias("positions"))


def keep_bitmaps(docs: DataFrame, min_docs: int = 10, min_chars: int = 1) -> DataFrame:
    """``doc_id, digest, dropped``: the words of the bitmap with a dropped line, as (word, bits).

    Documents that keep every line have no row. Writes the hashed lines to the scratch folder.
    """
    found = stored(first_occurrences(docs, min_chars), "lines")
    per_document = found.groupBy("high", "low", "doc_id").agg(F.lit(1).alias("one"))
    frequent = per_document.groupBy("high", "low").agg(F.count("one").alias("n_docs")).where(F.col("n_docs") >= min_docs)
    lost = found.join(frequent, ["high", "low"], "left_semi")
    words = lost.select("doc_id", "digest", F.explode("positions").alias("pos")).groupBy(
        "doc_id", "digest", F.expr(f"pos div {WORD}").cast("int").alias("word")
    ).agg(F.bit_or(F.expr(f"shiftleft(1L, pos % {WORD})")).alias("bits"))
    return words.groupBy("doc_id", "digest").agg(F.collect_list(F.struct("word", "bits")).alias("dropped"))


def _kept(lines: str, dropped: str) -> Column:
    """The lines whose bit is not set; the bitmap is laid out once per document, not per line."""
    return F.expr(f"""
        element_at(transform(array(map_from_entries({dropped})), sparse -> element_at(transform(
            array(transform(sequence(0, (size({lines}) - 1) div {WORD}), w -> coalesce(sparse[w], 0L))),
            dense -> filter({lines}, (line, i) ->
                (shiftright(element_at(dense, cast(i div {WORD} as int) + 1), i % {WORD}) & 1L) = 0L)), 1)), 1)
    """)


def drop_frequent_lines(docs: DataFrame, min_docs: int = 10, min_chars: int = 1, extra: tuple[str, ...] = ()) -> DataFrame:
    """One row per input row: ``doc_id``, the ``extra`` text columns, ``n_lines, n_dropped, kept_text``."""
    bitmaps = keep_bitmaps(docs, min_docs, min_chars).select(
        F.col("doc_id").alias("owner"), F.col("digest").alias("owner_digest"), "dropped"
    )
    rows = _rows(docs, **{name: "string" for name in extra})
    joined = rows.join(
        bitmaps, F.col("doc_id").eqNullSafe(F.col("owner")) & (F.col("digest") == F.col("owner_digest")), "left"
    ).withColumn("lines", _lines())
    return joined.select(
        "doc_id",
        *extra,
        F.size("lines").cast("long").alias("n_lines"),
        F.coalesce(
            F.aggregate("dropped", F.lit(0), lambda n, w: n + F.bit_count(w["bits"])), F.lit(0)
        ).cast("long").alias("n_dropped"),
        F.when(F.col("dropped").isNull(), F.coalesce("text", F.lit("")))
        .otherwise(F.array_join(_kept("lines", "dropped"), "\n")).alias("kept_text"),
    )


ORACLE = """
with lines as (
    select doc_id, unnest(string_split(coalesce(text, ''), chr(10))) as line,
           generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) as pos
    from documents),
keyed as (
    select *, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as key
    from lines),
frequent as (
    select key from keyed where length(key) >= 1 group by key having count(distinct doc_id) >= 10)
select doc_id, count(*) as n_lines, count(frequent.key) as n_dropped,
       sha256(coalesce(string_agg(line, chr(10) order by pos) filter (where frequent.key is null), ''))
           as kept_sha256
from keyed left join frequent using (key)
group by doc_id
"""


@query("op10_line_dedup", ORACLE)
def op10(spark, folder):
    kept = drop_frequent_lines(documents(spark, folder))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))
