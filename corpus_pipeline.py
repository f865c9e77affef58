"""A corpus made ready for training: the stages, in order, each on all rows that its predecessor kept.

A document that a stage rejects is gone for all later ones. The first four return the columns of ``documents``;
the last returns ``doc_id, n_tokens, ids_sha256, decoded_sha256`` of the texts that are left. Columns
that share their name with a helper column are safe, since operators take ``doc_id`` and ``text`` alone; decisions
come back by doc_id and a digest of the text, so repeated doc_ids with other texts keep their own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tallyhouse.llm import byte_pairs, decontamination, line_dedup, line_quality, shingle_join
from tallyhouse.llm.common import load, stored

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
QUALITY = 0.3


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose score is at least QUALITY; the field is trained on the labels."""
    model = line_quality.fit_sample(docs, load(spark, sf_dir, "labels"))
    return line_quality.with_score(docs.select(*COLUMNS), model, keep=True).where(F.col("score") >= QUALITY).select(*COLUMNS)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines that at least ten of them share; n_chars is counted again."""
    kept = line_dedup.drop_frequent_lines(docs.select(*COLUMNS), extra=("lang", "source"))
    return kept.select(
        "doc_id", F.col("kept_text").alias("text"), "lang", "source", F.char_length("kept_text").cast("long").alias("n_chars")
    )


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked documents the one with the smallest doc_id, NULL last; of repeated rows of it one."""
    joined = shingle_join.keyed_components(docs)
    # A text without words is linked with nothing: its row is its own group.
    alone = [F.when(F.col("comp").isNull(), F.col(name)).alias(f"own_{name}") for name in ("doc_id", "digest")]
    order = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "digest")
    first = joined.groupBy("comp", *alone).agg(F.min(order).alias("first"))
    first = first.select(F.col("first.doc_id").alias("first_id"), F.col("first.digest").alias("chosen"))
    rows = docs.select(*COLUMNS).withColumn("digest", F.xxhash64("text"))
    kept = rows.join(first, F.col("doc_id").eqNullSafe(F.col("first_id")) & (F.col("digest") == F.col("chosen")), "left_semi")
    return kept.dropDuplicates(["doc_id", "digest"]).select(*COLUMNS)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark passage."""
    hits = decontamination.find_passages(docs, load(spark, sf_dir, "benchmark"))
    hits = stored(hits.select(F.col("doc_id").alias("hit"), F.col("digest").alias("hit_digest")).distinct(), "leaks")
    rows = docs.select(*COLUMNS).withColumn("digest", F.xxhash64("text"))
    return rows.join(
        hits, F.col("doc_id").eqNullSafe(F.col("hit")) & (F.col("digest") == F.col("hit_digest")), "left_anti"
    ).select(*COLUMNS)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return byte_pairs.digests(byte_pairs.tokenized(docs))


STAGES = [
    ("quality classifier", quality),
    ("line dedup", lines),
    ("n-gram Jaccard join", near_copies),
    ("benchmark decontamination", benchmark),
    ("byte-level BPE", tokens),
]
#: The trained classifier and the merges have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over ``documents``; every result but the last is written and read again."""
    docs = load(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
