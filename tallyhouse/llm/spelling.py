"""Spelling variants of a corpus vocabulary: words one edit apart, by dynamic programming over sorted lists (op11).

A sorted list of words is scanned with one edit matrix per query word. Words next to each other share a prefix, and
rows of the matrix for that prefix are the same, so they are computed once (the list's longest common prefixes say where a
new row begins). Rows are kept as a band of three cells, since a cell further from the diagonal is over one edit already. Where
all three are over one edit, the whole range of words with that prefix is skipped.

The list is cut so that both words of a near pair always meet. Let m be the shorter length. Two words one edit
apart share a prefix and a suffix of together m - 1 characters at least, so they share the first or the last half of that. A word
goes to one list by its first half and to one by its last, for m its length and one less. Of a pair that shares
both, the prefix list alone reports it. A list that is still long (``MOST_TOGETHER``) is cut again: its words share
some characters, of the rest each word goes by the first and by the last half. This ends where all but one character are
shared, and there the alphabet bounds the list. So no list grows with the vocabulary, and no pair is lost or found twice.

Words are counted inside every task first; a frequent word reaches the shuffle as one row per task. Every word is
followed to its root by doubling: n grows at least tenfold with every step, so a handful of joins do.

NULL and empty texts have no words. A NULL doc_id counts as the empty text in the hash. Repeated rows count each. Words of
any length are compared whole. Ties go to the smaller word. Other columns are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from tallyhouse.llm.common import CRC_CELLS, crc32_sql, documents, query, stored, typed
from tallyhouse.llm.packing import texts_of

MIN_CHARS = 7
MIN_COUNT = 2
TIMES = 10  # a form is at least so many times as frequent as its word
SLIPS = 31  # one of so many (document, run) pairs loses a character
MOST_TOGETHER = 1000  # words of a list that is not cut further
FLUSH = 200_000  # distinct words a task holds before it hands them on
PAIRS = 1 << 20  # (query, list word) pairs scanned at once at most
_RUN = re.compile("[a-zÀ-ÿ]+")


def slipped(run: str, before: int, slips: int) -> str:
    """The run, less a character if the hash of its document and itself says so. ``before``: crc32 of ``<doc_id>:``."""
    h = zlib.crc32(run.encode(), before)
    if h % slips:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1 :]


def vocabulary(docs: DataFrame, min_chars: int = MIN_CHARS, min_count: int = MIN_COUNT, slips: int = SLIPS) -> DataFrame:
    """``word, n`` of all words of at least ``min_chars`` characters and ``min_count`` occurrences."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter = Counter()

        def rows():
            return pa.record_batch({"word": pa.array(total.keys(), pa.string()), "n": pa.array(total.values(), pa.int64())})

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), texts_of(batch.column(1))):
                before = zlib.crc32(b":" if doc_id is None else b"%d:" % doc_id)
                for run, n in Counter(_RUN.findall(text.lower().decode())).items():  # bytes.lower: A-Z alone
                    if len(run) >= min_chars:
                        word = slipped(run, before, slips)
                        if len(word) >= min_chars:
                            total[word] += n
                if len(total) >= FLUSH:
                    yield rows()
                    total.clear()
        yield rows()

    counted = typed(docs, doc_id="long", text="string").mapInArrow(count, "word string, n long")
    words = counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count)
    return stored(words, "vocabulary")


def _cut(rows: DataFrame) -> DataFrame:
    """Every row twice: by the first half of what is not shared yet, and by the last half of it."""
    half = F.expr("(m - prefix - suffix) div 2")  # of m - 1 - prefix - suffix, rounded up
    by_first = F.struct((F.col("prefix") + half).alias("prefix"), F.col("suffix"), F.col("below"))
    by_last = F.struct(
        F.col("prefix"), (F.col("suffix") + half).alias("suffix"), F.least("below", F.col("prefix") + half).alias("below")
    )
    return rows.select("word", "n", "length", "m", F.explode(F.array(by_first, by_last)).alias("cut")).select(
        "word", "n", "length", "m", "cut.*"
    )


def _keyed(rows: DataFrame) -> DataFrame:
    shared = [F.expr("left(word, prefix)"), F.expr("right(word, suffix)")]
    return rows.withColumn("list", F.xxhash64("m", "prefix", "suffix", "below", *shared))


def lists(words: DataFrame, most: int = MOST_TOGETHER) -> Iterator[DataFrame]:
    """Frames of rows keyed by ``list``. Both words of a near pair share exactly one list.

    ``m``: the shorter length of the pairs sought; ``prefix, suffix``: how many characters the list shares; ``below``:
    pairs with a longer common prefix belong to another list."""
    sized = words.select("word", F.col("n"), F.char_length("word").alias("length"))
    whole = sized.select(
        "*", F.explode(F.array("length", F.col("length") - 1)).alias("m"), F.lit(0).alias("prefix"), F.lit(0).alias("suffix"),
        F.lit(2**31 - 1).alias("below"),
    ).where("m > 0")
    left = _keyed(_cut(whole.where("m > 1")).unionByName(whole.where("m = 1")))
    while True:
        # How long a list is: one folded count per list and task.
        long = stored(
            left.where("m - 1 > prefix + suffix").groupBy("list").agg(F.count("*").alias("rows")).where(F.col("rows") > most),
            "long-lists",
        ).select("list")
        if long.isEmpty():
            yield left
            return
        yield left.join(long, "list", "left_anti")
        left = stored(_keyed(_cut(left.join(long, "list", "left_semi").drop("list"))), "cut-lists")


def scan(group: np.ndarray, words: pa.Array, m: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers (query, other) of words one edit apart in the same list; the query has length m, and every pair comes once.

    Rows are sorted by ``group``, then word."""
    codes = np.frombuffer("".join(words.to_pylist()).encode("utf-32-le"), dtype=np.uint32)
    length = pc.utf8_length(words).to_numpy().astype(np.int64)
    start = np.cumsum(length) - length
    n = len(length)
    lcp = np.full(n, -1, dtype=np.int64)  # with the row before; -1 where a list begins
    open_, depth = np.flatnonzero(group[1:] == group[:-1]) + 1, 0
    while len(open_):
        lcp[open_] = depth
        open_ = open_[(length[open_] > depth) & (length[open_ - 1] > depth)]
        open_ = open_[codes[start[open_] + depth] == codes[start[open_ - 1] + depth]]
        depth += 1
    by_depth = np.argsort(lcp, kind="stable")
    depths = lcp[by_depth]
    edges = np.append(np.flatnonzero(lcp < 0), n)
    lo = edges[np.searchsorted(edges, np.arange(n), "right") - 1]
    hi = edges[np.searchsorted(edges, np.arange(n), "right")]
    queries = np.flatnonzero((length == m) & (hi - lo > 1))
    found: list[tuple[np.ndarray, np.ndarray]] = []
    turn = np.cumsum(hi[queries] - lo[queries]) // PAIRS
    for part in np.split(queries, np.flatnonzero(np.diff(turn)) + 1):
        # One row per query and prefix of the list that is at most one edit away: its words [a, b), its band of cells.
        q, a, b = part, lo[part], hi[part]
        band = np.tile(np.array([2, 0, 1], dtype=np.int8), (len(q), 1))  # query prefixes of length depth - 1, depth, depth + 1
        depth = 0
        while len(q):
            whole = length[a] == depth  # the first word of the range ends here
            end = length[q] - depth + 1
            hit = np.flatnonzero(whole & (end >= 0) & (end <= 2))
            hit = hit[band[hit, end[hit]] == 1]
            near_q, near = q[hit], a[hit]
            once = (length[near] == length[near_q] + 1) | ((length[near] == length[near_q]) & (near > near_q))
            found.append((near_q[once], near[once]))
            a = a + whole
            some = a < b
            q, a, b, band = q[some], a[some], b[some], band[some]
            # Ranges of the words with one more character in common: where lcp equals depth, a new one begins.
            bounds = np.searchsorted(depths, [depth, depth + 1])
            cuts = by_depth[bounds[0] : bounds[1]]
            first, last = np.searchsorted(cuts, a, "right"), np.searchsorted(cuts, b, "left")
            parts = last - first + 1
            parent = np.repeat(np.arange(len(q)), parts)
            nth = np.arange(len(parent)) - np.repeat(np.cumsum(parts) - parts, parts)
            cuts = np.append(cuts, 0)  # so that the numbers below are valid where they are not used
            low = np.where(nth == 0, a[parent], cuts[np.minimum(first[parent] + nth - 1, len(cuts) - 1)])
            high = np.where(nth == parts[parent] - 1, b[parent], cuts[np.minimum(first[parent] + nth, len(cuts) - 1)])
            q, a, b, old = q[parent], low, high, band[parent]
            letter = codes[start[a] + depth]
            band = np.full((len(q), 3), 2, dtype=np.int8)
            for k in range(3):  # the query's prefix of length j
                j = depth + k
                cell = np.full(len(q), 2, dtype=np.int8)
                if k < 2:
                    cell = np.minimum(cell, old[:, k + 1] + 1)
                if k > 0:
                    cell = np.minimum(cell, band[:, k - 1] + 1)
                if j > 0:
                    inside = length[q] >= j
                    same = codes[start[q] + np.minimum(j, length[q]) - 1] == letter
                    cell = np.where(inside, np.minimum(cell, old[:, k] + ~same), 2)
                band[:, k] = np.minimum(cell, 2)
            depth += 1
            alive = band.min(axis=1) <= 1
            q, a, b, band = q[alive], a[alive], b[alive], band[alive]
    return np.concatenate([f[0] for f in found] or [lo[:0]]), np.concatenate([f[1] for f in found] or [lo[:0]])


def common_prefix(words: pa.Array, one: np.ndarray, other: np.ndarray) -> np.ndarray:
    codes = np.frombuffer("".join(words.to_pylist()).encode("utf-32-le"), dtype=np.uint32)
    length = pc.utf8_length(words).to_numpy().astype(np.int64)
    start = np.cumsum(length) - length
    shared, open_, depth = np.zeros(len(one), dtype=np.int64), np.arange(len(one)), 0
    while len(open_):
        shared[open_] = depth
        x, y = one[open_], other[open_]
        open_, x, y = (v[(length[x] > depth) & (length[y] > depth)] for v in (open_, x, y))
        open_ = open_[codes[start[x] + depth] == codes[start[y] + depth]]
        depth += 1
    return shared


def near_pairs(keyed: DataFrame) -> DataFrame:
    """``word, other, other_n``: both directions of every near pair of the lists."""

    def pairs(table: pa.Table) -> pa.RecordBatch:
        table = table.combine_chunks()
        words = table["word"].combine_chunks()
        m, below, n = (table[c].to_numpy().astype(np.int64) for c in ("m", "below", "n"))
        one, other = scan(table["list"].to_numpy(), words, m)
        ours = common_prefix(words, one, other) < below[one]
        one, other = one[ours], other[ours]
        left, right = np.concatenate([one, other]), np.concatenate([other, one])
        return pa.record_batch({"word": words.take(pa.array(left)), "other": words.take(pa.array(right)), "other_n": pa.array(n[right])})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # the last list, which may go on in the next batch
        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([batch])
            table = pa.concat_tables([held, table]) if held is not None else table
            group = table["list"].to_numpy()
            last = int(np.searchsorted(group, group[-1]))
            if last:
                yield pairs(table.slice(0, last))
            held = table.slice(last)
        if held is not None:
            yield pairs(held)

    rows = keyed.select("list", "word", "n", "m", "below").repartition("list").sortWithinPartitions("list", "word")
    return rows.mapInArrow(run, "word string, other string, other_n long")


def rooted(forms: DataFrame) -> DataFrame:
    """``word, root``: every word of ``forms`` (word, form) followed to its last form."""
    at = stored(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        further = at.select(F.col("word").alias("stop"), F.col("root").alias("next"))
        steps = at.join(further, F.col("root") == F.col("stop"), "left")
        moved = stored(steps.select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        at = moved.select("word", "root")
        if moved.where("moved").isEmpty():
            return at


def variants(words: DataFrame, times: int = TIMES, most: int = MOST_TOGETHER) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` for every row of a vocabulary (word, n)."""
    pairs = None
    for keyed in lists(words, most):
        part = near_pairs(keyed)
        pairs = part if pairs is None else pairs.unionByName(part)
    # At most as many near words as the alphabet allows; the largest n first, then the smaller word.
    near = pairs.groupBy("word").agg(
        F.count("*").alias("n_near"), F.min(F.struct((-F.col("other_n")).alias("order"), F.col("other"))).alias("best")
    )
    best_n: Column = -F.col("best.order")
    enough = best_n >= times * F.col("n")
    formed = stored(
        words.join(near, "word", "left").select(
            "word", F.when(enough, F.col("best.other")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
            F.when(enough, best_n).alias("form_n"),
        ),
        "forms",
    )
    roots = rooted(formed.where("form is not null"))
    return formed.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )


ORACLE = f"""
with recursive crc as ({CRC_CELLS}),
runs as (
    select doc_id, run, count(*) as n from (
        select doc_id, unnest(regexp_extract_all(
            translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-zÀ-ÿ]+')) as run
        from documents)
    where length(run) >= {MIN_CHARS} group by all),
marked as (select run, n, hex(encode(concat(doc_id, ':', run))) as digits from runs),
hashed as (select run, n, {crc32_sql('digits')} as h from marked, crc),
spelled as (
    select case when h % {SLIPS} = 0
                then substr(run, 1, (h % length(run))::int) || substr(run, (h % length(run))::int + 2) else run end as word, n
    from hashed),
words as (
    select word, sum(n)::bigint as n from spelled where length(word) >= {MIN_CHARS} group by word having sum(n) >= {MIN_COUNT}),
cut as (
    select word, n, place, substr(word, 1, place) || substr(word, place + 2) as rest
    from (select word, n, unnest(range(length(word))) as place from words)),
pairs as (
    select a.word, b.word as other, b.n as other_n from cut a join cut b on a.rest = b.rest and a.place = b.place and a.word <> b.word
    union select a.word, b.word, b.n from cut a join words b on a.rest = b.word
    union select b.word, a.word, a.n from cut a join words b on a.rest = b.word),
near as (select word, count(*) as n_near, arg_min(other, struct_pack(o := -other_n, w := other)) as best, max(other_n) as best_n
    from pairs group by word),
formed as (
    select word, n, coalesce(n_near, 0) as n_near, case when best_n >= {TIMES} * n then best end as form,
        case when best_n >= {TIMES} * n then best_n end as form_n
    from words left join near using (word)),
walk as (
    select word, word as here from formed
    union all select walk.word, formed.form from walk join formed on formed.word = walk.here where formed.form is not null)
select formed.word, form, here as root, n, n_near, form_n from formed join walk on walk.word = formed.word
where not exists (select 1 from formed as f where f.word = walk.here and f.form is not null)
"""


@query("op11_spelling", ORACLE)
def op11(spark, folder):
    return variants(vocabulary(documents(spark, folder)))
