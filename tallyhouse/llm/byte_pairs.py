"""Byte-level BPE encoding and decoding with DuckDB inside the tasks (op8).

Every partition splits its texts by the tokenizer's pattern and keeps a table of pieces it has met.
New pieces go to DuckDB as token-position rows: a recursive query joins neighbouring positions with
the merge table and contracts each piece's leftmost pair of minimum rank, until no piece has a pair
left. Decoding joins the ids with the vocabulary and aggregates the bytes in order. A piece that is
itself in the vocabulary is that token, as in the tiktoken library. Pieces longer than ``LONG_PIECE``
bytes, where one contraction a step would take the square of the length, use the same rule with a
heap. The vocabulary is read on the driver (its size is fixed by the tokenizer) and broadcast.

Rows are independent: NULL text is an empty text, repeated rows and NULL doc_ids are kept as they are,
other columns are ignored, and an empty table gives an empty result.
"""

from __future__ import annotations

import base64
import heapq
from collections import defaultdict
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, functions as F

from tallyhouse.llm.common import documents, query, typed
from tallyhouse.llm.packing import lean, texts_of

LONG_PIECE, KNOWN_PIECES, BATCH_BYTES, PIECES_AT_ONCE = 160, 600_000, 2 << 20, 20_000

CONTRACT = """
with recursive t(w, p, id, c, step) as (
  select l.w, l.p, l.id, m.c, 0::integer
  from base l left join base r on r.w = l.w and r.p = l.p + 1 left join merges m on ab = (l.id::bigint << 32) | r.id
  union all
  select * from (
    with best as (
      select w, (best // 65536)::integer as c, (best % 65536)::integer as q
      from (select w, min(c::bigint * 65536 + p) as best from t where c is not null group by w)),
    around as (
      select x.w, x.c, x.q, bm.c as before, am.c as after
      from best x left join t b on b.w = x.w and b.p = x.q - 1 left join t a on a.w = x.w and a.p = x.q + 2
           left join merges bm on bm.ab = (b.id::bigint << 32) | x.c left join merges am on am.ab = (x.c::bigint << 32) | a.id)
    select s.w, s.p - (s.p > y.q)::integer, case when s.p = y.q then y.c else s.id end,
           case when s.p = y.q then y.after when s.p = y.q - 1 then y.before else s.c end, (s.step + 1)::integer
    from t s join around y on s.w = y.w where s.p <> y.q + 1))
select t.w, t.id from t join (select w, max(step) as step from t group by w) f on t.w = f.w and t.step = f.step
order by t.w, t.p
"""
DECODE = "select d, string_agg(piece, '' order by p) as x from ids join vocabulary using (id) group by d order by d"


class Vocabulary:
    """Ranks of a tiktoken file and all pairs whose concatenation has a rank."""

    def __init__(self, ranks: dict[bytes, int], pairs: np.ndarray, merged: np.ndarray):
        self.ranks, self.pairs, self.merged = ranks, pairs, merged

    @staticmethod
    def read(path: str) -> tuple[dict[bytes, int], np.ndarray, np.ndarray]:
        with open(path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        pairs = [
            (ranks[token[:k]] << 32 | ranks[token[k:]], rank)
            for token, rank in ranks.items()
            for k in range(1, len(token))
            if token[:k] in ranks and token[k:] in ranks
        ]
        return ranks, np.array([p for p, _ in pairs], np.int64), np.array([c for _, c in pairs], np.int64)

    def merge_long(self, piece: bytes) -> list[int]:
        """Contract the leftmost pair of minimum rank until there is none, with a heap of pairs."""
        ranks, n = self.ranks, len(piece)
        end, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap: list[tuple[int, int, int, int]] = []

        def offer(i: int) -> None:
            j = end[i]
            if j < n and (rank := ranks.get(piece[i : end[j]])) is not None:
                heapq.heappush(heap, (rank, i, j, end[j]))

        for i in range(n):
            offer(i)
        while heap:
            _, i, j, stop = heapq.heappop(heap)
            if end[i] != j or j >= n or end[j] != stop:  # one of the two has been merged since
                continue
            end[i], end[j] = stop, -1
            if stop < n:
                before[stop] = i
            offer(i)
            if before[i] >= 0:
                offer(before[i])
        out, i = [], 0
        while i < n:
            out.append(ranks[piece[i : end[i]]])
            i = end[i]
        return out


class Encoder:
    """The pieces that a task has met, and DuckDB for those it has not.

    A piece is a number; the ids of piece k are ``pool[start[k] : start[k] + length[k]]``.
    """

    def __init__(self, vocabulary: Vocabulary, pattern: str):
        import duckdb
        import regex

        # White_Space as a property: Python's own \s takes four control characters more.
        pattern = pattern.replace(r"[^\s", r"[^\p{White_Space}").replace(r"\S", r"\P{White_Space}")
        self.split = regex.compile(pattern.replace(r"\s", r"\p{White_Space}")).findall
        self.vocabulary = vocabulary
        self.single = np.array([vocabulary.ranks[bytes([b])] for b in range(256)], dtype=np.int32)
        self.duck = duckdb.connect(config={"threads": 1, "memory_limit": "400MB"})
        self.duck.register("pairs", pa.table({"ab": vocabulary.pairs, "c": vocabulary.merged.astype(np.int32)}))
        self.duck.execute("create table merges as select * from pairs")
        self.duck.unregister("pairs")
        self.forget()

    def forget(self) -> None:
        self.number: defaultdict[str, int] = defaultdict()
        self.number.default_factory = self.number.__len__
        self.pool = np.zeros(0, dtype="<u4")
        self.length = np.zeros(0, dtype=np.int64)

    def learn(self, pieces: list[str]) -> None:
        """Add the ids of the next pieces in the order of their numbers."""
        data = [p.encode() for p in pieces]
        size = np.fromiter(map(len, data), dtype=np.int64, count=len(data))
        rank = np.fromiter((self.vocabulary.ranks.get(d, -1) for d in data), dtype=np.int64, count=len(data))
        length = np.ones(len(data), dtype=np.int64)
        whose, ids = [np.flatnonzero(rank >= 0)], [rank[rank >= 0]]
        for k in np.flatnonzero((rank < 0) & (size > LONG_PIECE)).tolist():
            long = self.vocabulary.merge_long(data[k])
            length[k] = len(long)
            whose.append(np.full(len(long), k))
            ids.append(np.array(long))
        short = np.flatnonzero((rank < 0) & (size <= LONG_PIECE))
        short = short[np.argsort(size[short], kind="stable")]
        for at in range(0, len(short), PIECES_AT_ONCE):
            part = short[at : at + PIECES_AT_ONCE]
            owner, found = self.contract([data[k] for k in part.tolist()])
            length[part] = np.bincount(owner, minlength=len(part))
            whose.append(part[owner])
            ids.append(found)
        order = np.argsort(np.concatenate(whose), kind="stable")
        self.pool = np.concatenate([self.pool, np.concatenate(ids)[order].astype("<u4")])
        self.length = np.concatenate([self.length, length])

    def contract(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The number of the piece and the id, for all tokens of the pieces in order."""
        blob = np.frombuffer(b"".join(pieces), dtype=np.uint8)
        lengths = np.fromiter(map(len, pieces), dtype=np.int64, count=len(pieces))
        starts = np.cumsum(lengths) - lengths
        self.duck.register("base", pa.table({
            "w": np.repeat(np.arange(len(pieces), dtype=np.int32), lengths),
            "p": (np.arange(len(blob)) - np.repeat(starts, lengths)).astype(np.int32),
            "id": self.single[blob],
        }))
        rows = self.duck.execute(CONTRACT).fetchnumpy()
        self.duck.unregister("base")
        return rows["w"], rows["id"]

    def encode(self, texts: list[str]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of every text."""
        if len(self.number) > KNOWN_PIECES:
            self.forget()
        codes = []
        for text in texts:
            pieces = self.split(text)
            codes.append(np.fromiter(map(self.number.__getitem__, pieces), dtype=np.int32, count=len(pieces)))
        new = list(islice(self.number, len(self.length), None))
        if new:
            self.learn(new)
        start = np.cumsum(self.length) - self.length
        out = []
        for code in codes:
            length = self.length[code]
            ends = np.cumsum(length)
            shift = np.repeat(start[code] - (ends - length), length)
            out.append(self.pool[shift + np.arange(len(shift))].tobytes())
        return out


def _small(batches: Iterator[pa.RecordBatch], column: int, most: int) -> Iterator[pa.RecordBatch]:
    """Slices of about ``most`` bytes in one column; a longer row comes alone."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist()
        at, size = 0, 0
        for i, n in enumerate(sizes):
            if i > at and size + n > most:
                yield batch.slice(at, i - at)
                at, size = i, 0
            size += n
        if len(sizes) > at:
            yield batch.slice(at)


def _shared(spark: SparkSession, path: str):
    return spark.sparkContext.broadcast(Vocabulary.read(path))


def _encoding(vocabulary, pattern: str):
    """Batches of (doc_id, text) to batches of (doc_id, ids)."""

    def run(batches):
        encoder = Encoder(Vocabulary(*vocabulary.value), pattern)
        for batch in _small(batches, 1, BATCH_BYTES):
            ids = encoder.encode([t.decode() for t in texts_of(batch.column(1))])
            yield pa.record_batch({"doc_id": batch.column(0), "ids": pa.array(ids, pa.binary())})

    return run


def _decoding(vocabulary):
    """Batches of (doc_id, ids) to batches of (doc_id, ids, decoded)."""

    def run(batches):
        import duckdb

        duck = duckdb.connect(config={"threads": 1, "memory_limit": "400MB"})
        ranks = vocabulary.value[0]
        duck.register("pieces", pa.table({
            "id": pa.array(list(ranks.values()), pa.int64()), "piece": pa.array([p.hex() for p in ranks], pa.string()),
        }))
        duck.execute("create table vocabulary as select * from pieces")
        for batch in _small(batches, 1, BATCH_BYTES):
            rows = [x or b"" for x in batch.column(1).to_pylist()]
            ids = np.frombuffer(b"".join(rows), dtype="<u4").astype(np.int64)
            counts = [len(x) // 4 for x in rows]
            duck.register("ids", pa.table({
                "d": np.repeat(np.arange(len(rows)), counts), "p": np.arange(len(ids)), "id": ids,
            }))
            found = dict(duck.execute(DECODE).fetchall())
            decoded = [bytes.fromhex(found.get(i, "")) for i in range(len(rows))]
            yield pa.record_batch({
                "doc_id": batch.column(0), "ids": batch.column(1), "decoded": pa.array(decoded, pa.binary()),
            })

    return run


IDS, DECODED = "doc_id long, ids binary", "doc_id long, ids binary, decoded binary"


def encode(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """``doc_id, ids``: the ids of the whole text as little-endian unsigned 32-bit integers."""
    run = _encoding(_shared(docs.sparkSession, path), pattern)
    return typed(docs, doc_id="long", text="string").mapInArrow(lean(run), IDS)


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """``doc_id, ids, decoded``: the bytes that the ids stand for."""
    return encoded.mapInArrow(lean(_decoding(_shared(encoded.sparkSession, path))), DECODED)


def round_trip(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """``decode`` of ``encode`` in one Python process a task in place of two, each with a vocabulary of its own."""
    vocabulary = _shared(docs.sparkSession, path)
    there, back = _encoding(vocabulary, pattern), _decoding(vocabulary)
    return typed(docs, doc_id="long", text="string").mapInArrow(lean(lambda batches: back(there(batches))), DECODED)


def digests(decoded: DataFrame) -> DataFrame:
    return decoded.select(
        "doc_id",
        F.expr("cast(octet_length(ids) div 4 as long)").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def tokenized(docs: DataFrame) -> DataFrame:
    """Ids and decoded bytes under the public vocabulary of 50,256 ranks."""
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return round_trip(docs, path, public_tokenizers.PATTERN)


@query("op8_byte_pairs")
def op8(spark, folder):
    return digests(tokenized(documents(spark, folder)))
