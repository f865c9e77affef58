"""Chunks of documents as single rows, and arrays of numbers as compressed bytes.

A chunk is the unit that whole-corpus passes come back to: its number is stored with it, so a later
pass, or a task that runs again, sees the same documents in the same order.
"""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from tallyhouse.llm.common import stored, typed

NULL_ID = np.iinfo(np.int64).max
CHUNK_SCHEMA = "chunk long, n_words long, body binary"


def give_back() -> None:
    """Free memory of this process goes back to the system, where its allocators can do that."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def lean(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """A function for ``mapInArrow`` that begins and ends with ``give_back``: Spark keeps a task's Python process for later
    stages, and what it holds on to counts against the executor all that time."""

    def wrapped(batches: Iterator) -> Iterator:
        give_back()
        yield from run(batches)
        give_back()

    return wrapped


def lean_group(run: Callable) -> Callable:
    """The same for a function for ``applyInPandas``, around every group."""

    def wrapped(group):
        give_back()
        done = run(group)
        give_back()
        return done

    return wrapped


def squeeze(data: bytes) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(data)


def unsqueeze(data: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(data)


def unsqueezed_size(data: bytes) -> int:
    """Bytes that ``unsqueeze`` gives; the compressed form begins with it."""
    return zstandard.frame_content_size(data)


def pack_numbers(values: np.ndarray) -> bytes:
    """Byte planes of the numbers, compressed: high bytes of small numbers cost nothing."""
    values = np.ascontiguousarray(values)
    planes = values.view(np.uint8).reshape(len(values), values.dtype.itemsize).T
    return squeeze(np.ascontiguousarray(planes).tobytes())


def unpack_numbers(data: bytes, dtype) -> np.ndarray:
    dtype = np.dtype(dtype)
    planes = np.frombuffer(unsqueeze(data), dtype=np.uint8).reshape(dtype.itemsize, -1)
    return np.ascontiguousarray(planes.T).view(dtype).reshape(-1)


def pack_sorted(values: np.ndarray, dtype) -> bytes:
    return pack_numbers(np.diff(values, prepend=values[:1] * 0).astype(dtype))


def unpack_sorted(data: bytes, dtype) -> np.ndarray:
    return np.cumsum(unpack_numbers(data, dtype), dtype=dtype)


def pack_bits(flags: np.ndarray) -> bytes:
    return squeeze(np.packbits(flags).tobytes())


def unpack_bits(data: bytes, n: int) -> np.ndarray:
    return np.unpackbits(np.frombuffer(unsqueeze(data), dtype=np.uint8), count=n).astype(bool)


def texts_of(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of a text column, empty for NULL."""
    return [t or b"" for t in column.cast(pa.binary()).to_pylist()]


def chunk_rows(batch: pa.RecordBatch) -> tuple[int, list[int], list[bytes]]:
    """One chunk row as (number, ids with NULL_ID for NULL, texts)."""
    body = chunk_body(batch)
    ids = [NULL_ID if i is None else i for i in body.column("doc_id").to_pylist()]
    return batch.column("chunk")[0].as_py(), ids, body.column("text").to_pylist()


def chunk_body(batch: pa.RecordBatch) -> pa.Table:
    """The documents of one chunk row."""
    return pa.ipc.open_stream(unsqueeze(batch.column("body")[0].as_py())).read_all()


def single_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Every row as a batch of its own."""
    for batch in batches:
        for i in range(batch.num_rows):
            yield batch.slice(i, 1)


def answers(one: pa.RecordBatch, name: str) -> list[dict]:
    """What ``with_answers`` gave a chunk: rows of ``part`` and ``bits``."""
    return (one.column(name)[0].as_py() or []) if name in one.schema.names else []


def by_chunk(bits: DataFrame, name: str) -> DataFrame:
    """All answers (chunk, part, bits) to a chunk as one row."""
    return bits.groupBy("chunk").agg(F.collect_list(F.struct("part", "bits")).alias(name))


def with_answers(chunks: DataFrame, *answered: DataFrame) -> DataFrame:
    for one in answered:
        chunks = chunks.join(one.hint("shuffle_hash"), "chunk", "left")
    return chunks


def chunked(docs: DataFrame, chunk_bytes: int = 2 << 20, **numbers: str) -> DataFrame:
    """``docs`` as stored rows of about ``chunk_bytes`` of whole texts each; a longer text is a chunk
    of its own. NULL texts are empty. ``numbers`` are further columns of ``docs`` to keep, all ``long``."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        ids: list[int | None] = []
        texts: list[bytes] = []
        others: list[list[int | None]] = [[] for _ in numbers]
        size = 0

        def row():
            columns = {"doc_id": pa.array(ids, pa.int64()), "text": pa.array(texts, pa.binary())}
            body = pa.record_batch(columns | {n: pa.array(c, pa.int64()) for n, c in zip(numbers, others)})
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, body.schema) as out:
                out.write_batch(body)
            return pa.record_batch({
                "chunk": pa.array([number], pa.int64()),
                "n_words": pa.array([sum(len(t.split()) for t in texts)], pa.int64()),
                "body": pa.array([squeeze(sink.getvalue().to_pybytes())], pa.binary()),
            })

        for batch in batches:
            more = [c.to_pylist() for c in batch.columns[2:]]
            for at, (i, t) in enumerate(zip(batch.column(0).to_pylist(), texts_of(batch.column(1)))):
                if texts and size + len(t) > chunk_bytes:
                    yield row()
                    number, ids, texts, size = number + 1, [], [], 0
                    others = [[] for _ in numbers]
                ids.append(i)
                texts.append(t)
                for values, column in zip(others, more):
                    values.append(column[at])
                size += len(t)
        if texts:
            yield row()

    rows = typed(docs, doc_id="long", text="string", **numbers).mapInArrow(lean(pack), CHUNK_SCHEMA)
    return stored(rows, "chunks")
