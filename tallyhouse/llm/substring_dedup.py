"""Removal of word windows that also begin in an earlier document (op1).

Count-min prefilter. Every chunk of documents makes a sketch of its windows: the set of cells its
windows fall into, in ``DEPTH`` independent rows of cells. The sketches are merged block by block of
the cell space, so no task and no broadcast holds the whole sketch, and the cell space grows with
the corpus: the share of windows that only look repeated is the same at every size. A merged cell
count is never below the count of a window in it, so a window that occurs twice is always estimated
as repeated in all rows. A second pass groups exactly, by 96-bit identity of the word sequence,
only the windows estimated as repeated; before the shuffle a chunk folds its equal windows to one
entry with the smallest doc_id, so a passage held by a third of all documents is one entry per chunk.
The answer to an entry is one bit: does another chunk hold this window in an earlier document.

NULL text is an empty text, NULL doc_id counts as later than all others, rows with equal doc_id never
remove from each other, and a text with fewer words than a window keeps all of them. Other columns
are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import compress

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tallyhouse.llm import packing
from tallyhouse.llm.common import documents, integer, query, stored
from tallyhouse.llm.rolling import Words, mix

DEPTH, CELLS_PER_WINDOW, BLOCK_BITS, ENTRIES_PER_PART = 2, 8, 25, 1 << 21
RESULT = "doc_id long, n_words long, n_removed long, kept_sha256 string, kept_text string"


class ChunkWindows:
    """All windows of a chunk with their sketch cells; the same in every pass."""

    def __init__(self, texts: list[bytes], size: int, blocks: int):
        self.words = Words(texts)
        self.at = self.words.window_starts(size)
        self.owner = self.words.owner(size)
        self.high = self.words.windows(size, 0)
        self.low = self.words.windows(size, 1)
        per_row = np.uint64(max(blocks // DEPTH, 1) << BLOCK_BITS)
        self.cells = [
            (mix(self.high + np.uint64((row + 1) * 0x9E3779B97F4A7C15 % (1 << 64))) % per_row).astype(np.int64)
            + row * int(per_row)
            for row in range(DEPTH)
        ]

    def sketch(self) -> tuple[np.ndarray, np.ndarray]:
        """The sorted cells of the chunk, and which of them hold more than one of its windows."""
        cells, counts = np.unique(np.concatenate(self.cells), return_counts=True)
        return cells, counts > 1

    def repeated(self, answers) -> np.ndarray:
        """Windows estimated to occur more than once in the corpus."""
        cells, many = self.sketch()
        block = cells >> BLOCK_BITS
        for row in answers:
            low, high = np.searchsorted(block, [row["part"], row["part"] + 1])
            many[low:high] |= packing.unpack_bits(row["bits"], high - low)
        flags = np.ones(len(self.at), dtype=bool)
        for row in self.cells:
            flags &= many[np.searchsorted(cells, row)]
        return flags

    def entries(self, flags: np.ndarray, ids: np.ndarray, parts: int):
        """Distinct flagged windows by part and identity: the smallest doc_id of each, and the
        entry number of every flagged window."""
        high, low, ids = self.high[flags], self.low[flags] >> np.uint64(32), ids[self.owner[flags]]
        part = (high % np.uint64(parts)).astype(np.int64)
        order = np.lexsort((low, high, part))
        new = np.ones(len(order), dtype=bool)
        new[1:] = (np.diff(high[order]) != 0) | (np.diff(low[order]) != 0)
        at = np.flatnonzero(new)
        number = np.empty(len(order), dtype=np.int64)
        number[order] = np.cumsum(new) - 1
        smallest = np.minimum.reduceat(ids[order], at) if len(at) else ids[:0]
        return part[order][at], high[order][at], low[order][at].astype(np.uint32), smallest, number


def _chunks(batches: Iterator[pa.RecordBatch]):
    for one in packing.single_rows(batches):
        yield one, *packing.chunk_rows(one)


def remove_repeated(docs: DataFrame, size: int = 13) -> DataFrame:
    """One row per document: counts, digest and text without the words that repeated windows cover.

    Runs jobs: chunks of the documents and the two answers are written to the scratch folder.
    """
    chunks = packing.chunked(docs)
    total = integer(chunks, F.sum("n_words"))
    blocks = DEPTH * max(1, -(-total * CELLS_PER_WINDOW >> BLOCK_BITS))
    parts = max(1, -(-total // ENTRIES_PER_PART))

    def sketches(batches):
        for _, chunk, _, texts in _chunks(batches):
            cells, _ = ChunkWindows(texts, size, blocks).sketch()
            block = cells >> BLOCK_BITS
            for b in np.unique(block).tolist():
                low, high = np.searchsorted(block, [b, b + 1])
                inside = cells[low:high] & ((1 << BLOCK_BITS) - 1)
                yield pa.record_batch({
                    "part": pa.array([b], pa.int64()), "chunk": pa.array([chunk], pa.int64()),
                    "body": pa.array([packing.pack_sorted(inside, np.uint32)], pa.binary()),
                })

    def merge(group: pd.DataFrame) -> pd.DataFrame:
        once = np.zeros(1 << BLOCK_BITS, dtype=bool)
        more = np.zeros(1 << BLOCK_BITS, dtype=bool)
        for body in group["body"]:
            cells = packing.unpack_sorted(body, np.uint32)
            more[cells[once[cells]]] = True
            once[cells] = True
        bits = [packing.pack_bits(more[packing.unpack_sorted(b, np.uint32)]) for b in group["body"]]
        return pd.DataFrame({"chunk": group["chunk"], "part": group["part"], "bits": bits})

    answer = "chunk long, part long, bits binary"
    estimated = stored(packing.by_chunk(
        chunks.mapInArrow(sketches, "part long, chunk long, body binary").groupBy("part").applyInPandas(merge, answer),
        "estimated",
    ), "estimated")

    def entries(batches):
        for one, chunk, ids, texts in _chunks(batches):
            seen = ChunkWindows(texts, size, blocks)
            flags = seen.repeated(packing.answers(one, "estimated"))
            part, high, low, smallest, _ = seen.entries(flags, np.array(ids, dtype=np.int64), parts)
            for p in np.unique(part).tolist():
                a, b = np.searchsorted(part, [p, p + 1])
                yield pa.record_batch({
                    "part": pa.array([p], pa.int64()), "chunk": pa.array([chunk], pa.int64()),
                    "high": pa.array([packing.pack_sorted(high[a:b], np.uint64)], pa.binary()),
                    "low": pa.array([low[a:b].tobytes()], pa.binary()),
                    "ids": pa.array([packing.pack_numbers(smallest[a:b])], pa.binary()),
                })

    def group(rows: pd.DataFrame) -> pd.DataFrame:
        highs = [packing.unpack_sorted(x, np.uint64) for x in rows["high"]]
        ends = np.cumsum([len(x) for x in highs])
        high = np.concatenate(highs)
        low = np.concatenate([np.frombuffer(x, dtype=np.uint32) for x in rows["low"]])
        ids = np.concatenate([packing.unpack_numbers(x, np.int64) for x in rows["ids"]])
        order = np.lexsort((low, high))
        new = np.ones(len(order), dtype=bool)
        new[1:] = (np.diff(high[order]) != 0) | (np.diff(low[order]) != 0)
        smallest = np.minimum.reduceat(ids[order], np.flatnonzero(new))
        earlier = np.empty(len(order), dtype=bool)
        earlier[order] = smallest[np.cumsum(new) - 1] < ids[order]
        bits = [packing.pack_bits(x) for x in np.split(earlier, ends[:-1])]
        return pd.DataFrame({"chunk": rows["chunk"], "part": rows["part"], "bits": bits})

    found = packing.with_answers(chunks, estimated).mapInArrow(
        entries, "part long, chunk long, high binary, low binary, ids binary"
    )
    earlier = packing.by_chunk(found.groupBy("part").applyInPandas(group, answer), "earlier")

    def cut(batches):
        for one, _, ids, texts in _chunks(batches):
            seen = ChunkWindows(texts, size, blocks)
            flags = seen.repeated(packing.answers(one, "estimated"))
            whose = np.array(ids, dtype=np.int64)
            part, _, _, smallest, number = seen.entries(flags, whose, parts)
            elsewhere = np.zeros(len(part), dtype=bool)
            for row in packing.answers(one, "earlier"):
                a, b = np.searchsorted(part, [row["part"], row["part"] + 1])
                elsewhere[a:b] = packing.unpack_bits(row["bits"], b - a)
            gone = elsewhere[number] | (smallest[number] < whose[seen.owner[flags]])
            at = seen.at[flags][gone]
            depth = np.zeros(len(seen.words.starts) + 1, dtype=np.int32)
            np.add.at(depth, at, 1)
            np.add.at(depth, at + size, -1)
            keep = np.cumsum(depth)[:-1] == 0
            result: list[tuple] = []
            for i, text, first, n in zip(ids, texts, seen.words.first, seen.words.counts):
                mask = keep[first : first + n]
                words = text.split() if mask.all() else compress(text.split(), mask.tolist())
                kept = b" ".join(words)
                result.append((
                    None if i == packing.NULL_ID else i, int(n), int(n - mask.sum()),
                    hashlib.sha256(kept).hexdigest(), kept.decode("utf-8", "replace"),
                ))
            names = ("doc_id", "n_words", "n_removed", "kept_sha256", "kept_text")
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string())
            yield pa.record_batch({n: pa.array(c, k) for n, c, k in zip(names, zip(*result), kinds)})

    return packing.with_answers(chunks, estimated, earlier).mapInArrow(cut, RESULT)


@query("op1_substring_dedup")
def op1(spark, folder):
    return remove_repeated(documents(spark, folder)).drop("kept_text")
