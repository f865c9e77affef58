"""Documents linked by the Jaccard similarity of their word 5-shingles (op6): a grouped prefix join.

1. A sketch of shingle frequencies (its cells grow with the corpus and are summed block by block over all
   documents) gives every chunk the same order of shingles, rare ones first. Two sets with Jaccard similarity of 80 % share a shingle in
   their prefixes, the first ``n - ceil(0.8 n) + 1`` shingles in that order. A shingle alone in its cell
   keeps its place in the prefix, but is no posting.
2. Documents with one prefix and one size are a group, and equal sets are one node. Postings
   (shingle, group) travel packed and sorted; a shingle with one group is dropped where it is met. Groups are expanded to
   their nodes in the lists that are left; the nodes of one group are a list of their own.
3. The nodes of a list are ranked, those with the most company first: among near copies that is their common original.
   A slice of ranks are hubs, and every hub meets all nodes behind it that are not connected with it yet, if sizes and positions allow a link. Slices
   grow fourfold, and after each one found links are contracted: a list whose nodes are connected is done. A cluster of k near copies so costs
   a multiple of k pairs, not its square. The last slice reaches the end of every list that is still open, so
   no pair that could link two components remains untested.
4. Pairs pass a sound test before their texts are fetched. A set's parity bitmap has two bits and more per shingle; where the
   bitmaps of two sets differ in more bits than linked sets can differ in shingles, there is no link. Whole texts decide about the others.

A text with fewer than five words is one shingle; without words (or NULL) it is linked with nothing
and is its own component. Rows with one doc_id are separate rows; a NULL doc_id never names a
component unless all of the component's are NULL. Other columns are ignored. An empty table gives
an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window as W, functions as F

from tallyhouse.llm import packing
from tallyhouse.llm.common import documents, integer, query, stored, typed
from tallyhouse.llm.components import contracted
from tallyhouse.llm.rolling import mix, shingle_sets

CELLS_PER_SHINGLE, BLOCK_BITS, SLICE_BITS, POSTINGS_PER_PART = 8, 25, 22, 1 << 21
MOST = 1 << 30  # a count stays there, so that it never turns back to 1
BITMAP_BITS, VERIFIED_BYTES = 25, 1 << 20
PAIRS_PER_POSTING = 3  # in a round, for each hub that a posting has met before; one hub at least


class ChunkShingles:
    """The shingle sets of a chunk's texts and their sketch cells; the same in every pass."""

    def __init__(self, texts: list[bytes], cells: int):
        self.sets = shingle_sets(texts)
        self.cell = (np.concatenate(self.sets) % np.uint64(cells)).astype(np.int64)
        self.distinct, self.count = np.unique(self.cell, return_counts=True)

    def classes(self, answers: list[dict]) -> list[np.ndarray]:
        """The frequency class of every shingle, by set."""
        rank = np.zeros(len(self.distinct), dtype=np.uint8)
        block = self.distinct >> BLOCK_BITS
        for row in answers:
            low, high = np.searchsorted(block, [row["part"], row["part"] + 1])
            rank[low:high] = np.frombuffer(packing.unsqueeze(row["bits"]), dtype=np.uint8)
        every = rank[np.searchsorted(self.distinct, self.cell)]
        return np.split(every, np.cumsum([len(s) for s in self.sets])[:-1])


def frequency_classes(chunks: DataFrame, cells: int) -> DataFrame:
    """For every chunk the frequency classes (quarters of a power of two) of its distinct cells.

    Class 0 means that the whole corpus holds one document's one shingle in this cell. The cell space grows with the corpus and is summed block by block; nothing holds all of it."""

    def count(batches):
        for one in packing.single_rows(batches):
            seen = ChunkShingles(packing.chunk_body(one).column("text").to_pylist(), cells)
            block = seen.distinct >> BLOCK_BITS
            for b in np.unique(block).tolist():
                low, high = np.searchsorted(block, [b, b + 1])
                inside = seen.distinct[low:high] & ((1 << BLOCK_BITS) - 1)
                yield pa.record_batch({
                    "part": pa.array([b], pa.int64()), "chunk": one.column("chunk"),
                    "body": pa.array([packing.pack_sorted(inside, np.uint32)], pa.binary()),
                    "counts": pa.array([packing.pack_numbers(np.minimum(seen.count[low:high], MOST).astype(np.uint32))], pa.binary()),
                })

    def add(group: pd.DataFrame) -> pd.DataFrame:
        # A block is summed in slices: its cells in use are an eighth of it, so the whole table would be the largest part.
        cells = [packing.unpack_sorted(body, np.uint32) for body in group["body"]]
        counts = [packing.unpack_numbers(c, np.uint32) for c in group["counts"]]
        classes = [np.empty(len(c), dtype=np.uint8) for c in cells]
        for first in range(0, 1 << BLOCK_BITS, 1 << SLICE_BITS):
            total = np.zeros(1 << SLICE_BITS, dtype=np.uint32)
            bounds = np.array([first, first + (1 << SLICE_BITS)], dtype=np.uint32)
            spans = [slice(*np.searchsorted(c, bounds)) for c in cells]
            for c, n, span in zip(cells, counts, spans):
                here = c[span] - np.uint32(first)
                total[here] = np.minimum(total[here] + n[span], MOST)
            for c, found, span in zip(cells, classes, spans):
                found[span] = (4 * np.log2(np.maximum(total[c[span] - np.uint32(first)], 1))).astype(np.uint8)
        return pd.DataFrame({
            "chunk": group["chunk"], "part": group["part"], "bits": [packing.squeeze(c.tobytes()) for c in classes],
        })

    counted = chunks.mapInArrow(packing.lean(count), "part long, chunk long, body binary, counts binary")
    return packing.by_chunk(counted.groupBy("part").applyInPandas(packing.lean_group(add), "chunk long, part long, bits binary"), "classes")


def _key(values: np.ndarray) -> int:
    return int.from_bytes(hashlib.blake2b(values.tobytes(), digest_size=8).digest(), "little", signed=True)


FOLDED = ("p0", "p1", "p2", "p3")  # the parity bitmap folded to 256 bits
META = "doc_id long, digest long, n long, node binary, gkey long, parity binary, " + ", ".join(f"{p} long" for p in FOLDED)


def parity_bitmap(found: np.ndarray) -> bytes:
    """One bit per value modulo the bitmap's size, flipped by every value: a power of two of at least 256 bits and 2 a value."""
    bits = max(256, 1 << int(2 * len(found) - 1).bit_length())
    odd = np.bincount((mix(found) % np.uint64(bits)).astype(np.int64), minlength=bits).astype(np.uint8) & 1
    return np.packbits(odd).tobytes()


def folded(bitmap: bytes) -> tuple[int, ...]:
    return tuple(np.bitwise_xor.reduce(np.frombuffer(bitmap, np.int64).reshape(-1, len(FOLDED)), axis=0).tolist())


def fewest_differences(one: bytes, other: bytes) -> int:
    """Two sets differ in at least so many values. A larger bitmap is folded to the size of the smaller one."""
    x, y = sorted((np.frombuffer(one, np.uint8), np.frombuffer(other, np.uint8)), key=len)
    # Bit b of n bits holds the values that are b modulo n, so halves fold by exclusive or.
    y = np.bitwise_xor.reduce(y.reshape(-1, len(x)), axis=0)
    return int(np.bitwise_count(x ^ y).sum())


def _prefixes(chunks: DataFrame, cells: int, parts: int, percent: int) -> DataFrame:
    """One pass over chunks with their classes: a row per document (part is NULL) and packed postings (part is a number)."""
    schema = f"{META}, part int, body binary, groups binary"
    names = [c.split()[0] for c in schema.split(", ")]

    def run(batches):
        for one in packing.single_rows(batches):
            docs = packing.chunk_body(one)
            seen = ChunkShingles(docs.column("text").to_pylist(), cells)
            ids, digests = docs.column("doc_id").to_pylist(), docs.column("digest").to_pylist()
            out, tokens, owners, positions, known = [], [], [], [], {}
            for doc_id, digest, found, rank in zip(ids, digests, seen.sets, seen.classes(packing.answers(one, "classes"))):
                n = len(found)
                if not n:
                    out.append((doc_id, digest, 0, None, None, None, *[None] * len(FOLDED)))
                    continue
                length = n - (percent * n + 99) // 100 + 1
                first = np.argsort(rank, kind="stable")[:length]  # ``found`` is sorted: ties in order of the hash
                prefix = found[first]
                gkey = _key(np.append(prefix, np.uint64(n)))
                bitmap = parity_bitmap(found)
                out.append((doc_id, digest, n, hashlib.blake2b(found.tobytes(), digest_size=16).digest(), gkey, bitmap, *folded(bitmap)))
                if gkey not in known:
                    known[gkey] = (len(known), n)
                    shared = np.flatnonzero(rank[first])  # class 0 comes first, and no other document can hold it
                    tokens.append(prefix[shared])
                    owners.append(np.full(len(shared), len(known) - 1))
                    positions.append(shared)
            columns = dict(zip(names, zip(*out)))
            yield pa.record_batch({
                "doc_id": pa.array(columns["doc_id"], pa.int64()), "digest": pa.array(columns["digest"], pa.int64()),
                "n": pa.array(columns["n"], pa.int64()), "node": pa.array(columns["node"], pa.binary()),
                "gkey": pa.array(columns["gkey"], pa.int64()), "parity": pa.array(columns["parity"], pa.binary()),
                **{p: pa.array(columns[p], pa.int64()) for p in FOLDED}, "part": pa.nulls(len(out), pa.int32()),
                "body": pa.nulls(len(out), pa.binary()), "groups": pa.nulls(len(out), pa.binary()),
            })
            if not tokens:
                continue
            token, owner, position = map(np.concatenate, (tokens, owners, positions))
            part = (mix(token) % np.uint64(parts)).astype(np.int64)
            turn = np.lexsort((token, part))
            token, owner, position, part = token[turn], owner[turn], position[turn], part[turn]
            every = np.array([(k, n) for k, (_, n) in known.items()], dtype=np.int64)
            for p in np.unique(part).tolist():
                a, b = np.searchsorted(part, [p, p + 1])
                used, local = np.unique(owner[a:b], return_inverse=True)
                packed = [
                    packing.pack_sorted(token[a:b], np.uint64), packing.pack_numbers(local.astype(np.uint32)),
                    packing.pack_numbers(position[a:b].astype(np.uint32)),
                ]
                yield pa.record_batch({
                    "doc_id": pa.nulls(1, pa.int64()), "digest": pa.nulls(1, pa.int64()), "n": pa.nulls(1, pa.int64()),
                    "node": pa.nulls(1, pa.binary()), "gkey": pa.nulls(1, pa.int64()), "parity": pa.nulls(1, pa.binary()),
                    **{p: pa.nulls(1, pa.int64()) for p in FOLDED}, "part": pa.array([p], pa.int32()),
                    "body": pa.array([b"".join(len(x).to_bytes(4, "little") + x for x in packed)], pa.binary()),
                    "groups": pa.array([every[used].tobytes()], pa.binary()),
                })

    return chunks.mapInArrow(packing.lean(run), schema)


def _columns(body: bytes) -> list[bytes]:
    out, at = [], 0
    while at < len(body):
        n = int.from_bytes(body[at : at + 4], "little")
        out.append(body[at + 4 : at + 4 + n])
        at += 4 + n
    return out


def _shared_lists(rows: pd.DataFrame) -> pd.DataFrame:
    """Postings of the shingles that at least two groups hold."""
    columns: tuple[list, list, list] = ([], [], [])
    for body, groups in zip(rows["body"], rows["groups"]):
        token, local, position = _columns(body)
        known = np.frombuffer(groups, dtype=np.int64).reshape(-1, 2)[:, 0]
        columns[0].append(packing.unpack_sorted(token, np.uint64))
        columns[1].append(known[packing.unpack_numbers(local, np.uint32)])
        columns[2].append(packing.unpack_numbers(position, np.uint32).astype(np.int32))
    token, gkey, pos = map(np.concatenate, columns)
    for pieces in columns:
        pieces.clear()
    turn = np.lexsort((gkey, token))
    token, gkey, pos = token[turn], gkey[turn], pos[turn]
    del turn
    new = np.ones(len(token), dtype=bool)
    new[1:] = (token[1:] != token[:-1]) | (gkey[1:] != gkey[:-1])
    token, gkey, pos = token[new], gkey[new], pos[new]
    same = np.zeros(len(token) + 1, dtype=bool)
    same[1:-1] = token[1:] == token[:-1]
    several = same[1:] | same[:-1]
    token, gkey, pos = token[several], gkey[several], pos[several]
    starts = np.ones(len(token), dtype=bool)
    starts[1:] = token[1:] != token[:-1]
    count = np.diff(np.append(np.flatnonzero(starts), len(token)))
    return pd.DataFrame({"token": token.view(np.int64), "gkey": gkey, "pos": pos, "held": np.repeat(count, count)})


def _plausible(pairs: DataFrame, members: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) of nodes whose parity bitmaps leave room for a link."""

    def run(batches):
        for batch in batches:
            sizes = [batch.column(k).to_pylist() for k in (2, 4)]
            bitmaps = [batch.column(k) for k in (3, 5)]
            keep = [
                # Sets of n and m values with a link differ in (n + m) (100 - percent) / (100 + percent) values at most.
                (100 + percent) * fewest_differences(bitmaps[0][i].as_py(), bitmaps[1][i].as_py()) <= (100 - percent) * (n + m)
                for i, (n, m) in enumerate(zip(*sizes))
            ]
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    known = members.select("node", "n", "parity")
    joined = pairs.join(known.toDF("a", "n_a", "parity_a"), "a").join(known.toDF("b", "n_b", "parity_b"), "b")
    return joined.select("a", "b", "n_a", "parity_a", "n_b", "parity_b").mapInArrow(packing.lean(run), "a binary, b binary")


def _slices(*columns: pa.Array) -> Iterator[slice]:
    """Rows whose texts (compressed) have ``VERIFIED_BYTES`` together, or one row with longer ones: hashing takes many times that."""
    first, size = 0, 0
    for at, row in enumerate(zip(*columns)):
        more = sum(packing.unsqueezed_size(t.as_py()) for t in row)
        if at > first and size + more > VERIFIED_BYTES:
            yield slice(first, at)
            first, size = at, 0
        size += more
    if len(columns[0]):
        yield slice(first, len(columns[0]))


def _verified(pairs: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """The pairs of nodes whose whole texts are similar enough."""

    def run(batches):
        for batch in batches:
            a, b = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            x, y = batch.column(2), batch.column(3)
            found_a, found_b = [], []
            for some in _slices(x, y):
                first = {k: i for i, k in reversed(list(enumerate(a[some])))}
                left = dict(zip(first, shingle_sets([packing.unsqueeze(x[some.start + i].as_py()) for i in first.values()])))
                right = shingle_sets([packing.unsqueeze(t.as_py()) for t in y[some]])
                for ka, kb, other in zip(a[some], b[some], right):
                    one = left[ka]
                    total = len(one) + len(other)
                    both = np.sort(np.concatenate([one, other]))
                    common = int((both[1:] == both[:-1]).sum())
                    if (100 + percent) * common >= percent * total:
                        found_a.append(ka)
                        found_b.append(kb)
            yield pa.record_batch({"a": pa.array(found_a, pa.binary()), "b": pa.array(found_b, pa.binary())})

    one, two = texts.toDF("a", "x"), texts.toDF("b", "y")
    joined = pairs.join(one, "a").join(two, "b").select("a", "b", "x", "y")
    return joined.mapInArrow(packing.lean(run), "a binary, b binary")


def _possible(percent: int) -> str:
    """Size and position leave room for a link. Of linked sets the first shingle in common, which both
    prefixes hold, has all others behind it in both; so this one at least passes."""
    room = "1 + least(l.n - l.pos - 1, r.n - r.pos - 1)"
    return f"100 * least(l.n, r.n) >= {percent} * greatest(l.n, r.n) and ({100 + percent}) * ({room}) >= {percent} * (l.n + r.n)"


def link_components(docs: DataFrame, percent: int = 80) -> DataFrame:
    """``doc_id, digest, n_shingles, component_id`` for every row; ``digest`` tells rows with one
    doc_id and other texts apart. Runs jobs and writes to the scratch folder."""
    return keyed_components(docs, percent).drop("comp")


def keyed_components(docs: DataFrame, percent: int = 80) -> DataFrame:
    """As ``link_components``, with the component's own key ``comp``: two components can share a
    ``component_id``, where doc_ids are NULL or repeated. It is NULL for texts without words."""
    rows = typed(docs, text="string", doc_id="long").withColumn("digest", F.xxhash64("text"))
    chunks = packing.chunked(rows, digest="long")
    total = integer(chunks, F.sum("n_words"))
    cells = max(1, -(-total * CELLS_PER_SHINGLE >> BLOCK_BITS)) << BLOCK_BITS
    parts = max(1, -(-total // (5 * POSTINGS_PER_PART)))
    ranked = packing.with_answers(chunks, frequency_classes(chunks, cells))
    packed = stored(_prefixes(ranked, cells, parts, percent), "prefixes")
    meta = packed.where("part is null").select(*[c.split()[0] for c in META.split(", ")])
    lists = stored(
        packed.where("part is not null").select("part", "body", "groups").groupBy("part")
        .applyInPandas(packing.lean_group(_shared_lists), "token long, gkey long, pos int, held long"), "lists",
    )
    nodes = meta.where("node is not null").groupBy("node", "gkey").agg(
        F.min("digest").alias("digest"), F.min("n").alias("n"), F.first("parity").alias("parity"),
        *[F.min(p).alias(p) for p in FOLDED],  # equal for one node
    )
    crowded = nodes.groupBy("gkey").agg(F.count("*").alias("k")).where("k > 1").select("gkey")
    members = stored(nodes.join(lists.select("gkey").union(crowded).distinct(), "gkey", "left_semi"), "members")
    company = lists.groupBy("gkey").agg(F.sum("held").alias("company"))  # groups met in all lists together
    places = members.select("gkey", "node", F.col("n").cast("int").alias("n")).join(company, "gkey", "left")
    shared = lists.select("token", "gkey", "pos").join(places, "gkey")
    own = places.join(crowded, "gkey", "left_semi").withColumns({"token": F.xxhash64(F.lit("own"), "gkey"), "pos": F.lit(0)})
    whole = W.partitionBy("token")
    order = whole.orderBy(F.desc_nulls_last("company"), F.xxhash64("node"), "node")
    open_lists = stored(shared.unionByName(own).select(
        "token", "node", "n", "pos", F.count("*").over(whole).cast("int").alias("k"),
        (F.row_number().over(order) - 1).alias("rank"),
    ).where("k > 1"), "open")
    labels = stored(members.select("node", F.col("node").alias("comp")), "labels")
    first, after = 0, 1
    marked = open_lists.withColumn("comp", F.col("node"))
    while True:
        apart = f"l.comp <> r.comp and r.rank > l.rank and {_possible(percent)}"
        if first:
            # Lists that their first hubs did not connect: folded bitmaps cut pairs where they are formed.
            differ = " + ".join(f"bit_count(l.{p} ^ r.{p})" for p in FOLDED)
            apart += f" and {100 + percent} * ({differ}) <= {100 - percent} * (l.n + r.n)"
        hubs = marked.where((F.col("rank") >= first) & (F.col("rank") < after))
        pairs = hubs.alias("l").join(marked.alias("r"), F.expr(f"l.token = r.token and {apart}"))
        pairs = pairs.selectExpr("l.node as a", "r.node as b").distinct()
        candidates = stored(_plausible(pairs, members, percent), "candidates")
        if not candidates.isEmpty():
            texts = _texts(rows, members.join(candidates.select(F.explode(F.array("a", "b")).alias("node")).distinct(), "node", "left_semi"))
            labels = contracted(labels, stored(_verified(candidates, texts, percent), "links"))
        # What is left: in each list the nodes behind its hubs, where they are of several components.
        marked = open_lists.where((F.col("k") > after + 1) & (F.col("rank") >= after)).join(
            labels.join(members.select("node", *FOLDED), "node"), "node"
        )
        several = F.min("comp").over(whole) != F.max("comp").over(whole)
        marked = stored(marked.withColumn("several", several).where("several").drop("several"), "marked")
        if marked.isEmpty():
            break
        open_lists = marked.drop("comp", *FOLDED)
        first, after = after, after + max(1, PAIRS_PER_POSTING * after)

    known = meta.where("node is not null")
    per_node = known.groupBy("node").agg(F.min("doc_id").alias("first")).join(labels, "node", "left")
    per_node = per_node.withColumn("comp", F.coalesce("comp", "node"))
    smallest = per_node.groupBy("comp").agg(F.min("first").alias("component_id"))
    named = per_node.join(smallest, "comp").select("node", "comp", "component_id")
    return meta.join(named, "node", "left").select(
        "doc_id", "digest", F.col("n").alias("n_shingles"),
        F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
        "comp",
    )


def _texts(rows: DataFrame, wanted: DataFrame) -> DataFrame:
    """``node, text`` (compressed) of one document for each wanted node.

    A bitmap of the wanted digests drops most other texts before the shuffle; the join then is exact. Its size follows
    their number up to 2**BITMAP_BITS bits; beyond some millions of nodes more of the other texts travel, none is lost.
    """
    digests = stored(wanted.groupBy("digest").agg(F.min("node").alias("node")), "wanted")
    bits = min(BITMAP_BITS, max(16, (16 * digests.count()).bit_length()))
    slot = F.pmod("digest", F.lit(1 << bits))
    words = digests.groupBy(F.shiftright(slot, 5).alias("at")).agg(
        F.bit_or(F.expr(f"shiftleft(1L, cast(pmod(digest, {1 << bits}) % 32 as int))")).alias("word")
    ).toPandas()  # at most 2**(BITMAP_BITS - 5) numbers
    bitmap = np.zeros(1 << (bits - 5), dtype=np.uint32)
    bitmap[words["at"].to_numpy(dtype=np.int64)] = words["word"].to_numpy(dtype=np.int64).astype(np.uint32)
    shared = rows.sparkSession.sparkContext.broadcast(bitmap)

    def run(batches):
        for batch in batches:
            slots = batch.column(1).to_numpy(zero_copy_only=False) % np.int64(1 << bits)
            needed = (shared.value[slots >> 5] >> (slots & 31).astype(np.uint32)) & np.uint32(1)
            some = batch.filter(pa.array(needed.astype(bool)))
            texts = [packing.squeeze(t) for t in packing.texts_of(some.column(0))]
            yield pa.record_batch({"digest": some.column(1), "text": pa.array(texts, pa.binary())})

    every = rows.select("text", "digest").mapInArrow(packing.lean(run), "digest long, text binary")
    return stored(every.join(digests, "digest").groupBy("node").agg(F.first("text").alias("text")), "texts")


@query("op6_shingle_join")
def op6(spark, folder):
    return link_components(documents(spark, folder)).drop("digest")
