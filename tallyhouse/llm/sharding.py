"""Placement of documents in shards by a hierarchical weighted hash tree (op13), with DataFrame functions.

A tree has regions, racks and shards; a node weighs what the shards below it weigh. A row descends it:
among the children of a node the one with the smallest draw wins. A draw is ``-ln(u) / weight`` with ``u``
from a hash of the row's key and the child's name alone, so a child wins in proportion to its weight, and a
change of one weight changes no draw of another node. Rows move only between subtrees whose weights
changed: a row that stays in a subtree without changes keeps its place in it.

A shard that joins an old rack makes that rack and its region heavier, and what they draw in spreads
over all of their shards. ``grown`` therefore hangs a new shard on a branch of its own: rows then move into the new
shard only, never between the old ones. The shard's machine may stand in any region; the branch is a name.

The law is ``key``: the key (a doc_id) and the tree decide, nothing else about a row. All rows
without a doc_id share one key, the empty text. NULL text counts as empty. Repeated rows get a slot each. Slots are
numbered by doc_id (NULL last), size, crc32, then in the order that the rows were first stored in: rows are
placed by range on that whole key, so a shard or a key that holds a third of all rows spreads over tasks. Long texts
are only measured and hashed. Other columns are ignored, whatever their names. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from tallyhouse.llm.common import CRC_CELLS, crc32_sql, documents, query, stored, typed
from tallyhouse.operators.ordering import number_rows


class Shard(NamedTuple):
    region: str
    rack: str
    shard: int
    weight: float = 1.0


#: Two regions of two racks of two shards each.
TREE = tuple(Shard(f"region{n // 4}", f"rack{n // 2}", n) for n in range(8))


def grown(tree: Sequence[Shard], shard: int, weight: float = 1.0) -> tuple[Shard, ...]:
    """The tree with one more shard, on a branch of its own."""
    if any(s.shard == shard for s in tree):
        raise ValueError(f"shard {shard} is in the tree")
    return (*tree, Shard(f"branch{shard}", f"branch{shard}", shard, weight))


def levels(tree: Sequence[Shard]) -> list[list[list[tuple[str, float, int]]]]:
    """For each level the children of every node of the level above, as (name, weight, number below).

    Below a region is the number of its list of racks, below a rack that of its shards, and below a shard the shard."""
    live = sorted(s for s in tree if s.weight > 0)
    if not live:
        raise ValueError("the tree has no shard with a weight")
    if len({s.shard for s in tree}) < len(tree):
        raise ValueError("a shard is in the tree twice")
    regions: dict[str, dict[str, list[Shard]]] = {}
    for s in live:
        regions.setdefault(s.region, {}).setdefault(s.rack, []).append(s)
    top, racks, shards = [], [], []
    for region, below in regions.items():
        top.append((region, sum(s.weight for each in below.values() for s in each), len(racks)))
        here = []
        for rack, leaves in below.items():
            here.append((f"{region}/{rack}", sum(s.weight for s in leaves), len(shards)))
            shards.append([(f"{region}/{rack}/{s.shard}", s.weight, s.shard) for s in leaves])
        racks.append(here)
    return [[top], racks, shards]


def _lists(level: list[list[tuple[str, float, int]]]) -> Column:
    return F.array(*[
        F.array(*[F.struct(F.lit(n).alias("name"), F.lit(float(w)).alias("weight"), F.lit(b).alias("below"))
                  for n, w, b in children])
        for children in level
    ])


def _draw(key: Column, child: Column) -> Column:
    """-ln(u) / weight, u from 52 bits of a hash of the child's name and the key, never 0 or 1."""
    bits = F.conv(F.substring(F.md5(F.concat(child["name"], F.lit(":"), key).cast("binary")), 1, 13), 16, 10)
    return -F.log((bits.cast("double") + 0.5) / float(1 << 52)) / child["weight"]


def shard_of(key: Column, tree: Sequence[Shard]) -> Column:
    """The shard of a text key. A tree of any size is three array literals, one lookup a level."""
    at = F.lit(0)
    for level in levels(tree):
        children = F.element_at(_lists(level), at + 1)
        drawn = F.transform(children, lambda c: F.struct(_draw(key, c).alias("draw"), c["below"].alias("below")))
        at = F.array_min(drawn)["below"]
    return at


def key_of(doc_id: str = "doc_id") -> Column:
    return F.coalesce(F.col(doc_id).cast("string"), F.lit(""))


def placed(docs: DataFrame, tree: Sequence[Shard] = TREE, larger: Sequence[Shard] | None = None) -> DataFrame:
    """``doc_id, size, text_crc32, law, shard, slot, grown_shard`` for every row; ``larger`` is the tree of grown_shard."""
    larger = larger or grown(tree, max(s.shard for s in tree) + 1)
    text = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    small = stored(
        typed(docs, doc_id="long", text="string").select(
            "doc_id",
            (F.octet_length(text).cast("long") + 1).alias("size"),
            F.crc32(text).alias("text_crc32"),
            F.lit("key").alias("law"),
            shard_of(key_of(), tree).alias("shard"),
            shard_of(key_of(), larger).alias("grown_shard"),
            F.monotonically_increasing_id().alias("row"),
        ),
        "placed",
    )
    order = ["shard", F.col("doc_id").asc_nulls_last(), "size", "text_crc32", "row"]
    numbered = number_rows(small, order, "number")
    counts = small.groupBy("shard").agg(F.count("*").alias("n_rows"))
    # One row per shard of the tree: a window over them all is bounded, and so is the broadcast.
    earlier = W.orderBy("shard").rowsBetween(W.unboundedPreceding, -1)
    first = counts.select(
        F.col("shard").alias("home"), F.coalesce(F.sum("n_rows").over(earlier), F.lit(0)).alias("first")
    )
    return numbered.join(F.broadcast(first), F.col("shard") == F.col("home")).select(
        "doc_id", "size", "text_crc32", "law", "shard", (F.col("number") - 1 - F.col("first")).alias("slot"), "grown_shard"
    )


def write_shards(docs: DataFrame, path: str, tree: Sequence[Shard] = TREE) -> None:
    """The documents as Parquet, one folder per shard. A large shard is written by several tasks."""
    named = docs.withColumn("shard", shard_of(key_of(), tree))
    named.hint("rebalance", F.col("shard")).write.partitionBy("shard").option("compression", "zstd").parquet(path)


def moves(docs: DataFrame, tree: Sequence[Shard], other: Sequence[Shard]) -> DataFrame:
    """Rows and bytes that go from one shard to another when ``other`` replaces ``tree``: ``shard, to_shard, n_rows, n_bytes``."""
    rows = typed(docs, doc_id="long", text="string").select(
        shard_of(key_of(), tree).alias("shard"), shard_of(key_of(), other).alias("to_shard"),
        F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("bytes"),
    )
    return rows.where("shard <> to_shard").groupBy("shard", "to_shard").agg(
        F.count("*").alias("n_rows"), F.sum("bytes").alias("n_bytes")
    )


def _descent_sql(tree: Sequence[Shard], name: str) -> str:
    top, racks, shards = levels(tree)

    def table(level):
        cells = [(at, n, w, b) for at, children in enumerate(level) for n, w, b in children]
        return ", ".join(f"({at}, '{n}', {w}, {b})" for at, n, w, b in cells)

    text, before = "", "(select distinct key, 0 as below from keyed)"
    for depth, level in enumerate((top, racks, shards)):
        text += f"""
    {name}{depth} as (
        select key, arg_min(node.below, struct_pack(
            draw := -ln((cast('0x' || substr(md5(node.name || ':' || key), 1, 13) as bigint) + 0.5) / 4503599627370496) / node.weight,
            below := node.below)) as below
        from {before} as rows
        join (values {table(level)}) as node(parent, name, weight, below) on node.parent = rows.below
        group by key),"""
        before = f"{name}{depth}"
    return text


ORACLE = f"""
with crc as ({CRC_CELLS}),
keyed as (
    select doc_id, coalesce(cast(doc_id as varchar), '') as key, hex(encode(coalesce(text, ''))) as bytes
    from documents),
measured as (
    select doc_id, key, length(bytes) // 2 + 1 as size,
        {crc32_sql('bytes')} as text_crc32
    from keyed, crc),{_descent_sql(TREE, 'here')}{_descent_sql(grown(TREE, len(TREE)), 'then')}
result as (
    select doc_id, size, text_crc32, 'key' as law, here2.below as shard, then2.below as grown_shard
    from measured join here2 using (key) join then2 using (key))
select *, row_number() over (partition by shard order by doc_id, size, text_crc32) - 1 as slot from result
"""


@query("op13_sharding", ORACLE)
def op13(spark, folder):
    return placed(documents(spark, folder))
