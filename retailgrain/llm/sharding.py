"""Sharding by a hierarchical weighted hash tree: region, rack, shard.

At each level a row draws once for every child, ``-ln(u) / weight`` with ``u`` a hash of the
row's id and the child's name, and goes to the smallest draw. A child's draw depends on no
other child, so a change of weight moves rows only between that child's subtree and the rest.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from retailgrain.llm.common import hex_cell, ranked


@dataclass(frozen=True)
class Rack:
    name: str
    shards: tuple[tuple[int, float], ...]  # (shard, weight)

    @property
    def weight(self) -> float:
        return sum(w for _, w in self.shards)


@dataclass(frozen=True)
class Region:
    name: str
    racks: tuple[Rack, ...]

    @property
    def weight(self) -> float:
        return sum(r.weight for r in self.racks)


Tree = tuple[Region, ...]


def plan_tree(shards: int, base: int = 40, racks: int = 4, per_rack: int = 2) -> Tree:
    """Tree of equal shards. The first ``base`` fill regions of ``racks`` racks of ``per_rack`` shards.

    Every later shard comes as a region of its own: no other subtree's weight changes then,
    and so rows move into the new shard only. Regrouping grown shards is a new ``base``, which
    moves rows by intent.
    """
    full = racks * per_rack
    regions = []
    for first in range(0, min(shards, base), full):
        ids = range(first, min(first + full, shards, base))
        groups = [ids[i : i + per_rack] for i in range(0, len(ids), per_rack)]
        regions.append(Region(f"r{first // full}", tuple(Rack(f"r{first // full}.k{k}", tuple((s, 1.0) for s in g)) for k, g in enumerate(groups))))
    for s in range(base, shards):
        regions.append(Region(f"x{s}", (Rack(f"x{s}.k0", ((s, 1.0),)),)))
    return tuple(regions)


def draw(key: Column, child: str, weight: float) -> Column:
    """Exponential draw of a child: from 48 bits of an md5, so that any engine can repeat it."""
    digits = F.substring(F.md5(F.concat(key, F.lit(f"/{child}")).cast("binary")), 1, 12)
    u = (F.conv(digits, 16, 10).cast("double") + 0.5) / float(1 << 48)
    return -F.log(u) / weight


def smallest(key: Column, children: list[tuple[str, float, Column]]) -> Column:
    """The value of the child with the smallest draw; a lone child needs no draw."""
    live = [c for c in children if c[1] > 0]
    if len(live) == 1:
        return live[0][2]
    return F.least(*[F.struct(draw(key, n, w).alias("d"), F.lit(i).alias("i"), v.alias("v")) for i, (n, w, v) in enumerate(live)])["v"]


def place(key: Column, tree: Tree) -> Column:
    """Shard of a row: one draw per child on the way down."""
    region = smallest(key, [(r.name, r.weight, F.lit(i)) for i, r in enumerate(tree)])
    chain = None
    for i, r in enumerate(tree):
        rack = smallest(key, [(k.name, k.weight, smallest(key, [(f"{k.name}.s{s}", w, F.lit(s)) for s, w in k.shards])) for k in r.racks])
        chain = F.when(region == i, rack) if chain is None else chain.when(region == i, rack)
    return chain


def shard(df: DataFrame, shards: int, id_col: str = "doc_id", text_col: str = "text", base: int = 40) -> DataFrame:
    """(id, size, text_crc32, law, shard, slot, grown_shard) for every row.

    The id and the number of shards decide, so rows repeating an id share a shard; a null id
    counts as the word ``null``. A null text counts as empty: size 16, CRC 0. ``slot`` counts the
    rows of a shard from 0 by a hash cell, then by id, CRC and size. Other columns are ignored.
    An empty table gives no rows.
    """
    key = F.coalesce(F.col(id_col).cast("string"), F.lit("null"))
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = df.select(
        F.col(id_col),
        (F.octet_length(text).cast("long") + 16).alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.lit("key").alias("law"),
        place(key, plan_tree(shards, base)).alias("shard"),
        place(key, plan_tree(shards + 1, base)).alias("grown_shard"),
    )
    cell = hex_cell(F.concat(key, F.lit(":"), F.col("text_crc32").cast("string")), 2)
    placed = ranked(rows.withColumn("_cell", cell), ["shard"], "_cell", [id_col, "text_crc32", "size"], "slot")
    return placed.select(id_col, "size", "text_crc32", "law", "shard", F.col("slot").cast("long").alias("slot"), "grown_shard")
