"""Shards by a hierarchical weighted hash tree: a row descends region, rack and shard by weighted hash draws.

At each level every child draws -ln(u) / weight, where u is a hash of the row's key and the child's name, and the least
draw wins; so a child gets rows in proportion to its weight, and when weights change, rows move only into or out of the
subtrees whose weights change. A tree grows by a subtree of its own, so one more shard takes rows only into itself.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexloom.llm.ranks import rank_within


@dataclass(frozen=True)
class Shard:
    number: int
    region: str
    rack: str
    weight: float = 1.0


def balanced_tree(shards: int, racks: int = 2, per_rack: int = 5) -> list[Shard]:
    """Shards 0 .. shards-1 in regions of `racks` racks of `per_rack` shards."""
    room = racks * per_rack
    return [Shard(i, f"r{i // room}", f"r{i // room}/k{i % room // per_rack}") for i in range(shards)]


def grown(tree: list[Shard], shards: int = 1) -> list[Shard]:
    """The tree with more shards, each a region of its own: no other subtree's weight changes."""
    first = max((s.number for s in tree), default=-1) + 1
    return [*tree, *(Shard(i, f"own{i}", f"own{i}/k0") for i in range(first, first + shards))]


def _levels(tree: list[Shard]) -> list[dict[str, list[tuple[str, float]]]]:
    """For each level: parent -> its children and their weights."""
    region: dict[str, float] = {}
    rack: dict[str, dict[str, float]] = {}
    leaf: dict[str, list[tuple[str, float]]] = {}
    for s in tree:
        if s.weight < 0:
            raise ValueError("weights are 0 or more")
        region[s.region] = region.get(s.region, 0) + s.weight
        rack.setdefault(s.region, {}).setdefault(s.rack, 0)
        rack[s.region][s.rack] += s.weight
        leaf.setdefault(s.rack, []).append((str(s.number), s.weight))
    return [{"": list(region.items())}, {r: list(c.items()) for r, c in rack.items()}, leaf]


def _draw(key: Column, name: Column | str, weight: Column | float, seed: int) -> Column:
    name = F.lit(name) if isinstance(name, str) else name
    u = (F.shiftrightunsigned(F.xxhash64(F.lit(seed), name, key), 11).cast("double") + 0.5) * (2.0**-53)
    return -F.log(u) / weight


def place(key: Column, tree: list[Shard], seed: int = 9) -> Column:
    """The shard of a key, as a column; a null key is a key like any other. Children of weight 0 get nothing."""
    at = F.lit("")
    for level in _levels(tree):
        children = {p: [(n, w) for n, w in c if w > 0] for p, c in level.items()}
        children = {p: c for p, c in children.items() if c}
        if not children:
            raise ValueError("a tree needs a shard of some weight")
        table = F.create_map(*[x for p, c in children.items() for x in (F.lit(p), F.array(*[F.struct(F.lit(n).alias("name"), F.lit(float(w)).alias("weight")) for n, w in c]))])
        draws = F.transform(F.element_at(table, at), lambda c: F.struct(_draw(key, c["name"], c["weight"], seed).alias("draw"), c["name"].alias("name")))
        at = F.array_min(draws)["name"]
    return at.cast("int")


def assign_sized(df: DataFrame, tree: list[Shard], key: str = "doc_id", size: str = "size", more: list[Shard] | None = None, seed: int = 9) -> DataFrame:
    """df with shard, slot (0, 1, 2 ... within a shard) and, if `more` is given, grown_shard: the shard in that tree. All
    columns of df move once, to blocks of their shard, so give it only what the result needs. Null keys are a key like
    any other, repeated keys go to the same shard and get slots of their own; extra columns stay, older ones with these
    names are replaced; an empty table gives an empty result."""
    out = df.drop("shard", "slot", "grown_shard").withColumn("shard", place(F.col(key), tree, seed))
    if more is not None:
        out = out.withColumn("grown_shard", place(F.col(key), more, seed))
    return rank_within(out, "shard", [key, size], "slot")


def assign(df: DataFrame, tree: list[Shard], key: str = "doc_id", text: str = "text", more: list[Shard] | None = None, seed: int = 9) -> DataFrame:
    """assign_sized for a writer of shards, which needs the texts: df with `size` too, the UTF-8 bytes of the text plus 16
    (null: 16). The texts move once."""
    sized = df.drop("size").withColumn("size", F.coalesce(F.octet_length(F.col(text)), F.lit(0)).cast("long") + 16)
    return assign_sized(sized, tree, key, "size", more, seed)
