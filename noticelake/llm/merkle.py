"""A Merkle manifest of a dataset: a tree of SHA-256 digests per source, and one over the sources.

Leaves of a source ascend by their key; every ``arity`` consecutive nodes become one until one
is left, the source's subroot, and subroots ordered by source become the root the same way.

Only every ``stride``-th level is kept (checkpoint); the levels between are never stored. They
are computed again where a proof needs them (recompute): the stored nodes below one stored node
form an aligned subtree of ``arity ** stride`` nodes at most, which is one row of its own; its
missing levels come from these nodes alone, give each of them its siblings, and are forgotten.
Paths are made from the top down, a stored level at a time: what lies above a subtree is one
list of siblings for all of it. So no task holds more than a subtree, a source of any size is
spread over tasks by subtree, and the work above the leaves is a small part of it.

All columns of a leaf may be null and enter its digest as ``-``. Rows of equal key are ordered
by their digest, and exact repeats are leaves of their own. A null source is a source and comes
first, as does a null key. An empty table has no leaves and no root.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from noticelake.llm.common import let, packed, settled
from noticelake.operators.positions import number_rows

ARITY = 16
STRIDE = 2
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def leaf_digest(columns: Sequence[Column]) -> Column:
    """Of each value: ``-`` if null, else its bytes in UTF-8, a colon and the value."""

    def written(value: Column) -> Column:
        text = value.cast("string")
        return F.coalesce(F.concat(F.octet_length(text), F.lit(":"), text), F.lit("-"))

    return F.sha2(F.concat(*map(written, columns)), 256)


def joined_digest(digests: Column) -> Column:
    return F.sha2(F.array_join(digests, ""), 256)


def _next_level(nodes: Column, arity: int) -> Column:
    runs = F.sequence(F.lit(0), ((F.size(nodes) - 1) / arity).cast("int"))
    return F.transform(runs, lambda i: joined_digest(F.slice(nodes, i * arity + 1, F.lit(arity))))


@dataclass(frozen=True)
class Tree:
    """Trees of one or many kinds, each named by ``tree``.

    ``stored`` holds ``tree, nodes, at, digest``: how many nodes its level has, the place, from
    0, and the digest of a node; each is ``stride`` levels above the one before it, or less
    where the tree ends. The lowest may hold a ``row`` that goes with each leaf.
    """

    stored: tuple[DataFrame, ...]
    arity: int
    stride: int

    def tops(self) -> DataFrame:
        """``tree, digest`` of what remains of each tree."""
        found = [level.where("nodes = 1").select("tree", "digest") for level in self.stored]
        # A tree that has ended is not on the levels above.
        return _union(found)


def _union(parts: list[DataFrame]) -> DataFrame:
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return whole


def _subtrees(level: DataFrame, width: int) -> DataFrame:
    """``tree, nodes, block, members`` with the nodes below each stored node above, in order."""
    block = F.floor(F.col("at") / width).cast("long")
    own = [c for c in level.columns if c not in ("tree", "nodes")]
    in_order = F.array_sort(F.collect_list(F.struct(*own)), lambda a, b: (a["at"] - b["at"]).cast("int"))
    subtrees = level.groupBy("tree", "nodes", block.alias("block")).agg(in_order.alias("members"))
    return subtrees.withColumn("digests", F.col("members.digest"))


def _levels(digests: Column, nodes: Column, arity: int, stride: int, body) -> Column:
    """``body`` of the levels of a subtree from its lowest, each an array; null where the tree ended."""

    def grown(found: list[Column], left: Column) -> Column:
        if len(found) > stride:
            return body(found)
        above = F.when(left > 1, _next_level(found[-1], arity))
        return let(above, lambda named: grown([*found, named], F.ceil(left / arity)))

    return grown([digests], nodes)


def build(leaves: DataFrame, arity: int = ARITY, stride: int = STRIDE) -> Tree:
    """From the lowest level, which is kept as it is."""
    if arity < 2 or stride < 1:
        raise ValueError("arity must be 2 and stride 1 at least")
    width, stored = arity**stride, [settled(leaves)]
    largest = stored[0].agg(F.max("nodes")).first()[0] or 0
    while largest > 1:
        blocks = _subtrees(stored[-1].where("nodes > 1").drop("row"), width)
        top = _levels(F.col("digests"), F.col("nodes"), arity, stride, lambda found: F.coalesce(*reversed(found))[0])
        made = blocks.select("tree", "nodes", F.col("block").alias("at"), top.alias("digest"))
        # In a step of its own: within one select a lambda would see the new column of that name.
        stored.append(settled(made.withColumn("nodes", F.ceil(F.col("nodes") / width).cast("long"))))
        largest = math.ceil(largest / width)
    return Tree(tuple(stored), arity, stride)


def _siblings(nodes: Column, place: Column, arity: int) -> Column:
    """The run of a node without it: what stands left and right of it, as text."""
    start = F.floor(place / arity).cast("int") * arity
    run = F.slice(nodes, start + 1, F.lit(arity))
    return F.struct(
        F.array_join(F.slice(run, F.lit(1), place - start), "").alias("left"),
        F.array_join(F.slice(run, place - start + 2, F.lit(arity)), "").alias("right"),
    )


def paths(tree: Tree, above: DataFrame | None = None) -> DataFrame:
    """``tree, at, digest[, row], top, path``: for each leaf the siblings of every level.

    ``top`` is the digest its tree has come to. ``path`` is an array from the lowest level up of
    ``left`` and ``right``, the joined digests that stand on either side; it goes on with the
    ``path`` that ``above`` has for the ``tree``. It is made in the task that has the subtree.
    """
    arity, width = tree.arity, tree.arity**tree.stride
    empty = F.array().cast("array<struct<left:string,right:string>>")

    def topmost(level: DataFrame) -> DataFrame:
        """The nodes of a level that are tops, with the path above them."""
        ended = level.where("nodes = 1").drop("nodes").withColumn("top", F.col("digest"))
        return ended.withColumn("path", empty) if above is None else ended.join(above.select("tree", "path"), "tree")

    found = topmost(tree.stored[-1])
    for level in reversed(tree.stored[:-1]):
        upper = found.select("tree", F.col("at").alias("block"), "top", F.col("path").alias("upper"))
        blocks = _subtrees(level.where("nodes > 1"), width).join(upper, ["tree", "block"])
        own = [c for c in level.columns if c not in ("tree", "nodes")]

        def members(levels: list[Column]) -> Column:
            def one(member: Column, place: Column) -> Column:
                steps, at = [], place
                for nodes, above_it in zip(levels, levels[1:]):
                    steps.append(F.when(above_it.isNotNull(), _siblings(nodes, at, arity)))
                    at = F.floor(at / arity).cast("int")
                path = F.concat(F.array_compact(F.array(*steps)), F.col("upper"))
                return F.struct(*[member[c].alias(c) for c in own], path.alias("path"))

            return F.transform("members", one)

        rows = _levels(F.col("digests"), F.col("nodes"), arity, tree.stride, members)
        found = blocks.select("tree", "top", F.inline(rows)).unionByName(topmost(level))
    return found


def folded(digest: Column, path: Column) -> Column:
    """The root that a leaf and its siblings give."""
    return F.aggregate(path, digest, lambda acc, step: F.sha2(F.concat(step["left"], acc, step["right"]), 256))


def path_digest(path: Column) -> Column:
    """One digest of all siblings, level by level, left to right."""
    return F.sha2(F.array_join(F.transform(path, lambda s: F.concat(s["left"], s["right"])), ""), 256)


@dataclass(frozen=True)
class Manifest:
    """``within``: a tree for each source, named by its place in their order; ``across``: the one over them."""

    sources: DataFrame
    within: Tree
    across: Tree

    def root(self) -> DataFrame:
        return self.across.tops().select(F.col("digest").alias("root"))

    def proofs(self) -> DataFrame:
        """``row, leaf, subroot, path`` of each leaf; the path leads to the root.

        Paths are long: whoever needs only what can be told from them should do so at once.
        """
        up = paths(self.across).select(F.col("at").alias("tree"), "path")
        return paths(self.within, up).select("row", F.col("digest").alias("leaf"), F.col("top").alias("subroot"), "path")


def manifest(
    rows: DataFrame,
    leaf: Column,
    key_col: str = "doc_id",
    source_col: str = "source",
    arity: int = ARITY,
    stride: int = STRIDE,
) -> Manifest:
    """Of rows by the digest of each and a key that orders them.

    All columns given stay in ``row`` and travel with the leaf, so give few.
    """
    columns = {"row": packed(rows), "digest": leaf, "key": F.col(f"`{key_col}`"), "source": F.col(f"`{source_col}`")}
    kept = settled(rows.select(*[c.alias(name) for name, c in columns.items()]))
    numbered = number_rows(kept, ["source", "key", "digest"], "number")
    per_source = numbered.groupBy("source").agg(F.min("number").alias("first"), F.count("*").alias("nodes"))
    # One row per source, numbered by the order of sources, which is that of their first leaves.
    sources = settled(number_rows(per_source, ["first"], "tree").withColumn("tree", F.col("tree") - 1))
    by_source = sources.select(F.col("source").alias("of"), "tree", "nodes", "first")
    placed = numbered.join(by_source, F.col("source").eqNullSafe(F.col("of")))
    within = build(placed.select("tree", "nodes", (F.col("number") - F.col("first")).alias("at"), "digest", "row"), arity, stride)
    total = sources.select(F.count("*")).scalar()
    top = within.tops().select(F.lit(0).alias("tree"), total.alias("nodes"), F.col("tree").alias("at"), "digest")
    return Manifest(sources.drop("first"), within, build(top, arity, stride))
