"""A Merkle manifest of a dataset: a tree over each group's rows, and a tree over the groups.

A level is one aggregation. The position of a node among its group's tells its parent
(position / fanout) and its slot there (the remainder); conditional aggregates spread the
children of a parent into one column per slot. The columns side by side are what the parent's
digest is taken from; leaving out a child's own column gives its siblings. Levels are written as
they are made, each a third (at a fanout of three) of the one below. On the way back down, the
siblings along the path of a parent are handed to its children, so a proof takes one join of a
level with the one above it, and none for the leaves themselves: the lowest level carries their
ids.

Positions come from one sort over ranges of (group, order): a task numbers the rows of its
range, and a small table of rows per task and group gives each range its first position. A
group may therefore hold any part of the rows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from revmill.llm.common import if_small
from revmill.session import cut_lineage

FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]
FANOUT = 3
PATH = "array<struct<before: binary, after: binary>>"


def digest(*inputs: Column) -> Column:
    """SHA-256 of the inputs one behind the other, as binary."""
    return F.unhex(F.sha2(F.concat(*[i.cast("binary") for i in inputs]), 256))


def as_text(value: Column) -> Column:
    """A digest in lowercase hex; no digest is no text."""
    return F.lower(F.hex(F.coalesce(value, F.lit(b""))))


def field(value: Column) -> Column:
    """A value with its length in UTF-8 bytes before it; null is a dash."""
    text = value.cast("string")
    size = F.octet_length(text).cast("string")
    return F.when(value.isNull(), "-").otherwise(F.concat(size, F.lit(":"), text))


def ranked(df: DataFrame, group: list[str], order: list[str]) -> DataFrame:
    """A written table with __pos, gapless from 0 within each group, by the order columns
    (nulls first), and __size, the rows of the group. Null is a group like others. Rows that
    agree in all order columns are numbered in any order."""
    by = [*group, *order]
    # Equal rows share a range; a last key by place in df spreads those too.
    placed = df.withColumn("__tie", F.monotonically_increasing_id())
    ranges = placed.repartitionByRange(*by, "__tie").sortWithinPartitions(*by, "__tie").drop("__tie")
    rows = cut_lineage(ranges.withColumn("__at", F.monotonically_increasing_id()))
    # The upper bits of that number are the task's, the lower ones count its rows.
    rows = rows.withColumn("__task", F.shiftright("__at", 33))
    names = [f"__g{i}" for i in range(len(group))]
    parts = rows.groupBy(*[F.col(g).alias(n) for g, n in zip(group, names)], F.col("__task").alias("__t"))
    parts = parts.agg(F.min("__at").alias("__first"), F.count("*").alias("__n"))
    own = Window.partitionBy(*(names or [F.lit(0)]))
    before = own.orderBy("__t").rowsBetween(Window.unboundedPreceding, -1)
    parts = cut_lineage(
        parts.withColumn("__before", F.coalesce(F.sum("__n").over(before), F.lit(0)))
        .withColumn("__size", F.sum("__n").over(own))
        .drop("__n")
    )
    same = [F.col(g).eqNullSafe(F.col(n)) for g, n in zip(group, names)]
    joined = rows.join(if_small(parts, parts.count(), 120), [F.col("__task") == F.col("__t"), *same])
    place = F.col("__before") + F.col("__at") - F.col("__first")
    return joined.withColumn("__pos", place).drop("__at", "__task", "__t", "__first", "__before", *names)


def pivot(nodes: DataFrame, fanout: int, carried: list[str]) -> DataFrame:
    """The parents of nodes (g, pos, n, digest and the carried columns), each with one column
    per slot of digest (digest_0, ...) and of the carried ones. n is the nodes of the group on
    the level."""
    slot = F.pmod("pos", F.lit(fanout))
    spread = [
        F.max(F.when(slot == i, F.col(c))).alias(f"{c}_{i}")
        for c in ["digest", *carried]
        for i in range(fanout)
    ]
    parents = nodes.groupBy("g", F.floor(F.col("pos") / fanout).alias("pos")).agg(
        F.ceil(F.max("n") / fanout).alias("n"), *spread
    )
    return parents.withColumn("digest", digest(*[as_text(F.col(f"digest_{i}")) for i in range(fanout)]))


@dataclass(frozen=True)
class Trees:
    """Levels of all groups' trees, lowest first, and the one row of each group that is its top
    (g, digest). Groups of one leaf have no level."""

    levels: list[DataFrame]
    single: DataFrame
    tops: DataFrame


def grow(leaves: DataFrame, fanout: int, carried: list[str]) -> Trees:
    """Trees over leaves (g, pos, n, digest, carried), a written table."""
    single = leaves.filter("n = 1")
    tops = single.select("g", "digest")
    # Sizes of groups, not rows: the largest one tells how many levels there are.
    most = leaves.agg(F.max("n")).first()[0] or 0
    levels: list[DataFrame] = []
    nodes = leaves
    while most > 1:
        level = cut_lineage(pivot(nodes.filter("n > 1"), fanout, [] if levels else carried))
        levels.append(level)
        tops = tops.unionByName(level.filter("n = 1").select("g", "digest"))
        nodes, most = level.select("g", "pos", "n", "digest"), -(-most // fanout)
    return Trees(levels, single, tops)


def _siblings(slot: int, fanout: int) -> Column:
    """The digests of the other slots, those before the slot and those after it. A slot that a
    short run lacks adds nothing."""
    sides = []
    for others in (range(slot), range(slot + 1, fanout)):
        parts = [F.coalesce(f"digest_{i}", F.lit(b"")) for i in others]
        sides.append(F.concat(F.lit(b""), *parts))
    return F.struct(sides[0].alias("before"), sides[1].alias("after"))


def descend(trees: Trees, fanout: int, carried: list[str]) -> DataFrame:
    """g, pos, digest, carried and path of every leaf. A path has one entry for each level,
    lowest first: the digests of the siblings before the node and after it."""
    none = F.array().cast(PATH)
    below = None
    for depth in range(len(trees.levels) - 1, -1, -1):
        level = trees.levels[depth].drop("digest")
        if below is None:
            here = level.withColumn("path", none)
        else:
            # Tops of groups have nothing above them.
            here = level.join(below, ["g", "pos"], "left").withColumn("path", F.coalesce("path", none))
        wanted = carried if depth == 0 else []
        children = F.array(
            *[
                F.struct(
                    (F.col("pos") * fanout + i).alias("pos"),
                    F.col(f"digest_{i}").alias("digest"),
                    *[F.col(f"{c}_{i}").alias(c) for c in wanted],
                    F.concat(F.array(_siblings(i, fanout)), F.col("path")).alias("path"),
                )
                for i in range(fanout)
            ]
        )
        below = here.select("g", F.explode(children).alias("c")).select("g", "c.*").filter("digest is not null")
        if depth:
            below = below.drop("digest")
    alone = trees.single.select("g", "pos", "digest", *carried, none.alias("path"))
    return alone if below is None else below.select(alone.columns).unionAll(alone)


def fold(leaf: Column, path: Column) -> Column:
    """The root that a leaf's digest and the siblings along its path lead to."""
    return F.aggregate(
        path,
        leaf,
        lambda own, step: digest(as_text(step["before"]), as_text(own), as_text(step["after"])),
    )


def proof(path: Column) -> Column:
    """All siblings of a path as one text in hex, lowest level first."""
    return F.aggregate(
        path, F.lit(""), lambda text, step: F.concat(text, as_text(step["before"]), as_text(step["after"]))
    )


def manifest(
    docs: DataFrame,
    fields: list[str] = FIELDS,
    group: str = "source",
    order: str = "doc_id",
    fanout: int = FANOUT,
    audited: dict[str, Column] | None = None,
) -> DataFrame:
    """order, leaf, audited_leaf, subroot, root, path of every row of docs.

    A leaf is the digest of the row's fields. The rows of a group, ascending by the order
    column, are the leaves of a tree with the group's subroot on top; the subroots, ascending
    by group (null first), are the leaves of the tree whose top is the root. Every `fanout`
    consecutive nodes have one parent; a group's single leaf is its subroot. audited replaces
    columns by what is found at an audit; audited_leaf is the digest of a row with these, the
    leaf itself where nothing changed. Digests are binary, path as `descend` has it.

    Nulls in the group or order column are values of their own and come first. Rows that agree
    in both stand in ascending order of their leaf. Repeated rows are leaves like others, empty
    and very long texts are fields like others. No rows give no rows. Other columns are left
    out.
    """
    found = audited or {}
    leaf = digest(*[field(F.col(c)) for c in fields])
    seen = digest(*[field(found.get(c, F.col(c))) for c in fields])
    differs = F.lit(False)
    for c, value in found.items():
        differs = differs | ~F.col(c).eqNullSafe(value)
    digests = docs.select(
        F.col(group).alias("group"),
        F.col(order).alias("id"),
        leaf.alias("digest"),
        F.when(differs, seen).alias("changed"),
    )
    placed = ranked(cut_lineage(digests), ["group"], ["id", "digest"])
    carried = ["id", "changed"]
    groups = ranked(cut_lineage(placed.select("group").distinct()), [], ["group"])
    groups = cut_lineage(groups.select(F.col("group").alias("name"), F.col("__pos").alias("g"), F.col("__size").alias("groups")))
    n_groups = groups.count()
    leaves = placed.join(if_small(groups, n_groups, 200), F.col("group").eqNullSafe(F.col("name")))
    leaves = cut_lineage(leaves.select("g", F.col("__pos").alias("pos"), F.col("__size").alias("n"), "digest", *carried))
    trees = grow(leaves, fanout, carried)
    # The groups' tops are leaves of one more tree, by the groups' own order.
    tops = trees.tops.join(groups, "g")
    tops = cut_lineage(tops.select(F.lit(0).alias("g"), F.col("g").alias("pos"), F.col("groups").alias("n"), "digest"))
    upper = grow(tops, fanout, [])
    above = descend(upper, fanout, []).select(
        F.col("pos").alias("g"), F.col("digest").alias("subroot"), F.col("path").alias("above")
    )
    top = upper.tops.first()
    root = F.lit(bytes(top["digest"])) if top else F.lit(None).cast("binary")
    rows = descend(trees, fanout, carried).join(if_small(above, n_groups, 4096), "g")
    return rows.select(
        F.col("id").alias(order),
        F.col("digest").alias("leaf"),
        F.coalesce("changed", "digest").alias("audited_leaf"),
        "subroot",
        root.alias("root"),
        F.concat("path", "above").alias("path"),
    )
