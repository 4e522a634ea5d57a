"""Merkle manifest of a dataset: a tree of hashes over the rows of each group, and one over the groups.

A node is the SHA-256 of its children, ``arity`` consecutive nodes of the level below (the last run of a
level may be shorter). A level is never a table of its own: rows are dense in their position, so the nodes
of level k stand on every ``arity**k``-th row, and lag and lead at multiples of that fixed offset, masked by
the node's slot in its run and the run's length, are its siblings. The first child's row hashes the parent.

Windows run over blocks of ``arity**LEVELS`` positions, never over a group: a pass over the rows takes the
tree up by ``LEVELS`` levels inside each block, one row a block goes on to the next pass, and the paths of
the upper passes are then joined to the rows below, on the key of the windows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import written
from .texts import named

ARITY = 2
#: Levels that one pass takes; a block has ARITY**LEVELS rows, which is what a window holds at once.
LEVELS = 10
_PATH = "array<struct<before: string, after: string>>"


def hashed(*parts: Column) -> Column:
    """Lower-case hexadecimal SHA-256 of texts put together."""
    return F.sha2(F.concat(*parts), 256)


def field(value: Column) -> Column:
    """A value so that no two rows of values run together alike: its size in bytes, a colon and the value as
    text; ``-`` for null."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(*values: Column) -> Column:
    return hashed(*map(field, values))


def fold(start: Column, path: Column) -> Column:
    """The root that a leaf and the siblings on its way up lead to."""
    return F.aggregate(path, start, lambda node, s: hashed(s["before"], node, s["after"]))


def proof(path: Column) -> Column:
    """Digest of all siblings of a path, upwards, and from left to right within a level."""
    return F.sha2(F.array_join(F.transform(path, lambda s: F.concat(s["before"], s["after"])), ""), 256)


def numbered(rows: DataFrame, order: Sequence[str]) -> DataFrame:
    """Adds ``pos``, the place of a row in its ``grp`` from 0 on, and ``n``, the size of the group.

    Rows are dealt by ranges of group and order, so a large group is spread over many tasks; a table with
    a row for each task and group, of running totals, makes positions of the places within tasks. ``rows``
    must be stored, with an order that no two rows share.
    """
    dealt = rows.repartitionByRange("grp", *order).sortWithinPartitions("grp", *order)
    dealt = written(dealt.withColumn("place", F.monotonically_increasing_id()), "merkle_order")
    task = F.shiftright("place", 33)  # the id holds the task above 33 bits for the row
    shares = dealt.groupBy("grp", task.alias("task")).agg(F.count("*").alias("rows"), F.min("place").alias("first"))
    in_group = Window.partitionBy("grp")
    earlier = in_group.orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    shares = written(shares.select(
        F.col("grp").alias("of"), "task", (F.coalesce(F.sum("rows").over(earlier), F.lit(0)) - F.col("first")).alias("shift"),
        F.sum("rows").over(in_group).alias("n")), "merkle_shares")
    joined = dealt.withColumn("in_task", task).join(shares, (F.col("in_task") == F.col("task")) & (F.col("grp") == F.col("of")))
    return joined.withColumn("pos", F.col("place") + F.col("shift")).drop("place", "in_task", "of", "task", "shift")


def climb(nodes: DataFrame, arity: int, levels: int) -> DataFrame:
    """Nodes (``grp, pos, n, hash``) with their ``block``, the ``path`` to its top within ``levels`` levels, and
    the ``top`` on a block's first row."""
    width = arity ** levels
    rows = nodes.withColumn("block", F.floor(F.col("pos") / width)).withColumn("h0", F.col("hash"))
    block = Window.partitionBy("grp", "block").orderBy("pos")
    for k in range(levels):
        step = arity ** k
        # nodes of the group on this level; the group's tree ends where one is left
        there = F.floor((F.col("n") + (step - 1)) / step)
        node = F.floor(F.col("pos") / step)
        slot = node % arity
        run = F.least(F.lit(arity), there - (node - slot))
        is_node, goes_on = F.col("pos") % step == 0, there > 1
        rows = rows.withColumns({
            **{f"lag{j}": F.lag(f"h{k}", j * step).over(block) for j in range(1, arity)},
            **{f"lead{j}": F.lead(f"h{k}", j * step).over(block) for j in range(1, arity)}})
        before = F.concat_ws("", *(F.when(slot >= j, F.col(f"lag{j}")) for j in range(arity - 1, 0, -1)))
        after = F.concat_ws("", *(F.when(slot + j < run, F.col(f"lead{j}")) for j in range(1, arity)))
        parent = F.when(goes_on, hashed(F.col(f"h{k}"), after)).otherwise(F.col(f"h{k}"))
        rows = rows.withColumns({
            f"s{k}": F.when(is_node & goes_on, F.struct(before.alias("before"), after.alias("after"))),
            f"h{k + 1}": F.when(F.col("pos") % (step * arity) == 0, parent),
        }).drop(f"h{k}", *(f"{way}{j}" for way in ("lag", "lead") for j in range(1, arity)))
    # A row's ancestor on a level stands on the last row of that level at or before it.
    so_far = block.rowsBetween(Window.unboundedPreceding, 0)
    steps = F.array(*(F.last(f"s{k}", ignorenulls=True).over(so_far) for k in range(levels)))
    path = F.filter(steps, lambda s: s.isNotNull()).alias("path")
    return rows.select("*", path).withColumnRenamed(f"h{levels}", "top").drop(*(f"s{k}" for k in range(levels)))


def tree(nodes: DataFrame, arity: int = ARITY, levels: int = LEVELS) -> DataFrame:
    """For each row of nodes (``grp, pos, n, hash``, stored) the ``path`` to its group's root, and that ``root``."""
    width = arity ** levels
    most = nodes.agg(F.max("n")).first()[0] or 0
    passes = [nodes]
    while most > 1:
        tops = climb(passes[-1], arity, levels).filter(F.col("pos") % width == 0).select(
            "grp", F.col("block").alias("pos"), F.floor((F.col("n") + (width - 1)) / width).alias("n"), F.col("top").alias("hash"))
        passes.append(written(tops, "merkle_tops"))
        most = -(-most // width)
    # One node a group is left: its root.
    above = passes[-1].select(
        F.col("grp").alias("of"), F.col("pos").alias("under"), F.array().cast(_PATH).alias("up"), F.col("hash").alias("root"))
    for rows in reversed(passes[:-1]):
        found = climb(rows, arity, levels).join(above, (F.col("grp") == F.col("of")) & (F.col("block") == F.col("under")))
        found = found.withColumn("path", F.concat("path", "up")).drop("of", "under", "up", "block", "top")
        if rows is nodes:
            return found
        above = written(found.select(
            F.col("grp").alias("of"), F.col("pos").alias("under"), F.col("path").alias("up"), "root"), "merkle_paths")
    return nodes.withColumn("path", F.array().cast(_PATH)).withColumn("root", F.col("hash"))


def manifest(
    docs: DataFrame, columns: Sequence[str], group_col: str, id_col: str = "doc_id",
    arity: int = ARITY, levels: int = LEVELS, **more: Column,
) -> DataFrame:
    """The place of each row of ``docs`` in the tree of its group, and of the group in the tree of all.

    Returns per row: ``doc_id``, ``leaf`` (:func:`leaf` of ``columns``), ``subroot`` (of the group), ``root``, and
    ``path``, the siblings from the leaf to the root: an entry a level, with the digests before and after
    the node put together. ``more`` names columns of ``docs`` to carry along. :func:`fold` of leaf and path
    is the root.

    Leaves ascend by id (a null id first), then by digest; rows that share both are alike. Groups
    ascend by name as UTF-8 bytes, the null group first. Null values count as ``-``. A group of one row has its
    leaf as root. No rows give no rows, and no root. Other columns are not looked at, whatever their
    names.
    """
    rows = docs.select(
        named(id_col).alias("doc_id"), F.coalesce(F.concat(F.lit("="), named(group_col).cast("string")), F.lit("")).alias("grp"),
        leaf(*map(named, columns)).alias("hash"), F.monotonically_increasing_id().alias("row"),
        *(value.alias(f"more_{name}") for name, value in more.items()))
    rows = written(rows, "merkle_leaves")
    found = tree(written(numbered(rows, ["doc_id", "hash", "row"]), "merkle_nodes"), arity, levels)
    found = written(found.withColumnsRenamed({"root": "subroot", "hash": "leaf"}).drop("pos", "n", "row"), "merkle_trees")

    groups = written(found.groupBy("grp").agg(F.first("subroot").alias("hash")).withColumnsRenamed({"grp": "name"}), "merkle_groups")
    of_all = tree(written(numbered(groups.withColumn("grp", F.lit("")), ["name"]), "merkle_roots"), arity, levels)
    of_all = written(of_all.select("name", "root", F.col("path").alias("up")), "merkle_all")
    joined = found.join(of_all, F.col("grp") == F.col("name"))
    return joined.select(
        "doc_id", "leaf", "subroot", "root", F.concat("path", "up").alias("path"),
        *(F.col(f"more_{name}").alias(name) for name in more))


def verified(rows: DataFrame, candidate: str) -> DataFrame:
    """A :func:`manifest` with the root that the leaf in column ``candidate`` leads to, and whether it is the root."""
    return rows.withColumn("folded_root", fold(F.col(candidate), F.col("path"))).withColumn(
        "verified", F.col("folded_root") == F.col("root"))
