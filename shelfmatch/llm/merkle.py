"""A Merkle tree over the rows of a table, whose nodes are labelled with the leaves they cover.

The leaves of a group are numbered in order. A node carries its level and the interval of leaf
numbers that it covers. Going up, the intervals that fall into one bucket of a level make a parent.
Going down, a join of the buckets of a level, in which the parent's interval must contain the
child's, gives each node its ancestor; the children of that ancestor whose intervals differ from
the node's own are its siblings. So a path from the root is made once for each node and each leaf
gets it from its parent alone. The last nodes of all groups are the leaves of one more tree.

Digests are SHA-256 in lowercase hex, of concatenated hex digests above the leaves.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .kept import keep

FANOUT = 8
STEP = "struct<left:string,right:string>"  # digests before and after a node
LABELS = ["_group", "_lo", "_hi", "_size", "_digest"]


def field(value: Column) -> Column:
    """A value as it goes into a leaf: its length in UTF-8 bytes, a colon and itself; null is a dash."""
    value = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))


def leaf_digest(*values: Column) -> Column:
    return F.sha2(F.concat(*[field(v) for v in values]), 256)


def group_key(group: Column) -> Column:
    """Text that is never null and sorts like the group, bytewise, null first."""
    return F.coalesce(F.concat(F.lit("="), group.cast("string")), F.lit("-"))


def numbered(rows: DataFrame, order: list[str]) -> DataFrame:
    """The rows with _lo, their number in their _group from 0 by ``order``, _hi and the group's _size.

    Rows are dealt out by ranges of group and order, and written; each then knows its place in its
    part, and a table of one row for each part and group says how many came before. No window sees
    a whole group, so a group of any size is spread over all parts, as are rows that are alike.
    """
    tie = F.monotonically_increasing_id().alias("_tie")
    by = ["_group", *order, "_tie"]
    dealt = keep(rows).select("*", tie).repartitionByRange(*by).sortWithinPartitions(*by)
    # the part, and the place in it in the last 33 bits
    dealt = keep(dealt.drop("_tie").withColumn("_place", F.monotonically_increasing_id()))
    dealt = dealt.withColumn("_part", F.shiftright("_place", 33))
    sizes = dealt.groupBy("_group", "_part").agg(F.count("*").alias("_n"), F.min("_place").alias("_first"))
    group = Window.partitionBy("_group")  # at most as many rows as parts
    before = group.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    start = F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first")
    starts = sizes.select("_group", "_part", start.alias("_start"), F.sum("_n").over(group).alias("_size"))
    low = F.col("_start") + F.col("_place")
    found = dealt.join(starts, ["_group", "_part"]).withColumn("_lo", low).withColumn("_hi", low + 1)
    return found.drop("_start", "_place", "_part")


def is_last() -> Column:
    """Whether a node is what remains of its group."""
    return F.col("_hi") - F.col("_lo") == F.col("_size")


def grown(leaves: DataFrame, fanout: int = FANOUT) -> list[DataFrame]:
    """The levels of the trees of all groups, leaves first, each a ``fanout``th of the one below.

    Nodes have LABELS and _children, structs of lo, hi and digest in order. A group has no nodes
    above the one that remains of it. Levels are written as they are made.
    """
    levels, width = [leaves], 1
    most = leaves.agg(F.max("_size")).first()[0] or 0
    while width < most:
        width *= fanout
        child = F.struct(F.col("_lo").alias("lo"), F.col("_hi").alias("hi"), F.col("_digest").alias("digest"))
        made = levels[-1].where(~is_last()).groupBy("_group", F.floor(F.col("_lo") / width).alias("_bucket"))
        made = made.agg(F.sort_array(F.collect_list(child)).alias("_children"), F.max("_size").alias("_size"))
        digest = F.array_join(F.transform("_children", lambda c: c["digest"]), "")
        levels.append(
            keep(
                made.select(
                    "_group",
                    F.element_at("_children", 1)["lo"].alias("_lo"),
                    F.element_at("_children", -1)["hi"].alias("_hi"),
                    "_size",
                    F.sha2(digest, 256).alias("_digest"),
                    "_children",
                )
            )
        )
    return levels


def with_ancestors(levels: list[DataFrame], above: DataFrame, fanout: int = FANOUT) -> DataFrame:
    """The leaves with _path, a step for each level from below, and the other columns of ``above``.

    ``above`` has a row for each _group with the _path from the group's last node on.
    """
    carried = [c for c in above.columns if c not in ("_group", "_path")]
    joined = None
    for level in range(len(levels) - 1, -1, -1):
        nodes = levels[level]
        last = nodes.where(is_last()).join(above, "_group")
        if joined is None:
            joined = last
            continue
        width = fanout ** (level + 1)
        bucket = lambda c: F.floor(F.col(c) / width)
        parents = joined.select(
            F.col("_group").alias("_group_above"), bucket("_lo").alias("_bucket_above"),
            F.col("_lo").alias("_lo_above"), F.col("_hi").alias("_hi_above"),
            F.col("_children").alias("_siblings"), "_path", *carried,
        )
        below = nodes.where(~is_last()).withColumn("_bucket", bucket("_lo"))
        contained = (F.col("_lo") >= F.col("_lo_above")) & (F.col("_hi") <= F.col("_hi_above"))
        met = (F.col("_group") == F.col("_group_above")) & (F.col("_bucket") == F.col("_bucket_above"))
        below = below.join(parents, met & contained)
        # what the parent's interval holds beside the node's own
        left = F.filter("_siblings", lambda c: c["hi"] <= F.col("_lo"))
        right = F.filter("_siblings", lambda c: c["lo"] >= F.col("_hi"))
        text = lambda a: F.array_join(F.transform(a, lambda c: c["digest"]), "")
        step = F.array(F.struct(text(left).alias("left"), text(right).alias("right")))
        path = F.concat(step, F.col("_path")).alias("_path")
        joined = last.unionByName(below.select(*nodes.columns, path, *carried))
    return joined


def manifest(
    rows: DataFrame, leaf: str, order: list[str], group: str, fanout: int = FANOUT
) -> DataFrame:
    """The rows with subroot, the digest of their group's tree, root, and path up to the root.

    ``leaf`` is a column of digests, as ``leaf_digest`` makes them; leaves of a group ascend by
    ``order``, nulls first, ties by digest. Groups ascend bytewise, null first; a null group is a
    group. Repeated rows are leaves each. While several nodes remain, ``fanout`` consecutive ones,
    of the last fewer, become the digest of their joined digests; a lone leaf is its subroot. An
    empty table stays empty. ``path`` has, from the leaf up, the siblings before and after it.
    Columns named subroot, root or path are replaced, others moved as they are: leave long ones out.
    """
    kept = [c for c in rows.columns if c not in ("subroot", "root", "path")]
    labelled = rows.select(
        group_key(F.col(group)).alias("_group"), F.col(leaf).alias("_digest"), F.struct(*kept).alias("_row")
    )
    leaves = keep(numbered(labelled, [f"_row.{_quoted(c)}" for c in order] + ["_digest"]))
    levels = grown(leaves, fanout)
    subroots = reduce(
        DataFrame.union, (nodes.where(is_last()).select("_group", "_digest") for nodes in levels)
    )
    # one more tree, whose leaves are the groups
    subroots = subroots.select(F.lit("").alias("_group"), F.col("_group").alias("_name"), "_digest")
    tops = grown(keep(numbered(subroots, ["_name"])), fanout)
    none = F.array().cast(f"array<{STEP}>").alias("_path")
    root = reduce(
        DataFrame.union,
        (n.where(is_last()).select("_group", none, F.col("_digest").alias("root")) for n in tops),
    )
    above = keep(
        with_ancestors(tops, root, fanout).select(
            F.col("_name").alias("_group"), "_path", F.col("_digest").alias("subroot"), "root"
        )
    )
    return with_ancestors(levels, above, fanout).select(
        "_row.*", "subroot", "root", F.col("_path").alias("path")
    )


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def proof(path: str = "path") -> Column:
    """The digest of all siblings from the leaf up, left to right at each level."""
    steps = F.transform(path, lambda s: F.concat(s["left"], s["right"]))
    return F.sha2(F.array_join(steps, ""), 256)


def folded(leaf: str, path: str = "path") -> Column:
    """The root that a leaf and its siblings give."""
    up = lambda below, s: F.sha2(F.concat(s["left"], below, s["right"]), 256)
    return F.aggregate(path, F.col(leaf), up)
