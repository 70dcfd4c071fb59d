"""Connected components of a graph given as an edge table, without a driver or a hot task.

Rounds of large star and small star (Kiveris et al., "Connected components in MapReduce and
beyond"): minima per node, which combine before the shuffle, and joins, whose hot nodes adaptive
execution splits. Each round is a written table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .kept import keep


def _least(edges: DataFrame) -> DataFrame:
    return edges.groupBy("u").agg(F.min("v").alias("m"))


def _state(edges: DataFrame) -> tuple:
    return tuple(
        edges.agg(F.count("*"), F.sum((F.xxhash64("u", "v") / 65536).cast("decimal(30,0)"))).first()
    )


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Columns id and component, the smallest id reachable, for every node that has an edge.

    Null ends and edges from a node to itself are ignored.
    """
    known = edges.where(F.col(a).isNotNull() & F.col(b).isNotNull())
    pairs = known.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
    now = keep(pairs.where(F.col("u") > F.col("v")).distinct())
    state = _state(now)
    while state[0]:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = _least(both).withColumn("m", F.least("m", "u"))
        large = (
            both.where(F.col("v") > F.col("u"))
            .join(least, "u")
            .select(F.col("v").alias("u"), F.col("m").alias("v"))
            .where(F.col("u") > F.col("v"))
            .distinct()
        )
        # in a small star the node itself and its smaller neighbours go to the least of them
        least = _least(large)
        star = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        star = star.unionByName(least.withColumnRenamed("m", "v"))
        now = keep(star.where(F.col("u") > F.col("v")).distinct())
        before, state = state, _state(now)
        if state == before:
            break
    members = now.select(F.col("u").alias("id"), F.col("v").alias("component"))
    roots = now.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct()
    return members.unionByName(roots)
