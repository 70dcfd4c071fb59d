"""Sharding on a consistent-hash ring with virtual nodes and bounded loads.

Every shard owns virtual nodes on a ring of fixed places. A key lies at the place of its hash and
belongs to the next virtual node clockwise; keys that find a shard full continue clockwise. The
bounds add up to the number of rows, so that no two shards differ by more than one row. Only the
number of keys at each place is looked at to say which shard takes how many of them; rows learn
their shard from their rank at their place.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .kept import keep

PLACES = 4096  # of the ring; what the driver sees is one count for each
NODES = 64  # virtual nodes of a shard
RANKED_ROWS = 4096  # rows that are ranked in one window


def ring(shards: int, nodes: int = NODES, places: int = PLACES) -> list[int]:
    """The shard whose virtual node comes next clockwise, for each place."""
    at: dict[int, tuple[bytes, int]] = {}
    for shard in range(shards):
        for node in range(nodes):
            digest = hashlib.sha256(f"{shard}/{node}".encode()).digest()
            place = int.from_bytes(digest[:8], "big") % places
            at[place] = min(at.get(place, (digest, shard)), (digest, shard))
    owner, shard = [0] * places, at[min(at)][1]
    for place in range(places - 1, -1, -1):
        shard = at[place][1] if place in at else shard
        owner[place] = shard
    return owner


def clockwise(counts: list[int], shards: int, nodes: int = NODES) -> list[tuple[int, int, int, int, int]]:
    """Who takes the keys of each place: place, first rank, end of ranks, shard, first slot.

    Keys arrive place by place. Going round from a place, each shard takes what it has room for.
    """
    places, total = len(counts), sum(counts)
    owner = ring(shards, nodes, places)
    room = [total // shards + (s < total % shards) for s in range(shards)]
    taken, parts = [0] * shards, []
    for place in range(places):
        rank, at = 0, place
        while rank < counts[place]:
            shard = owner[at % places]
            n = min(counts[place] - rank, room[shard] - taken[shard])
            if n:
                parts.append((place, rank, rank + n, shard, taken[shard]))
                taken[shard] += n
                rank += n
            at += 1
    return parts


def assign(rows: DataFrame, key: str, shards: int, nodes: int = NODES, places: int = PLACES) -> DataFrame:
    """The rows with shard, from 0, and slot, gapless from 0 in each shard.

    ``rows`` are narrow and must be cheap to group: repeated rows are counted before they move. A
    null key has a place like any other; an empty table stays empty. Columns named shard or slot
    are replaced.
    """
    kept = keep(rows.drop("shard", "slot"))
    columns = kept.columns
    place = F.pmod(F.xxhash64(key), F.lit(places)).cast("int")
    counts = [0] * places
    for r in kept.groupBy(place.alias("place")).count().collect():  # as many rows as places
        counts[r[0]] = r[1]
    spark = rows.sparkSession
    parts = spark.createDataFrame(
        clockwise(counts, shards, nodes), "_place int, _from long, _to long, shard int, _slot long"
    )
    # ranks at a place: those of small parts, after the sizes of the parts before
    cuts = max(1, -(-sum(counts) // (places * RANKED_ROWS)))
    one = kept.groupBy(*columns).agg(F.count("*").alias("_n"))
    one = one.select(
        "*", place.alias("_place"), F.pmod(F.xxhash64(*columns), F.lit(cuts)).alias("_cut")
    )
    in_cut = Window.partitionBy("_place", "_cut").orderBy(F.xxhash64(*columns), *columns)
    before = F.sum("_n").over(in_cut.rowsBetween(Window.unboundedPreceding, -1))
    one = one.withColumn("_before", F.coalesce(before, F.lit(0)))
    if cuts > 1:
        sizes = one.groupBy("_place", "_cut").agg(F.sum("_n").alias("_size"))
        in_place = Window.partitionBy("_place").orderBy("_cut")
        start = F.sum("_size").over(in_place.rowsBetween(Window.unboundedPreceding, -1))
        sizes = sizes.select("_place", "_cut", F.coalesce(start, F.lit(0)).alias("_start"))
        one = one.join(sizes, ["_place", "_cut"]).withColumn("_before", F.col("_before") + F.col("_start"))
    rank = F.explode(F.sequence(F.col("_before"), F.col("_before") + F.col("_n") - 1)).alias("_rank")
    ranked = one.select(*columns, "_place", rank)
    # at most two parts a place and one more a shard that fills up
    held = (F.col("_rank") >= F.col("_from")) & (F.col("_rank") < F.col("_to"))
    out = ranked.join(F.broadcast(parts), "_place").where(held)
    return out.select(*columns, "shard", (F.col("_slot") + F.col("_rank") - F.col("_from")).alias("slot"))
