"""Numbers and quotas over all rows without a task that sees them all.

Ranks come from ranges of the order: rows are dealt out by range and written, each knows its place
in its part, and the sizes of the parts, one number each, say how many rows come before. A quota
is cut at the row of a given rank in the order of a hash, which histograms of ever longer prefixes
of the hash close in on.
"""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfmatch.operators.hotkeys import grid_join
from shelfmatch.sources.tables import cut_lineage

RANKED_ROWS = 10_000  # rows of a class that one window sorts
PREFIX = 3  # hex digits by which a histogram is refined at a time
DIGITS = 32


def with_rank(df: DataFrame, order: list[Column], name: str = "rank", first: int = 1) -> DataFrame:
    """The rows with their place in the order, gapless from ``first``.

    Rows that are alike in the order are ranked by a hash of all their columns, so that any number
    of them is spread; of rows alike in all columns any comes first. A column of that name is
    replaced.
    """
    df = df.drop(name)
    by = [*order, F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])]
    sorted_ = df.repartitionByRange(*by).sortWithinPartitions(*by)
    # the part, and the place in it in the last 33 bits
    placed = cut_lineage(sorted_.withColumn("_place", F.monotonically_increasing_id()))
    part = F.shiftright("_place", 33).alias("_part")
    sizes = sorted(placed.groupBy(part).agg(F.min("_place"), F.count("*")).collect())
    before = accumulate((n for _, _, n in sizes), initial=first)
    starts = [(p, start - low) for (p, low, _), start in zip(sizes, before)]
    table = df.sparkSession.createDataFrame(starts, "_part int, _start long")  # a row for each part
    found = placed.withColumn("_part", part).join(F.broadcast(table), "_part")
    return found.withColumn(name, F.col("_start") + F.col("_place")).drop("_part", "_start", "_place")


def with_dense_id(df: DataFrame, keys: list[str], name: str = "row_id") -> DataFrame:
    """The rows numbered from 0 in the order of their keys."""
    return with_rank(df, [F.asc_nulls_first(F.col(f"`{k}`")) for k in keys], name, 0)


def _cuts(hashed: DataFrame, share: float) -> DataFrame:
    """``_class, _cut_hash, _cut_key``: of each class the last row, by hash and key, of its share.

    Classes of which no row falls into the share have no row here.
    """
    kept = cut_lineage(hashed)
    quota = F.floor(F.col("_rows") * share + 0.5)
    sizes = kept.groupBy("_class").agg(F.count("*").alias("_rows"))
    at = sizes.select("_class", quota.alias("_left"), F.col("_rows").alias("_size"), F.lit("").alias("_prefix"))
    at = at.where("_left > 0")
    digits, inside = 0, kept.withColumn("_prefix", F.lit(""))
    while digits < DIGITS:
        at = cut_lineage(at)
        if (at.agg(F.max("_size")).first()[0] or 0) <= RANKED_ROWS:
            break
        digits = min(DIGITS, digits + PREFIX)
        # rows of the classes' parts in which the cut lies, by the next digits
        inside = kept.withColumn("_prefix", F.substring("_hash", 1, digits))
        above = F.substring("_prefix", 1, F.length("_above"))
        counted = inside.groupBy("_class", "_prefix").agg(F.count("*").alias("_n"))
        known = at.select(F.col("_class").alias("_of"), "_left", F.col("_prefix").alias("_above"))
        counted = counted.join(known, F.col("_class") == F.col("_of")).where(above == F.col("_above"))
        order = Window.partitionBy("_class").orderBy("_prefix")  # at most 16 ** PREFIX rows
        counted = counted.withColumn("_before", F.sum("_n").over(order) - F.col("_n"))
        crossed = (F.col("_before") < F.col("_left")) & (F.col("_left") <= F.col("_before") + F.col("_n"))
        at = counted.where(crossed).select(
            "_class", (F.col("_left") - F.col("_before")).alias("_left"), F.col("_n").alias("_size"), "_prefix"
        )
    rows = inside.join(at.select("_class", "_left", "_prefix"), ["_class", "_prefix"])
    order = Window.partitionBy("_class").orderBy("_hash", "_key")
    ranked = rows.withColumn("_rank", F.row_number().over(order)).where("_rank = _left")
    return ranked.select("_class", F.col("_hash").alias("_cut_hash"), F.col("_key").alias("_cut_key"))


def split_by_quota(
    df: DataFrame, key: str, label: str, weights: list[float] = (0.6, 0.4), seed: int = 42
) -> list[DataFrame]:
    """Parts of which each has its share of the rows of every class, to the row.

    Rows go by the hash of their unique key, so the split is the same in every run. A null label is
    a class. A class may hold any share of the rows.
    """
    text = F.col(key).cast("string")
    name = F.coalesce(F.concat(F.lit("="), F.col(label).cast("string")), F.lit("-"))
    own = {"_class": name, "_hash": F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(text, F.lit("")))), "_key": F.coalesce(text, F.lit(""))}
    placed = df.withColumns(own)
    shares = list(accumulate(weights))
    part = F.lit(0)
    for i, share in enumerate(shares[:-1]):
        cuts = _cuts(placed.select(*own), share / shares[-1])
        cuts = cut_lineage(cuts).withColumnsRenamed({"_cut_hash": f"_hash_{i}", "_cut_key": f"_key_{i}"})
        placed = grid_join(placed, cuts, ["_class"], ["_hash"], how="left")
        cut_hash, cut_key = F.col(f"_hash_{i}"), F.col(f"_key_{i}")
        inside = (F.col("_hash") < cut_hash) | ((F.col("_hash") == cut_hash) & (F.col("_key") <= cut_key))
        part = part + F.when(F.coalesce(inside, F.lit(False)), 0).otherwise(1)
    placed = placed.select(*df.columns, part.alias("_split"))
    return [placed.where(F.col("_split") == i).drop("_split") for i in range(len(shares))]
