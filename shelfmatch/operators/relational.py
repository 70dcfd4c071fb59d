"""Relational operators over relevance tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HOT_ROWS = 1_000_000  # rows of a key that one task takes without being cut
TEXT_FIELDS = ["product_title", "search_term", "product_description", "value"]


def _parts(rows: str, hot_rows: int) -> Column:
    return F.ceil(F.col(rows) / hot_rows).cast("int").alias("_parts")


def hot_keys(df: DataFrame, on: list[str], hot_rows: int = HOT_ROWS) -> DataFrame:
    """The keys of more than ``hot_rows`` rows, with the number of parts to cut them into."""
    return hot_counts(df.groupBy(*on).agg(F.count("*").alias("_rows")), on, "_rows", hot_rows)


def hot_counts(
    counts: DataFrame, on: list[str], rows: str, hot_rows: int = HOT_ROWS
) -> DataFrame:
    """``hot_keys`` from rows that have been counted already."""
    return counts.where(F.col(rows) > hot_rows).select(*on, _parts(rows, hot_rows))


def skew_join(
    left: DataFrame,
    right: DataFrame,
    on: list[str],
    spread: list[str],
    hot: DataFrame | None = None,
    how: str = "inner",
) -> DataFrame:
    """Inner or left equi-join in which the hot keys of ``left`` are spread over many tasks.

    Rows of a hot key are dealt out by the hash of their ``spread`` columns, and the matching rows
    of ``right`` are repeated for every part. All other keys join as usual. No row is dropped.
    Finding the hot keys reads ``left`` once more, unless ``hot`` has them.
    """
    hot = F.broadcast(hot_keys(left, on) if hot is None else hot)  # a key for each HOT_ROWS rows at most
    cut = F.coalesce(F.col("_parts"), F.lit(1))
    dealt, repeated = left.join(hot, on, "left"), right.join(hot, on, "left")
    part = F.pmod(F.xxhash64(*spread), cut.cast("long")).cast("int")
    dealt = dealt.withColumn("_part", part).drop("_parts")
    repeated = repeated.withColumn("_part", F.explode(F.sequence(F.lit(0), cut - 1))).drop("_parts")
    return dealt.join(repeated, [*on, "_part"], how).drop("_part")


def pick_attribute(attributes: DataFrame, name: str) -> DataFrame:
    """One attribute out of an entity-attribute-value table."""
    return attributes.where(F.col("name") == name).select("product_uid", "value")


def prefix_columns(df: DataFrame, prefix: str, except_: list[str] = ()) -> DataFrame:
    return df.withColumnsRenamed({c: f"{prefix}{c}" for c in df.columns if c not in except_})


def with_pair_id(df: DataFrame, keys: list[str], name: str = "pair_id") -> DataFrame:
    """A row id that follows from the key columns alone, not from how rows are partitioned."""
    if len(keys) == 1:
        return df.withColumn(name, F.col(keys[0]))
    texts = [F.coalesce(F.col(k).cast("string"), F.lit("")) for k in keys]
    return df.withColumn(name, F.md5(F.concat_ws("\u0001", *texts)))


def unpivot_fields(
    df: DataFrame, fields: list[str], ids: list[str], field: str = "field", text: str = "text"
) -> DataFrame:
    """One row per text field."""
    return df.select(*ids, *fields).unpivot(ids, fields, field, text)


def pivot_fields(
    df: DataFrame, fields: list[str], ids: list[str], field: str = "field", text: str = "text"
) -> DataFrame:
    """One column per text field again, in one aggregation in place of a chain of self-joins."""
    return df.groupBy(*ids).agg(
        *[F.max(F.when(F.col(field) == f, F.col(text))).alias(f) for f in fields]
    )


def drop_invalid(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Drop rows with a null or NaN."""
    return df.na.drop(subset=cols)


def non_empty_vectors(df: DataFrame, c: str) -> DataFrame:
    """Keep rows whose ML vector has a non-zero entry; looks at stored entries only."""
    return df.where(F.exists(F.unwrap_udt(F.col(c))["values"], lambda x: x != 0))


def dedupe_pairs(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.dropDuplicates(keys)


def drop_singletons(df: DataFrame, keys: list[str], spread: list[str]) -> DataFrame:
    """Keep rows whose key occurs more than once. A key may hold any share of the rows."""
    repeated = df.groupBy(*keys).agg(F.count("*").alias("_n")).where(F.col("_n") > 1)
    return skew_join(df, repeated.select(*keys), keys, spread, hot_counts(repeated, keys, "_n"))


def rank_pairs(df: DataFrame, score: str, ties: list[str]) -> DataFrame:
    """Best score first."""
    return df.orderBy(F.desc(score), *ties)


def top_k(df: DataFrame, order: list[Column], k: int = 500) -> DataFrame:
    return df.orderBy(*order).limit(k)


def split_share(key: Column | str, seed: int = 42) -> Column:
    """A number in [0, 1) that follows from the key and the seed."""
    k = F.col(key) if isinstance(key, str) else key
    digits = F.substring(F.md5(F.concat(F.lit(f"{seed}:"), k.cast("string"))), 1, 7)
    return F.conv(digits, 16, 10).cast("double") / F.lit(float(1 << 28))


def split_by_key(
    df: DataFrame, key: str, weights: list[float] = (0.6, 0.4), seed: int = 42
) -> list[DataFrame]:
    """Random split that puts a key on the same side in every run and partitioning."""
    share, total, low, parts = split_share(key, seed), sum(weights), 0.0, []
    for i, w in enumerate(weights):
        high = 1.0 if i == len(weights) - 1 else low + w / total
        parts.append(df.where((share >= low) & (share < high)))
        low = high
    return parts
