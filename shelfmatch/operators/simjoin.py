"""Similarity joins of two sides ``a`` and ``b`` that share an id and a value column name.

Results have ``id_a, id_b, distance`` with ``distance < threshold``. Equal values on a side are
compared once: the joins work on distinct values and only the last step puts ids back. Candidates
come from equi-joins whose hot keys are spread over tasks; none is capped or dropped. The joins
after that are plain ones on a digest, which adaptive execution splits where a key is large.

Each side is read several times. Cut the lineage of a side whose values are dear to compute before
joining it. Lists are exploded in the outer form and empty ones drop in the join: the filter Spark
adds to the inner form would compute the list twice.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmatch.functions.hashing import minhash_signature, projection_buckets, unit_directions
from shelfmatch.functions.vectors import dot, euclidean, jaccard_distance
from shelfmatch.operators.bucketpairs import near_in_buckets
from shelfmatch.operators.closesets import Bands, close_pairs, kept_sets
from shelfmatch.operators.relational import skew_join

COUNTED_BELOW = 0.5


def _keyed(side: DataFrame, id_: str, value: Column, text: Column) -> DataFrame:
    """``id, key, value`` where equal values have equal keys (a 128-bit digest of the value)."""
    return side.select(F.col(id_).alias("id"), value.alias("value")).withColumn(
        "key", F.unhex(F.md5(text))
    )


def _token_side(side: DataFrame, id_: str, tokens: str) -> DataFrame:
    terms = F.sort_array(F.array_distinct(F.col(tokens).cast("array<string>")))
    return _keyed(side, id_, terms, F.array_join("value", "\u0001"))


def _token_sides(a: DataFrame, b: DataFrame, id_: str, tokens: str) -> tuple[DataFrame, DataFrame]:
    one = _token_side(a, id_, tokens)
    return one, one if a is b else _token_side(b, id_, tokens)


def vector_side(side: DataFrame, id_: str, vec: str) -> DataFrame:
    return _keyed(
        side, id_, F.col(vec).cast("array<double>"), F.array_join("value", ",")
    )


def _set_distance(a: str, b: str) -> Column:
    """Jaccard distance of lists without repeated words."""
    return _distance_of(F.size(F.array_intersect(a, b)), F.size(a), F.size(b))


def _distance_of(shared: Column, size_a: Column, size_b: Column) -> Column:
    return 1 - F.try_divide(shared.cast("double"), (size_a + size_b - shared).cast("double"))


def distinct_values(keyed: DataFrame) -> DataFrame:
    return keyed.select("key", "value").dropDuplicates(["key"])


def verified(
    candidates: DataFrame, a: DataFrame, b: DataFrame, distance, threshold: float
) -> DataFrame:
    """Distances of the candidate key pairs, each pair once."""
    values_a = a.select(F.col("key").alias("key_a"), F.col("value").alias("value_a"))
    values_b = b.select(F.col("key").alias("key_b"), F.col("value").alias("value_b"))
    return (
        candidates.select("key_a", "key_b").distinct()
        .join(values_a, "key_a")
        .join(values_b, "key_b")
        .select("key_a", "key_b", distance("value_a", "value_b").alias("distance"))
        .where(F.col("distance") < threshold)
    )


def put_ids_back(pairs: DataFrame, a: DataFrame, b: DataFrame) -> DataFrame:
    ids_a = a.select(F.col("key").alias("key_a"), F.col("id").alias("id_a"))
    ids_b = b.select(F.col("key").alias("key_b"), F.col("id").alias("id_b"))
    return pairs.join(ids_a, "key_a").join(ids_b, "key_b").select("id_a", "id_b", "distance")


def _own_pairs(
    a: DataFrame, b: DataFrame, id_: str, value: str, distance, threshold: float
) -> DataFrame:
    """Each id of ``a`` against the same id of ``b``: a key join and one exact distance."""
    left = a.select(F.col(id_).alias("id_a"), F.col(value).alias("value_a"))
    right = b.select(F.col(id_).alias("id_b"), F.col(value).alias("value_b"))
    return (
        left.join(right, F.col("id_a") == F.col("id_b"))
        .select("id_a", "id_b", distance("value_a", "value_b").alias("distance"))
        .where(F.col("distance") < threshold)
    )


def _join_on_hashes(a: DataFrame, b: DataFrame, hashes: Column) -> DataFrame:
    """Key pairs that share a hash in the same place of the ``hashes`` array."""
    left = a.select(F.col("key").alias("key_a"), F.posexplode_outer(hashes).alias("band", "hash"))
    right = b.select(F.col("key").alias("key_b"), F.posexplode_outer(hashes).alias("band", "hash"))
    return skew_join(left, right, ["band", "hash"], ["key_a"])


def jaccard_join(
    a: DataFrame,
    b: DataFrame,
    id_: str,
    tokens: str,
    threshold: float = 1.0,
    hashes: int = 5,
    bands: int | None = None,
    paired_only: bool = False,
    seed: int = 42,
    how: str = "md5",
) -> DataFrame:
    """Pairs of word sets that share a MinHash band, with their true Jaccard distance.

    ``bands`` defaults to ``hashes``: one hash per band. Fewer bands of several hashes each let
    fewer dissimilar pairs through to the distance. From a similarity of COUNTED_BELOW on the pairs
    that share no band are dropped among those that ``closesets`` finds near enough.
    """
    if paired_only:
        return _own_pairs(a, b, id_, tokens, jaccard_distance, threshold)
    bands = bands or hashes
    if hashes % bands:
        raise ValueError("hashes must be a multiple of bands")
    rows = hashes // bands
    signature = minhash_signature("value", hashes, seed, how)

    def bands_of(signature: Column) -> Column:
        places = F.sequence(F.lit(0), F.lit(bands - 1))
        return F.transform(places, lambda i: F.array_join(F.slice(signature, i * rows + 1, rows), ","))

    keyed_a, keyed_b = _token_sides(a, b, id_, tokens)
    if 1.0 - threshold >= COUNTED_BELOW:
        return close_pairs(kept_sets(keyed_a, keyed_b, Bands(hashes, bands, seed, how)), threshold, banded=True)
    sets_a, sets_b = distinct_values(keyed_a), distinct_values(keyed_b)
    signed_a = sets_a.withColumn("signature", signature)
    signed_b = sets_b.withColumn("signature", signature)
    candidates = _join_on_hashes(
        signed_a, signed_b, F.col("signature") if rows == 1 else bands_of(F.col("signature"))
    )
    pairs = verified(candidates, sets_a, sets_b, _set_distance, threshold)
    return put_ids_back(pairs, keyed_a, keyed_b)


def _count_shared(sets_a: DataFrame, sets_b: DataFrame, threshold: float) -> DataFrame:
    def words(sets: DataFrame, side: str) -> DataFrame:
        return sets.select(
            F.col("key").alias(f"key_{side}"),
            F.size("value").alias(f"size_{side}"),
            F.explode_outer("value").alias("word"),
        )

    shared = (
        skew_join(words(sets_a, "a"), words(sets_b, "b"), ["word"], ["key_a"])
        .where(_sizes_reach(1.0 - threshold))
        .groupBy("key_a", "size_a", "key_b", "size_b")
        .agg(F.count("*").alias("shared"))
    )
    distance = _distance_of(F.col("shared"), F.col("size_a"), F.col("size_b"))
    return shared.select("key_a", "key_b", distance.alias("distance")).where(
        F.col("distance") < threshold
    )


def jaccard_join_exact(
    a: DataFrame, b: DataFrame, id_: str, tokens: str, threshold: float = 1.0
) -> DataFrame:
    """All pairs of word sets below a Jaccard distance.

    For a similarity ``s`` under COUNTED_BELOW nearly every shared word makes a candidate, so the
    shared words are counted and the distance follows from the count. From there on prefixes and
    parity bits filter (``closesets``). Either way only sets whose sizes can reach ``s`` are compared.
    """
    keyed_a, keyed_b = _token_sides(a, b, id_, tokens)
    if 1.0 - threshold < COUNTED_BELOW:
        sets_a, sets_b = distinct_values(keyed_a), distinct_values(keyed_b)
        return put_ids_back(_count_shared(sets_a, sets_b, threshold), keyed_a, keyed_b)

    return close_pairs(kept_sets(keyed_a, keyed_b), threshold)


def _sizes_reach(s: float) -> Column:
    """Whether sets of size_a and size_b words can have a similarity of ``s``."""
    return F.least("size_a", "size_b") >= s * F.greatest("size_a", "size_b") - 1e-9


def euclidean_join(
    a: DataFrame,
    b: DataFrame,
    id_: str,
    vec: str,
    dim: int,
    threshold: float = 1000.0,
    bucket_length: float = 2.0,
    tables: int = 3,
    paired_only: bool = False,
    seed: int = 42,
    per_table: int = 1,
) -> DataFrame:
    """Pairs of vectors that share a random-projection bucket, with their Euclidean distance.

    ``per_table`` projections make one bucket of a table together. Buckets must be short against
    the distances between most vectors, or nearly all pairs share one: on unit vectors use several
    projections of a bucket length near ``threshold``, and more tables to find enough.
    """
    if paired_only:
        return _own_pairs(a, b, id_, vec, euclidean, threshold)
    keyed_a = vector_side(a, id_, vec)
    keyed_b = keyed_a if a is b else vector_side(b, id_, vec)
    buckets = projection_buckets("value", dim, tables * per_table, bucket_length, seed)

    def hashed(keyed: DataFrame) -> DataFrame:
        starts = range(1, tables * per_table + 1, per_table)
        places = lambda i: F.slice("buckets", i, per_table)
        whole = lambda i: F.forall(places(i), lambda x: x.isNotNull())
        together = F.array(*[F.when(whole(i), F.xxhash64(places(i))) for i in starts])
        return distinct_values(keyed).withColumn("buckets", buckets).select("key", "value", together.alias("hashes"))

    vectors_a = hashed(keyed_a)
    vectors_b = vectors_a if a is b else hashed(keyed_b)
    return put_ids_back(near_in_buckets(vectors_a, vectors_b, dim, threshold), keyed_a, keyed_b)


def distance_join_exact(
    a: DataFrame,
    b: DataFrame,
    id_: str,
    vec: str,
    dim: int,
    threshold: float,
    metric: str = "euclidean",
    axes: int = 3,
    seed: int = 42,
) -> DataFrame:
    """All pairs of vectors below a Euclidean or cosine distance, found on a grid.

    A projection on a unit direction never moves two vectors further apart. Cells are as wide as
    the threshold, so partners lie in the same or a neighbouring cell along every axis. Cosine
    distance ``d`` is Euclidean distance ``sqrt(2 d)`` of the scaled vectors; zero vectors have no
    cosine and no partner.
    """
    if metric == "cosine":
        radius = math.sqrt(2.0 * threshold)
        a, b = (unit_side(side, id_, vec) for side in (a, b))
    elif metric == "euclidean":
        radius = threshold
    else:
        raise ValueError(f"unknown metric {metric!r}")
    keyed_a, keyed_b = vector_side(a, id_, vec), vector_side(b, id_, vec)
    vectors_a, vectors_b = distinct_values(keyed_a), distinct_values(keyed_b)
    # the directions are rounded, so cells are a little wider than the radius
    width = radius * (1 + 1e-4)
    directions = unit_directions(axes, dim, seed)
    cells = [
        F.floor(dot("value", F.array(*[F.lit(x) for x in d])) / width).cast("long")
        for d in directions
    ]
    names = [f"cell_{i}" for i in range(axes)]
    left = vectors_a.select(F.col("key").alias("key_a"), *[c.alias(n) for c, n in zip(cells, names)])
    right = vectors_b.select(F.col("key").alias("key_b"), *[c.alias(n) for c, n in zip(cells, names)])
    for n in names:
        near = F.explode(F.sequence(F.col(n) - 1, F.col(n) + 1))
        right = right.withColumn(n, near)
    candidates = skew_join(left, right, names, ["key_a"])
    pairs = verified(candidates, vectors_a, vectors_b, euclidean, radius)
    result = put_ids_back(pairs, keyed_a, keyed_b)
    if metric == "cosine":
        return result.withColumn("distance", F.col("distance") * F.col("distance") / 2)
    return result


def unit_side(side: DataFrame, id_: str, vec: str) -> DataFrame:
    v = F.col(vec).cast("array<double>")
    size = F.sqrt(dot(vec, vec))
    return (
        side.select(id_, v.alias(vec), size.alias("_size"))
        .where(F.col("_size") > 0)
        .select(id_, F.transform(vec, lambda x: x / F.col("_size")).alias(vec))
    )
