"""Euclidean join by random-projection buckets that are planned for a recall.

A table puts a vector into a bucket by several projections. Two vectors at a distance share a
bucket of a table, or lie in buckets that differ by one in a few projections, with a probability
that follows from the distance, the bucket length and the dimension alone. The plan solves for the
cheapest tables that reach the recall at the threshold; nearer pairs are found more often. One
side looks into its own bucket and into its neighbours in up to ``flips`` projections, so that few
tables do.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations, product

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmatch.functions.hashing import unit_directions
from shelfmatch.functions.vectors import euclidean
from shelfmatch.operators.bucketpairs import sketched_pairs, sketches
from shelfmatch.operators.simjoin import distinct_values, put_ids_back, vector_side, verified
from shelfmatch.sources.tables import cut_lineage, tell_workers

SAMPLE_ROWS = 256  # vectors whose distances stand for those of all, in a plan from data
MOST_TABLES = 64
MOST_PROBES = 200  # buckets of a table that one vector looks into
STRIPE_ROWS = 1024  # vectors that are projected together
VERIFIED = 8  # rows of a bucket join that cost as much as one pair's distance
LENGTHS = (0.25, 0.35, 0.5, 0.7, 1.0, 1.4, 2.0, 2.8, 4.0)  # of a bucket, by the spread of a projection

_ODD = np.uint64(0x9E3779B97F4A7C15)


@dataclass(frozen=True)
class BucketPlan:
    bucket_length: float
    per_table: int
    tables: int
    flips: int = 0
    recall: float = 0.0  # at the threshold

    def probes(self) -> list[tuple[int, ...]]:
        """Steps from a bucket to those that it looks into, its own first."""
        steps = []
        for n in range(self.flips + 1):
            for places in combinations(range(self.per_table), n):
                for signs in product((-1, 1), repeat=n):
                    step = [0] * self.per_table
                    for place, sign in zip(places, signs):
                        step[place] = sign
                    steps.append(tuple(step))
        return steps


def collision(distance: float, bucket_length: float, dim: int) -> tuple[float, float]:
    """Probabilities that one projection puts two vectors into the same bucket, and into neighbours.

    The projection of their difference on a random direction of ``dim`` dimensions has a density
    in proportion to ``(1 - t^2)^((dim - 3) / 2)``; where a bucket begins is even in it.
    """
    if distance <= 0:
        return 1.0, 0.0
    if dim == 1:
        moved = np.array([1.0])
        weight = np.array([1.0])
    else:
        angle = (np.arange(4000) + 0.5) * (math.pi / 2 / 4000)  # t = sin(angle) has no pole
        moved, weight = np.sin(angle), np.cos(angle) ** (dim - 2)
    apart = distance * moved / bucket_length
    same = np.clip(1 - apart, 0, 1)
    near = np.clip(2 - apart, 0, 1) - same
    total = weight.sum()
    return float((same * weight).sum() / total), float((near * weight).sum() / total)


def table_probability(distance: float, bucket_length: float, per_table: int, flips: int, dim: int) -> float:
    """That one table finds two vectors at this distance."""
    same, near = collision(distance, bucket_length, dim)
    return sum(math.comb(per_table, n) * same ** (per_table - n) * near**n for n in range(flips + 1))


def found_share(plan: BucketPlan, distance: float, dim: int) -> float:
    """Share of the pairs at a distance that the tables find."""
    p = table_probability(distance, plan.bucket_length, plan.per_table, plan.flips, dim)
    return 1 - (1 - p) ** plan.tables


def plan_buckets(
    threshold: float,
    dim: int,
    recall: float = 0.9,
    distances: list[float] = (math.sqrt(2.0),),
    rows: tuple[int, int] = (1_000_000, 1_000_000),
) -> BucketPlan:
    """The cheapest plan that finds ``recall`` of the pairs at the threshold.

    ``distances`` stand for those between any two vectors, ``rows`` are the sizes of the sides. The
    cost is that of the rows of the bucket join and of the pairs to be compared.
    """
    if not 0 < recall < 1 or threshold <= 0:
        raise ValueError("a recall between 0 and 1 and a threshold above 0")
    best, least = None, math.inf
    for by_spread in LENGTHS:
        length = round(by_spread * threshold / math.sqrt(dim), 9)
        for per_table in range(1, 25):
            for flips in range(min(per_table, 3) + 1):
                probes = sum(math.comb(per_table, n) * 2**n for n in range(flips + 1))
                p = table_probability(threshold, length, per_table, flips, dim)
                if probes > MOST_PROBES or p <= 0:
                    continue
                tables = max(1, math.ceil(math.log(1 - recall) / math.log1p(-min(p, 1 - 1e-12))))
                if tables > MOST_TABLES:
                    continue
                plan = BucketPlan(length, per_table, tables, flips)
                share = sum(found_share(plan, d, dim) for d in distances) / len(distances)
                cost = tables * (rows[0] + probes * rows[1]) + VERIFIED * share * rows[0] * rows[1]
                if cost < least:
                    best, least = plan, cost
    if best is None:
        raise ValueError(f"no plan of at most {MOST_TABLES} tables reaches a recall of {recall}")
    return BucketPlan(best.bucket_length, best.per_table, best.tables, best.flips, found_share(best, threshold, dim))


def sampled_distances(values: list[DataFrame], rows: int = SAMPLE_ROWS) -> list[float]:
    """Quantiles of the distances between vectors of a sample, chosen by digest."""
    found = [r[0] for v in values for r in v.orderBy("key").limit(rows).select("value").collect()]
    x = np.array([v for v in found if v is not None], dtype=float)
    if len(x) < 2:
        return [1.0]
    squares = (x**2).sum(1)[:, None] + (x**2).sum(1) - 2 * x @ x.T
    far = np.sqrt(np.maximum(squares[np.triu_indices(len(x), 1)], 0))
    return np.quantile(far, np.linspace(0.005, 0.995, 100)).tolist()


def hashed(buckets: np.ndarray, steps: np.ndarray) -> np.ndarray:
    """A hash of table and bucket at each step: rows, tables, steps from rows, tables, projections.

    Different buckets may share a hash, which makes one more pair to compare and no other result.
    """
    out = np.empty((*buckets.shape[:2], len(steps)), np.uint64)
    start = np.arange(buckets.shape[1], dtype=np.uint64) * _ODD
    for n, step in enumerate(steps):
        h = np.broadcast_to(start, buckets.shape[:2])
        for i, x in enumerate(step):
            h = (h ^ (buckets[:, :, i] + x).astype(np.uint64)) * _ODD
            h = h ^ (h >> np.uint64(29))
        out[:, :, n] = h
    return out


def _in_buckets(
    values: DataFrame, plan: BucketPlan, dim: int, seed: int, steps: list[tuple[int, ...]]
) -> DataFrame:
    """``key, sketch, hashes``: a hash for each table and step of each vector."""
    ways = np.array(unit_directions(plan.tables * plan.per_table, dim, seed)).T
    moves = np.array(steps, np.int64)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, STRIPE_ROWS):
                part = batch.slice(at, STRIPE_ROWS)
                vectors = np.asarray(part[1].flatten(), dtype=float).reshape(-1, dim)
                own = np.floor(vectors @ ways / plan.bucket_length).astype(np.int64)
                found = hashed(own.reshape(-1, plan.tables, plan.per_table), moves).reshape(len(own), -1)
                offsets = np.arange(len(own) + 1, dtype=np.int32) * found.shape[1]
                lists = pa.ListArray.from_arrays(offsets, found.ravel().view(np.int64))
                yield pa.record_batch([part[0], sketches(vectors), lists], names=["key", "sketch", "hashes"])

    return values.select("key", "value").mapInArrow(work, "key binary, sketch binary, hashes array<long>")


def planned_join(
    a: DataFrame,
    b: DataFrame,
    id_: str,
    vec: str,
    dim: int,
    threshold: float,
    recall: float = 0.9,
    plan: BucketPlan | None = None,
    seed: int = 42,
) -> DataFrame:
    """``id_a, id_b, distance`` of the pairs below a distance that the planned buckets find.

    Without a plan one is made from a sample of the vectors and the sizes of the sides; the share
    of results that is found is then ``recall`` or more on average over directions. Equal vectors
    are compared once and always found. Null vectors have no partner; nor have those with null or
    non-finite places.
    """
    number = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < math.inf)
    usable = (F.size(vec) == dim) & F.forall(vec, number)
    doubles = lambda side: side.select(id_, F.col(vec).cast("array<double>").alias(vec)).where(usable)
    keyed_a, keyed_b = (vector_side(doubles(side), id_, vec) for side in (a, b))
    values_a, values_b = (cut_lineage(distinct_values(keyed)) for keyed in (keyed_a, keyed_b))
    if plan is None:
        rows = (values_a.count(), values_b.count())
        plan = plan_buckets(threshold, dim, recall, sampled_distances([values_a, values_b]), rows)
    tell_workers(a.sparkSession)
    lying = _in_buckets(values_a, plan, dim, seed, [(0,) * plan.per_table])
    looking = _in_buckets(values_b, plan, dim, seed, plan.probes())
    candidates = sketched_pairs(lying, looking, threshold)
    return put_ids_back(verified(candidates, values_a, values_b, euclidean, threshold), keyed_a, keyed_b)
