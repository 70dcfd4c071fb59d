import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfmatch.operators import bucketpairs as bp
from shelfmatch.operators import buckets as bu
from shelfmatch.operators import radius as ra
from workload import tables as wt

KIND = "id bigint, v array<double>"


@pytest.mark.parametrize("dim", [1, 2, 3, 16, 64])
def test_collision_probabilities(dim):
    rng = np.random.default_rng(dim)
    way = rng.standard_normal((200_000, dim))
    moved = np.abs(0.8 * way[:, 0] / np.linalg.norm(way, axis=1))
    start = rng.random(len(moved)) * 0.3
    steps = np.floor((start + moved) / 0.3) - np.floor(start / 0.3)
    same, near = bu.collision(0.8, 0.3, dim)
    assert same == pytest.approx((steps == 0).mean(), abs=0.005)
    assert near == pytest.approx((steps == 1).mean(), abs=0.005)
    assert bu.collision(0.0, 0.3, dim) == (1.0, 0.0)


def test_plan():
    plan = bu.plan_buckets(0.447, 64, 0.9, rows=(10**6, 10**6))
    assert plan.recall >= 0.9 and bu.found_share(plan, 0.3, 64) > plan.recall
    assert bu.found_share(plan, math.sqrt(2), 64) < 1e-3  # few of the other pairs are compared
    small = bu.plan_buckets(0.447, 64, 0.9, rows=(100, 100))
    assert small.tables <= plan.tables
    assert bu.BucketPlan(1.0, 3, 1, 1).probes() == [
        (0, 0, 0), (-1, 0, 0), (1, 0, 0), (0, -1, 0), (0, 1, 0), (0, 0, -1), (0, 0, 1),
    ]
    for wrong in ((0.0, 0.9), (1.0, 1.0), (1.0, 0.0)):
        with pytest.raises(ValueError):
            bu.plan_buckets(wrong[0], 8, wrong[1])


def test_recall_against_the_exact_join(spark, data):
    """The registered query's plan: pairs at up to 0.6, most of them near the threshold of 0.65."""
    e, moved = spark.read.parquet(f"{data}/embeddings.parquet"), wt.moved_vectors(spark, data)
    ids = lambda df: {(r.id_a, r.id_b) for r in df.collect()}
    exact = ids(ra.radius_join(e, moved, "vec_id", "embedding", wt.DIM, wt.NEAR))
    found = ids(bu.planned_join(e, moved, "vec_id", "embedding", wt.DIM, wt.NEAR, plan=wt.near_plan()))
    assert found <= exact and len(found) >= 0.9 * len(exact) > 200


def test_recall_of_a_plan_from_the_data(spark):
    rng = np.random.default_rng(2)
    unit = lambda x: x / np.linalg.norm(x, axis=1, keepdims=True)
    base = rng.standard_normal((400, 24)) * 2
    at = base + 0.99 * unit(rng.standard_normal((400, 24)))  # all just below the threshold
    a = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(base)] + [(9000, None)], KIND)
    b = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(at)] + [(9001, [1.0])], KIND)
    rows = bu.planned_join(a, b, "id", "v", 24, 1.0, recall=0.9).collect()
    assert len({(r.id_a, r.id_b) for r in rows}) == len(rows)
    assert all(r.distance == pytest.approx(np.linalg.norm(base[r.id_a] - at[r.id_b])) for r in rows)
    assert sum(r.id_a == r.id_b for r in rows) >= 0.9 * 400


def test_odd_vectors(spark):
    rows = [(i, v) for i, v in enumerate([None, [], [1.0], [None, 0.0], [math.nan, 0.0], [0.0, 0.0], [0.0, 0.0], [9.0, 9.0]])]
    df = spark.createDataFrame(rows, KIND)
    got = {(r.id_a, r.id_b) for r in bu.planned_join(df, df, "id", "v", 2, 0.5).collect()}
    assert got == {(5, 5), (5, 6), (6, 5), (6, 6), (7, 7)}
    none = df.where(F.lit(False))
    assert bu.planned_join(none, df, "id", "v", 2, 0.5).count() == bu.planned_join(none, none, "id", "v", 2, 0.5).count() == 0


def test_sketches_rule_out_no_near_pair():
    rng = np.random.default_rng(5)
    x = rng.standard_normal((300, 16)) * 10.0 ** rng.integers(-3, 4, (300, 1))
    y = x + rng.standard_normal(x.shape) * 0.1
    x[:2], y[:2] = [[0.0] * 16, [1e200] * 16], [[1e-310] * 16, [1e200] * 16]
    column = lambda v: bp.pa.chunked_array([bp.sketches(v)])
    (m, off_m), (n, off_n) = bp._read_sketches(column(x)), bp._read_sketches(column(y))
    with np.errstate(over="ignore", invalid="ignore"):
        size = (m * m).sum(1)[:, None] + (n * n).sum(1)
        exact = np.sqrt(((x[:, None] - y) ** 2).sum(2))
        near = bp._may_be_near(size - 2 * m @ n.T, size, off_m[:, None] + off_n, 0.5)
    assert near[exact < 0.5].all() and (exact < 0.5).sum() >= 250
    assert near.sum() < 2.5 * (exact < 0.5).sum()


def test_candidates_are_no_rows(spark):
    """Vectors of one bucket that are far apart leave no pair, in cells of any size."""
    rng = np.random.default_rng(6)
    x = rng.standard_normal((200, 8)) * 3
    hashes = [[7] if i < 150 else [8 + i // 2] for i in range(200)]
    packed = [bytes(s) for s in bp.sketches(x).to_pylist()]
    rows = [(i.to_bytes(2, "big"), s, h) for i, (s, h) in enumerate(zip(packed, hashes))]
    df = spark.createDataFrame(rows, "key binary, sketch binary, hashes array<long>")
    got = sorted((int.from_bytes(r.key_a, "big"), int.from_bytes(r.key_b, "big")) for r in bp.sketched_pairs(df, df, 0.5).collect())
    far = np.sqrt(((x[:, None] - x) ** 2).sum(2))
    below = [(i, j) for i in range(200) for j in range(200) if hashes[i] == hashes[j] and far[i, j] < 0.5]
    assert set(below) <= set(got) and len(got) == len(set(got)) <= len(below) + 20
