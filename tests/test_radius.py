import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfmatch.operators import radius as ra
from shelfmatch.sources.tables import read_table

KIND = "id bigint, v array<double>"


def brute_force(a, b, threshold, metric="euclidean"):
    out = {}
    for i, x in a:
        for j, y in b:
            if metric == "cosine":
                far = 1 - np.dot(x, y) / (np.linalg.norm(x) * np.linalg.norm(y))
            else:
                far = np.linalg.norm(np.subtract(x, y))
            if far < threshold:
                out[i, j] = far
    return out


def found(df):
    rows = df.collect()
    out = {(r.id_a, r.id_b): r.distance for r in rows}
    assert len(out) == len(rows), "a pair came twice"
    return out


def clusters(n, dim, spread, seed):
    rng = np.random.default_rng(seed)
    centre = rng.standard_normal((9, dim)) * 3
    return centre[rng.integers(0, 9, n)] + rng.standard_normal((n, dim)) * spread


@pytest.mark.parametrize("pivots", [1, 5, 40, None])
@pytest.mark.parametrize("radius,metric", [(0.4, "euclidean"), (1.5, "euclidean"), (1e-9, "euclidean"), (0.02, "cosine"), (30.0, "euclidean")])
def test_equals_brute_force(spark, monkeypatch, pivots, radius, metric):
    monkeypatch.setattr(ra, "BLOCK_ROWS", 40)  # so that cells are cut into blocks
    monkeypatch.setattr(ra, "STRIPE_ROWS", 16)
    rows = clusters(260, 6, 0.5, 1).tolist()
    rows += [rows[0]] * 30 + [[2 * x for x in rows[1]]]  # copies and a multiple
    a = list(enumerate(rows[:150] + rows[-20:]))
    b = [(1000 + i, v) for i, v in enumerate(rows[100:])]
    got = found(ra.radius_join(*[spark.createDataFrame(x, KIND).repartition(3) for x in (a, b)],
                               "id", "v", 6, radius, metric, pivots=pivots))
    assert got == pytest.approx(brute_force(a, b, radius, metric), abs=1e-9)


def test_odd_vectors_have_no_partner(spark):
    odd = [None, [], [1.0], [None, 1.0], [math.nan, 0.0], [math.inf, 0.0]]
    rows = [(i, v) for i, v in enumerate(odd)] + [(10, [0.0, 0.0]), (11, [0.0, 0.5]), (None, [0.0, 0.5])]
    df = spark.createDataFrame(rows, KIND)
    near = ra.radius_join(df, df, "id", "v", 2, 1.0)
    pairs = sorted(((r.id_a, r.id_b) for r in near.collect()), key=str)
    assert pairs == sorted([(x, y) for x in (10, 11, None) for y in (10, 11, None)], key=str)
    by_cosine = ra.radius_join(df, df, "id", "v", 2, 0.5, "cosine").collect()
    assert {r.id_a for r in by_cosine} == {11, None}
    assert ra.radius_join(df.limit(0), df, "id", "v", 2, 1.0).count() == 0
    assert ra.radius_join(df, df.limit(0), "id", "v", 2, 1.0, pivots=3).count() == 0
    assert ra.radius_join(df.limit(0), df.limit(0), "id", "v", 2, 1.0).count() == 0
    with pytest.raises(ValueError):
        ra.radius_join(df, df, "id", "v", 2, 1.0, "other")


def test_pivots_leave_few_pairs_of_clusters(spark):
    """Cells and rings alone: pairs that meet in a block, against all."""
    rows = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(clusters(1500, 8, 0.3, 2))], KIND)
    one, many = (ra.radius_join_work(rows, rows, "id", "v", 8, 0.5, pivots=n).first() for n in (1, 40))
    assert one.pairs == many.pairs > 1500 and many.compared < 0.25 * 1500**2 and many.compared < one.compared
    assert many.candidates <= many.compared


def test_few_candidates_among_the_embeddings(spark, data):
    """Vectors without structure: partial sums leave few pairs to sum to the end."""
    e = read_table(spark, data, "embeddings")
    n, dim = e.count(), 64
    work = ra.radius_join_work(e, e, "vec_id", "embedding", dim, 1.05, pivots=16).first()
    v = np.array([r[0] for r in e.select("embedding").collect()], float)
    want = (np.sqrt(((v[:, None] - v[None]) ** 2).sum(2)) < 1.05).sum()
    assert n <= work.pairs == want < work.candidates < 0.1 * n * n


def test_plan_takes_more_pivots_where_they_pay():
    sample = clusters(2000, 8, 0.2, 3)
    assert ra.plan(sample, 0.3, 1000, 1000) < ra.plan(sample, 0.3, 10**8, 10**8)
    everywhere = np.random.default_rng(1).standard_normal((2000, 64))
    assert ra.plan(everywhere, 20.0, 10**8, 10**8) == 1  # all pairs lie within


def test_ranges_hold_every_vector(spark):
    """A ring for each vector, and the ball around a vector reaches the ring of each partner."""
    vectors = clusters(400, 4, 0.4, 5)
    pivots = ra._ranged(ra.Pivots(vectors[:12], np.eye(4), *ra._none(12), 1.0), vectors, 0.3)
    cell, far = pivots.home(vectors)
    ring = pivots.ring(far, cell)
    row, cells, rings = pivots.reached(vectors, 0.3)
    reached = set(zip(row.tolist(), cells.tolist(), rings.tolist()))
    assert len(reached) == len(row)
    for i, j in np.argwhere(ra.distances(vectors, vectors) < 0.3):
        assert (i, cell[j], ring[j]) in reached


def test_rows_are_repeated_for_few_blocks(spark):
    rows = 60_000
    side = spark.range(rows).selectExpr("0 AS _cell", "0 AS _ring", "unhex(md5(string(id))) AS key", "array(1.0D) AS value")
    left, right = ra._blocks(side, side, ra.block_rows(rows))
    assert left.count() <= ra.GRID * rows and right.count() <= ra.GRID * rows  # 15 times in blocks of 4,096 rows
    assert ra.block_rows(100) == ra.SMALL_BLOCK and ra.block_rows(10**9) == ra.BLOCK_ROWS


@pytest.mark.parametrize("away, wide", [(0.0, 1.0), (1e6, 1.0), (0.0, 1e-20), (0.0, 1e17)])
def test_short_numbers_drop_no_pair(monkeypatch, away, wide):
    monkeypatch.setattr(ra, "STRIPE_COLUMNS", 7)
    r = np.random.default_rng(4)
    a, b = (away + wide * r.normal(size=(n, 12)) for n in (300, 40))
    far = np.sqrt(((a[:, None] - b) ** 2).sum(2))
    radius = float(np.sort(far.ravel())[500])  # a pair lies just at the radius
    i, j, d, _ = ra.near_pairs(a, b, radius, np.linalg.qr(r.normal(size=(12, 12)))[0])
    assert sorted(zip(i.tolist(), j.tolist())) == [tuple(x) for x in np.argwhere(far < radius).tolist()]
    assert (d == np.sqrt(((a[i] - b[j]) ** 2).sum(1))).all()
