import math
import random

import numpy as np
import pytest
from pyspark.ml.feature import MinHashLSH
from pyspark.sql import functions as F

from shelfmatch.functions.hashing import minhash_signature, term_id
from shelfmatch.operators import closesets as cs
from shelfmatch.operators import relational as re_
from shelfmatch.operators import simjoin as sj
from shelfmatch.sources import tables as so


def token_sides(spark, n=60):
    r = random.Random(3)
    vocabulary = [f"w{i}" for i in range(40)]
    def side(base):
        out = []
        for i in range(n):
            if i % 3 == 0:  # a third are copies
                out.append((base + i, ["w1", "w2", "w3", "w4"]))
            else:
                out.append((base + i, [r.choice(vocabulary) for _ in range(r.randint(0, 9))]))
        return out

    a, b = side(0), side(1000)
    return a, b, *[spark.createDataFrame(x, "id bigint, t array<string>") for x in (a, b)]


def brute_jaccard(a, b, threshold):
    out = {}
    for i, x in a:
        for j, y in b:
            x_, y_ = set(x), set(y)
            if x_ and y_:
                d = 1 - len(x_ & y_) / len(x_ | y_)
                if d < threshold:
                    out[i, j] = d
    return out


def found(df):
    rows = df.collect()
    out = {(r.id_a, r.id_b): r.distance for r in rows}
    assert len(out) == len(rows), "a pair came twice"
    return out


@pytest.mark.parametrize("counted_below", [0.0, 0.5])
@pytest.mark.parametrize("threshold", [1.0, 0.8, 0.5, 0.3, 0.01])
def test_exact_jaccard_is_brute_force(spark, monkeypatch, threshold, counted_below):
    monkeypatch.setattr(sj, "COUNTED_BELOW", counted_below)
    a, b, da, db = token_sides(spark)
    want = brute_jaccard(a, b, threshold)
    assert found(sj.jaccard_join_exact(da, db, "id", "t", threshold)) == pytest.approx(want)


def test_exact_jaccard_with_hot_words(spark, monkeypatch):
    monkeypatch.setattr(re_, "HOT_ROWS", 5)
    monkeypatch.setattr(re_.hot_counts, "__defaults__", (5,))
    monkeypatch.setattr(sj, "COUNTED_BELOW", 0.0)
    a, b, da, db = token_sides(spark)
    want = brute_jaccard(a, b, 0.6)
    assert found(sj.jaccard_join_exact(da, db, "id", "t", 0.6)) == pytest.approx(want)


@pytest.mark.parametrize("bands, how", [(None, "md5"), (None, "xxhash64"), (4, "md5")])
def test_minhash_join(spark, bands, how):
    a, b, da, db = token_sides(spark)
    want = brute_jaccard(a, b, 0.9)
    hashes = 8 if bands else 5
    got = found(sj.jaccard_join(da, db, "id", "t", 0.9, hashes, bands, how=how))
    assert set(got) <= set(want)
    assert all(got[k] == pytest.approx(want[k]) for k in got)
    # every pair of equal sets is found, and most of the similar ones
    assert {k for k, d in want.items() if d == 0} <= set(got)
    near = [k for k, d in want.items() if d <= 0.4]
    assert sum(k in got for k in near) >= 0.8 * len(near)


def test_minhash_finds_as_much_as_ml(spark):
    a, b, da, db = token_sides(spark)
    from pyspark.ml.feature import CountVectorizer

    cv = CountVectorizer(inputCol="t", outputCol="f").fit(da.unionAll(db))
    fa, fb = (cv.transform(d).where(F.size("t") > 0) for d in (da, db))
    ml = MinHashLSH(numHashTables=5, seed=1, inputCol="f", outputCol="h").fit(fa)
    theirs = ml.approxSimilarityJoin(fa, fb, 0.9, "d").select(
        F.col("datasetA.id").alias("i"), F.col("datasetB.id").alias("j"), "d"
    ).collect()
    want = brute_jaccard(a, b, 0.9)
    assert all(want[r.i, r.j] == pytest.approx(r.d) for r in theirs)
    ours = found(sj.jaccard_join(da, db, "id", "t", 0.9))
    assert len(ours) >= 0.7 * len(theirs)


def test_own_pairs(spark):
    a = [(1, ["x", "y"]), (2, ["x"]), (3, [])]
    b = [(1, ["y"]), (2, ["z"]), (3, []), (4, ["x"])]
    da, db = (spark.createDataFrame(x, "id bigint, t array<string>") for x in (a, b))
    assert found(sj.jaccard_join(da, db, "id", "t", 1.0, paired_only=True)) == {(1, 1): 0.5}


def test_signature_of_nothing_is_null(spark):
    df = spark.createDataFrame([([],), (["a"],)], "t array<string>")
    got = [r[0] for r in df.select(minhash_signature("t")).collect()]
    assert got[0] is None and len(got[1]) == 5


def vector_sides(spark, dim=6, n=50):
    r = random.Random(5)
    a, b = (
        [
            (base + i, [1.0, 0.0, 0.0, 0.0, 0.0, 0.5] if i % 3 == 0 else [r.gauss(0, 1) for _ in range(dim)])
            for i in range(n)
        ]
        for base in (0, 1000)
    )
    b.append((5000, [0.0] * dim))
    return a, b, *[spark.createDataFrame(x, "id bigint, v array<double>") for x in (a, b)]


def brute(a, b, threshold, metric):
    out = {}
    for i, x in a:
        for j, y in b:
            if metric == "euclidean":
                d = math.dist(x, y)
            else:
                size = math.hypot(*x) * math.hypot(*y)
                if size == 0:
                    continue
                d = 1 - sum(p * q for p, q in zip(x, y)) / size
            if d < threshold:
                out[i, j] = max(d, 0.0)
    return out


@pytest.mark.parametrize(
    "metric, threshold", [("euclidean", 0.7), ("euclidean", 1.5), ("euclidean", 4.0), ("cosine", 0.1), ("cosine", 0.6)]
)
def test_exact_distance_is_brute_force(spark, metric, threshold):
    a, b, da, db = vector_sides(spark)
    want = brute(a, b, threshold, metric)
    got = found(sj.distance_join_exact(da, db, "id", "v", 6, threshold, metric))
    assert set(got) == set(want)
    assert all(got[k] == pytest.approx(want[k], abs=1e-9) for k in got)


def test_projection_join(spark):
    a, b, da, db = vector_sides(spark)
    want = brute(a, b, 3.0, "euclidean")
    got = found(sj.euclidean_join(da, db, "id", "v", 6, 3.0, bucket_length=2.0, tables=3))
    assert set(got) <= set(want) and all(got[k] == pytest.approx(want[k]) for k in got)
    assert {k for k, d in want.items() if d == 0} <= set(got)
    assert len(got) >= 0.7 * len(want)


def test_projections_together_leave_few_candidates(spark):
    a, b, da, db = vector_sides(spark)
    got = found(sj.euclidean_join(da, db, "id", "v", 6, 100.0, 1.0, tables=6, per_table=4))
    want = brute(a, b, 100.0, "euclidean")
    assert all(got[k] == pytest.approx(want[k]) for k in got)
    assert {k for k, d in want.items() if d == 0} <= set(got)
    apart = [k for k, d in want.items() if d > 0]
    assert sum(k in got for k in apart) < 0.1 * len(apart)


def test_no_cross_product_in_plans(spark):
    _, _, da, db = token_sides(spark)
    _, _, va, vb = vector_sides(spark)
    for df in (
        sj.jaccard_join(da, db, "id", "t", 0.5),
        sj.jaccard_join_exact(da, db, "id", "t", 0.5),
        sj.euclidean_join(va, vb, "id", "v", 6, 1.0),
        sj.distance_join_exact(va, vb, "id", "v", 6, 1.0),
    ):
        plan = df._jdf.queryExecution().toString()
        assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_close_sets_move_words_of_near_pairs_only(spark):
    """Sets that share rare words and are not near: pairs with their words were joined before."""
    from shelfmatch.operators import closesets as cs

    r = random.Random(8)
    a = []
    for i in range(40):
        words = [f"rare{i // 8}-{k}" for k in range(20)] + [f"own{i}-{k}" for k in range(40)]
        a.append((i, words))
        a.append((100 + i, r.sample(words, 55)))  # its near copy
    a += [(200, []), (201, None), (202, ["x"]), (203, ["x", "x"])]
    df = spark.createDataFrame(a, "id bigint, t array<string>")
    want = brute_jaccard(a[:80] + a[82:], a[:80] + a[82:], 0.4)
    assert found(sj.jaccard_join_exact(df, df, "id", "t", 0.4)) == pytest.approx(want)
    banded = found(sj.jaccard_join(df, df, "id", "t", 0.4, hashes=12, bands=4))
    assert set(banded) <= set(want) and {(i, i) for i in range(40)} <= set(banded)
    side = sj._token_side(df, "id", "t")
    sets = cs.kept_sets(side, side)
    candidates = cs._candidates(sets, 0.6)
    assert cs._unlikely_dropped(candidates, sets, 0.6, False).count() < 2 * 40


def test_banded_join_of_close_sets_is_the_bucket_join(spark, monkeypatch):
    a, b, da, db = token_sides(spark)
    got = found(sj.jaccard_join(da, db, "id", "t", 0.4, hashes=8, bands=4))
    monkeypatch.setattr(sj, "COUNTED_BELOW", 2.0)
    assert got and got == pytest.approx(found(sj.jaccard_join(da, db, "id", "t", 0.4, hashes=8, bands=4)))


def test_bucket_join_makes_no_row_of_a_candidate(spark, monkeypatch):
    """All share a bucket of every table, which were 120 * 120 rows with both vectors before."""
    from shelfmatch.operators import bucketpairs as bp

    monkeypatch.setattr(bp, "CELL_ROWS", 16)
    monkeypatch.setattr(bp, "BIN_ROWS", 64)
    r = random.Random(9)
    a = [(i, [r.random() for _ in range(6)]) for i in range(120)] + [(500, None), (501, [1.0, None, 0.0, 0.0, 0.0, 0.0])]
    df = spark.createDataFrame(a, "id bigint, v array<double>")
    join = sj.euclidean_join(df, df, "id", "v", 6, 0.5, 50.0, tables=3, per_table=2)
    assert found(join) == pytest.approx(brute(a[:120], a[:120], 0.5, "euclidean"))
    assert "FlatMapCoGroupsInArrow" in join._jdf.queryExecution().toString()


def test_bands_are_those_of_the_signature(spark):
    rows = [(i, [f"w{j * j % (i + 3)}" for j in range(i)] + [None] * (i % 3)) for i in range(40)] + [(41, ["ä", ""])]
    df = spark.createDataFrame(rows, "id int, w array<string>")
    for how in ("md5", "xxhash64"):
        ids = "w" if how == "md5" else F.transform("w", lambda x: term_id(x, how)).alias("w")
        terms = df.select("id", ids, minhash_signature("w", 6, 7, how).alias("s")).orderBy("id").toArrow()
        got = cs.Bands(6, 3, 7, how).of(terms["w"].combine_chunks()).to_pylist()
        for made, want in zip(got, terms["s"].to_pylist()):
            if want is not None and None not in want:
                assert [np.frombuffer(x, "<u4").tolist() for x in made] == [want[:2], want[2:4], want[4:]]


def test_what_a_join_keeps_is_read_by_its_result(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(so, "shared_folder", lambda session: str(tmp_path))
    rows = [(i, [f"w{j}" for j in range(i % 5, 20)]) for i in range(30)]
    df = spark.createDataFrame(rows, "id int, w array<string>")
    for made in (sj.jaccard_join_exact(df, df, "id", "w", 0.3), sj.jaccard_join(df, df, "id", "w", 0.3, 10, 5)):
        assert made.count() > 30
    assert len(list(tmp_path.iterdir())) == 8  # sets, their first rows, copies and pairs; no prefixes, candidates or bits
