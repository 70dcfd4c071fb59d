import hashlib
import random

import pytest
from pyspark.sql import functions as F

from shelfmatch.operators import order as od


def test_ranks(spark):
    rng = random.Random(1)
    rows = [(rng.choice([None, 1.0, 2.5, float(i)]), i % 30, "x") for i in range(500)] + [(7.0, 7, "y")] * 200
    df = spark.createDataFrame(rows, "score double, id int, rank string").repartition(7)
    got = od.with_rank(df, [F.desc("score"), F.asc("id")]).orderBy("rank").collect()
    assert [r.rank for r in got] == list(range(1, 701))
    want = sorted(((s is None, -(s or 0), i) for s, i, _ in rows))
    assert [(r.score is None, -(r.score or 0), r.id) for r in got] == want
    assert od.with_rank(df.limit(0), [F.desc("score")]).count() == 0


def test_dense_ids(spark):
    df = spark.range(300).select(((F.col("id") * 7) % 300).alias("a b"), F.lit(1).alias("c.d"))
    got = od.with_dense_id(df.repartition(5), ["c.d", "a b"]).collect()
    assert all(r.row_id == r["a b"] for r in got) and len(got) == 300


def test_no_part_ranks_many_rows_that_are_alike_in_the_order(spark):
    df = spark.range(4000).select(F.lit(1).alias("k"), "id")
    by = [F.asc("k"), F.xxhash64("k", "id")]
    sizes = df.repartitionByRange(4, *by).groupBy(F.spark_partition_id()).count().collect()
    assert max(r["count"] for r in sizes) < 2000
    assert sorted(r.rank for r in od.with_rank(df, [F.asc("k")]).collect()) == list(range(1, 4001))


def brute_force(rows, weights, seed=42):
    """Part of each key."""
    out, classes = {}, {}
    for key, label in rows:
        classes.setdefault(label, []).append((hashlib.md5(f"{seed}:{key}".encode()).hexdigest(), str(key), key))
    for members in classes.values():
        for rank, (_, _, key) in enumerate(sorted(members)):
            low, part = 0.0, 0
            for w in weights[:-1]:
                low += w
                part += rank >= int(len(members) * low / sum(weights) + 0.5)
            out[key] = part
    return out


@pytest.mark.parametrize("ranked_rows", [2, 60, 10_000])
@pytest.mark.parametrize("weights", [[0.6, 0.4], [3, 1, 1], [1.0]])
def test_quotas(spark, monkeypatch, ranked_rows, weights):
    monkeypatch.setattr(od, "RANKED_ROWS", ranked_rows)
    monkeypatch.setattr(od, "PREFIX", 1)
    rows = [(i, ["a", "a", "a", "b", None, "", f"c{i % 40}"][i % 7]) for i in range(600)]
    df = spark.createDataFrame(rows, "id long, label string").repartition(3)
    parts = od.split_by_quota(df, "id", "label", weights)
    got = {r.id: n for n, part in enumerate(parts) for r in part.collect()}
    assert got == brute_force(rows, weights) and len(got) == 600
    assert all(part.columns == ["id", "label"] for part in parts)


def test_quota_of_an_empty_table(spark):
    none = spark.createDataFrame([], "id long, label string")
    assert [p.count() for p in od.split_by_quota(none, "id", "label")] == [0, 0]
