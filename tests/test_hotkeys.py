from collections import Counter

import pytest
from pyspark.sql import functions as F

from shelfmatch.operators import hotkeys as hk
from shelfmatch.operators import relational as re_


def rows(df):
    return Counter(tuple(r) for r in df.collect())


def test_consolidate_multiplies_and_drops(spark):
    pairs = spark.createDataFrame([(1, "q1"), (1, "q2"), (2, "q3"), (3, "q4")], "product_uid int, search_term string")
    desc = spark.createDataFrame([(1, "d"), (1, "e"), (2, "f")], "product_uid int, product_description string")
    attrs = spark.createDataFrame(
        [(1, "brand", "b"), (1, "size", "9"), (2, "brand", "c"), (3, "brand", "d")],
        "product_uid int, name string, value string",
    )
    brand = re_.pick_attribute(attrs, "brand")
    got = hk.consolidate(pairs, desc, brand, ["search_term"])
    want = pairs.join(desc, "product_uid").join(brand, "product_uid")
    assert rows(got.select(want.columns)) == rows(want) and got.count() == 5


@pytest.fixture(scope="module")
def sides(spark):
    """Key 7 is hot on both sides, 8 on the right alone; nulls, copies and keys of one side."""
    key = lambda hot: F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 40 == 1, F.lit(None)).otherwise(hot)
    left = spark.range(1500).select(key(F.col("id") % 50).cast("int").alias("k"), (F.col("id") % 700).alias("x"))
    right = spark.range(300).select(
        key(F.when(F.col("id") % 2 == 0, 8).otherwise(F.col("id") % 60)).cast("int").alias("k"),
        (F.col("id") % 90).alias("y"),
    )
    return left, right


@pytest.mark.parametrize("hot_rows", [1, 20, 100, 10**6])
@pytest.mark.parametrize("how", ["inner", "left"])
def test_grid_join_is_a_join(sides, hot_rows, how):
    left, right = sides
    got = hk.grid_join(left, right, ["k"], ["x"], hot_rows=hot_rows, how=how)
    assert rows(got.select("k", "x", "y")) == rows(left.join(right, "k", how).select("k", "x", "y"))
    with pytest.raises(ValueError):
        hk.grid_join(left, right, ["k"], ["x"], how="outer")


def test_two_columns_with_odd_names(spark):
    df = spark.range(200).select((F.col("id") % 3).alias("a b"), (F.col("id") % 2).cast("string").alias("c.d"), "id")
    other = df.withColumnRenamed("id", "y")
    on = ["a b", "c.d"]
    want = rows(df.join(other, ["a b", "c.d"]).select("id", "y"))
    assert rows(hk.grid_join(df, other, on, ["id"], hot_rows=10).select("id", "y")) == want


def test_no_place_of_the_grid_gets_many_rows(sides):
    left, right = (df.na.drop() for df in sides)
    counts = [hk.frequent_keys(df, ["k"]) for df in (left, right)]
    dealt = hk.dealt(left.distinct(), right.distinct(), ["k"], ["x"], *counts, hot_rows=50)
    for side in dealt:
        sizes = [r["count"] for r in side.groupBy("k", hk.ROW, hk.COLUMN).count().collect()]
        assert max(sizes) < 100
    assert dealt[0].where("k = 7").select(hk.ROW).distinct().count() == 11  # 520 rows
    assert dealt[1].where("k = 8").select(hk.COLUMN).distinct().count() == 2


def test_rows_are_computed_once(spark, sides):
    left, _ = sides
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    kept, counts = hk.kept_with_frequent_keys(left.mapInArrow(count, left.schema), ["k"])
    assert rows(kept) == rows(left) and seen.value == 1500
    want = {r.h: r.n for r in left.groupBy(hk.key_hash(["k"]).alias("h")).agg(F.count("*").alias("n")).collect()}
    assert counts == want
    few = hk.frequent_keys(left, ["k"], 16)  # a small sketch still holds the hot key
    assert max(few, key=few.get) == max(want, key=want.get)
    assert hk.kept_with_frequent_keys(left.limit(0), ["k"])[1] == {}


def test_consolidate_reads_the_pairs_once(spark):
    pairs = spark.range(100).select((F.col("id") % 5).alias("product_uid"), F.col("id").alias("q"))
    names = spark.range(5).select(F.col("id").alias("product_uid"), F.col("id").alias("product_description"))
    value = names.select("product_uid", F.col("product_description").alias("value"))
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    for hot_rows in (3, 1000):
        before = seen.value
        got = hk.consolidate(pairs.mapInArrow(count, pairs.schema), names, value, ["q"], hot_rows)
        assert got.count() == 100 and seen.value - before == 100
