from collections import Counter

from pyspark.sql import functions as F

from shelfmatch.operators import relational as re_


def rows(df):
    return Counter(tuple(r) for r in df.collect())


def hot_sides(spark):
    left = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 50).alias("k"), F.col("id").alias("x")
    )
    right = spark.range(60).select((F.col("id") % 55).alias("k"), F.col("id").alias("y"))
    return left, right


def test_skew_join_is_a_join(spark):
    left, right = hot_sides(spark)
    want = rows(left.join(right, "k").select("k", "x", "y"))
    hot = re_.hot_keys(left, ["k"], 100)
    assert {r.k: r._parts for r in hot.collect()} == {7: 11}
    for joined in (
        re_.skew_join(left, right, ["k"], ["x"], hot),
        re_.skew_join(left, right, ["k"], ["x"]),
    ):
        assert rows(joined.select("k", "x", "y")) == want
    few = right.where(F.col("k") < 10)
    assert rows(re_.skew_join(left, few, ["k"], ["x"], hot, how="left").select("k", "x", "y")) == rows(
        left.join(few, "k", "left").select("k", "x", "y")
    )


def test_skew_join_spreads_the_hot_key(spark):
    left, right = hot_sides(spark)
    hot = re_.hot_keys(left, ["k"], 100)
    parts = left.join(hot, "k").select(F.pmod(F.xxhash64("x"), F.col("_parts"))).distinct().count()
    assert parts == 11


def test_every_hot_key_is_cut_into_enough_parts(spark):
    df = spark.range(6000).select((F.col("id") % 2000).alias("k"))
    hot = re_.hot_keys(df, ["k"], 2)
    assert hot.count() == 2000 and {r._parts for r in hot.collect()} == {2}
    one = spark.range(5000).select(F.lit(1).alias("k"))
    assert re_.hot_keys(one, ["k"], 2).first()._parts == 2500


def test_fields_there_and_back(spark):
    df = spark.createDataFrame([(1, "a", "b"), (2, "c", None)], "pair_id int, t string, q string")
    long = re_.unpivot_fields(df, ["t", "q"], ["pair_id"])
    assert long.count() == 4
    assert rows(re_.pivot_fields(long, ["t", "q"], ["pair_id"])) == rows(df)


def test_keys_do_not_depend_on_partitions(spark):
    df = spark.range(500).select("id", (F.col("id") % 7).alias("b"))

    def ids(d):
        return rows(re_.with_pair_id(d, ["id", "b"]))

    def split(d):
        return [rows(p) for p in re_.split_by_key(d, "id", [0.6, 0.4], 42)]

    assert ids(df.repartition(1)) == ids(df.repartition(16))
    assert split(df.repartition(1)) == split(df.repartition(16))
    first, second = split(df)
    assert not first & second and sum((first + second).values()) == 500
    assert 250 < sum(first.values()) < 350


def test_singletons_and_duplicates(spark):
    df = spark.createDataFrame([(1, 1, "x"), (1, 1, "y"), (1, 2, "z"), (2, 1, "w")], "a int, b int, c string")
    assert rows(re_.drop_singletons(df, ["a", "b"], ["c"]).select("a", "b", "c")) == Counter(
        [(1, 1, "x"), (1, 1, "y")]
    )
    assert re_.dedupe_pairs(df, ["a", "b"]).count() == 3


def test_drop_invalid(spark):
    df = spark.createDataFrame([(1, 1.0), (2, None), (3, float("nan"))], "id int, x double")
    assert [r.id for r in re_.drop_invalid(df).collect()] == [1]


def test_order_and_top(spark):
    df = spark.createDataFrame([(1, 0.5), (2, 0.9), (3, 0.5)], "id int, s double")
    assert [r.id for r in re_.rank_pairs(df, "s", ["id"]).collect()] == [2, 1, 3]
    assert [r.id for r in re_.top_k(df, [F.desc("id")], 2).collect()] == [3, 2]
    plan = re_.top_k(df, [F.desc("id")], 2)._jdf.queryExecution().toString()
    assert "TakeOrderedAndProject" in plan


def test_prefix_columns(spark):
    df = spark.createDataFrame([(1, "a")], "id int, x string")
    assert re_.prefix_columns(df, "title_", ["id"]).columns == ["id", "title_x"]


def test_skew_join_shuffles_a_side_once(spark):
    """The hot keys are broadcast; joined by a shuffle they made each side move twice."""
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        left, right = spark.range(50).withColumn("x", F.col("id") % 7), spark.range(7).withColumnRenamed("id", "x")
        joined = re_.skew_join(left, right, ["x"], ["id"])
        plan = joined._jdf.queryExecution().sparkPlan().toString()
        assert plan.count("BroadcastHashJoin") == 2 and plan.count("SortMergeJoin") == 1
        assert joined.count() == 50
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
