import math
import uuid
from collections import Counter

import pytest
from pyspark.sql import functions as F

from shelfmatch.operators import termmodels as tm

LISTS = [["a", "b", "a", "c"], ["a", "x"], [], None, ["b", "a", None], ["c", "c", "c"]]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(list(enumerate(LISTS)), "id int, w array<string>")


def rows(df):
    return Counter(tuple(r) for r in df.collect())


def test_model_is_read_without_moving_it(spark, docs, tmp_path):
    name = f"m{uuid.uuid4().hex}"
    words = tm.field_terms(docs, "id", ["w"])
    saved = tm.save_term_table(tm.vocabulary(docs, "w", 2), name, str(tmp_path / "m"))
    again = tm.load_term_table(spark, f"{name}_again", str(tmp_path / "m"))
    assert rows(saved) == rows(again) == Counter([("a", 4, 3), ("b", 2, 2), ("c", 4, 2)])
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for model in (saved, again):
            joined = tm.join_model(words, model)
            plan = joined._jdf.queryExecution().executedPlan().toString()
            assert plan.count("Exchange hashpartitioning") == 1 and "SortMergeJoin" in plan
            assert f"FileScan parquet" in plan and "Bucketed: true" in plan
            assert rows(joined.select("id", "term", "n")) == Counter(
                [(0, "a", 2), (0, "b", 1), (0, "c", 1), (1, "a", 1), (4, "a", 1), (4, "b", 1), (5, "c", 3)]
            )
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
        for t in (name, f"{name}_again"):
            spark.sql(f"DROP TABLE `{t}`")


@pytest.mark.parametrize("hot_rows", [1, 3, 100])
@pytest.mark.parametrize("how", ["inner", "left"])
def test_join_model_is_a_join(spark, hot_rows, how):
    left = spark.range(60).select(
        F.when(F.col("id") % 2 == 0, "hot").when(F.col("id") % 5 == 0, None).otherwise(F.concat(F.lit("t"), F.col("id") % 9)).alias("term"), "id"
    )
    model = spark.createDataFrame([("hot", 1), ("t1", 2), ("t3", 3), ("unused", 4)], "term string, v int")
    got = tm.join_model(left, model, how=how, hot_rows=hot_rows)
    assert rows(got.select("term", "id", "v")) == rows(left.join(model, "term", how).select("term", "id", "v"))


def test_tfidf_of_fields(spark):
    data = [(1, ["a", "a", "b"], ["a", "z"]), (2, ["b"], []), (3, None, ["b", "b"])]
    df = spark.createDataFrame(data, "id int, title array<string>, query array<string>")
    frequencies = spark.createDataFrame([("a", 1), ("b", 2)], "term string, df int")
    got = {(r.id, r.field, r.term): (r.tf, r.weight) for r in tm.tfidf_fields(df, "id", ["title", "query"], frequencies, 3).collect()}
    idf = lambda n: math.log(4 / (n + 1))
    want = {
        (1, "title", "a"): (2, 2 * idf(1)), (1, "title", "b"): (1, idf(2)), (1, "query", "a"): (1, idf(1)),
        (1, "query", "z"): (1, idf(0)), (2, "title", "b"): (1, idf(2)), (3, "query", "b"): (2, 2 * idf(2)),
    }
    assert got.keys() == want.keys()
    assert all(got[k] == (want[k][0], pytest.approx(want[k][1])) for k in want)


def test_pair_counts(spark):
    data = [(1, ["a", "a", "b", "q"], ["a", "c"]), (2, ["q"], ["q"]), (3, [], ["a"]), (4, None, None), (5, None, ["b", "b"])]
    df = spark.createDataFrame(data, "id int, x array<string>, y array<string>")
    model = spark.createDataFrame([("a",), ("b",), ("c",)], "term string")
    got = {tuple(r) for r in tm.pair_counts(df, ["id"], "x", "y", model).collect()}
    assert got == {(1, 2, 2, 1, 3), (3, 0, 1, 0, 1), (5, 0, 1, 0, 4)}
