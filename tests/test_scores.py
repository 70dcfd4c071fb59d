import math

import pytest
from pyspark.ml.linalg import Vectors
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from shelfmatch.functions import fixed_values as fixed
from shelfmatch.functions import vectors as ve
from shelfmatch.operators import metrics as me


def test_cosine_and_euclidean(spark):
    df = spark.createDataFrame(
        [([3.0, 4.0], [4.0, 3.0]), ([0.0, 0.0], [1.0, 2.0])], "a array<double>, b array<double>"
    )
    got = df.select(ve.cosine("a", "b"), ve.euclidean("a", "b")).collect()
    assert got[0][0] == pytest.approx(24 / 25) and got[0][1] == pytest.approx(math.sqrt(2))
    assert got[1][0] is None and got[1][1] == pytest.approx(math.sqrt(5))


def test_sparse_euclidean(spark):
    a, b = Vectors.sparse(9, {1: 2.0, 4: 1.0}), Vectors.sparse(9, {4: 3.0, 7: 1.0})
    df = spark.createDataFrame([(a, b), (a, a), (a, Vectors.sparse(9, {}))], ["a", "b"])
    plain = ve.sparse_euclidean(F.unwrap_udt(F.col("a")), F.unwrap_udt(F.col("b")))
    dense = ve.euclidean(vector_to_array("a"), vector_to_array("b"))
    for x, y in df.select(plain, dense).collect():
        assert x == pytest.approx(y)


def test_jaccard(spark):
    df = spark.createDataFrame(
        [(["a", "b", "b"], ["b", "c"]), (["a"], ["b"]), ([], [])], "a array<string>, b array<string>"
    )
    got = [r[0] for r in df.select(ve.jaccard_distance("a", "b")).collect()]
    assert got == [pytest.approx(2 / 3), 1.0, None]


def test_thresholds(spark):
    df = spark.createDataFrame([(0.6,), (0.59,), (0.61,), (None,)], "s double")
    assert [r[0] for r in df.select(ve.threshold("s", 0.6)).collect()] == [1, 0, 1, None]
    assert [r[0] for r in df.select(ve.threshold("s", 0.6, "at_most")).collect()] == [1, 1, 0, None]


def test_classes(spark):
    grid = [1, 1.25, 1.33, 1.5, 1.67, 1.75, 2, 2.25, 2.33, 2.5, 2.67, 2.75, 3]
    df = spark.createDataFrame([(float(g),) for g in grid], "r double")
    def got(cuts):
        return [int(r[0]) for r in df.select(ve.bin_label("r", cuts)).collect()]

    assert got(fixed.CUTS_13) == list(range(13))
    assert got(fixed.CUTS_4) == [0, 0, 0, 0, 1, 1, 1, 1, 2, 2, 3, 3, 3]
    assert got(fixed.CUTS_3) == [0] * 4 + [1] * 5 + [2] * 4
    assert got(fixed.CUTS_BINARY_LOW) == [0] * 3 + [1] * 10


def test_binary_metrics(spark):
    rows = [(1, 1)] * 5 + [(0, 0)] * 3 + [(1, 0)] * 2 + [(0, 1)]
    got = me.binary_metrics(spark.createDataFrame(rows, "prediction int, relevance int")).first()
    assert (got.TP, got.TN, got.FP, got.FN) == (5, 3, 2, 1)
    assert got.accuracy == pytest.approx(8 / 11)
    assert got.recall == pytest.approx(5 / 6) and got.precision == pytest.approx(5 / 7)
    assert got.f1 == pytest.approx(2 * (5 / 6) * (5 / 7) / (5 / 6 + 5 / 7))


def test_metrics_of_nothing_positive(spark):
    got = me.binary_metrics(spark.createDataFrame([(0, 0)], "prediction int, relevance int")).first()
    assert got.accuracy == 1.0 and got.recall is None and got.precision is None and got.f1 is None


def test_same_as_ml_evaluators(spark):
    from pyspark.ml.evaluation import MulticlassClassificationEvaluator, RegressionEvaluator

    rows = [(float(i % 3), float(i % 4)) for i in range(50)]
    df = spark.createDataFrame(rows, "prediction double, label double")
    ours = me.multiclass_accuracy(df).first()
    theirs = MulticlassClassificationEvaluator(metricName="accuracy").evaluate(df)
    assert ours.accuracy == pytest.approx(theirs) and ours.error == pytest.approx(1 - theirs)
    assert me.mse(df, label="label").first()[0] == pytest.approx(
        RegressionEvaluator(metricName="mse").evaluate(df)
    )
