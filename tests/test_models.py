import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from shelfmatch.operators import features as fe
from shelfmatch.operators import models as mo
from shelfmatch.operators.metrics import mse, multiclass_accuracy

SMALL = {"rf_class": {"num_trees": 20}, "gbt": {"rounds": 5}}


@pytest.fixture(scope="module")
def frame(spark):
    r = np.random.default_rng(4)
    x = r.uniform(0, 5, size=(200, 3))
    y = 1 + 0.4 * x[:, 0] - 0.2 * x[:, 1] + r.normal(0, 0.1, 200)
    rows = [(i, *map(float, v), float(t), float(t > 1.5)) for i, (v, t) in enumerate(zip(x, y))]
    df = spark.createDataFrame(rows, "pair_id bigint, a double, b double, c double, relevance double, label double")
    return mo.ready_to_train(fe.assemble(df, ["a", "b", "c"]), "pair_id")


def guesses(model, frame):
    return [r.prediction for r in mo.score(model, frame).orderBy("pair_id").collect()]


@pytest.mark.parametrize("kind", mo.REGRESSORS)
def test_regressors_beat_the_mean_and_repeat(frame, kind):
    model = mo.train(frame, kind, label="relevance", **SMALL.get(kind, {}))
    variance = frame.agg(F.var_pop("relevance")).first()[0]
    assert mse(mo.score(model, frame)).first()[0] <= variance
    assert guesses(model, frame) == guesses(
        mo.train(frame, kind, label="relevance", **SMALL.get(kind, {})), frame
    )


@pytest.mark.parametrize("kind", ["naive_bayes", "logistic", "ovr", "rf_class"])
def test_classifiers_beat_the_majority(frame, kind):
    model = mo.train(frame, kind, **SMALL.get(kind, {}))
    label = "indexed_label" if kind == "rf_class" else "label"
    share = frame.agg(F.avg("label")).first()[0]
    accuracy = multiclass_accuracy(mo.score(model, frame), label=label).first()[0]
    floor = 0.5 if kind == "naive_bayes" else max(share, 1 - share)
    assert accuracy > floor


def test_forest_names_labels(frame):
    got = mo.score(mo.train(frame, "rf_class", num_trees=5), frame)
    assert got.where(F.col("predicted_label").cast("double").isin(0.0, 1.0)).count() == got.count()
    right = F.col("predicted_label").cast("double") == F.col("label")
    assert got.where(right != (F.col("prediction") == F.col("indexed_label"))).count() == 0


def test_linear_solves_the_ridge_equations(frame):
    rows = frame.select(vector_to_array("features").alias("x"), "relevance").collect()
    x, y = np.array([r.x for r in rows]), np.array([r.relevance for r in rows])
    model = mo.train(frame, "linear", label="relevance", reg=0.0)
    want, *_ = np.linalg.lstsq(np.c_[x, np.ones(len(x))], y, rcond=None)
    assert [*model.coefficients, model.intercept] == pytest.approx(list(want), abs=1e-6)
    # a penalty on scaled coefficients: they are smaller, the mean is kept
    ridge = mo.train(frame, "linear", label="relevance", reg=0.1)
    assert np.abs(ridge.coefficients.toArray())[0] < abs(want[0])
    assert np.mean(guesses(ridge, frame)) == pytest.approx(y.mean(), abs=1e-6)


def test_isotonic_rises_and_uses_one_feature(frame):
    model = mo.train(frame, "isotonic", label="relevance")
    assert list(model.predictions) == sorted(model.predictions)
    assert list(model.boundaries) == sorted(model.boundaries)
    pairs = sorted(
        (r.x[0], r.prediction)
        for r in mo.score(model, frame).select(vector_to_array("features").alias("x"), "prediction").collect()
    )
    assert [p for _, p in pairs] == sorted(p for _, p in pairs)


@pytest.mark.parametrize("kind", ["tree", "rf_reg", "gbt"])
def test_importances(frame, kind):
    model = mo.train(frame, kind, label="relevance", **SMALL.get(kind, {}))
    got = {r.feature: r.importance for r in mo.importances(model, ["a", "b", "c"]).collect()}
    assert sum(got.values()) == pytest.approx(1.0) and max(got, key=got.get) == "a"


def test_label_numbers(spark):
    df = spark.createDataFrame([("x",), ("y",), ("y",), ("z",), ("w",)], "label string")
    model = mo.label_indexer(df)
    assert list(model.labels) == ["y", "w", "x", "z"]
    back = mo.label_names(model, "indexed_label", "name").transform(model.transform(df))
    assert back.where("name <> label").count() == 0
