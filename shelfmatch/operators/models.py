"""Supervised models: one ``train`` for all of them, ``score`` for all fitted ones."""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.classification import (
    LogisticRegression,
    NaiveBayes,
    OneVsRest,
    RandomForestClassifier,
)
from pyspark.ml.feature import IndexToString, StringIndexer, VectorIndexer
from pyspark.ml.regression import (
    DecisionTreeRegressor,
    GBTRegressor,
    GeneralizedLinearRegression,
    IsotonicRegression,
    LinearRegression,
    RandomForestRegressor,
)
from pyspark.sql import DataFrame, SparkSession

from shelfmatch.sources.tables import cut_lineage

CLASSIFIERS = ["naive_bayes", "ovr", "rf_class"]
REGRESSORS = ["linear", "glm", "tree", "rf_reg", "gbt", "isotonic"]


def _naive_bayes(cols):
    return NaiveBayes(**cols)


def _logistic(cols, max_iter=10000, tol=1e-6):
    return LogisticRegression(maxIter=max_iter, tol=tol, fitIntercept=True, **cols)


def _ovr(cols, max_iter=10000, tol=1e-6, parallelism=2):
    return OneVsRest(
        classifier=_logistic({}, max_iter, tol), parallelism=parallelism, **cols
    )


def label_indexer(train: DataFrame, label: str = "label", out: str = "indexed_label"):
    """Number the labels, the most frequent first, equals in alphabetical order."""
    return StringIndexer(inputCol=label, outputCol=out).fit(train)


def feature_indexer(
    features: str = "features", out: str = "indexed_features", max_categories: int = 4
) -> VectorIndexer:
    """Number the values of features that have at most ``max_categories``; leave the others."""
    return VectorIndexer(
        inputCol=features, outputCol=out, maxCategories=max_categories, handleInvalid="keep"
    )


def label_names(indexer, prediction: str = "prediction", out: str = "predicted_label"):
    """Back from label numbers to labels."""
    return IndexToString(inputCol=prediction, outputCol=out, labels=indexer.labels)


def forest_pipeline(
    train: DataFrame, cols, num_trees=1000, max_categories=4, seed=42, **more
) -> Pipeline:
    """Index the label and the few-valued features, grow a forest, name the predicted label."""
    labels = label_indexer(train, cols["labelCol"])
    forest = RandomForestClassifier(
        labelCol="indexed_label", featuresCol="indexed_features", numTrees=num_trees, seed=seed, **more
    )
    features = feature_indexer(cols["featuresCol"], max_categories=max_categories)
    return Pipeline(stages=[labels, features, forest, label_names(labels)])


def _linear(cols, max_iter=10000, reg=0.1, elastic_net=0.0):
    return LinearRegression(maxIter=max_iter, regParam=reg, elasticNetParam=elastic_net, **cols)


def _glm(cols, max_iter=10000, reg=0.3):
    return GeneralizedLinearRegression(
        family="gaussian", link="identity", maxIter=max_iter, regParam=reg, **cols
    )


def _tree(cols, seed=42, **more):
    return DecisionTreeRegressor(seed=seed, **cols, **more)


def _rf_reg(cols, num_trees=20, seed=42, **more):
    return RandomForestRegressor(numTrees=num_trees, seed=seed, **cols, **more)


def _gbt(cols, rounds=20, seed=42, **more):
    return GBTRegressor(maxIter=rounds, seed=seed, **cols, **more)


def _isotonic(cols, feature_index=0):
    return IsotonicRegression(featureIndex=feature_index, **cols)


ESTIMATORS = {
    "naive_bayes": _naive_bayes,
    "logistic": _logistic,
    "ovr": _ovr,
    "linear": _linear,
    "glm": _glm,
    "tree": _tree,
    "rf_reg": _rf_reg,
    "gbt": _gbt,
    "isotonic": _isotonic,
}


def train(df: DataFrame, kind: str, features: str = "features", label: str = "label", **params):
    """Fit one of the models of ``ESTIMATORS``, or "rf_class" with its indexers around it."""
    cols = {"featuresCol": features, "labelCol": label}
    if kind == "rf_class":
        return forest_pipeline(df, cols, **params).fit(df)
    return ESTIMATORS[kind](cols, **params).fit(df)


def score(model, df: DataFrame) -> DataFrame:
    return model.transform(df)


def ready_to_train(df: DataFrame, key: str) -> DataFrame:
    """The frame in an order that follows from the key, kept so that every model reads it as is.

    Samplers and tree bins depend on row order; this makes repeated runs equal.
    """
    return cut_lineage(df.repartition(key).sortWithinPartitions(key))


def coefficients(model, names: list[str]) -> DataFrame:
    """``feature, coefficient`` of a fitted linear model, and its intercept as "(intercept)"."""
    rows = [("(intercept)", float(model.intercept))]
    rows += [(n, float(w)) for n, w in zip(names, model.coefficients.toArray())]
    return SparkSession.active().createDataFrame(rows, "feature string, coefficient double")


def isotonic_boundaries(model) -> DataFrame:
    """``boundary, prediction`` of a fitted isotonic model, in rising order."""
    pairs = zip(model.boundaries.toArray(), model.predictions.toArray())
    rows = [(float(x), float(y)) for x, y in pairs]
    return SparkSession.active().createDataFrame(rows, "boundary double, prediction double")


def importances(model, names: list[str]) -> DataFrame:
    """``feature, importance`` of a fitted tree model, one row per feature."""
    rows = [(n, float(w)) for n, w in zip(names, model.featureImportances.toArray())]
    return SparkSession.active().createDataFrame(rows, "feature string, importance double")
