"""Relevance classes from text overlap."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmatch.functions.vectors import bin_label
from shelfmatch.functions.fixed_values import CUTS_BINARY_LOW
from shelfmatch.operators.features import assemble, fit_pca, normalize, pca_transform
from shelfmatch.operators.metrics import multiclass_accuracy
from shelfmatch.operators.models import CLASSIFIERS, ready_to_train, score, train
from shelfmatch.operators.relational import split_by_key
from shelfmatch.plans.features import OVERLAP_FEATURES, overlap_features


def classification_frames(
    pairs: DataFrame, cuts: list[float] = CUTS_BINARY_LOW, seed: int = 42
) -> tuple[DataFrame, DataFrame]:
    """Train and test frames ``pair_id, label, features`` with rows scaled by their largest entry."""
    labelled = overlap_features(pairs).withColumn("label", bin_label("relevance", cuts))
    scaled = normalize(assemble(labelled, OVERLAP_FEATURES, "raw"), c="raw", out="features")
    frame = ready_to_train(scaled.select("pair_id", "label", "features"), "pair_id")
    first, second = split_by_key(frame, "pair_id", seed=seed)
    return first, second


def pca_frames(train_df: DataFrame, test_df: DataFrame, k: int = 3) -> tuple[DataFrame, DataFrame]:
    """The same frames in principal components learnt from the training rows."""
    model = fit_pca(train_df, k)
    first, second = (
        pca_transform(model, d).select("pair_id", "label", F.col("pca_features").alias("features"))
        for d in (train_df, test_df)
    )
    return first, second


def classify_relevance(
    pairs: DataFrame,
    cuts: list[float] = CUTS_BINARY_LOW,
    models: list[str] = CLASSIFIERS,
    params: dict[str, dict] | None = None,
) -> DataFrame:
    """``model, accuracy, error`` on held-out pairs, naive Bayes on the features as they are
    (it takes no negative values) and the others on three principal components."""
    plain = classification_frames(pairs, cuts)
    reduced = pca_frames(*plain)
    rows = []
    for kind in models:
        train_df, test_df = plain if kind == "naive_bayes" else reduced
        model = train(train_df, kind, **(params or {}).get(kind, {}))
        label = "indexed_label" if kind == "rf_class" else "label"
        accuracy = multiclass_accuracy(score(model, test_df), label=label)
        rows.append(accuracy.select(F.lit(kind).alias("model"), "accuracy", "error"))
    return reduce(DataFrame.unionAll, rows)
