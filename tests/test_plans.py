import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfmatch.functions.vectors import bin_label
from shelfmatch.operators.features import fit_word2vec
from shelfmatch.plans import match
from shelfmatch.plans.classify import classification_frames, classify_relevance
from shelfmatch.plans.features import OVERLAP_FEATURES, overlap_features
from shelfmatch.plans.regress import regress_relevance, regression_frame
from workload import tables as wt


@pytest.fixture(scope="module")
def pairs(spark, data):
    return wt.pairs(spark, data).persist()


SHORT = [
    (1, "steel hammer 16 ounces", "hammer", "a heavy steel hammer", "acme", "3"),
    (2, "red paint 2 gallons", "the blue paint", "paint, red", "bold", "1.33"),
    (3, "garden hose 50 feet", "hammer", "a hose", "acme", "1"),
]
COLS = "pair_id bigint, product_title string, search_term string, product_description string, value string, relevance string"


def test_overlap_features(spark):
    got = {r.pair_id: r for r in overlap_features(spark.createDataFrame(SHORT, COLS)).collect()}
    one = got[1]
    assert (one.product_title_len, one.search_term_len, one.product_description_len) == (4, 1, 3)
    assert (one.common_words_ST, one.common_words_SD) == (1, 1)
    assert (one.ratio_desc_len_search_len, one.ratio_title_len_search_len) == (3.0, 4.0)
    assert (got[2].common_words_ST, got[2].relevance) == (1, 1.33)
    assert (got[3].common_words_ST, got[3].common_words_SD) == (0, 0)


def test_features_are_one_pass(spark, pairs):
    plan = overlap_features(pairs)._jdf.queryExecution().toString()
    assert "Exchange" not in plan.split("== Physical Plan ==")[1].split("InMemoryTableScan")[0]


def test_frames_do_not_depend_on_partitions(pairs):
    def rows(p):
        return [sorted(map(str, f.collect())) for f in classification_frames(p)]

    assert rows(pairs.repartition(1)) == rows(pairs.repartition(7))


def test_classification(pairs):
    got = {r.model: r for r in classify_relevance(pairs, params={"rf_class": {"num_trees": 10}}).collect()}
    assert set(got) == {"naive_bayes", "ovr", "rf_class"}
    for r in got.values():
        assert 0.5 < r.accuracy <= 1 and r.error == pytest.approx(1 - r.accuracy)


def test_regression(pairs):
    frame = regression_frame(pairs, size=10)
    assert frame.where(F.isnan("cosine_similarity") | F.col("cosine_similarity").isNull()).count() == 0
    got = {r.model: r.mse for r in regress_relevance(pairs, ["linear", "tree"], size=10).collect()}
    assert set(got) == {"linear", "tree"} and all(0 <= x < 2 for x in got.values())


def test_match_by_jaccard_modes(pairs):
    counted = match.term_pairs(pairs)
    every = match.jaccard_predictions(counted, rows_per_side=None, keep_unmatched=True).count()
    touching = match.jaccard_predictions(counted, rows_per_side=None).count()
    assert touching <= every <= pairs.count()
    ids = sorted(r.pair_id for r in match.jaccard_predictions(counted, rows_per_side=None, keep_unmatched=True).collect())
    top = match.jaccard_predictions(counted, rows_per_side=10, keep_unmatched=True).collect()
    assert {r.pair_id for r in top} <= set(ids[-10:])
    again = match.jaccard_predictions(counted.repartition(9), rows_per_side=10, keep_unmatched=True).collect()
    assert sorted(again) == sorted(top)


def test_match_by_cosine(spark):
    rows = [
        (1, "3", [1.0, 0.0], [1.0, 0.1]),
        (2, "1", [1.0, 0.0], [0.0, 1.0]),
        (3, "3", [0.0, 0.0], [0.0, 1.0]),
    ]
    df = spark.createDataFrame(rows, "pair_id int, relevance string, title_vector array<double>, query_vector array<double>")
    got = match.match_by_cosine(df.withColumn("relevance", F.col("relevance").cast("double"))).first()
    assert (got.TP, got.TN, got.FP, got.FN) == (1, 1, 0, 0) and got.f1 == 1.0


def test_match_words_by_cosine(spark):
    rows = [
        (1, "hammer steel", "hammer steel", "", "", "3"),
        (2, "paint red", "unheard words", "", "", "1"),
        (3, "steel hammer", "hammer", "", "", "3"),
    ]
    words = [(["hammer", "steel"],), (["steel", "hammer"],), (["paint", "red"],)]
    model = fit_word2vec(spark.createDataFrame(words * 20, "w array<string>"), "w", size=5)
    pairs = spark.createDataFrame(rows, COLS)
    got = match.match_words_by_cosine(pairs, t=-1.0, word2vec=model, stem=None).first()
    # the pair whose query has no known word has no cosine and drops
    assert (got.TP, got.TN, got.FP, got.FN) == (2, 0, 0, 0)
    # cosines of equal words are 1 up to rounding, those of one word out of two are less
    high = match.match_words_by_cosine(pairs, t=1 - 1e-9, word2vec=model, stem=None).first()
    assert (high.TP, high.FN) == (1, 1)


def test_term_pairs_are_count_vectors(pairs):
    """Against Spark ML's vocabulary and vectors of the same stems."""
    from pyspark.ml.functions import vector_to_array

    from shelfmatch.operators.features import count_vectors, fit_count_vectors

    words = match.stemmed_sides(pairs, [1.5])
    model = fit_count_vectors(words, "title")
    for f in ("title", "query"):
        words = count_vectors(words, f, model).withColumn(f"{f}_vector", vector_to_array("features")).drop("features")
    want = {}
    for r in words.collect():
        t, q = r.title_vector, r.query_vector
        n = (sum(x > 0 for x in t), sum(x > 0 for x in q), sum(x > 0 and y > 0 for x, y in zip(t, q)))
        if any(n):
            want[r.pair_id] = (*n, int(sum((x - y) ** 2 for x, y in zip(t, q))))
    counted = match.term_pairs(pairs)
    got = {r.pair_id: (r.n_title, r.n_query, r.n_both, r.square) for r in counted.collect()}
    assert got == want
    for cut in (5.0, 15.0):
        rows = match.euclidean_predictions(counted, cut).collect()
        assert {r.pair_id: r.prediction for r in rows} == {
            i: int(sq**0.5 <= cut) for i, (t, q, _, sq) in want.items() if t and q
        }


def test_match_by_jaccard_joined(pairs):
    """Pairs that the join finds, each judged as it is by itself."""
    counted = match.term_pairs(pairs)
    alone = {r.pair_id: r.prediction for r in match.jaccard_predictions(counted, keep_unmatched=False).collect()}
    found = match.joined_predictions(pairs, hashes=40).collect()
    assert {(r.pair_id, r.prediction) for r in found} <= set(alone.items()) and len(found) > 0.5 * len(alone)
    with pytest.raises(ValueError):
        match.match_by_jaccard(pairs, by="other")
