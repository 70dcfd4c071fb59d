import math
from collections import Counter

import numpy as np
import pytest
from pyspark.ml.feature import IDF, CountVectorizer, HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from shelfmatch.operators import features as fe
from shelfmatch.operators import relational as re_

DOCS = [(1, ["a", "b", "a"]), (2, ["b", "c"]), (3, ["b"]), (4, [])]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(DOCS, "id bigint, w array<string>")


def test_term_stats(docs):
    got = {r.term: (r.tf, r.df) for r in fe.term_stats(docs, "w").collect()}
    assert got == {"a": (2, 1), "b": (3, 3), "c": (1, 1)}


def test_tfidf_long(spark, docs):
    other = spark.createDataFrame([(9, ["a", "b", "x", "x"])], "id bigint, w array<string>")
    got = {r.term: (r.tf, r.weight) for r in fe.tfidf_long(other, "id", "w", docs, "w").collect()}
    want = {t: (n, n * math.log(5 / (df + 1))) for t, n, df in (("a", 1, 1), ("b", 1, 3), ("x", 2, 0))}
    assert {t: n for t, (n, _) in got.items()} == {t: n for t, (n, _) in want.items()}
    assert all(got[t][1] == pytest.approx(want[t][1]) for t in want)


def test_tfidf_long_same_as_ml(docs):
    cv = CountVectorizer(inputCol="w", outputCol="tf").fit(docs)
    ml = IDF(inputCol="tf", outputCol="x").fit(cv.transform(docs)).transform(cv.transform(docs))
    want = {}
    for r in ml.collect():
        want.update({(r.id, cv.vocabulary[i]): v for i, v in zip(r.x.indices, r.x.values)})
    got = {(r.id, r.term): r.weight for r in fe.tfidf_long(docs, "id", "w", docs, "w").collect()}
    assert got == pytest.approx({k: v for k, v in want.items()})


def test_count_vectors(docs):
    long = fe.count_vectors_long(docs, "id", "w", docs, "w", 2)
    assert {tuple(r) for r in long.collect()} == {(1, "b", 1), (2, "b", 1), (3, "b", 1)}
    model = fe.fit_count_vectors(docs, "w", min_df=1)
    kept = re_.non_empty_vectors(fe.count_vectors(docs, "w", model), "features")
    assert {r.id for r in kept.collect()} == {1, 2, 3}
    for r in kept.collect():
        words = {model.vocabulary[i]: int(v) for i, v in zip(r.features.indices, r.features.values)}
        assert words == Counter(dict(DOCS)[r.id])


def test_hashed_tf(docs):
    tf = HashingTF(numFeatures=10000)
    for r in fe.hashed_tf(docs, "w").collect():
        assert r.tf.size == 10000
        want = Counter(tf.indexOf(w) for w in r.w)
        assert dict(zip(map(int, r.tf.indices), map(int, r.tf.values))) == want


def test_word_vectors(spark, docs):
    model = fe.fit_word2vec(docs, "w", size=8, seed=3)
    table = model.getVectors().select("word", vector_to_array("vector").alias("vector"))
    asked = spark.createDataFrame(
        [(1, ["a", "b", "zz", "a"]), (2, ["zz"]), (3, [])], "id bigint, w array<string>"
    )
    ml = {r.id: r.v.toArray() for r in fe.embed_tokens(asked, "w", model, "v").collect()}
    own = {r.id: np.array(r.vector) for r in fe.embed_with_table(asked, "id", "w", table, 8).collect()}
    assert set(own) == {1, 2, 3}
    for i in own:
        assert own[i] == pytest.approx(ml[i], abs=1e-6)
    assert not ml[2].any() and not ml[3].any()


def features(spark, n=80, seed=0):
    r = np.random.default_rng(seed)
    x = r.normal(size=(n, 4)) @ r.normal(size=(4, 4))
    rows = [(i, *map(float, v), float(r.integers(0, 3))) for i, v in enumerate(x)]
    df = spark.createDataFrame(rows, "id bigint, a double, b double, c double, d double, y double")
    return x, fe.assemble(df, ["a", "b", "c", "d"])


def test_normalize(spark):
    _, df = features(spark)
    for p, size in ((math.inf, lambda v: np.abs(v).max()), (1.0, lambda v: np.abs(v).sum())):
        for r in fe.normalize(df, p).collect():
            assert size(r.norm_features.toArray()) == pytest.approx(1.0)
    both = fe.normalize(df).select(
        vector_to_array("norm_features").alias("m"), fe.normalize_array(vector_to_array("features")).alias("n")
    )
    assert all(r.m == pytest.approx(r.n) for r in both.collect())
    zero = spark.createDataFrame([([0.0, 0.0],)], "v array<double>")
    assert zero.select(fe.normalize_array("v")).first()[0] == [0.0, 0.0]


def test_pca(spark):
    x, df = features(spark)
    model = fe.fit_pca(df, 3)
    basis = model.pc.toArray()
    assert basis.T @ basis == pytest.approx(np.eye(3), abs=1e-9)
    _, _, want = np.linalg.svd(x - x.mean(axis=0))
    assert np.abs(basis.T @ want[:3].T) == pytest.approx(np.eye(3), abs=1e-6)
    got = np.array([r.pca_features.toArray() for r in fe.pca_transform(model, df).orderBy("id").collect()])
    assert got == pytest.approx(x @ basis)


def test_chi2(spark):
    r = np.random.default_rng(1)
    rows = [(float(i % 3), float(r.integers(0, 4)), float(r.integers(0, 2))) for i in range(200)]
    df = spark.createDataFrame(rows, "y double, a double, b double")
    got = {x.feature: (x.statistic, x.dof) for x in fe.chi2_scores(df, ["a", "b"], "y").collect()}
    ml = fe.chi2_test(fe.assemble(df, ["a", "b"]), "features", "y").collect()
    for x in ml:
        statistic, dof = got["ab"[x.featureIndex]]
        assert statistic == pytest.approx(x.statistic) and dof == x.degreesOfFreedom


@pytest.mark.parametrize("method", ["chi2", "f"])
def test_select_features(spark, method):
    r = np.random.default_rng(2)
    rows = [
        (float(i % 3), float(r.integers(0, 4)), float(i % 3 + (i % 10 == 0)), float(r.integers(0, 2)))
        for i in range(150)
    ]
    df = fe.assemble(spark.createDataFrame(rows, "y double, a double, b double, c double"), ["a", "b", "c"])
    model = fe.select_features(df, 1, "y", method=method)
    got = model.transform(df).select(vector_to_array("selected_features").alias("v"), "b")
    assert got.where("size(v) != 1 or v[0] != b").count() == 0


def test_select_features_takes_any_number_of_values(spark):
    df = spark.range(20_000).select(
        (F.col("id") % 2).cast("double").alias("y"),
        F.col("id").cast("double").alias("a"),
        (F.col("id") % 2).cast("double").alias("b"),
        F.lit(1.0).alias("c"),
    )
    df = fe.assemble(df, ["a", "b", "c"])
    assert fe.select_features(df, 1, "y").getIndices() == [1]
    assert fe.select_features(df, 2, "y").getIndices() == [0, 1]


def test_word_vectors_do_not_follow_from_the_partitioning(spark):
    docs = spark.createDataFrame(
        [([f"w{(i * j) % 17}" for j in range(1, 9)],) for i in range(200)], "w array<string>"
    )
    before, seen = spark.conf.get("spark.sql.shuffle.partitions"), []
    try:
        for n in (1, 4, 16):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            model = fe.fit_word2vec(docs.repartition(n), "w", size=4)
            seen.append(sorted((r.word, tuple(r.vector)) for r in model.getVectors().collect()))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert seen[0] == seen[1] == seen[2]
