import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfmatch.operators import features as fe
from shelfmatch.operators import wordvectors as wv
from shelfmatch.sources import tables as so


@pytest.fixture(scope="module")
def lists():
    """Words of six topics, with null and empty lists, null and repeated words."""
    rng = random.Random(1)
    words = [f"w{i}" for i in range(60)]
    pick = lambda i: rng.choice(words[i % 6 * 10 : i % 6 * 10 + 14])
    out = [[pick(i) for _ in range(rng.randint(0, 60))] for i in range(300)]
    return out + [None, [], ["alone"], [None, "w1", "w2"], ["w3"] * 9]


@pytest.fixture(scope="module")
def docs(spark, lists):
    return spark.createDataFrame(list(enumerate(lists)), "id int, w array<string>")


@pytest.fixture(autouse=True)
def small_parts(monkeypatch):
    """So that a small vocabulary has many slices, blocks and parts of blocks."""
    for name, n in (("SLICE_WORDS", 16), ("GROUP_SLICES", 2), ("BLOCK_ENTRIES", 200), ("STEP_ENTRIES", 37)):
        monkeypatch.setattr(wv, name, n)


def counted(lists, window):
    n = {}
    for words in lists:
        words = [w for w in words or [] if w is not None]
        for i, a in enumerate(words):
            for j in range(max(0, i - window), min(len(words), i + window + 1)):
                if i != j:
                    n[a, words[j]] = n.get((a, words[j]), 0) + 1
    return n


def matrix(lists, window, shift=1.0):
    n = counted(lists, window)
    total, own = sum(n.values()), {}
    for (a, _), c in n.items():
        own[a] = own.get(a, 0) + c
    words = sorted(own)
    m = np.zeros((len(words), len(words)))
    for (a, b), c in n.items():
        m[words.index(a), words.index(b)] = max(0.0, math.log(c * total / (own[a] * own[b])) - math.log(shift))
    return words, m


def test_counts_and_ppmi(docs, lists):
    got = {(r.word, r.context): r.n for r in wv.cooccurrences(docs, "w", 3).collect()}
    assert got == counted(lists, 3)
    words, m = matrix(lists, 3, 1.5)
    rows = wv.ppmi(docs, "w", 3, shift=1.5).collect()
    assert {(r.word, r.context) for r in rows} == {(words[i], words[j]) for i, j in np.argwhere(m > 0)}
    assert all(abs(r.ppmi - m[words.index(r.word), words.index(r.context)]) < 1e-9 for r in rows)
    often = {r.word for r in wv.ppmi(docs, "w", 3, min_count=200).collect()}
    own = {w: sum(n for (a, _), n in counted(lists, 3).items() if a == w) for w in words}
    assert often <= {w for w in words if own[w] >= 200} and often


def test_hot_words(docs, lists, monkeypatch):
    monkeypatch.setattr(wv.hot_counts, "__defaults__", (5,))
    words, m = matrix(lists, 2)
    assert wv.ppmi(docs, "w", 2).count() == (m > 0).sum()


def test_vectors_are_the_leading_eigenvectors(docs, lists):
    words, m = matrix(lists, 3)
    value, turn = np.linalg.eigh(m)
    order = np.argsort(-np.abs(value))[:8]
    full = turn[:, order] * np.sqrt(np.abs(value[order]))
    got = {r.word: np.array(r.vector) for r in wv.word_vectors(docs, "w", 8, 3, iterations=20).collect()}
    assert sorted(got) == [w for i, w in enumerate(words) if m[i].any()]
    for i, w in enumerate(words):
        if w in got:
            assert np.abs(got[w]) == pytest.approx(np.abs(full[i]), abs=1e-5)
    # words of a topic are nearer to each other than to others
    cosine = lambda a, b: a @ b / np.linalg.norm(a) / np.linalg.norm(b)
    assert cosine(got["w5"], got["w6"]) > 0.5 > cosine(got["w5"], got["w35"])


def test_the_same_in_any_partitioning(spark, docs):
    made = []
    for parts, shuffles in ((1, 1), (4, 4), (16, 7)):
        before = spark.conf.get("spark.sql.shuffle.partitions")
        spark.conf.set("spark.sql.shuffle.partitions", shuffles)
        try:
            rows = wv.word_vectors(docs.repartition(parts), "w", 5).collect()
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", before)
        made.append(np.array([r.vector for r in sorted(rows)]))
    assert all(x == pytest.approx(made[0], abs=1e-6) for x in made[1:])


def test_small_corpora(spark):
    none = spark.createDataFrame([], "w array<string>")
    assert wv.word_vectors(none, "w", 4).count() == wv.cooccurrences(none, "w").count() == 0
    few = spark.createDataFrame([(["a", "b"],), (["c", "d"],)], "w array<string>")
    got = {r.word: r.vector for r in wv.word_vectors(few, "w", 6).collect()}
    assert sorted(got) == ["a", "b", "c", "d"] and all(len(v) == 6 for v in got.values())
    assert np.linalg.norm(np.array(got["a"]) - np.array(got["b"])) < 2 and np.isfinite(list(got.values())).all()


def test_embedding_of_several_fields(spark):
    vectors = spark.createDataFrame([("a", [1.0, 0.0]), ("b", [0.0, 2.0])], "word string, vector array<double>")
    rows = [(1, ["a", "b", "b", "x"], ["a"]), (2, [], ["x", "x"]), (3, None, ["b", "a"]), (4, ["x"], None)]
    df = spark.createDataFrame(rows, "id int, p array<string>, q array<string>")
    got = {r.id: (r.p_vector, r.q_vector) for r in fe.embed_fields_with_table(df, "id", ["p", "q"], vectors, 2).collect()}
    zero = [0.0, 0.0]
    assert got == {1: ([0.25, 1.0], [1.0, 0.0]), 2: (zero, zero), 3: (zero, [0.5, 1.0]), 4: (zero, zero)}
    assert fe.embed_fields_with_table(df, "id", ["p"], vectors.where(F.lit(False)), 2).count() == 4


def test_a_block_asks_once_for_the_vector_of_a_word(spark, monkeypatch):
    monkeypatch.setattr(fe, "BLOCK_WORDS", 2000)  # four blocks
    words = [f"w{i}" for i in range(40)]
    table = [(w, [float(i), None, 0.1 * i]) for i, w in enumerate(words)]
    table += [("w3", [1.0, 1.0, 1.0]), ("w4", None), (None, [9.0, 9.0, 9.0])]
    vectors = spark.createDataFrame(table, "word string, vector array<double>")
    rows = [(i % 90, words[i % 7 :] + [None, "x"]) for i in range(180)] + [(None, ["w1"]), (None, ["w2"])]
    made = fe.embed_with_table(spark.createDataFrame(rows, "id int, w array<string>"), "id", "w", vectors, 3)
    of = {w: np.array([x or 0.0 for x in v]) for w, v in table[:40]}
    of["w3"] = of["w3"] + 1.0
    want = {}
    for id_, w in rows:
        want[id_] = want.get(id_, 0) + sum(of.get(x, np.zeros(3)) for x in w) / len(w)
    got = {r.id: np.array(r.vector) for r in made.collect()}
    assert got.keys() == want.keys() and all(got[k] == pytest.approx(want[k]) for k in want)
    plan = made._jdf.queryExecution().optimizedPlan().toString()
    assert "FlatMapCoGroupsInArrow" in plan and "Aggregate [id" not in plan  # no vector is a row of a list


def test_pairs_of_words_move_in_one_order(docs, lists):
    plan = wv.cooccurrences(docs, "w", 3)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1  # and are not counted again when mirrored
    got = [(r.word, r.context, r.n) for r in wv.ppmi(docs, "w", 3, min_count=40).collect()]
    assert len(got) == len({(w, c) for w, c, _ in got}) and set(got) == {(c, w, n) for w, c, n in got}
    assert any(w == c for w, c, _ in got)


def test_word2vec_trains_in_parts_as_large_as_ever(spark, monkeypatch):
    seen = []
    plain = fe.Word2Vec
    monkeypatch.setattr(fe, "Word2Vec", lambda **given: seen.append(given["numPartitions"]) or plain(**given))
    df = spark.createDataFrame([([f"w{i % 9}", "b", f"w{i % 4}"],) for i in range(40)] + [([],)], "w array<string>")
    alone = fe.fit_word2vec(df, "w", size=4).getVectors().collect()
    monkeypatch.setattr(fe, "TRAINED_WORDS", 30)
    rows = fe.fit_word2vec(df, "w", size=4).getVectors().collect()
    fe.fit_word2vec(df, "w", size=4, partitions=2)
    assert seen == [1, 4, 2]  # of 120 words
    assert {r.word for r in rows} == {r.word for r in alone} == {f"w{i}" for i in range(9)} | {"b"}
    assert np.isfinite([r.vector.toArray() for r in rows]).all()


def test_a_block_asks_for_the_words_of_its_columns_alone(spark, monkeypatch):
    monkeypatch.setattr(wv, "BLOCK_ASKED", 10)
    df = spark.createDataFrame([([f"a{i}", f"b{i}", f"b{i + 1}"],) for i in range(40)], "w array<string>")
    entries = wv.ppmi(df, "w", 1).select("word", "context", "ppmi")
    vocabulary, stride = wv._vocabulary(entries)
    rows = wv._blocks(entries, vocabulary, stride).collect()
    group = {r.word: r.slice // 2 for r in vocabulary.collect()}
    pairs = entries.collect()
    assert len({(r.wgroup, r.part) for r in rows}) > len(set(group.values())) > 1
    assert sum(len(r.x) for r in rows) == 8 * len(pairs)
    asked = {(group[r.word], r.context) for r in pairs}
    assert sum(len(r.ask) for r in rows) == 4 * len(asked) < 4 * len(set(group.values())) * len(group)


def test_random_factors_are_drawn_where_they_are_used(docs, monkeypatch):
    plans, plain = [], wv._product
    seen = lambda df: plans.append(df._jdf.queryExecution().optimizedPlan().toString())
    monkeypatch.setattr(wv, "_product", lambda df, *a, **b: seen(df) or plain(df, *a, **b))
    assert wv.word_vectors(docs, "w", 4).count() > 0
    assert [p.count("Join") for p in plans] == [0, 0, 1, 0]  # factors with their image, and not with random ones


def test_few_columns_at_a_time_and_nothing_kept_that_is_not_read(docs, monkeypatch, tmp_path):
    whole = np.array([r.vector for r in sorted(wv.word_vectors(docs, "w", 5).collect())])
    steps, plain = [], wv._multiplied_columns
    monkeypatch.setattr(wv, "_multiplied_columns", lambda *a: steps.append(a[-2:]) or plain(*a))
    monkeypatch.setattr(wv, "MOVED_BYTES", 0)
    monkeypatch.setattr(so, "shared_folder", lambda spark: str(tmp_path))
    parts = wv.word_vectors(docs, "w", 5)
    assert len(set(steps)) > 1 and sum(b - a for a, b in set(steps)) == 15
    assert len(list(tmp_path.iterdir())) == 2  # the vocabulary and the factors
    assert np.array([r.vector for r in sorted(parts.collect())]) == pytest.approx(whole, abs=1e-9)
    with pytest.raises(ValueError):
        so.drop_kept(docs.sparkSession.read.parquet("/root/testdata/sf0.001/labels.parquet"))
