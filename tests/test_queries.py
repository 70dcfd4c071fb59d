import duckdb
import pytest

import __spark_entry__ as entry
from tools.compare import TABLES, rows_of

QUICK = [
    "attribute_filter", "pair_id", "drop_invalid", "number_casts", "consolidate_join",
    "drop_singletons", "split_by_key", "clean_html", "tokenize", "stem_porter", "common_terms",
    "label_13", "term_stats", "minhash", "projection", "jaccard_join", "jaccard_join_exact",
    "distance_join_exact", "binary_metrics", "naive_bayes", "match_by_jaccard",
    "jaccard_join_close", "jaccard_join_banded", "euclidean_join_close", "select_features",
    "select_features_f", "linear", "linear_coefficients", "isotonic_boundaries", "radius_join", "radius_join_cosine",
    "euclidean_join_planned", "radius_join_moved", "consolidate_join_split", "tree_split", "rf_class_split", "gbt_split", "importances_split", "logistic_equations",
    "ovr_equations", "pca_covariances", "empty_tables", "classify_naive_bayes_table", "rf_reg_split", "term_model", "tfidf_fields", "match_by_jaccard_joined", "match_by_euclidean", "ranked_orders", "dense_ids", "split_by_quota", "word_ppmi", "embed_with_table", "match_by_cosine",
]


@pytest.fixture(scope="module")
def db(data):
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{data}/{t}.parquet'")
    return c


def test_every_sql_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", QUICK)
def test_query_equals_sql(spark, data, db, name):
    df = entry.queries()[name](spark, data)
    cur = db.execute(entry.oracle_sql()[name])
    names = [c[0] for c in cur.description]
    assert sorted(names) == sorted(df.columns)
    got = rows_of(df.collect(), [df.columns.index(c) for c in sorted(names)])
    assert got and got == rows_of(cur.fetchall(), [names.index(c) for c in sorted(names)])


def test_entry(spark):
    got = entry.entry(spark).collect()
    assert len(got) == 1 and got[0]["TP"] > 0
