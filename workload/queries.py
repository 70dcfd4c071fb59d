"""Every operator run over the given tables: name -> function of (spark, folder).

Whole numbers are cast to bigint and doubles rounded to six places, so that results can be compared
with the SQL in ``oracles``. Lists are given as rows or as text joined by "|".
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.ml.feature import CountVectorizerModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmatch.functions import fixed_values as fixed
from shelfmatch.functions import text as tx
from shelfmatch.functions.hashing import minhash_signature, projection_buckets, term_id
from shelfmatch.functions.stemming import stem_tokens
from shelfmatch.functions.vectors import (
    bin_label,
    cosine,
    euclidean,
    jaccard_distance,
    threshold,
)
from shelfmatch.operators import buckets as bu
from shelfmatch.operators import features as fe
from shelfmatch.operators import hotkeys as hk
from shelfmatch.operators import metrics as me
from shelfmatch.operators import models as mo
from shelfmatch.operators import order as od
from shelfmatch.operators import radius as ra
from shelfmatch.operators import relational as re_
from shelfmatch.operators import simjoin as sj
from shelfmatch.operators import termmodels as tm
from shelfmatch.operators import wordvectors as wv
from shelfmatch.plans import match
from shelfmatch.plans.classify import classification_frames, classify_relevance, pca_frames
from shelfmatch.plans.features import OVERLAP_FEATURES, overlap_features, words_of
from shelfmatch.plans.regress import regress_relevance
from shelfmatch.sources import tables as so
from workload import tables as wt

REGISTRY: dict = {}


def query(f):
    REGISTRY[f.__name__] = f
    return f


def big(c: Column | str, name: str) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("bigint").alias(name)


def r6(c: Column | str, name: str) -> Column:
    return F.round((F.col(c) if isinstance(c, str) else c).cast("double"), 6).alias(name)


def bar(c: Column | str, name: str) -> Column:
    return F.array_join(F.col(c) if isinstance(c, str) else c, "|").alias(name)


def scratch(spark: SparkSession) -> str:
    return f"{so.shared_folder(spark)}/run-{uuid.uuid4().hex}"


def docs(spark, d) -> DataFrame:
    return wt.documents(spark, d).select("doc_id", "text")


def doc_words(spark, d) -> DataFrame:
    return docs(spark, d).select("doc_id", tx.remove_stopwords(tx.tokenize("text")).alias("words"))


def kept_doc_words(spark, d) -> DataFrame:
    """For operators that read the words more than once."""
    return so.cut_lineage(doc_words(spark, d))


def passage_words(spark, d) -> DataFrame:
    return so.read_table(spark, d, "benchmark").select(
        F.col("item_id").alias("doc_id"), tx.remove_stopwords(tx.tokenize("text")).alias("words")
    )


def pair_words(spark, d, stem=None) -> DataFrame:
    return words_of(wt.pairs(spark, d), ["title", "query", "desc"], "bare", stem)


# --- sources and sinks ---------------------------------------------------------------------------


@query
def csv_scan(spark, d):
    folder = scratch(spark)
    tables = {
        "train.csv": wt.rated(spark, d),
        "product_descriptions.csv": wt.descriptions(spark, d),
        "attributes.csv": wt.attributes(spark, d),
    }
    for name, df in tables.items():
        df.write.options(
            header=True, escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False
        ).csv(f"{folder}/{name}")
    columns = {name: df.columns for name, df in tables.items()}
    train, descriptions, attributes = so.read_relevance_csv(spark, folder, columns, multi_line=True)
    return hk.consolidate(
        train, descriptions, re_.pick_attribute(attributes, "brand"), ["search_term"]
    ).select(
        "product_uid",
        F.md5("product_title").alias("title_md5"),
        F.md5("search_term").alias("query_md5"),
        F.md5("product_description").alias("desc_md5"),
        "value",
        "relevance",
    )


@query
def parquet_round_trip(spark, d):
    written = so.materialize(wt.rated(spark, d), scratch(spark))
    return written.select(
        "product_uid", F.md5("product_title").alias("title_md5"), "search_term", "relevance"
    )


@query
def model_round_trip(spark, d):
    words = kept_doc_words(spark, d)
    path = scratch(spark)
    so.save_model(fe.fit_count_vectors(words, "words"), path)
    counted = fe.count_vectors(words, "words", so.load_model(CountVectorizerModel, path))
    plain = F.unwrap_udt(F.col("features"))
    return counted.select(
        "doc_id",
        big(F.size(plain["indices"]), "n_terms"),
        big(F.aggregate(plain["values"], F.lit(0.0), lambda a, x: a + x), "n_words"),
    )


# --- projection, filter, keys --------------------------------------------------------------------


@query
def attribute_filter(spark, d):
    return re_.pick_attribute(wt.attributes(spark, d), "brand")


@query
def prefix_columns(spark, d):
    return re_.prefix_columns(so.read_table(spark, d, "part"), "title_", ["p_partkey"]).select(
        "p_partkey", "title_p_name", "title_p_brand", big("title_p_size", "title_p_size")
    )


@query
def pair_id(spark, d):
    keys = ["l_orderkey", "l_linenumber", "l_partkey"]
    lines = so.read_table(spark, d, "lineitem").select(*keys)
    return re_.with_pair_id(lines, keys).select("pair_id", "l_orderkey", "l_partkey")


@query
def unpivot_fields(spark, d):
    return re_.unpivot_fields(wt.pairs(spark, d), re_.TEXT_FIELDS, ["pair_id"])


@query
def pivot_fields(spark, d):
    long = re_.unpivot_fields(wt.pairs(spark, d), re_.TEXT_FIELDS, ["pair_id"])
    return re_.pivot_fields(long, re_.TEXT_FIELDS, ["pair_id"])


@query
def drop_invalid(spark, d):
    ratio = F.try_divide("l_discount", "l_tax")
    lines = so.read_table(spark, d, "lineitem").select("l_orderkey", "l_partkey", ratio.alias("ratio"))
    return re_.drop_invalid(lines).select("l_orderkey", "l_partkey", r6("ratio", "ratio"))


@query
def non_empty_vectors(spark, d):
    words = kept_doc_words(spark, d)
    model = fe.fit_count_vectors(words, "words", min_df=5)
    passages = fe.count_vectors(passage_words(spark, d).unionAll(words), "words", model)
    return re_.non_empty_vectors(passages, "features").select(
        "doc_id", big(F.size(fe.vector_terms("features")), "n_terms")
    )


@query
def number_casts(spark, d):
    given = wt.ratings(spark, d).select("o_orderkey", "relevance")
    named = so.read_table(spark, d, "part").select("p_partkey", F.col("p_brand").alias("relevance"))
    both = given.unionAll(named)
    number = tx.to_double("relevance")
    return both.select(
        F.col("o_orderkey").alias("id"), "relevance", number.alias("number"),
        big(tx.to_int(number), "whole"),
    )


# --- joins ---------------------------------------------------------------------------------------


@query
def consolidate_join(spark, d):
    lines = so.read_table(spark, d, "lineitem").select(
        F.col("l_partkey").alias("product_uid"), "l_orderkey", "l_linenumber"
    )
    names = so.read_table(spark, d, "part").select(
        F.col("p_partkey").alias("product_uid"), F.col("p_name").alias("product_description")
    )
    brands = re_.pick_attribute(wt.attributes(spark, d), "brand")
    return hk.consolidate(lines, names, brands, ["l_orderkey", "l_linenumber"]).select(
        "product_uid", "l_orderkey", big("l_linenumber", "l_linenumber"), "product_description",
        "value",
    )


@query
def consolidate_join_split(spark, d):
    """``consolidate_join`` with so few rows to a task that most products are cut into a grid."""
    lines = so.read_table(spark, d, "lineitem").select(
        F.col("l_partkey").alias("product_uid"), "l_orderkey", "l_linenumber"
    )
    names = so.read_table(spark, d, "part").select(
        F.col("p_partkey").alias("product_uid"), F.col("p_name").alias("product_description")
    )
    both = wt.attributes(spark, d).select("product_uid", "value")  # brand and type, so two a product
    return hk.consolidate(lines, names, both, ["l_orderkey", "l_linenumber"], hot_rows=1).select(
        "product_uid", "l_orderkey", big("l_linenumber", "l_linenumber"), "product_description", "value"
    )


@query
def rated_pairs(spark, d):
    return wt.pairs(spark, d)


@query
def jaccard_own_pairs(spark, d):
    w = so.cut_lineage(pair_words(spark, d))
    titles, queries = (w.select("pair_id", F.col(f).alias("words")) for f in ("title", "query"))
    return sj.jaccard_join(titles, queries, "pair_id", "words", 0.99, paired_only=True).select(
        "id_a", "id_b", r6("distance", "distance")
    )


@query
def jaccard_join(spark, d):
    return sj.jaccard_join(
        kept_doc_words(spark, d), passage_words(spark, d), "doc_id", "words", 0.95
    ).select("id_a", "id_b", r6("distance", "distance"))


@query
def jaccard_join_exact(spark, d):
    return sj.jaccard_join_exact(
        kept_doc_words(spark, d), passage_words(spark, d), "doc_id", "words", 0.95
    ).select("id_a", "id_b", r6("distance", "distance"))


@query
def jaccard_join_close(spark, d):
    """Documents against documents at a distance for which prefixes filter."""
    words = doc_words(spark, d)  # the join keeps what it reads more than once
    return sj.jaccard_join_exact(words, words, "doc_id", "words", 0.3).select(
        "id_a", "id_b", r6("distance", "distance")
    )


@query
def jaccard_join_banded(spark, d):
    words = doc_words(spark, d)
    return sj.jaccard_join(words, words, "doc_id", "words", 0.3, hashes=10, bands=5).select(
        "id_a", "id_b", r6("distance", "distance")
    )


@query
def euclidean_join_close(spark, d):
    """Vectors against vectors, by buckets short enough to tell most pairs apart."""
    e = so.read_table(spark, d, "embeddings")
    return sj.euclidean_join(
        e, e, "vec_id", "embedding", wt.DIM, 1.2, bucket_length=0.125, tables=8, per_table=4
    ).select("id_a", "id_b", r6("distance", "distance"))


@query
def euclidean_join_planned(spark, d):
    """Vectors against moved ones, by buckets planned for a recall of 0.9."""
    return bu.planned_join(
        so.read_table(spark, d, "embeddings"), wt.moved_vectors(spark, d), "vec_id", "embedding",
        wt.DIM, wt.NEAR, plan=wt.near_plan(),
    ).select("id_a", "id_b", r6("distance", "distance"))


@query
def radius_join_moved(spark, d):
    """All pairs that ``euclidean_join_planned`` looks for."""
    return ra.radius_join(
        so.read_table(spark, d, "embeddings"), wt.moved_vectors(spark, d), "vec_id", "embedding",
        wt.DIM, wt.NEAR,
    ).select("id_a", "id_b", r6("distance", "distance"))


@query
def euclidean_own_pairs(spark, d):
    v = wt.vector_pairs(spark, d)
    titles, queries = (
        v.select("pair_id", F.col(f"{f}_vector").alias("vector")) for f in ("title", "query")
    )
    return sj.euclidean_join(
        titles, queries, "pair_id", "vector", wt.DIM, 1.4, paired_only=True
    ).select("id_a", "id_b", r6("distance", "distance"))


@query
def euclidean_join(spark, d):
    return sj.euclidean_join(
        so.read_table(spark, d, "embeddings"), wt.label_centres(spark, d), "vec_id", "embedding",
        wt.DIM, threshold=1000.0, bucket_length=2.0, tables=3,
    ).select("id_a", "id_b", r6("distance", "distance"))


@query
def distance_join_exact(spark, d):
    return sj.distance_join_exact(
        so.read_table(spark, d, "embeddings"), wt.label_centres(spark, d), "vec_id", "embedding",
        wt.DIM, 0.99,
    ).select("id_a", "id_b", r6("distance", "distance"))


@query
def cosine_join_exact(spark, d):
    return sj.distance_join_exact(
        so.read_table(spark, d, "embeddings"), wt.label_centres(spark, d), "vec_id", "embedding",
        wt.DIM, 0.85, metric="cosine",
    ).select("id_a", "id_b", r6("distance", "distance"))


@query
def radius_join(spark, d):
    """Vectors against vectors at a radius that few pairs lie within."""
    e = so.read_table(spark, d, "embeddings")
    return ra.radius_join(e, e, "vec_id", "embedding", wt.DIM, 1.05, pivots=16).select(
        "id_a", "id_b", r6("distance", "distance")
    )


@query
def radius_join_cosine(spark, d):
    """Vectors against the mean vectors of their labels, pivots as planned."""
    return ra.radius_join(
        so.read_table(spark, d, "embeddings"), wt.label_centres(spark, d), "vec_id", "embedding",
        wt.DIM, 0.85, metric="cosine",
    ).select("id_a", "id_b", r6("distance", "distance"))


@query
def drop_singletons(spark, d):
    lines = so.read_table(spark, d, "lineitem").select(
        "l_orderkey", big("l_linenumber", "l_linenumber"), "l_partkey", "l_suppkey"
    )
    return re_.drop_singletons(lines, ["l_orderkey", "l_linenumber"], ["l_partkey", "l_suppkey"])


@query
def dedupe_pairs(spark, d):
    keys = ["l_orderkey", "l_partkey"]
    return re_.dedupe_pairs(so.read_table(spark, d, "lineitem").select(*keys), keys)


# --- aggregation, order, split -------------------------------------------------------------------


@query
def term_stats(spark, d):
    return fe.term_stats(doc_words(spark, d), "words")


@query
def rank_pairs(spark, d):
    w = pair_words(spark, d)
    score = w.select("pair_id", r6(jaccard_distance("title", "query"), "score"))
    return re_.rank_pairs(score, "score", ["pair_id"])


@query
def top_k(spark, d):
    parts = so.read_table(spark, d, "part").select("p_partkey", "p_name")
    return re_.top_k(parts, [F.desc("p_partkey")], 500)


@query
def ranked_orders(spark, d):
    """All orders by price, the dearest first, with their rank."""
    orders = so.read_table(spark, d, "orders").select("o_orderkey", "o_totalprice")
    return od.with_rank(orders, [F.desc("o_totalprice"), F.asc("o_orderkey")]).select(
        "o_orderkey", big("rank", "rank")
    )


@query
def dense_ids(spark, d):
    lines = so.read_table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    return od.with_dense_id(lines, ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]).select(
        "l_orderkey", big("l_linenumber", "l_linenumber"), "l_partkey", "l_suppkey", big("row_id", "row_id")
    )


@query
def split_by_quota(spark, d):
    """60 and 40 of each class of orders, to the row."""
    orders = so.read_table(spark, d, "orders").select("o_orderkey", "o_orderstatus")
    first, second = od.split_by_quota(orders, "o_orderkey", "o_orderstatus", [0.6, 0.4], 42)
    return first.withColumn("part", F.lit("train")).unionAll(second.withColumn("part", F.lit("test")))


@query
def split_by_key(spark, d):
    lines = so.read_table(spark, d, "orders").select("o_orderkey")
    first, second = re_.split_by_key(lines, "o_orderkey", [0.6, 0.4], 42)
    return first.withColumn("part", F.lit("train")).unionAll(
        second.withColumn("part", F.lit("test"))
    )


# --- text ----------------------------------------------------------------------------------------


@query
def lower_all(spark, d):
    return tx.lower_all(docs(spark, d), ["text"])


@query
def strip_punct(spark, d):
    return docs(spark, d).select("doc_id", tx.strip_punct("text").alias("text"))


@query
def strip_html(spark, d):
    pages = wt.pages(spark, d)
    return pages.select("page_id", tx.strip_html_remnants("html").alias("text"))


@query
def units_dotted(spark, d):
    return docs(spark, d).select("doc_id", tx.normalize_units(F.lower("text"), "dotted").alias("text"))


@query
def units_bare(spark, d):
    return docs(spark, d).select("doc_id", tx.normalize_units(F.lower("text"), "bare").alias("text"))


@query
def clean_text(spark, d):
    return tx.clean_text(tx.lower_all(docs(spark, d), ["text"]), ["text"], "dotted")


@query
def clean_html(spark, d):
    pages = wt.pages(spark, d).select("page_id", F.lower("html").alias("text"))
    return pages.select(
        "page_id",
        tx.clean("text", "bare").alias("text"),
        tx.clean("text", "bare", "html_first").alias("html_first"),
    )


@query
def tokenize(spark, d):
    words = docs(spark, d).select("doc_id", tx.tokenize("text").alias("words"))
    return words.select("doc_id", bar("words", "words"), big(F.size("words"), "n_words"))


@query
def remove_stopwords(spark, d):
    return doc_words(spark, d).select("doc_id", bar("words", "words"), big(F.size("words"), "n_words"))


@query
def join_tokens(spark, d):
    return doc_words(spark, d).select("doc_id", tx.join_tokens("words").alias("text"))


@query
def ngrams(spark, d):
    two = doc_words(spark, d).select("doc_id", tx.ngrams("words", 2).alias("grams"))
    return two.select("doc_id", bar("grams", "grams"), big(F.size("grams"), "n_grams"))


@query
def stem_rules(spark, d):
    return doc_words(spark, d).select("doc_id", bar(stem_tokens("words", "plural"), "stems"))


@query
def stem_porter(spark, d):
    return doc_words(spark, d).select("doc_id", bar(stem_tokens("words", "porter"), "stems"))


@query
def token_len(spark, d):
    return docs(spark, d).select("doc_id", big(tx.token_len("text"), "n_parts"))


@query
def len_ratio(spark, d):
    w = pair_words(spark, d)
    return w.select(
        "pair_id",
        r6(tx.len_ratio(tx.token_count("desc"), tx.token_count("query")), "desc_query"),
        r6(tx.len_ratio(tx.token_count("title"), tx.token_count("query")), "title_query"),
    )


@query
def common_terms(spark, d):
    w = pair_words(spark, d)
    return w.select(
        "pair_id",
        big(tx.common_terms("query", "title"), "query_title"),
        big(tx.common_terms("query", "desc"), "query_desc"),
        big(tx.common_terms("title", "desc"), "title_desc"),
    )


@query
def phrase_hits(spark, d):
    fields = ["search_term", "product_title", "product_description"]
    cleaned = tx.clean_text(tx.lower_all(wt.pairs(spark, d), fields), fields, "bare")
    return cleaned.select("pair_id", big(tx.phrase_hits(*fields), "hits"))


@query
def overlap_feature_frame(spark, d):
    f = overlap_features(wt.pairs(spark, d))
    return f.select("pair_id", "relevance", *[r6(c, c) for c in OVERLAP_FEATURES])


# --- scores, thresholds, labels ------------------------------------------------------------------


@query
def cosine_similarity(spark, d):
    v = wt.vector_pairs(spark, d)
    return v.select("pair_id", r6(cosine("title_vector", "query_vector"), "cosine"))


@query
def euclidean_distance(spark, d):
    v = wt.vector_pairs(spark, d)
    return v.select("pair_id", r6(euclidean("title_vector", "query_vector"), "euclidean"))


@query
def jaccard(spark, d):
    w = pair_words(spark, d)
    return w.select("pair_id", r6(jaccard_distance("title", "query"), "distance"))


@query
def threshold_cosine(spark, d):
    v = wt.vector_pairs(spark, d)
    score = cosine("title_vector", "query_vector")
    return v.select("pair_id", big(threshold(score, 0.1), "prediction"))


@query
def threshold_jaccard(spark, d):
    w = pair_words(spark, d)
    score = jaccard_distance("title", "query")
    return w.select("pair_id", big(threshold(score, 0.95, "at_most"), "prediction"))


@query
def threshold_euclid(spark, d):
    v = wt.vector_pairs(spark, d)
    score = euclidean("title_vector", "query_vector")
    return v.select("pair_id", big(threshold(score, 1.4, "at_most"), "prediction"))


def _classes(spark, d, **cuts):
    number = wt.ratings(spark, d).select("o_orderkey", tx.to_double("relevance").alias("r"))
    return number.select("o_orderkey", *[bin_label("r", c).alias(n) for n, c in cuts.items()])


@query
def label_2(spark, d):
    return _classes(
        spark, d, low=fixed.CUTS_BINARY_LOW, mid=fixed.CUTS_BINARY_MID, high=fixed.CUTS_BINARY_HIGH
    )


@query
def label_3(spark, d):
    return _classes(spark, d, label=fixed.CUTS_3)


@query
def label_4(spark, d):
    return _classes(spark, d, label=fixed.CUTS_4)


@query
def label_13(spark, d):
    return _classes(spark, d, label=fixed.CUTS_13)


# --- text to vectors -----------------------------------------------------------------------------


@query
def hashed_tf(spark, d):
    counted = fe.hashed_tf(doc_words(spark, d), "words", "tf", 10000)
    plain = F.unwrap_udt(F.col("tf"))
    return counted.select(
        "doc_id",
        big(plain["size"], "n_buckets"),
        big(F.aggregate(plain["values"], F.lit(0.0), lambda a, x: a + x), "n_words"),
    )


@query
def tfidf_hashed(spark, d):
    counted = fe.hashed_tf(kept_doc_words(spark, d), "words", "tf", 10000)
    plain = F.unwrap_udt(F.col("tfidf"))
    weighted = fe.fit_idf(counted).transform(counted)
    return weighted.select("doc_id", F.explode(F.arrays_zip(plain["indices"], plain["values"]))).select(
        "doc_id", F.col("col.indices").alias("bucket"), r6("col.values", "weight")
    )


@query
def tfidf_long(spark, d):
    w = so.cut_lineage(pair_words(spark, d))
    return fe.tfidf_long(w, "pair_id", "desc", w, "title").select(
        "pair_id", "term", "tf", r6("weight", "weight")
    )


@query
def count_vectors_long(spark, d):
    w = so.cut_lineage(pair_words(spark, d))
    return fe.count_vectors_long(w, "pair_id", "query", w, "title", 5)


@query
def count_vectors(spark, d):
    w = so.cut_lineage(pair_words(spark, d))
    model = fe.fit_count_vectors(w, "title", min_df=5)
    plain = F.unwrap_udt(F.col("features"))
    return fe.count_vectors(w, "title", model).select(
        "pair_id",
        big(F.size(plain["indices"]), "n_terms"),
        big(F.aggregate(plain["values"], F.lit(0.0), lambda a, x: a + x), "n_words"),
    )


@query
def word2vec(spark, d):
    words = so.cut_lineage(pair_words(spark, d, "porter"))
    vectors = fe.fit_word2vec(words, "title").getVectors()
    return vectors.select("word", r6(F.get(vector_to_array("vector"), F.lit(0)), "first"))


@query
def word2vec_words(spark, d):
    """Which words have a vector, and of what length."""
    words = so.cut_lineage(pair_words(spark, d, "porter"))
    vectors = fe.fit_word2vec(words, "title").getVectors()
    return vectors.select("word", big(F.size(vector_to_array("vector")), "size"))


@query
def term_model(spark, d):
    """A vocabulary written in buckets, loaded as another table and joined: each term of each document."""
    words, path, name = kept_doc_words(spark, d), scratch(spark), f"terms_{uuid.uuid4().hex}"
    tm.save_term_table(tm.vocabulary(words, "words"), name, path)
    model = tm.load_term_table(spark, f"{name}_again", path)
    found = tm.join_model(tm.field_terms(words, "doc_id", ["words"]), model)
    return found.select("doc_id", "term", big("n", "n"), big("tf", "tf"), big("df", "df"))


@query
def tfidf_fields(spark, d):
    """One IDF, fitted on the titles, applied to three fields."""
    words = so.cut_lineage(pair_words(spark, d))
    return tm.tfidf_fields(
        words, "pair_id", ["title", "query", "desc"], fe.term_stats(words, "title"), words.count()
    ).select("pair_id", "field", "term", big("tf", "tf"), r6("weight", "weight"))


@query
def word_ppmi(spark, d):
    """Words of the titles that stand near each other more often than chance."""
    words = so.cut_lineage(pair_words(spark, d).select("title"))
    return wv.ppmi(words, "title", window=2, min_count=5).select(
        "word", "context", big("n", "n"), r6("ppmi", "ppmi")
    )


@query
def learnt_word_vectors(spark, d):
    """Vectors learnt from the titles: of each word their number of places and squared length."""
    words = so.cut_lineage(pair_words(spark, d).select("title"))
    vectors = wv.word_vectors(words, "title", size=50)
    return vectors.select(
        "word", big(F.size("vector"), "n"),
        r6(F.aggregate("vector", F.lit(0.0), lambda a, x: a + x * x), "square"),
    )


@query
def embed_tokens(spark, d):
    words = so.cut_lineage(pair_words(spark, d, "porter"))
    model = fe.fit_word2vec(words, "title")
    embedded = fe.embed_tokens(words, "query", model, "vector")
    return embedded.select("pair_id", F.posexplode(vector_to_array("vector")).alias("pos", "x"))


def word_vectors(spark, d, words: DataFrame) -> DataFrame:
    """An embedding for every distinct word, dealt out by the word's number."""
    e = so.read_table(spark, d, "embeddings")
    n = e.agg(F.count("*")).scalar()
    return (
        words.select(F.explode("words").alias("word")).distinct()
        .withColumn("vec_id", term_id(F.col("word")) % n)
        .join(e.select("vec_id", F.col("embedding").alias("vector")), "vec_id")
        .select("word", "vector")
    )


@query
def embed_with_table(spark, d):
    words = kept_doc_words(spark, d)
    embedded = fe.embed_with_table(words, "doc_id", "words", word_vectors(spark, d, words), wt.DIM)
    return embedded.select("doc_id", F.posexplode("vector").alias("pos", "x")).select(
        "doc_id", big("pos", "pos"), r6("x", "x")
    )


@query
def minhash(spark, d):
    return doc_words(spark, d).select("doc_id", bar(minhash_signature("words", 5), "signature"))


@query
def projection(spark, d):
    e = so.read_table(spark, d, "embeddings")
    buckets = projection_buckets("embedding", wt.DIM, 3, 0.25)
    return e.select("vec_id", bar(buckets, "buckets"))


# --- assembly, scaling, selection ----------------------------------------------------------------


@query
def assemble(spark, d):
    f = fe.assemble(overlap_features(wt.pairs(spark, d)), OVERLAP_FEATURES)
    return f.select("pair_id", F.posexplode(vector_to_array("features")).alias("pos", "x")).select(
        "pair_id", big("pos", "pos"), r6("x", "x")
    )


@query
def normalize(spark, d):
    f = fe.normalize(fe.assemble(overlap_features(wt.pairs(spark, d)), OVERLAP_FEATURES))
    return f.select("pair_id", F.posexplode(vector_to_array("norm_features")).alias("pos", "x")).select(
        "pair_id", big("pos", "pos"), r6("x", "x")
    )


@query
def normalize_l1(spark, d):
    f = fe.normalize(fe.assemble(overlap_features(wt.pairs(spark, d)), OVERLAP_FEATURES), 1.0)
    return f.select("pair_id", F.posexplode(vector_to_array("norm_features")).alias("pos", "x")).select(
        "pair_id", big("pos", "pos"), r6("x", "x")
    )


@query
def pca(spark, d):
    train_df, test_df = pca_frames(*classification_frames(wt.pairs(spark, d)))
    both = train_df.unionAll(test_df)
    return both.select("pair_id", F.posexplode(vector_to_array("features")).alias("pos", "x"))


@query
def chi2_scores(spark, d):
    f = so.cut_lineage(overlap_features(wt.pairs(spark, d)))
    return fe.chi2_scores(f, OVERLAP_FEATURES, "relevance").select(
        "feature", r6("statistic", "statistic"), "dof"
    )


@query
def select_features(spark, d):
    return _selected(_scalar_frame(spark, d), "chi2")


@query
def select_features_f(spark, d):
    return _selected(_scalar_frame(spark, d), "f")


def _selected(f: DataFrame, method: str) -> DataFrame:
    selected = fe.select_features(f, 5, "relevance", method=method).transform(f)
    return selected.select(
        "pair_id", F.posexplode(vector_to_array("selected_features")).alias("pos", "x")
    ).select("pair_id", big("pos", "pos"), r6("x", "x"))


@query
def label_index(spark, d):
    parts = so.read_table(spark, d, "part").select("p_partkey", "p_brand")
    model = mo.label_indexer(parts, "p_brand", "number")
    indexed = mo.label_names(model, "number", "name").transform(model.transform(parts))
    return indexed.select("p_partkey", "p_brand", "number", "name")


@query
def feature_index(spark, d):
    lines = so.read_table(spark, d, "lineitem").select(
        "l_orderkey",
        "l_partkey",
        F.ascii("l_returnflag").cast("double").alias("flag"),
        F.ascii("l_linestatus").cast("double").alias("status"),
        F.col("l_quantity").alias("quantity"),
    )
    f = fe.assemble(lines, ["flag", "status", "quantity"])
    indexed = vector_to_array("indexed_features")
    return (
        mo.feature_indexer().fit(f).transform(f)
        .select("l_orderkey", "l_partkey", "quantity", indexed.alias("v"))
        .select(
            "l_orderkey", "l_partkey", "quantity", F.get("v", F.lit(0)).alias("flag"),
            F.get("v", F.lit(1)).alias("status"), F.get("v", F.lit(2)).alias("kept"),
        )
    )


# --- models --------------------------------------------------------------------------------------


def _classified(spark, d, kind, reduced, **params):
    frames = classification_frames(wt.pairs(spark, d))
    train_df, test_df = pca_frames(*frames) if reduced else frames
    return mo.score(mo.train(train_df, kind, **params), test_df)


@query
def naive_bayes(spark, d):
    return _classified(spark, d, "naive_bayes", False).select("pair_id", "label", "prediction")


@query
def logistic(spark, d):
    return _classified(spark, d, "logistic", True).select("pair_id", "label", "prediction")


@query
def ovr(spark, d):
    return _classified(spark, d, "ovr", True).select("pair_id", "label", "prediction")


@query
def rf_class(spark, d):
    return _classified(spark, d, "rf_class", True).select(
        "pair_id", "label", "indexed_label", "prediction", "predicted_label"
    )


def _scalar_frame(spark, d):
    f = fe.assemble(overlap_features(wt.pairs(spark, d)), OVERLAP_FEATURES)
    return mo.ready_to_train(f.select("pair_id", "relevance", "features"), "pair_id")


def _scalar_frames(spark, d):
    return re_.split_by_key(_scalar_frame(spark, d), "pair_id")


def _regressed(spark, d, kind, **params):
    train_df, test_df = _scalar_frames(spark, d)
    model = mo.train(train_df, kind, label="relevance", **params)
    return mo.score(model, test_df).select("pair_id", "relevance", "prediction")


@query
def linear(spark, d):
    return _regressed(spark, d, "linear").withColumn("prediction", r6("prediction", "prediction"))


@query
def linear_coefficients(spark, d):
    train_df, _ = _scalar_frames(spark, d)
    fitted = mo.coefficients(mo.train(train_df, "linear", label="relevance"), OVERLAP_FEATURES)
    return fitted.select("feature", r6("coefficient", "coefficient"))


@query
def glm(spark, d):
    return _regressed(spark, d, "glm").withColumn("prediction", r6("prediction", "prediction"))


@query
def tree(spark, d):
    return _regressed(spark, d, "tree")


@query
def rf_reg(spark, d):
    return _regressed(spark, d, "rf_reg")


@query
def gbt(spark, d):
    return _regressed(spark, d, "gbt")


@query
def isotonic(spark, d):
    train_df, _ = _scalar_frames(spark, d)
    model = mo.train(train_df, "isotonic", label="relevance")
    return mo.score(model, train_df).select(
        "pair_id", "relevance", r6("prediction", "prediction")
    )


@query
def isotonic_boundaries(spark, d):
    """Where each level of the fit begins and ends."""
    train_df, _ = _scalar_frames(spark, d)
    fitted = mo.isotonic_boundaries(mo.train(train_df, "isotonic", label="relevance"))
    levels = fitted.select("boundary", r6("prediction", "prediction")).groupBy("prediction")
    return levels.agg(F.min("boundary").alias("first"), F.max("boundary").alias("last"))


@query
def importances(spark, d):
    train_df, _ = _scalar_frames(spark, d)
    return mo.importances(mo.train(train_df, "rf_reg", label="relevance"), OVERLAP_FEATURES)


# --- fits that SQL can do as well: one split, or the equations a fit must solve -------------------

EXACT = {"maxDepth": 1, "maxBins": 10_000}  # one split, between any two neighbouring values
ALL_ROWS = {"num_trees": 1, "bootstrap": False, "featureSubsetStrategy": "all"}


def _stump(spark, d, kind, **params):
    return _regressed(spark, d, kind, **params).select(
        "pair_id", "relevance", r6("prediction", "prediction")
    )


@query
def tree_split(spark, d):
    return _stump(spark, d, "tree", **EXACT)


@query
def rf_reg_split(spark, d):
    return _stump(spark, d, "rf_reg", **EXACT, **ALL_ROWS)


@query
def gbt_split(spark, d):
    """The first round of boosting fits the labels."""
    return _stump(spark, d, "gbt", rounds=1, **EXACT)


@query
def importances_split(spark, d):
    train_df, _ = _scalar_frames(spark, d)
    model = mo.train(train_df, "rf_reg", label="relevance", **EXACT, **ALL_ROWS)
    return mo.importances(model, OVERLAP_FEATURES)


def _high_frames(spark, d):
    """Scalar features and whether the relevance is 2.5 or more."""
    label = F.when(F.col("relevance") >= 2.5, "high").otherwise("low").alias("label")
    frame = _scalar_frame(spark, d).select("pair_id", label, "features")
    return re_.split_by_key(frame, "pair_id")


@query
def rf_class_split(spark, d):
    """Labels and features numbered, one split, the predicted label named again."""
    train_df, test_df = _high_frames(spark, d)
    model = mo.train(train_df, "rf_class", max_categories=2, **EXACT, **ALL_ROWS)
    return mo.score(model, test_df).select(
        "pair_id", "label", "indexed_label", "prediction", "predicted_label"
    )


def _shares(scored: DataFrame, score: Column) -> DataFrame:
    """Mean score weighted by each feature, as ``feature, share``."""
    x = vector_to_array("features")
    weighted = [
        r6(F.round(F.sum(score * F.get(x, F.lit(i))) / F.sum(F.get(x, F.lit(i))), 3), n)
        for i, n in enumerate(OVERLAP_FEATURES)
    ]
    sums = scored.agg(*weighted, r6(F.round(F.avg(score), 3), "(intercept)"))
    return sums.unpivot([], ["(intercept)", *OVERLAP_FEATURES], "feature", "share")


@query
def logistic_equations(spark, d):
    """Weighted by a feature, fitted probabilities and labels have the same sum."""
    train_df, _ = _high_frames(spark, d)
    numbered = train_df.withColumn("label", F.when(F.col("label") == "high", 1.0).otherwise(0.0))
    model = mo.train(numbered, "logistic", tol=1e-9)
    return _shares(mo.score(model, numbered), F.get(vector_to_array("probability"), F.lit(1)))


@query
def ovr_equations(spark, d):
    """The same for the model of each class against the rest."""
    frame = _scalar_frame(spark, d).withColumn("label", F.col("relevance") - 1)
    train_df, _ = re_.split_by_key(frame, "pair_id")
    model = mo.train(train_df, "ovr", tol=1e-9)
    out = []
    for c, one in enumerate(model.models):
        scored = one.transform(train_df.select("features"))
        shares = _shares(scored, F.get(vector_to_array("probability"), F.lit(1)))
        out.append(shares.withColumn("class", big(F.lit(c), "class")))
    return reduce(DataFrame.unionAll, out)


@query
def pca_covariances(spark, d):
    """Covariances of the features, put together from all components and their variances."""
    train_df, _ = _scalar_frames(spark, d)
    names, n = OVERLAP_FEATURES, len(OVERLAP_FEATURES)
    model = fe.fit_pca(train_df, n)
    total = train_df.agg(*[F.var_samp(F.get(vector_to_array("features"), F.lit(i))) for i in range(n)]).first()
    variance = [v * sum(total) for v in model.explainedVariance.toArray()]
    parts = model.pc.toArray()
    rows = [
        (names[i], names[j], float(sum(variance[k] * parts[i, k] * parts[j, k] for k in range(n))))
        for i in range(n) for j in range(n)
    ]
    made = spark.createDataFrame(rows, "one string, two string, covariance double")
    return made.select("one", "two", F.round("covariance", 3).alias("covariance"))


@query
def classify_naive_bayes_table(spark, d):
    table = classify_relevance(wt.pairs(spark, d), models=["naive_bayes"])
    return table.select("model", r6("accuracy", "accuracy"), r6("error", "error"))


@query
def empty_tables(spark, d):
    """Whether parts of each class of brands are there."""
    part = so.read_table(spark, d, "part")
    rows = [
        (size, so.is_empty(part.where(F.col("p_size") == size))) for size in (0, 1, 25, 50, 51)
    ]
    return spark.createDataFrame(rows, "p_size int, empty boolean").select(big("p_size", "p_size"), "empty")


# --- evaluation ----------------------------------------------------------------------------------


def _jaccard_judged(spark, d, cuts):
    w = pair_words(spark, d)
    return w.select(
        "pair_id",
        threshold(jaccard_distance("title", "query"), 0.95, "at_most").alias("prediction"),
        bin_label("relevance", cuts).cast("int").alias("relevance"),
    )


@query
def confusion_flags(spark, d):
    flags = me.confusion_flags(_jaccard_judged(spark, d, fixed.CUTS_BINARY_HIGH))
    return flags.select(
        "pair_id", big("prediction", "prediction"), big("relevance", "relevance"),
        "TP", "TN", "FP", "FN",
    )


def _rounded(metrics: DataFrame) -> DataFrame:
    return metrics.select(*[r6(c, c) for c in metrics.columns])


@query
def binary_metrics(spark, d):
    return _rounded(me.binary_metrics(_jaccard_judged(spark, d, fixed.CUTS_BINARY_HIGH)))


@query
def multiclass_accuracy(spark, d):
    w = pair_words(spark, d)
    judged = w.select(
        bin_label("relevance", fixed.CUTS_4).alias("label"),
        bin_label(3 * (1 - jaccard_distance("title", "query")), [0.05, 0.1, 0.15]).alias("prediction"),
    )
    return _rounded(me.multiclass_accuracy(judged))


@query
def mse(spark, d):
    w = pair_words(spark, d)
    guess = 1 + 2 * (1 - jaccard_distance("title", "query"))
    return _rounded(me.mse(w.select("relevance", guess.alias("prediction"))))


# --- whole programs ------------------------------------------------------------------------------


@query
def classify_relevance_table(spark, d):
    return classify_relevance(wt.pairs(spark, d))


@query
def regress_relevance_table(spark, d):
    return regress_relevance(wt.pairs(spark, d))


def embedded_pairs(spark, d) -> DataFrame:
    """Pairs with the mean word vectors of title and query, word vectors from the embeddings."""
    w = so.cut_lineage(words_of(wt.pairs(spark, d), ["title", "query"], "bare"))
    out = w.select("pair_id", "relevance")
    words = w.select(F.col("title").alias("words")).unionAll(w.select("query"))
    vectors = word_vectors(spark, d, words)
    for f in ("title", "query"):
        side = fe.embed_with_table(w, "pair_id", f, vectors, wt.DIM, f"{f}_vector")
        out = out.join(side, "pair_id")
    return out


@query
def match_by_cosine(spark, d):
    return _rounded(match.match_by_cosine(embedded_pairs(spark, d), 0.6))


@query
def match_words_by_cosine(spark, d):
    return _rounded(match.match_words_by_cosine(wt.pairs(spark, d)))


@query
def match_by_jaccard(spark, d):
    return _rounded(match.match_by_jaccard(wt.pairs(spark, d)))


@query
def match_by_jaccard_top500(spark, d):
    return _rounded(
        match.match_by_jaccard(wt.pairs(spark, d), rows_per_side=500, keep_unmatched=False)
    )


@query
def match_by_jaccard_joined(spark, d):
    """The 500 highest ids of each side through the approximate join."""
    return _rounded(match.match_by_jaccard(wt.pairs(spark, d), rows_per_side=500, by="join"))


@query
def match_by_euclidean(spark, d):
    return _rounded(match.match_by_euclidean(match.term_pairs(wt.pairs(spark, d)), 5.0))


@query
def match_by_euclidean_top500(spark, d):
    counted = match.term_pairs(wt.pairs(spark, d))
    return _rounded(match.match_by_euclidean(counted, 20.0, rows_per_side=500, below=1000.0))
