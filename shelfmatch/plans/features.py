"""Feature frames of rated pairs.

Pairs have ``pair_id, product_title, search_term, product_description, value, relevance``. They
stay one wide row from text to features; nothing is split into branches and joined again.
"""

from __future__ import annotations

from functools import reduce

from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmatch.functions.stemming import stem_tokens
from shelfmatch.functions.text import (
    clean_text,
    common_terms,
    len_ratio,
    lower_all,
    remove_stopwords,
    to_double,
    token_count,
    tokenize,
)
from shelfmatch.operators.features import embed_fields_with_table, embed_tokens

FIELDS = {
    "title": "product_title",
    "query": "search_term",
    "desc": "product_description",
    "brand": "value",
}
OVERLAP_FEATURES = [
    "product_title_len",
    "search_term_len",
    "product_description_len",
    "ratio_desc_len_search_len",
    "ratio_title_len_search_len",
    "common_words_ST",
    "common_words_SD",
]
REGRESSION_FEATURES = [
    "product_title_len",
    "search_term_len",
    "product_description_len",
    "brand_len",
    "ratio_desc_len_search_len",
    "ratio_title_len_search_len",
    "common_words_ST_T",
    "common_words_ST_D",
    "common_words_ST_B",
    "cosine_similarity",
    "euclidean_distance",
]


def words_of(
    pairs: DataFrame, fields: list[str], style: str = "bare", stem: str | None = None
) -> DataFrame:
    """``pair_id, relevance`` and a word list per field: clean, split, drop stop words, stem."""
    cols = {f: FIELDS[f] for f in fields}
    df = clean_text(lower_all(pairs, list(cols.values())), list(cols.values()), style)
    df = df.select(
        "pair_id",
        to_double("relevance").alias("relevance"),
        *[remove_stopwords(tokenize(c)).alias(f) for f, c in cols.items()],
    )
    if not stem:
        return df
    # one stemming of all fields in a row, then each field's share of it
    sizes = {f: F.size(f) for f in fields}
    stemmed = df.withColumn("stems", stem_tokens(F.flatten(F.array(*fields)), stem))
    starts = [reduce(Column.__add__, list(sizes.values())[:i], F.lit(1)) for i in range(len(fields))]
    return stemmed.select(
        "pair_id",
        "relevance",
        *[F.slice("stems", start, sizes[f]).alias(f) for f, start in zip(fields, starts)],
    )


def overlap_features(pairs: DataFrame) -> DataFrame:
    """``pair_id, relevance`` and the seven features of the classification."""
    w = words_of(pairs, ["title", "query", "desc"], "dotted")
    sized = w.withColumns(
        {
            "product_title_len": token_count("title"),
            "search_term_len": token_count("query"),
            "product_description_len": token_count("desc"),
            "common_words_ST": common_terms("query", "title"),
            "common_words_SD": common_terms("query", "desc"),
        }
    )
    query_len = F.col("search_term_len")
    return sized.withColumns(
        {
            "ratio_desc_len_search_len": len_ratio(F.col("product_description_len"), query_len),
            "ratio_title_len_search_len": len_ratio(F.col("product_title_len"), query_len),
        }
    ).select("pair_id", "relevance", *OVERLAP_FEATURES)


def stem_overlap_features(words: DataFrame) -> DataFrame:
    """Adds the lengths, ratios and overlaps of the regression to stemmed word lists."""
    sized = words.withColumns(
        {
            "product_title_len": token_count("title"),
            "search_term_len": token_count("query"),
            "product_description_len": token_count("desc"),
            "brand_len": token_count("brand"),
            "common_words_ST_T": common_terms("query", "title"),
            "common_words_ST_D": common_terms("query", "desc"),
            "common_words_ST_B": common_terms("query", "brand"),
        }
    )
    query_len = F.col("search_term_len")
    return sized.withColumns(
        {
            "ratio_desc_len_search_len": len_ratio(F.col("product_description_len"), query_len),
            "ratio_title_len_search_len": len_ratio(F.col("product_title_len"), query_len),
        }
    )


def embed_fields(words: DataFrame, fields: list[str], model, size: int = 100) -> DataFrame:
    """Adds ``<field>_vector`` per field: ML vectors of ``size`` by the same word vectors, a table
    ``word, vector`` or a Word2Vec model. With a table pair ids are unique."""
    if isinstance(model, DataFrame):
        embedded = embed_fields_with_table(words, "pair_id", fields, model, size)
        vectors = [array_to_vector(f"{f}_vector").alias(f"{f}_vector") for f in fields]
        return words.join(embedded.select("pair_id", *vectors), "pair_id")
    for f in fields:
        words = embed_tokens(words, f, model, f"{f}_vector")
    return words
