"""The given tables seen as relevance data: rated pairs, descriptions, attributes, vectors."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmatch.operators.buckets import BucketPlan, plan_buckets
from shelfmatch.operators.hotkeys import consolidate
from shelfmatch.operators.relational import pick_attribute
from shelfmatch.sources.tables import read_table, spread

DIM = 64  # length of the given embeddings
NEAR = 0.65  # distance of vectors that belong together, of those that ``moved_vectors`` makes


def documents(spark: SparkSession, d: str) -> DataFrame:
    return spread(read_table(spark, d, "documents"), "doc_id")


def pages(spark: SparkSession, d: str) -> DataFrame:
    return spread(read_table(spark, d, "pages"), "page_id")


def rated(spark: SparkSession, d: str) -> DataFrame:
    """``product_uid, product_title, search_term, relevance``: each labelled document (whole text)
    rated against a benchmark passage (whole text)."""
    labels, benchmark = read_table(spark, d, "labels"), read_table(spark, d, "benchmark")
    passages = benchmark.agg(F.count("*")).scalar()
    return (
        labels.join(documents(spark, d), "doc_id")
        .withColumn("item_id", F.col("doc_id") % passages)
        .join(benchmark.select("item_id", F.col("text").alias("search_term")), "item_id")
        .select(
            F.col("doc_id").alias("product_uid"),
            F.col("text").alias("product_title"),
            "search_term",
            (1 + F.col("quality") + (1 - F.col("toxic"))).cast("string").alias("relevance"),
        )
    )


def descriptions(spark: SparkSession, d: str) -> DataFrame:
    """``product_uid, product_description``: a whole web page per document."""
    html = read_table(spark, d, "pages")
    n = html.agg(F.count("*")).scalar()
    return (
        read_table(spark, d, "documents").select(F.col("doc_id").alias("product_uid"))
        .withColumn("page_id", F.col("product_uid") % n)
        .join(html.select("page_id", F.col("html").alias("product_description")), "page_id")
        .select("product_uid", "product_description")
    )


def attributes(spark: SparkSession, d: str) -> DataFrame:
    """``product_uid, name, value``: brand and type of every part."""
    part = read_table(spark, d, "part").select(
        F.col("p_partkey").alias("product_uid"),
        F.col("p_brand").alias("brand"),
        F.col("p_type").alias("type"),
    )
    return part.unpivot(["product_uid"], ["brand", "type"], "name", "value")


def pairs(spark: SparkSession, d: str) -> DataFrame:
    """``pair_id, product_title, search_term, product_description, value, relevance``."""
    return consolidate(
        rated(spark, d),
        descriptions(spark, d),
        pick_attribute(attributes(spark, d), "brand"),
        ["search_term"],
    ).select(
        F.col("product_uid").alias("pair_id"),
        "product_title",
        "search_term",
        "product_description",
        "value",
        "relevance",
    )


def ratings(spark: SparkSession, d: str) -> DataFrame:
    """``o_orderkey, relevance``: a rating text between 1.00 and 3.00 for every order."""
    cents = F.round(F.col("o_totalprice") * 100).cast("long") % 201
    return read_table(spark, d, "orders").select(
        "o_orderkey",
        F.concat(
            (1 + F.floor(cents / 100)).cast("string"), F.lit("."),
            F.lpad((cents % 100).cast("string"), 2, "0"),
        ).alias("relevance"),
    )


def vector_pairs(spark: SparkSession, d: str) -> DataFrame:
    """``pair_id, title_vector, query_vector, relevance``: neighbouring embeddings."""
    e = read_table(spark, d, "embeddings")
    other = e.select(
        (F.col("vec_id") - 1).alias("vec_id"),
        F.col("embedding").alias("query_vector"),
        F.col("label").alias("other_label"),
    )
    return e.join(other, "vec_id").select(
        F.col("vec_id").alias("pair_id"),
        F.col("embedding").cast("array<double>").alias("title_vector"),
        F.col("query_vector").cast("array<double>").alias("query_vector"),
        F.when(F.col("label") == F.col("other_label"), 1).otherwise(0).alias("relevance"),
    )


def label_centres(spark: SparkSession, d: str) -> DataFrame:
    """``vec_id, embedding``: the mean embedding of every label."""
    e = read_table(spark, d, "embeddings")
    means = [F.round(F.avg(F.get("embedding", F.lit(i)).cast("double")), 6) for i in range(DIM)]
    return e.groupBy("label").agg(*[m.alias(f"m{i}") for i, m in enumerate(means)]).select(
        F.col("label").cast("long").alias("vec_id"),
        F.array(*[f"m{i}" for i in range(DIM)]).alias("embedding"),
    )


def moved_vectors(spark: SparkSession, d: str) -> DataFrame:
    """``vec_id, embedding``: each embedding moved by 0.1 to 1.0 of the next one."""
    e = read_table(spark, d, "embeddings").select("vec_id", "embedding")
    after = e.select((F.col("vec_id") - 1).alias("vec_id"), F.col("embedding").alias("_next"))
    share = (F.lit(1) + F.col("vec_id") % 10) / 10
    moved = F.zip_with("embedding", "_next", lambda x, y: x.cast("double") + share * y.cast("double"))
    return e.join(after, "vec_id").select("vec_id", moved.alias("embedding"))


def near_plan() -> BucketPlan:
    """Buckets for 0.9 of the pairs at distance NEAR among some thousand vectors like the given ones."""
    return plan_buckets(NEAR, DIM, 0.9, [1.3, 1.4, 1.5], (2000, 2000))
