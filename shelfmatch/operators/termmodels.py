"""Models that are a table of terms: vocabulary, document frequencies, word vectors.

A model is written bucketed and sorted by term, so that a join by term moves the rows and not the
model. Rows of terms that are too many for one task join a part of the model that is as small as a
sketch of frequent terms.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmatch.functions.text import term_counts
from shelfmatch.operators.features import term_stats
from shelfmatch.operators.hotkeys import frequent_keys, key_hash
from shelfmatch.operators.relational import HOT_ROWS


def save_term_table(
    df: DataFrame, name: str, path: str, term: str = "term", buckets: int | None = None
) -> DataFrame:
    """Write the model to ``path/terms`` as table ``name``, in as many buckets as shuffle partitions."""
    spark = df.sparkSession
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    writer = df.write.format("parquet").bucketBy(buckets, term).sortBy(term)
    writer.mode("errorifexists").option("path", f"{path}/terms").saveAsTable(name)
    about = spark.createDataFrame([(term, buckets)], "term string, buckets int")
    about.coalesce(1).write.mode("errorifexists").parquet(f"{path}/about")
    return spark.table(name)


def load_term_table(spark: SparkSession, name: str, path: str) -> DataFrame:
    """The model of a folder as table ``name`` of this session."""
    about = spark.read.parquet(f"{path}/about").first()
    schema = spark.read.parquet(f"{path}/terms").schema
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    spark.sql(
        f"CREATE TABLE `{name}` ({columns}) USING parquet CLUSTERED BY (`{about.term}`) "
        f"SORTED BY (`{about.term}`) INTO {about.buckets} BUCKETS LOCATION '{path}/terms'"
    )
    return spark.table(name)


def vocabulary(df: DataFrame, tokens: str, min_df: int = 5) -> DataFrame:
    """``term, tf, df`` of the terms found in ``min_df`` documents or more; no limit on their number."""
    return term_stats(df, tokens).where(F.col("df") >= min_df)


def join_model(
    rows: DataFrame, model: DataFrame, term: str = "term", how: str = "inner", hot_rows: int = HOT_ROWS
) -> DataFrame:
    """Inner or left join of rows with a model by term, of which each term has one row.

    Rows of hot terms join the model's rows of these terms, which are broadcast: at most as many as
    a sketch tracks. All others join by term, where the rows move to the model's buckets.
    """
    counts = frequent_keys(rows, [term])
    hot = sorted(k for k, n in counts.items() if n > hot_rows)
    if not hot:
        return rows.join(model, term, how)
    table = F.broadcast(rows.sparkSession.createDataFrame([(k,) for k in hot], "_hot long"))
    is_hot = key_hash([term]) == F.col("_hot")
    few = F.broadcast(model.join(table, is_hot, "left_semi"))
    by_term = rows.join(table, is_hot, "left_anti").join(model, term, how)
    return by_term.unionByName(rows.join(table, is_hot, "left_semi").join(few, term, how))


def field_terms(df: DataFrame, id_: str, fields: list[str]) -> DataFrame:
    """``id, field, term, n`` of the different words of several lists of a row, counted inside it."""
    lists = F.explode(F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).alias("words")) for f in fields]))
    counted = df.select(id_, lists.alias("f")).select(
        id_, "f.field", F.explode_outer(term_counts("f.words")).alias("e")
    )
    return counted.where(F.col("e").isNotNull()).select(id_, "field", "e.term", "e.n")


def tfidf_fields(
    df: DataFrame, id_: str, fields: list[str], frequencies: DataFrame, size: int
) -> DataFrame:
    """``id, field, term, tf, weight`` of several fields by one IDF.

    ``frequencies`` has ``term, df`` of the corpus that the IDF is fitted on, of ``size`` documents;
    a term it lacks has df 0. ``weight = tf * ln((size + 1) / (df + 1))``.
    """
    long = field_terms(df, id_, fields)
    found = join_model(long, frequencies.select("term", "df"), how="left")
    idf = F.log((size + 1.0) / (F.coalesce("df", F.lit(0)) + 1.0))
    return found.select(id_, "field", "term", F.col("n").alias("tf"), (F.col("n") * idf).alias("weight"))


def pair_counts(df: DataFrame, ids: list[str], one: str, two: str, model: DataFrame) -> DataFrame:
    """Of two lists of words of a row, over the terms of a model: ``n_one, n_two, n_both`` different
    terms and ``square``, the squared distance of their counts. Rows without such terms are left out.
    """
    counts = lambda c: F.map_from_entries(F.transform(term_counts(c), lambda e: F.struct(e["term"], e["n"])))
    none = F.lit(0).cast("long")
    seen = df.select(*ids, counts(one).alias("_one"), counts(two).alias("_two"))
    first = F.transform(
        F.map_entries("_one"),
        lambda e: F.struct(
            e["key"].alias("term"), e["value"].cast("long").alias("one"),
            F.coalesce(F.try_element_at("_two", e["key"]).cast("long"), none).alias("two"),
        ),
    )
    second = F.transform(
        F.filter(F.map_entries("_two"), lambda e: F.try_element_at("_one", e["key"]).isNull()),
        lambda e: F.struct(e["key"].alias("term"), none.alias("one"), e["value"].cast("long").alias("two")),
    )
    empty = lambda x: F.coalesce(x, F.array().cast("array<struct<term:string,one:bigint,two:bigint>>"))
    terms = seen.select(*ids, F.explode_outer(F.concat(empty(first), empty(second))).alias("e")).select(*ids, "e.*")
    known = join_model(terms, model.select("term"))
    apart = F.col("one") - F.col("two")
    return known.groupBy(*ids).agg(
        F.count_if(F.col("one") > 0).alias("n_one"),
        F.count_if(F.col("two") > 0).alias("n_two"),
        F.count_if((F.col("one") > 0) & (F.col("two") > 0)).alias("n_both"),
        F.sum(apart * apart).alias("square"),
    )
