"""Text to vectors, and shaping of feature vectors."""

from __future__ import annotations

import math
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.feature import (
    IDF,
    PCA,
    CountVectorizer,
    HashingTF,
    Normalizer,
    UnivariateFeatureSelector,
    VectorAssembler,
    VectorSlicer,
    Word2Vec,
)
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import ChiSquareTest
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfmatch.functions.text import let, term_counts
from shelfmatch.operators.relational import skew_join
from shelfmatch.operators.wordtraining import WordTable, train, word_counts
from shelfmatch.sources.tables import cut_lineage, drop_kept, tell_workers

BLOCK_WORDS = 1 << 23  # of lists that take the vectors of their words together, about
STEP_WORDS = 1 << 15  # whose vectors are added up at a time
TRAINED_WORDS = 1 << 19  # of a corpus that one task learns word vectors from, about
HELD_WORDS = 1 << 16  # different words of which Spark ML's model, held by the driver and each task, is learnt
TABLE_PART = 1 << 21  # of a corpus with more, words that one task learns from, about


def _term_rows(df: DataFrame, ids: list[str], tokens: str) -> DataFrame:
    """Ids and ``e`` with ``e.term, e.n`` for every distinct word of a row.

    The outer form keeps Spark from adding a filter on the list, which would count the words twice.
    """
    return df.select(*ids, F.explode_outer(term_counts(tokens)).alias("e")).where(
        F.col("e").isNotNull()
    )


def term_stats(df: DataFrame, tokens: str) -> DataFrame:
    """``term, tf, df`` over a corpus of one row per document.

    Terms are counted inside each row first, so one shuffle of partial sums by term is all.
    """
    return (
        _term_rows(df, [], tokens)
        .groupBy(F.col("e.term").alias("term"))
        .agg(F.sum("e.n").alias("tf"), F.count("*").alias("df"))
    )


def hashed_tf(df: DataFrame, tokens: str, out: str = "tf", n: int = 10000) -> DataFrame:
    return HashingTF(numFeatures=n, inputCol=tokens, outputCol=out).transform(df)


def fit_idf(df: DataFrame, tf: str = "tf", out: str = "tfidf"):
    return IDF(inputCol=tf, outputCol=out).fit(df)


def tfidf_long(df: DataFrame, id_: str, tokens: str, fit_on: DataFrame, fit_tokens: str) -> DataFrame:
    """``id, term, tf, weight`` rows with ``weight = tf * ln((N + 1) / (df + 1))``.

    ``fit_on`` holds the corpus the document frequencies come from; a term it lacks has df 0.
    """
    size = fit_on.agg(F.count("*")).scalar()
    long = _term_rows(df, [id_], tokens).select(
        id_, F.col("e.term").alias("term"), F.col("e.n").alias("tf")
    )
    known = term_stats(fit_on, fit_tokens).select("term", "df")
    df_or_0 = F.coalesce(F.col("df"), F.lit(0))
    return skew_join(long, known, ["term"], [id_], how="left").select(
        id_, "term", "tf", (F.col("tf") * F.log((size + 1.0) / (df_or_0 + 1.0))).alias("weight")
    )


def fit_count_vectors(
    df: DataFrame, tokens: str, out: str = "features", vocab_size: int = 1_000_000, min_df: float = 5
):
    """Vocabulary of at most ``vocab_size`` terms found in ``min_df`` documents or more."""
    return CountVectorizer(
        inputCol=tokens, outputCol=out, vocabSize=vocab_size, minDF=min_df
    ).fit(df)


def count_vectors(df: DataFrame, tokens: str, model) -> DataFrame:
    return model.copy().setInputCol(tokens).transform(df)


def vector_terms(c: Column | str) -> Column:
    """Positions of the stored entries of a sparse ML vector."""
    return F.unwrap_udt(F.col(c) if isinstance(c, str) else c)["indices"]


def count_vectors_long(
    df: DataFrame, id_: str, tokens: str, fit_on: DataFrame, fit_tokens: str, min_df: int = 5
) -> DataFrame:
    """``id, term, n`` rows over the terms found in ``min_df`` documents of ``fit_on`` or more."""
    vocabulary = term_stats(fit_on, fit_tokens).where(F.col("df") >= min_df).select("term")
    long = _term_rows(df, [id_], tokens).select(
        id_, F.col("e.term").alias("term"), F.col("e.n").alias("n")
    )
    return skew_join(long, vocabulary, ["term"], [id_]).select(id_, "term", "n")


def fit_word2vec(
    df: DataFrame,
    tokens: str,
    out: str = "vector",
    size: int = 100,
    min_count: int = 0,
    seed: int = 42,
    partitions: int | None = None,
):
    """Word vectors learnt from a corpus in ``partitions`` parts, which are trained side by side.

    By default a part has about TRAINED_WORDS words, so that no task's work grows with the corpus;
    the words are counted first, which reads ``df`` once more. Rows are dealt out and sorted by
    their words, so that with one part the vectors follow from the corpus and the parameters alone.
    Of several parts Spark ML takes the mean of what they learnt of a word, and which rows a part
    sees first differs between runs, so the vectors do too.

    Spark ML holds its model as a whole. With more than HELD_WORDS different words the model is a
    ``WordTable``, learnt in the same way by tasks that hold the vectors of their own words
    (``wordtraining``), and the same in any run. By default parts have about TABLE_PART words, or
    TRAINED_WORDS while that makes eight parts or fewer.
    """
    words = df.agg(F.sum(F.when(F.col(tokens).isNotNull(), F.size(tokens)).cast("long"))).first()[0] or 0
    if words > HELD_WORDS and _different_words(df, tokens) > 0.9 * HELD_WORDS:
        counts = word_counts(df, tokens, min_count)
        if counts.count() > HELD_WORDS:
            parts = partitions or max(-(-words // TABLE_PART), min(8, -(-words // TRAINED_WORDS)))
            return WordTable(train(df, tokens, counts, size, seed, parts), size, tokens, out)
        drop_kept(counts)
    if partitions is None:
        partitions = max(1, -(-words // TRAINED_WORDS))
    digest = F.xxhash64(tokens)
    ordered = df.select(tokens).repartition(partitions, digest).sortWithinPartitions(digest, tokens)
    return Word2Vec(
        vectorSize=size,
        minCount=min_count,
        seed=seed,
        numPartitions=partitions,
        inputCol=tokens,
        outputCol=out,
    ).fit(ordered)


def _different_words(df: DataFrame, tokens: str) -> int:
    """About how many, to some hundredths."""
    return df.select(F.explode_outer(tokens).alias("w")).agg(F.approx_count_distinct("w", 0.02)).first()[0]


def embed_tokens(df: DataFrame, tokens: str, model, out: str | None = None) -> DataFrame:
    """Mean word vector per row; unknown words count as zero."""
    if isinstance(model, WordTable):
        out = out or model.out
        kept = cut_lineage(df.withColumn("_row", F.monotonically_increasing_id()))  # the rows are read twice
        made = embed_fields_with_table(kept, "_row", [tokens], model.vectors, model.size)
        vector = array_to_vector(f"{tokens}_vector").alias(out)
        return kept.join(made.select("_row", vector), "_row").select(*df.columns, out)
    m = model.copy().setInputCol(tokens)
    return (m.setOutputCol(out) if out else m).transform(df)


def embed_fields_with_table(
    df: DataFrame, id_: str, fields: list[str], vectors: DataFrame, dim: int
) -> DataFrame:
    """``id_`` and the mean word vector ``<field>_vector`` of each list of words, as an array.

    ``vectors`` is a table ``word, vector`` of any size; unknown words count as zero, so that a list
    without known words has the zero vector. Ids are unique; rows that share one are added up. Rows
    lie in blocks of about BLOCK_WORDS words. A block asks once for each of its different words, so
    a vector moves to a block and not to every list that has the word.
    """
    tell_workers(df.sparkSession)
    size = lambda f: F.when(F.col(f).isNotNull(), F.size(f)).otherwise(0) + dim
    total = df.agg(F.sum(reduce(Column.__add__, [size(f) for f in fields]).cast("long"))).first()[0] or 0
    block = F.pmod(F.xxhash64(id_), F.lit(max(1, -(-total // BLOCK_WORDS)))).cast("int").alias("_block")
    rows = df.select(block, id_, *fields)
    one = vectors.schema["vector"].dataType.elementType.simpleString()
    given = F.col("vector") if one == "float" else F.col("vector").cast("array<double>")
    known = vectors.select(F.col("word").alias("_word"), given.alias("_v")).where(F.col("_v").isNotNull())

    def ask(lists: pa.Table) -> pa.Table:
        found = [pc.unique(lists[f].combine_chunks().flatten()) for f in fields]
        words = pc.drop_null(pc.unique(pa.chunked_array(found, pa.string())))
        return pa.table({"_block": pa.repeat(lists["_block"][0], len(words)), "_word": words})

    def mean(lists: pa.Table, held: pa.Table) -> pa.Table:
        words = held["_word"].combine_chunks().dictionary_encode()
        moved = held["_v"].combine_chunks().flatten()
        moved = (pc.fill_null(moved, 0.0) if moved.null_count else moved).to_numpy(zero_copy_only=False)
        matrix = moved.reshape(held.num_rows, dim)
        if len(words.dictionary) < held.num_rows:  # the vectors of a word that has several are added up
            matrix = np.zeros((len(words.dictionary), dim))
            np.add.at(matrix, words.indices.to_numpy(), moved.reshape(held.num_rows, dim))
        ids = lists[id_].combine_chunks().dictionary_encode(null_encoding="encode")
        made = {id_: ids.dictionary}
        for f in fields:
            column = lists[f].combine_chunks()
            n = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False)
            at = pc.fill_null(pc.index_in(column.flatten(), words.dictionary), -1).to_numpy(zero_copy_only=False)
            row = np.repeat(np.arange(len(n)), n)[at >= 0]
            at, sums = at[at >= 0], np.zeros((len(n), dim))
            for start in range(0, len(at), STEP_WORDS):
                step = slice(start, start + STEP_WORDS)
                which, first = np.unique(row[step], return_index=True)
                sums[which] += np.add.reduceat(matrix[at[step]], first, dtype=float)
            by_id = np.zeros((len(ids.dictionary), dim))
            np.add.at(by_id, ids.indices.to_numpy(), sums / np.maximum(n, 1)[:, None])
            offsets = np.arange(len(by_id) + 1, dtype=np.int32) * dim
            made[f"{f}_vector"] = pa.ListArray.from_arrays(offsets, by_id.ravel())
        return pa.table(made)

    asked = rows.groupBy("_block").applyInArrow(ask, "_block int, _word string")
    answered = asked.join(known, "_word")
    schema = T.StructType([df.schema[id_], *[T.StructField(f"{f}_vector", T.ArrayType(T.DoubleType())) for f in fields]])
    return rows.groupBy("_block").cogroup(answered.groupBy("_block")).applyInArrow(mean, schema)


def embed_with_table(
    df: DataFrame, id_: str, tokens: str, vectors: DataFrame, dim: int, out: str = "vector"
) -> DataFrame:
    """``embed_tokens`` with the word vectors in a table: ``id_`` and the mean vector of a list."""
    made = embed_fields_with_table(df, id_, [tokens], vectors, dim)
    return made.withColumnRenamed(f"{tokens}_vector", out)


def assemble(df: DataFrame, cols: list[str], out: str = "features") -> DataFrame:
    return VectorAssembler(inputCols=cols, outputCol=out).transform(df)


def normalize(
    df: DataFrame, p: float = math.inf, c: str = "features", out: str = "norm_features"
) -> DataFrame:
    """Scale each row by its p-norm."""
    return Normalizer(p=p, inputCol=c, outputCol=out).transform(df)


def normalize_array(c: Column | str) -> Column:
    """Scale an ``array<double>`` by its largest absolute entry; all zero stays."""
    v = F.col(c) if isinstance(c, str) else c
    return let(
        F.array_max(F.transform(v, F.abs)),
        lambda top: F.when(top == 0, v).otherwise(F.transform(v, lambda x: x / top)),
    )


def fit_pca(train: DataFrame, k: int = 3, c: str = "features", out: str = "pca_features"):
    """Principal components, learnt from the training rows only."""
    return PCA(k=k, inputCol=c, outputCol=out).fit(train)


def pca_transform(model, df: DataFrame) -> DataFrame:
    return model.transform(df)


def chi2_scores(df: DataFrame, cols: list[str], label: str) -> DataFrame:
    """``feature, statistic, dof`` of the chi-squared test of each column against the label.

    Works from counts per (feature, value, class), so distinct values are not limited.
    """
    wide = df.select(F.col(label).alias("class"), *[F.col(c).cast("double").alias(c) for c in cols])
    return _chi2_of(wide.unpivot(["class"], cols, "feature", "value"))


def _chi2_of(long: DataFrame) -> DataFrame:
    """``chi2_scores`` of rows ``class, feature, value``."""
    cells = long.groupBy("feature", "value", "class").agg(F.count("*").alias("n"))
    by_value = cells.groupBy("feature", "value").agg(F.sum("n").alias("n_value"))
    by_class = cells.groupBy("feature", "class").agg(F.sum("n").alias("n_class"))
    # sum over cells of (observed - expected)^2 / expected equals N * (sum o^2 / (r * c) - 1),
    # which needs the observed cells only
    sums = (
        cells.join(by_value, ["feature", "value"])
        .join(by_class, ["feature", "class"])
        .groupBy("feature")
        .agg(
            F.sum(F.col("n") * F.col("n") / (F.col("n_value") * F.col("n_class"))).alias("s"),
            F.sum("n").alias("total"),
        )
    )
    sizes = by_value.groupBy("feature").agg(F.count("*").alias("values")).join(
        by_class.groupBy("feature").agg(F.count("*").alias("classes")), "feature"
    )
    return sums.join(sizes, "feature").select(
        "feature",
        (F.col("total") * (F.col("s") - 1)).alias("statistic"),
        ((F.col("values") - 1) * (F.col("classes") - 1)).alias("dof"),
    )


def select_features(
    df: DataFrame,
    k: int = 5,
    label: str = "relevance",
    c: str = "features",
    out: str = "selected_features",
    method: str = "chi2",
):
    """Fitted selector of the ``k`` top features.

    "chi2" treats every value as a category, any number of them; "f" scores continuous features
    against a continuous label. Features rank by how unlikely their chi-squared statistic is,
    measured by its normal score (Wilson and Hilferty), as p-values of strong features are all zero
    in double precision. Equal scores go to the lower position; a constant feature comes last.
    """
    if method == "chi2":
        long = df.select(
            F.col(label).alias("class"), F.posexplode(vector_to_array(c)).alias("feature", "value")
        )
        spread = 2 / (9 * F.col("dof"))
        score = (F.cbrt(F.col("statistic") / F.col("dof")) - (1 - spread)) / F.sqrt(spread)
        ranked = _chi2_of(long).select("feature", F.when(F.col("dof") > 0, score).alias("score"))
        top = ranked.orderBy(F.desc_nulls_last("score"), "feature").limit(k)
        positions = sorted(row["feature"] for row in top.collect())
        return VectorSlicer(inputCol=c, outputCol=out, indices=positions)
    if method == "f":
        selector = UnivariateFeatureSelector(
            featuresCol=c, labelCol=label, outputCol=out, selectionMode="numTopFeatures"
        )
        return (
            selector.setFeatureType("continuous")
            .setLabelType("continuous")
            .setSelectionThreshold(k)
            .fit(df)
        )
    raise ValueError(f"unknown method {method!r}")


def chi2_test(df: DataFrame, c: str, label: str) -> DataFrame:
    return ChiSquareTest.test(df, c, label, flatten=True)


def as_array(df: DataFrame, c: str) -> DataFrame:
    return df.withColumn(c, vector_to_array(c))
