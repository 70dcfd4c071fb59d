"""A corpus from raw documents to packed sequences, in stages that are each written and read again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmatch.llm import jaccard, langid, packing, substrings
from shelfmatch.llm.kept import keep
from shelfmatch.llm.queries import read_table

PART_BYTES = 1 << 20  # of texts packed together, as other stages have left less memory
SHINGLE, PERCENT = 5, 80  # near duplicates: words of a shingle, least similarity

ORACLE_SQL = None  # no stage can be written in SQL; tests compare with brute force


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents of no learnt language: no letters, or letters too unlikely in the likeliest.

    Languages are learnt from all labelled documents, and the least log-likelihood of a character
    follows from all of them; repeated rows count once. Without labelled documents nothing is learnt
    and all with letters stay.
    """
    model = langid.learn_sample(langid.labelled_sample(docs, rows_per_language=None))
    if not model[0]:
        return docs.where(F.col("text").rlike("\\p{L}"))
    found = keep(langid.predict(docs, model))
    floors = langid.floors_of(
        found.where(F.col("lang").isNotNull() & F.col("text").isNotNull())
        .select("lang", "doc_id", F.xxhash64("text"), "language").distinct()
    )
    floor = F.lit(None).cast("double")
    for language, least in floors.items():
        floor = F.when(F.col("language.lang_pred") == language, least).otherwise(floor)
    likely = F.col("language.log_likelihood") >= floor * F.col("language.n_chars")
    likely = F.coalesce(likely, F.lit(True))  # a language of which no labelled text is told
    return found.where((F.col("language.lang_pred") != langid.UNKNOWN) & likely).select(docs.columns)


def keep_one_of_similar(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of documents linked by a similarity of 0.8 or more the one of smallest id stays.

    A document without an id stays, as it can't be told from others.
    """
    groups = jaccard.link_similar(docs.select("doc_id", "text"), shingle=SHINGLE, percent=PERCENT)
    gone = keep(groups.where("doc_id != component_id").select("doc_id").distinct())
    return docs.join(gone, "doc_id", "left_anti").select(docs.columns)


def remove_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops passages that occur before, and documents of which nothing is left.

    Documents without such a passage keep their text as it is.
    """
    found = substrings.remove_repeats(docs)
    changed = F.col("repeats.n_removed") > 0
    text = F.when(changed, F.col("repeats.kept")).otherwise(F.col("text")).alias("text")
    found = found.where("repeats.n_removed = 0 or repeats.n_removed < repeats.n_words")
    length = F.when(changed, F.length("repeats.kept").cast("long")).otherwise(F.col("n_chars"))
    new = {"text": text, "n_chars": length.alias("n_chars")}
    return found.select(*[new.get(c, F.col(c)) for c in docs.columns])


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents and their places in sequences of 4096 tokens."""
    pieces = packing.token_pieces(docs.select("doc_id", "text"), split_bytes=PART_BYTES)
    return packing.pack(pieces, ["doc_id", "start"])


STAGES = [
    ("language_id", identify_language),
    ("jaccard_join", keep_one_of_similar),
    ("substring_dedup", remove_repeated_passages),
    ("packing", pack_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder."""
    docs = read_table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = keep(stage(spark, docs, sf_dir))
    return docs
