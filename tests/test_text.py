import random
from collections import Counter
from functools import reduce

import pytest
from pyspark.ml.feature import NGram, StopWordsRemover, Tokenizer
from pyspark.sql import functions as F

from shelfmatch.functions import fixed_values as fixed
from shelfmatch.functions import text as tx


def one(spark, value, f, kind="string"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(f("x")).first()[0]


@pytest.mark.parametrize(
    "given, expected",
    [("a&nbsp;b-c/d<br/>e 5°", "anbspb-cdbre 5°"), (None, ""), ("[x]{y}^_`~\\|", "xy")],
)
def test_strip_punct(spark, given, expected):
    assert one(spark, given, tx.strip_punct) == expected


@pytest.mark.parametrize(
    "style, given, expected",
    [
        ("dotted", "aluminum bulb cut dimmer lamps", "alumin.um bulb. cu.t dimm.er lamp."),
        ("bare", "aluminum bulb cut dimmer lamps", "aluminum bulb cut dimmer lamp"),
        ("dotted", "5 gallons per minute", "5 gal. per min.ute"),
        ("bare", "5 gallons per minute", "5 gal per min"),
        ("dotted", "90 degrees 5° degree", "90 deg. 5deg. deg."),
        ("bare", "90 degrees 5° degree", "90 deg 5deg deg"),
        ("bare", "amperes", "amps"),
    ],
)
def test_units(spark, style, given, expected):
    assert one(spark, given, lambda c: tx.normalize_units(c, style)) == expected


def test_units_whole_words(spark):
    got = one(spark, "clamps 5 amps 2 feet", lambda c: tx.normalize_units(c, "bare", True))
    assert got == "clamps 5 amp 2 ft"


def test_clean_orders(spark):
    assert one(spark, "a&nbsp;b &amp; c", tx.clean) == "ab amp c"
    assert one(spark, "a&nbsp;b &amp; c", lambda c: tx.clean(c, order="html_first")) == "a b  c"


@pytest.mark.parametrize("style", ["dotted", "bare"])
def test_rules_equal_plain_patterns(spark, data, style):
    texts = spark.read.parquet(f"{data}/documents.parquet").select(F.lower("text").alias("t")).unionAll(
        spark.read.parquet(f"{data}/pages.parquet").select(F.lower("html"))
    )
    plain = reduce(
        lambda c, r: F.regexp_replace(c, F.lit(r[0]), F.lit(r[1])),
        [(fixed.PUNCTUATION, ""), *fixed.HTML_REMNANTS, *tx.UNIT_STYLES[style]],
        F.col("t"),
    )
    assert texts.where(plain != tx.clean("t", style)).count() == 0


@pytest.mark.parametrize(
    "given, expected", [("a  b ", ["a", "", "b"]), ("", [""]), ("  ", []), ("The\tQuick", ["the", "quick"])]
)
def test_tokenize(spark, given, expected):
    assert one(spark, given, tx.tokenize) == expected


def test_stopwords(spark):
    assert one(spark, "The Quick of", lambda c: tx.remove_stopwords(tx.tokenize(c))) == ["quick"]
    assert one(spark, "a  b ", lambda c: tx.remove_stopwords(tx.tokenize(c))) == ["", "b"]
    assert fixed.ENGLISH_STOPWORDS == StopWordsRemover.loadDefaultStopWords("english")


def test_same_as_ml_stages(spark, data):
    docs = spark.read.parquet(f"{data}/documents.parquet")
    ml = Tokenizer(inputCol="text", outputCol="ml").transform(docs)
    ml = StopWordsRemover(inputCol="ml", outputCol="ml_kept").transform(ml)
    ml = NGram(n=3, inputCol="ml", outputCol="ml_grams").transform(ml)
    ours = ml.withColumn("k", tx.tokenize("text"))
    differs = (
        (F.col("ml") != F.col("k"))
        | (F.col("ml_kept") != tx.remove_stopwords("k"))
        | (F.col("ml_grams") != tx.ngrams("k", 3))
    )
    assert ours.where(differs).count() == 0


def test_lengths(spark):
    assert one(spark, "", tx.token_len) == 1
    assert one(spark, "a  b ", tx.token_len) == 4
    assert one(spark, [], tx.token_count, "array<string>") == 1
    df = spark.createDataFrame([(6, 4)], "a int, b int")
    assert df.select(tx.len_ratio(F.col("a"), F.col("b"))).first()[0] == 1.5


def test_term_counts(spark):
    got = one(spark, ["b", "a", "b", ""], tx.term_counts, "array<string>")
    assert [tuple(r) for r in got] == [("", 1), ("a", 1), ("b", 2)]
    assert one(spark, [], tx.term_counts, "array<string>") == []


def overlap(a, b):
    def trimmed(t):
        t = list(t)
        while t and t[-1] == "":
            t.pop()
        return t

    return sum((Counter(trimmed(a)) & Counter(trimmed(b))).values())


def test_common_terms(spark):
    r = random.Random(1)
    rows = [(list("aab"), list("aaabb")), ([""], ["a"]), (["a", ""], ["", ""]), ([], ["a"])]
    for size in (5, 40, 400):
        for _ in range(15):
            a, b = (
                [r.choice(["", *[f"w{i}" for i in range(size // 3 + 2)]]) for _ in range(r.randint(0, size))]
                for _ in "ab"
            )
            rows.append((a, b))
    df = spark.createDataFrame(rows, "a array<string>, b array<string>")
    got = [x[0] for x in df.select(tx.common_terms("a", "b")).collect()]
    assert got == [overlap(a, b) for a, b in rows]
    assert got[0] == 3 and max(got) > tx.FEW_SHARED_TERMS


def test_phrase_hits(spark):
    df = spark.createDataFrame(
        [("a b", "x a b", "a b y"), ("a b", "x", "a b"), ("", "x", "y"), ("x", "", "x")],
        "q string, t string, d string",
    )
    assert [r[0] for r in df.select(tx.phrase_hits("q", "t", "d")).collect()] == [2, 1, 0, 0]


def test_numbers(spark):
    df = spark.createDataFrame([("2.67",), ("x",), (None,)], "r string")
    got = df.select(tx.to_double("r"), tx.to_int(tx.to_double("r"))).collect()
    assert [tuple(r) for r in got] == [(2.67, 2), (None, None), (None, None)]


def test_functions_on_a_stream(spark, data, tmp_path):
    docs = spark.read.parquet(f"{data}/documents.parquet")
    docs.select("doc_id", "text").repartition(2).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("doc_id bigint, text string").parquet(str(tmp_path / "in"))
    words = stream.select("doc_id", tx.remove_stopwords(tx.tokenize(tx.clean("text"))).alias("w"))
    run = words.writeStream.format("memory").queryName("words_out").start()
    run.processAllAvailable()
    run.stop()
    assert spark.table("words_out").count() == docs.count()
