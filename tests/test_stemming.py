import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from shelfmatch.functions import stemming
from shelfmatch.functions.stemming import porter, stem_tokens

GOLDEN = """
caresses caress ponies poni ties ti cats cat feed feed agreed agre plastered plaster bled bled
motoring motor sing sing conflated conflat troubled troubl sized size hopping hop tanned tan
falling fall hissing hiss fizzed fizz failing fail filing file happy happi sky sky
relational relat conditional condit rational ration valenci valenc hesitanci hesit
digitizer digit conformabli conform radicalli radic differentli differ vileli vile
analogousli analog vietnamization vietnam predication predic operator oper feudalism feudal
decisiveness decis hopefulness hope callousness callous formaliti formal sensitiviti sensit
sensibiliti sensibl triplicate triplic formative form formalize formal electriciti electr
electrical electr hopeful hope goodness good revival reviv allowance allow inference infer
airliner airlin gyroscopic gyroscop adjustable adjust defensible defens irritant irrit
replacement replac adjustment adjust dependent depend adoption adopt homologou homolog
communism commun activate activ angulariti angular homologous homolog effective effect
bowdlerize bowdler probate probat rate rate cease ceas controll control roll roll
""".split()


@pytest.mark.parametrize("word, stem", list(zip(GOLDEN[::2], GOLDEN[1::2])))
def test_porter_words(word, stem):
    assert porter(word) == stem


def test_porter_lists(spark):
    rows = [(1, None), (2, []), (3, ["cats", None, "running", ""]), (4, ["cats"])]
    df = spark.createDataFrame(rows, "id int, w array<string>").repartition(1)
    got = dict(df.select("id", stem_tokens("w")).collect())
    assert got == {1: None, 2: [], 3: ["cat", None, "run", ""], 4: ["cat"]}


def test_plural_rules(spark):
    df = spark.createDataFrame([(["parties", "lenses", "cats", "glass", "bus", "movies"],)], "w array<string>")
    assert df.select(stem_tokens("w", "plural")).first()[0] == [
        "party", "lense", "cat", "glass", "bus", "movy",
    ]


def test_filter_on_stems_above_a_join(spark):
    a = spark.createDataFrame([(i, ["cats", "dogs"]) for i in range(50)], "id int, w array<string>")
    b = spark.createDataFrame([(i, ["cat", "mice"]) for i in range(50)], "id int, v array<string>")
    joined = a.join(b.hint("merge"), "id").select("id", stem_tokens("w").alias("s"), stem_tokens("v").alias("t"))
    assert joined.where(F.size(F.array_intersect("s", "t")) == 1).count() == 50


def test_stems_remembered_are_bounded(monkeypatch):
    monkeypatch.setattr(stemming, "MOST_KNOWN", 5)
    words = [f"word{i}s" for i in range(20)] + ["cats"] * 3
    known = {}
    for _ in range(2):
        got = stemming._stem_lists(pa.array([words, None, ["cats"]], pa.list_(pa.string())), known)
        assert got.to_pylist() == [[porter(w) for w in words], None, ["cat"]]
    assert len(known) <= 5
