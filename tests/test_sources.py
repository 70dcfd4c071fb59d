import pytest
from pyspark.ml.feature import CountVectorizerModel, Word2VecModel

from shelfmatch.operators import features as fe
from shelfmatch.sources import tables as so


def write(path, lines):
    path.write_text("\n".join(lines) + "\n", encoding="utf-8")


def test_relevance_csv(spark, tmp_path):
    write(tmp_path / "train.csv", ["id,product_uid,product_title,search_term,relevance", '1,7,"a, ""b""",c,2.33', "2,8,,d,3"])
    write(tmp_path / "product_descriptions.csv", ["product_uid,product_description", "7,long"])
    write(tmp_path / "attributes.csv", ["product_uid,name,value", "7,MFG Brand Name,acme", "7,color,red"])
    train, descriptions, attributes = so.read_relevance_csv(spark, str(tmp_path))
    assert {t for df in (train, descriptions, attributes) for _, t in df.dtypes} == {"string"}
    assert [tuple(r) for r in train.orderBy("id").collect()] == [
        ("1", "7", 'a, "b"', "c", "2.33"),
        ("2", "8", None, "d", "3"),
    ]
    assert attributes.count() == 2 and descriptions.first().product_description == "long"


def test_lines_inside_fields(spark, tmp_path):
    write(tmp_path / "t.csv", ["a,b", '1,"x', 'y"'])
    got = so.read_csv(spark, str(tmp_path / "t.csv"), ["a", "b"], multi_line=True)
    assert [tuple(r) for r in got.collect()] == [("1", "x\ny")]


def test_materialize(spark, tmp_path):
    df = spark.range(10)
    path = str(tmp_path / "out")
    assert so.materialize(df, path).count() == 10
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        so.materialize(df, path)
    assert so.materialize(spark.range(3), path, "overwrite").count() == 3


def test_models_come_back(spark, tmp_path):
    docs = spark.createDataFrame([(["a", "b"],), (["b"],)], "w array<string>")
    model = fe.fit_count_vectors(docs, "w", min_df=1)
    so.save_model(model, str(tmp_path / "cv"))
    so.save_model(model, str(tmp_path / "cv"))
    with pytest.raises(Exception, match="already exists"):
        so.save_model(model, str(tmp_path / "cv"), overwrite=False)
    assert so.load_model(CountVectorizerModel, str(tmp_path / "cv")).vocabulary == model.vocabulary
    words = fe.fit_word2vec(docs, "w", size=4)
    so.save_model(words, str(tmp_path / "w2v"))
    again = so.load_model(Word2VecModel, str(tmp_path / "w2v"))
    a, b = (
        fe.embed_tokens(docs, "w", m, "v").collect() for m in (words, again)
    )
    assert a == b


def test_is_empty(spark):
    assert so.is_empty(spark.range(0)) and not so.is_empty(spark.range(1))


def test_kept_in_the_folder_the_session_names(spark):
    before = spark.conf.get("spark.checkpoint.dir", None)
    if before:
        assert so.shared_folder(spark) == before
    df = so.cut_lineage(spark.range(10).selectExpr("id * 2 AS x"))
    assert "Range" not in df._jdf.queryExecution().toString()
    assert sorted(r.x for r in df.collect()) == list(range(0, 20, 2))
