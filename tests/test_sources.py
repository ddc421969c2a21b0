import pytest
from tabsmith.sources.loaders import CSVDataLoader, apply_null_tokens, infer_types


def test_csv_blanks_after_commas_and_null_token(spark, sample_csv):
    df = CSVDataLoader(sample_csv).load(spark)
    assert df.dtypes == [("lot", "bigint"), ("roast", "string"), ("grade", "string")]
    assert sorted(map(tuple, df.collect()), key=str) == [(12, None, "A"), (15, "dark", "A"), (7, "dark", "B"), (7, "dark", "B")]


def test_csv_loader_missing_file(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        CSVDataLoader(str(tmp_path / "does_not_exist.csv")).load(spark)


def test_trailing_blank_token_is_a_value(spark, tmp_path):
    path = tmp_path / "blank.csv"
    path.write_text("a,b\n? ,1\nNA,2\n,3\n\tx\t,4\n", encoding="utf-8")
    df = CSVDataLoader(str(path)).load(spark)
    vals = [r["a"] for r in df.orderBy("b").collect()]
    # '? ' is compared before the strip -> kept as '?'; NA and empty are default tokens
    assert vals == ["?", None, None, "x"]


def test_type_inference_is_strict(spark):
    df = spark.createDataFrame([("1", "1.5", "True", "1d", "yes"), ("2", "2", "false", "2", "no"),
                                (None, None, None, None, None)], "a string, b string, c string, d string, e string")
    out = infer_types(df)
    assert dict(out.dtypes) == {"a": "bigint", "b": "double", "c": "boolean", "d": "string", "e": "string"}


def test_all_null_column_is_double(spark):
    df = spark.createDataFrame([(None,), (None,)], "a string")
    assert dict(infer_types(df).dtypes)["a"] == "double"


def test_null_tokens_only_on_listed_columns(spark):
    df = spark.createDataFrame([("?", "?")], "a string, b string")
    out = apply_null_tokens(df, ["?"], ["a"]).first()
    assert out["a"] is None and out["b"] == "?"
