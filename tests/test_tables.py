import pytest
from pyspark.sql import types as T

from riskframe.errors import DataLoadError
from riskframe.sources.sinks import read_json, write_json
from riskframe.sources.tables import load_table


def put(folder, name, text):
    path = folder / name
    path.write_text(text)
    return str(path)


def test_reads_csv_with_types(spark, tmp_path):
    df = load_table(spark, put(tmp_path, "t.csv", "a,b,c,d,e\n1,1.5,x,True,\n2,NA,y,False,\n"))
    assert [f.dataType for f in df.schema.fields] == [
        T.LongType(), T.DoubleType(), T.StringType(), T.BooleanType(), T.DoubleType()]
    assert [tuple(r) for r in df.orderBy("a").collect()] == [
        (1, 1.5, "x", True, None), (2, None, "y", False, None)]


def test_pinned_schema_skips_inference(spark, tmp_path):
    path = put(tmp_path, "t.csv", "a,b\n1,3\n2,4\n")
    df = load_table(spark, path, schema=T.StructType([
        T.StructField("a", T.StringType()), T.StructField("b", T.DoubleType())]))
    assert sorted(map(tuple, df.collect())) == [("1", 3.0), ("2", 4.0)]


def test_reader_options_pass_through(spark, tmp_path):
    assert load_table(spark, put(tmp_path, "t.csv", "a;b\n1;3\n"), sep=";").columns == ["a", "b"]


def test_folder_of_part_files(spark, tmp_path):
    put(tmp_path, "1.csv", "a,b\n1,3\n")
    put(tmp_path, "2.csv", "a,b\n2,4\n")
    assert load_table(spark, str(tmp_path)).count() == 2


def test_short_rows_are_filled_and_long_rows_fail(spark, tmp_path):
    short = load_table(spark, put(tmp_path, "short.csv", "a,b\n1,2\n3\n"))
    assert sorted(map(tuple, short.collect())) == [(1, 2), (3, None)]
    with pytest.raises(DataLoadError):
        load_table(spark, put(tmp_path, "long.csv", "a,b\n1,2\n3,4,5\n"))


@pytest.mark.parametrize("text", ["", "a,b\n"])
def test_nothing_in_the_file(spark, tmp_path, text):
    with pytest.raises(DataLoadError):
        load_table(spark, put(tmp_path, "e.csv", text))


def test_missing_path(spark, tmp_path):
    with pytest.raises(DataLoadError):
        load_table(spark, str(tmp_path / "no.csv"))
    with pytest.raises(DataLoadError):
        load_table(spark, str(tmp_path / "no.parquet"), "parquet")


def test_nan_becomes_null(spark, tmp_path):
    spark.createDataFrame([(1.0,), (float("nan"),)], "x double").write.parquet(str(tmp_path / "p"))
    df = load_table(spark, str(tmp_path / "p"), "parquet")
    assert df.where("x is null").count() == 1


def test_json_document(spark, tmp_path):
    write_json(spark, {"a": [1, 2], "b": None}, str(tmp_path / "doc"))
    assert read_json(spark, str(tmp_path / "doc")) == {"a": [1, 2], "b": None}


def test_number_suffixes_stay_text(spark, tmp_path):
    (tmp_path / "t.csv").write_text("a,b,c\n12d,1e3,0x1F\n7f,-.5,3\n1D,+2.,4\n")
    df = load_table(spark, str(tmp_path / "t.csv"))
    assert dict(df.dtypes) == {"a": "string", "b": "double", "c": "string"}
    assert [r["a"] for r in df.collect()] == ["12d", "7f", "1D"]
