"""CSV files read by many tasks (S-4): quoted line breaks across splits, types
from all values as the pandas reader infers them."""

import io
import os
import random

import pandas as pd
import pytest

from hirelens.sources import csvfiles


def rows_of(df):
    return sorted(str(tuple(r)) for r in df.collect())


@pytest.fixture()
def small_splits(spark):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1000")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    yield
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


def random_frame(rng, n):
    pick = lambda: rng.choice(['say "hi"', "two\nlines", 'a "quoted\nbreak", b', "plain", "x,y", "\n\n", "long " * 120 + "\n" + "end " * 90, "é\r\nü", "q"])
    return pd.DataFrame({"ID": [str(i) for i in range(n)], "a": [pick() for _ in range(n)], "b": [pick() for _ in range(n)]})


@pytest.mark.parametrize("seed", [1, 2])
def test_one_file_is_read_by_several_tasks(spark, tmpdir_path, small_splits, seed):
    path = os.path.join(tmpdir_path, "one.csv")
    want = random_frame(random.Random(seed), 60)
    want.to_csv(path, index=False)
    assert spark.read.text(path).rdd.getNumPartitions() > 5
    got = csvfiles.read_csv(spark, path, "ID string, a string, b string", null_tokens=[])
    assert rows_of(got) == sorted(str(tuple(r)) for r in want.itertuples(index=False, name=None))
    places = [r["ID"] for r in csvfiles.csv_text(spark, path, with_place=True).orderBy("at").collect()]
    assert places == list(want["ID"])


def test_files_without_line_breaks_run_no_python(spark, tmpdir_path, small_splits):
    path = os.path.join(tmpdir_path, "plain.csv")
    want = pd.DataFrame({"ID": range(200), "a": [f'"{i}", x' for i in range(200)]})
    want.to_csv(path, index=False)
    got = csvfiles.csv_text(spark, path)
    assert "MapInPandas" not in got._jdf.queryExecution().toString()
    assert rows_of(got) == sorted(str((str(i), f'"{i}", x')) for i in range(200))


TYPED = {
    "whole": ["1", " 2 ", "007", "+5"], "missing": ["1", "", "3", "NA"], "large": ["1", "99999999999999999999", "3", "4"],
    "decimal": ["1", "2.5", "NA", "1e5"], "endless": ["inf", "-Infinity", "+inf", "1"], "truth": ["True", "FALSE", "true", "false"],
    "some_truth": ["True", "", "False", "NA"], "mixed_truth": ["True", "1", "False", "0"], "text": ["x", "1", "2.5", "True"],
    "none": ["", "NA", "nan", "null"], "hex": ["0x10", "1", "2", "3"], "dots": [".5", "5.", "-1.", "0"], "large_decimal": ["1.5", "99999999999999999999", "3", "4"],
    "date": ["2024-01-01", "2024-01-02", "NA", ""],
}


def test_types_are_those_of_the_pandas_reader(spark, tmpdir_path):
    path = os.path.join(tmpdir_path, "typed.csv")
    pd.DataFrame(TYPED).to_csv(path, index=False)
    want = pd.read_csv(path, float_precision="round_trip")
    got = csvfiles.read_csv(spark, path)
    names = {"int64": "bigint", "float64": "double", "bool": "boolean", "object": "string"}
    expected = {c: names[str(t)] for c, t in want.dtypes.items()} | {"some_truth": "boolean"}  # there: objects
    assert dict(got.dtypes) == expected
    back = got.toPandas()
    for c in want.columns:
        assert sorted(back[c].astype(str).str.replace("None", "nan")) == sorted(want[c].astype(str)), c


def test_types_follow_all_values(spark, tmpdir_path, small_splits):
    path = os.path.join(tmpdir_path, "late.csv")
    pd.DataFrame({"a": [str(i) for i in range(900)] + ["late"], "b": [str(i) for i in range(900)] + ["0.5"]}).to_csv(path, index=False)
    assert csvfiles.read_csv(spark, path).dtypes == [("a", "string"), ("b", "double")]


def test_edges(spark, tmpdir_path):
    def read(text, name, **kw):
        path = os.path.join(tmpdir_path, name)
        with open(path, "w", newline="") as f:
            f.write(text)
        return csvfiles.read_csv(spark, path, **kw)
    assert read("", "empty.csv").columns == []
    assert read("a,b\n", "head.csv").collect() == [] and read("a,b\n", "head2.csv").columns == ["a", "b"]
    assert rows_of(read('a,b\r\n1,"x\r\ny"\r\n\r\n2,z\r\n', "crlf.csv")) == ["(1, 'x\\r\\ny')", "(2, 'z')"]
    assert rows_of(read('"a,1","b"\n1,2\n', "quoted.csv")) == ["(1, 2)"]
    assert read('a,b\n1,"never closed\n2,x\n', "open.csv").count() == 1
    assert rows_of(read("a,b\n1\n2,3,4\n", "ragged.csv", schema="a string, b string")) == ["('1', None)", "('2', '3')"]
    assert rows_of(read("a,b\nx,2024-02-30\n3,2024-02-28\n", "cast.csv", schema="a int, b date")) == [
        "(3, datetime.date(2024, 2, 28))", "(None, None)"]
    with pytest.raises(ValueError):
        csvfiles.read_csv(spark, [os.path.join(tmpdir_path, "head.csv"), os.path.join(tmpdir_path, "quoted.csv")])


def test_meet_of_all_kinds():
    L, D, B, X, N, G = csvfiles.LONG, csvfiles.DOUBLE, csvfiles.BOOLEAN, csvfiles.TEXT, csvfiles.NULL, csvfiles.LARGE
    for bits in range(64):
        values = [v for b, v in ((L, "7"), (D, "1.5"), (B, "True"), (X, "x"), (N, ""), (G, "99999999999999999999")) if bits & b]
        if not values:
            continue
        kind = str(pd.read_csv(io.StringIO("a,b\n" + "\n".join(f"{v},1" for v in values)))["a"].dtype)
        want = {"int64": "bigint", "float64": "double", "bool": "boolean", "object": "string"}[kind]
        assert csvfiles.meet(bits) == ("boolean" if bits == B | N else want), values
