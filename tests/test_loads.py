"""Rerunnable loads (S-8, S-9, S-14, P-14)."""

import os

import pytest
from pyspark.sql import functions as F

from hirelens.sources import loads

SCHEMA = "ID string, CITY string"


def rows_of(spark, root):
    schema = spark.createDataFrame([], SCHEMA).schema
    return sorted(tuple(r) for r in loads.read_loads(spark, root, schema).collect())


@pytest.fixture()
def batch(spark):
    return lambda *rows: spark.createDataFrame(list(rows), SCHEMA)


def test_a_repeated_load_replaces_its_own_rows_only(spark, tmpdir_path, batch):
    root = os.path.join(tmpdir_path, "store")
    assert rows_of(spark, root) == []
    for _ in range(2):
        assert loads.load_new(batch(("1", "a"), ("2", "b")), root, "2024-01-01") == 2
    assert loads.load_new(batch(("2", "x"), ("3", "c"), (None, "n")), root, "2024-01-02") == 2
    first = [("1", "a", "2024-01-01"), ("2", "b", "2024-01-01")]
    schema = spark.createDataFrame([], SCHEMA).schema
    assert {tuple(r) for r in loads.read_loads(spark, root, schema).collect()} == {*first, ("3", "c", "2024-01-02"), (None, "n", "2024-01-02")}
    loads.load_new(batch(("4", "d"), ("2", "x")), root, "2024-01-02")  # a changed batch
    assert rows_of(spark, root) == first + [("4", "d", "2024-01-02")]
    assert loads.load_new(batch(("4", "d")), root, "2024-01-01") == 0  # no row left
    assert rows_of(spark, root) == [("4", "d", "2024-01-02")]


def test_a_failure_while_writing_changes_nothing(spark, tmpdir_path, batch):
    root = os.path.join(tmpdir_path, "store")
    loads.write_load(batch(("1", "a")), root, "2024-01-01")
    bad = batch(("1", "new"), ("9", "z")).repartition(2).select("ID", F.when(F.col("ID") == "9", F.raise_error(F.lit("lost"))).otherwise(
        F.col("CITY")).cast("string").alias("CITY"))
    with pytest.raises(Exception, match="lost"):
        loads.write_load(bad, root, "2024-01-01")
    assert rows_of(spark, root) == [("1", "a", "2024-01-01")]
    loads.write_load(batch(("1", "new"), ("9", "z")), root, "2024-01-01")
    assert rows_of(spark, root) == [("1", "new", "2024-01-01"), ("9", "z", "2024-01-01")]


def test_a_failure_after_the_write_is_mended_by_a_rerun(spark, tmpdir_path, batch, monkeypatch):
    root = os.path.join(tmpdir_path, "store")

    def lost(*_a, **_k):
        raise RuntimeError("driver lost between write and end")
    with monkeypatch.context() as m:
        m.setattr(loads, "int", lost, raising=False)  # the count behind the write
        with pytest.raises(RuntimeError):
            loads.load_new(batch(("1", "a"), ("2", "b")), root, "2024-01-01")
    assert loads.load_new(batch(("1", "a"), ("2", "b")), root, "2024-01-01") == 2
    assert rows_of(spark, root) == [("1", "a", "2024-01-01"), ("2", "b", "2024-01-01")]


def test_columns_are_checked_and_partitions_pruned(spark, tmpdir_path, batch):
    root = os.path.join(tmpdir_path, "store")
    loads.write_load(batch(("1", "a")), root, "2024-01-01")
    with pytest.raises(ValueError):
        loads.write_load(batch(("1", "a")).select("CITY", "ID"), root, "2024-01-02")
    other = loads.read_loads(spark, root, batch().schema).where("LOAD_DATE <> '2024-01-01'")
    assert other._jdf.queryExecution().executedPlan().toString().count("LOAD_DATE") and other.count() == 0
    table = loads.load_table(spark, root, "loads_test")
    loads.write_load(batch(("2", "b")), root, "2024-01-02")
    assert loads.load_table(spark, root, "loads_test").count() == 2 and table.columns == ["ID", "CITY", "LOAD_DATE"]
    spark.sql("DROP TABLE loads_test")
