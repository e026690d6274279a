"""Steps that must not grow faster than their input."""

import os

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from hirelens import operators as O
from hirelens.operators import joins
from hirelens.plans import daystates, models, registry
from hirelens.schemas import CLEAN_SCHEMA
from hirelens.sources import csvfiles, fixtures, loads


def test_neighbouring_keys_share_a_row(spark, monkeypatch):
    """10,000 whole numbers are few rows, so they are broadcast; keys that only
    look like numbers, texts and null match themselves alone."""
    monkeypatch.setattr(joins, "BROADCAST_MAX_ROWS", 500)
    ids = [str(i) for i in range(-5_000, 5_000)] + ["007", "+7", " 7", "7.0", "-0", "#0", "=7", "x", "", "9" * 30, None, "63", "64"]
    new = spark.createDataFrame([(i,) for i in ids], "ID string")
    held = [str(i) for i in range(-5_000, 5_000, 3)] + ["07", "-0", "=x", "", None, "9" * 30, "x "]
    stored = spark.createDataFrame([(i,) for i in held], "ID string")
    for null_safe in (True, False):
        out = O.anti_join_new(new, stored, "ID", null_safe=null_safe)
        assert "LEFT ANTI" not in out._jdf.queryExecution().toString() and "BroadcastHashJoin" in out._jdf.queryExecution().executedPlan().toString()
        want = [i for i in ids if (i not in held if i is not None else not null_safe)]
        assert sorted(map(str, (r.ID for r in out.collect()))) == sorted(map(str, want))


@pytest.mark.parametrize("kind", ["bigint", "date", "decimal(5,1)"])
def test_keys_of_other_types(spark, kind):
    def keys(values):
        text = spark.createDataFrame([(v,) for v in values], "v string")
        n = F.col("v").cast("int")
        return text.select((F.date_add(F.lit("2020-01-01").cast("date"), n) if kind == "date" else n.cast(kind)).alias("ID"), "v")
    out = O.anti_join_new(keys(["1", "2", "2", "-64", None]), keys(["2", "64", None]), "ID")
    assert sorted(r.v for r in out.collect()) == ["-64", "1"]


def test_first_load_compares_with_nothing(spark, tmpdir_path, monkeypatch):
    root = os.path.join(tmpdir_path, "store")
    batch = spark.createDataFrame([("1",), ("1",), (None,)], "ID string")
    monkeypatch.setattr(loads, "anti_join_new", lambda *a: pytest.fail("no other load"))
    assert [loads.load_new(batch, root, "a") for _ in range(2)] == [3, 3]
    monkeypatch.undo()
    assert loads.load_new(batch.union(spark.createDataFrame([("2",)], "ID string")), root, "b") == 1


def test_postings_are_joined_once(spark, monkeypatch):
    from conftest import SF0001
    calls = []
    join = fixtures._joined
    monkeypatch.setattr(fixtures, "_joined", lambda *a: (calls.append(1), join(*a))[1])
    for name in ("q_daily_loads", "q_kept_calls", "q_translate_kept", "q_ingest", "q_ingest_v1", "q_by_city", "q_by_state", "q_int_data", "q_marts"):
        calls.clear()
        plan = registry.QUERIES[name](spark, SF0001)._jdf.queryExecution().optimizedPlan().toString()
        assert len(calls) == 1 and "orders.parquet" not in plan and "o_orderdate" not in plan.split("Join")[0], name


def test_states_of_a_key_are_few(spark, tmpdir_path):
    """IDs come in any order, each with one day: a day's numbers are one run."""
    root = os.path.join(tmpdir_path, "states")
    rows = spark.range(100_000).select(F.xxhash64("id").cast("string").alias("ID"), (F.col("id") % 50).cast("string").alias("DAY"))
    n = daystates.add_load(rows, root, "d", ["DAY"])
    assert n <= 50 + 100_000 // 32_768 + 1  # 200 where every day meets every range
    got = daystates.count_states(daystates.read_states(spark, root, rows.select("DAY").schema), ["DAY"]).collect()
    assert len(got) == 50 and {r.total_jobs for r in got} == {2_000}


def test_links_have_ranges_by_their_size(spark, monkeypatch):
    rows = spark.range(20_000).select(*[(F.col("id") % 15_000).cast("string").alias(f.name) if f.name in ("ID", "URL") else
                                        F.lit(None).cast(f.dataType).alias(f.name) for f in CLEAN_SCHEMA.fields])
    monkeypatch.setattr(models, "RANGE_BYTES", 64 * 1024)
    links = models.job_links(rows)
    assert links.rdd.getNumPartitions() >= 10
    got = [r.ID for r in links.collect()]
    assert got == sorted(got) and len(got) == len(set(got)) == 15_000


def test_records_cut_from_batches_of_any_size():
    lines = ["a,b", '1,"x', "y", 'z"', '2,"q"', '3,"open', "more", 'end"', "4,w", '5,"never']
    rows = [{"file": f, "split": s, "inside": s == 7, "value": v, "odd": v.count('"') % 2}
            for f, s, part in [(1, 0, lines[:6]), (1, 7, lines[6:]), (2, 0, lines[:1]), (2, 5, [])] for v in part]
    want = [(1, 0, 0, "whole", "a,b"), (1, 0, 1, "whole", '1,"x\ny\nz"'), (1, 0, 4, "whole", '2,"q"'), (1, 0, 5, "tail", '3,"open'),
            (1, 7, 0, "head", 'more\nend"'), (1, 7, 2, "whole", "4,w"), (1, 7, 3, "tail", '5,"never'), (2, 0, 0, "whole", "a,b")]
    for size in (1, 2, 3, 100):
        batches = [pa.RecordBatch.from_pylist(rows[i:i + size]) for i in range(0, len(rows), size)]
        assert [tuple(r.values()) for b in csvfiles._cutter()(batches) for r in b.to_pylist()] == want


def test_texts_are_cut_into_words_once(spark):
    from hirelens.operators.skills import scored_terms
    df = spark.createDataFrame([("a", "x y"), ("b", "y z"), ("a", None)], "g string, t string")
    plan = scored_terms(df, "g", "t", min_docs=1)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("split(lower(") == 1


def test_reading_leaves_the_schema_as_it_is(spark, tmpdir_path):
    from hirelens.sources import feed
    folder = os.path.join(tmpdir_path, "feed", "job_category=Data Engineer")
    os.makedirs(folder)
    with open(os.path.join(folder, "a.json"), "w") as f:
        f.write('{"id": "1"}')
    names = list(feed.LANDED_JSON_SCHEMA.names)
    assert [feed.read_landed_json(spark, os.path.dirname(folder)).columns[-1] for _ in range(2)] == ["job_category"] * 2
    assert feed.LANDED_JSON_SCHEMA.names == names
