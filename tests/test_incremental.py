"""State kept between runs: dictionaries (U-2, U-3, F-28), day states (A-3,
A-5, M-9), and landed records with their rejects (S-1)."""

import collections
import json
import os

import pytest
from pyspark.sql import functions as F

from hirelens.plans import daystates, enrich
from hirelens.sources import feed


def test_kept_dictionary_calls_only_what_it_has_no_answer_for(spark, tmpdir_path):
    root, calls = os.path.join(tmpdir_path, "kept"), spark.sparkContext.accumulator(0)
    broken = {"b"}

    def fn(values):
        if values.isin(list(broken)).any():
            raise ValueError("down")
        calls.add(len(values))
        return values + "!"
    rows = lambda *v: spark.createDataFrame([(x, None) for x in v], "a string, z string")
    known, called, failed = enrich.kept_dictionary(rows("a", "b", "a", None), ["a", "z"], fn, root)
    assert (called, failed, calls.value) == (2, 1, 1)
    assert sorted(map(tuple, known.collect())) == [("a", "a!")]
    _, called, failed = enrich.kept_dictionary(rows("a", "b", "c"), ["a"], fn, root)  # the failed one again, and what is new
    assert (called, failed, calls.value) == (2, 1, 2)
    broken.clear()
    known, called, failed = enrich.kept_dictionary(rows("a", "b", "c"), ["a"], fn, root)
    assert (called, failed, calls.value) == (1, 0, 3)
    known, called, _ = enrich.kept_dictionary(rows("a", "b", "c", "c"), ["a"], fn, root)  # nothing is called
    assert (called, calls.value) == (0, 3)
    assert sorted(map(tuple, known.collect())) == [("a", "a!"), ("b", "b!"), ("c", "c!")]


def test_translation_with_a_store(spark, tmpdir_path):
    df = spark.createDataFrame([("1", "sydney", "", "nan", None), ("2", "perth", "NA", " na ", "perth"), ("3", None, "bad", "x", "y")],
                               "ID string, CITY string, STATE string, ORGANIZATION string, SENIORITY string")

    def fn(values):
        if (values == "bad").any():
            raise ValueError
        return values.str.upper()
    for variant, want in (("v2", [("1", "SYDNEY", "NA", "NA", None), ("2", "PERTH", "NA", "NA", "PERTH"), ("3", None, "bad", "X", "Y")]),
                          ("v1", [("1", "SYDNEY", "NA", "NAN", "NA"), ("2", "PERTH", "NA", " NA ", "PERTH"), ("3", "NA", "NA", "X", "Y")])):
        for store in (None, os.path.join(tmpdir_path, variant)):
            got = enrich.translate_columns(df, variant=variant, translator=fn, store=store)
            assert sorted(map(tuple, got.collect())) == want


def test_day_states_are_exact_over_any_loads(spark, tmpdir_path):
    root, schema = os.path.join(tmpdir_path, "states"), "CAT string, DAY string, ID string"
    days = {"d1": [("x", "1", "a"), ("x", "1", "b"), ("y", "1", "a"), ("x", "1", None), ("z", "1", None)],
            "d2": [("x", "2", "b"), ("x", "2", "c"), (None, "2", "a")] + [("w", "2", f"id{i}") for i in range(40_000)],
            "d3": [("x", "3", "a"), ("w", "3", "id7"), ("w", "3", "new")]}

    def counts(keys, chosen):
        rows = [dict(zip(("CAT", "DAY", "ID"), r)) for d in chosen for r in days[d]]
        ids = collections.defaultdict(set)
        for r in rows:
            ids[tuple(r[k] for k in keys)].update({r["ID"]} - {None})
        return {k: len(v) for k, v in ids.items()}
    for load in ("d1", "d2", "d1", "d3", "d2"):  # some again
        daystates.add_load(spark.createDataFrame(days[load], schema), root, load, ["CAT", "DAY"])
    states = daystates.read_states(spark, root, spark.createDataFrame([], "CAT string, DAY string").schema)
    for keys in (["CAT"], ["CAT", "DAY"]):
        for chosen in (["d1"], ["d1", "d3"], list(days)):
            got = daystates.count_states(states.where(F.col("LOAD_DATE").isin(chosen)), keys).collect()
            assert {tuple(r)[:-1]: r.total_jobs for r in got} == counts(keys, chosen)
    numbers = spark.read.parquet(f"{root}/ids")
    assert numbers.count() == numbers.select("n").distinct().count() == 40_004
    assert numbers.agg(F.max("n")).first()[0] == 40_003  # dense
    days["d3"] = [("x", "3", "q")]  # a changed batch replaces its own states
    daystates.add_load(spark.createDataFrame(days["d3"], schema), root, "d3", ["CAT", "DAY"])
    states = daystates.read_states(spark, root, spark.createDataFrame([], "CAT string, DAY string").schema)
    got = daystates.count_states(states, ["CAT"]).collect()
    assert {tuple(r)[:-1]: r.total_jobs for r in got} == counts(["CAT"], days)


def test_adding_a_day_reads_no_other_days_states(spark, tmpdir_path, monkeypatch):
    root, schema = os.path.join(tmpdir_path, "states"), "CAT string, ID string"
    plans = []
    write = daystates.write_load
    monkeypatch.setattr(daystates, "write_load", lambda df, *a: (plans.append(df._jdf.queryExecution().toString()), write(df, *a))[1])
    for load in ("d1", "d2"):
        daystates.add_load(spark.createDataFrame([("x", load)], schema), root, load, ["CAT"])
    assert len(plans) == 2 and all("/ids" in p and "/states/LOAD_DATE" not in p and "bits#" not in p.split("Relation")[-1] for p in plans)


def test_landed_records_and_rejects(spark, tmpdir_path):
    root = os.path.join(tmpdir_path, "landing")
    os.makedirs(os.path.join(root, "job_category=Data Engineer"))
    lines = [json.dumps({"id": "1", "title": "t", "employment_type": ["FULL_TIME"]}), "{broken", "", "[1]", "5", json.dumps({"title": "no id"}),
             json.dumps({"id": "2", "employment_type": 5}), json.dumps({"id": None}), json.dumps({"id": "3", "unknown": {"a": 1}}), "   "]
    with open(os.path.join(root, "job_category=Data Engineer", "a.json"), "w") as f:
        f.write("\n".join(lines))
    landed = feed.land_json(spark, root)
    assert landed.counts == {"records": 8, "malformed": 1, "not an object": 2, "wrong type": 1, "no id": 2}
    assert sorted(r.id for r in landed.rows.collect()) == ["1", "3"]
    assert sorted(map(tuple, landed.rejects.select("record", "reason").collect())) == sorted(
        [("{broken", "malformed"), ("[1]", "not an object"), ("5", "not an object"), (lines[5], "no id"), (lines[6], "wrong type"), (lines[7], "no id")])
    assert landed.rows.columns == [*feed.LANDED_JSON_SCHEMA.fieldNames(), "job_category"]


def test_merged_schema(spark):
    texts = ['{"a": 1, "b": {"c": "x", "d": [1, 2]}}', '{"a": 2.5, "b": {"c": 3}, "e": true}', '{"b": {"f": null}, "l": [{"m": 1}, {"n": "z"}]}',
             "[1, 2]", "no json", None, '"text"', "{}"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, j string")
    assert feed.merged_json_schema(df, "j").simpleString() == (
        "struct<a:double,b:struct<c:string,d:array<bigint>,f:string>,e:boolean,l:array<struct<m:bigint,n:string>>>")
    flat = feed.flatten_json(df, "j")
    assert flat.columns == ["id", "j.a", "j.b.c", "j.b.d", "j.b.f", "j.e", "j.l"]
    got = {r[0]: tuple(r)[1:6] for r in flat.collect()}
    assert got[0] == (1.0, "x", [1, 2], None, None) and got[1] == (2.5, "3", None, None, True)
    assert all(got[i] == (None,) * 5 for i in (3, 4, 5, 6, 7))
    assert feed.flatten_json(df.where("id > 2"), "j").columns == ["id"]


@pytest.mark.parametrize("name", ["q_marts", "q_job_links"])
def test_plans(spark, name):
    from conftest import SF0001
    from test_plans import live_nodes, shuffles
    from hirelens.plans import models, registry
    df = registry.QUERIES[name](spark, SF0001)
    nodes = live_nodes(df)
    own = [d for d in shuffles(nodes) if "ENSURE_REQUIREMENTS" in d or "range" in d.lower()]
    if name == "q_job_links":
        assert len(shuffles(nodes)) == 1 and "rangepartitioning" in own[0]
        rows = [tuple("~" if v is None else v for v in (r.JOB_CATEGORY, r.ID, r.TITLE)) for r in df.collect()]
        assert rows == sorted(rows)
    else:
        assert sum(n == "Expand" for n, _ in nodes) == 1
        assert sum("lineitem" in d for n, d in nodes if "Scan" in n) == 1
        fact = registry._fact(spark, SF0001)
        for mart, columns in models.MARTS.items():
            want = getattr(models, f"jobs_{mart}")(fact).collect()
            got = models.mart(df, mart).collect()
            assert sorted(map(str, got)) == sorted(str(r) for r in want), mart
