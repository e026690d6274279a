"""Sources and sinks: CSV round trip, landed JSON, flattening, sheets,
CSV blocks in free text, ingest end to end and its streaming form."""

import csv
import io
import json
import os

import pandas as pd
import pytest
from pyspark.sql import functions as F

from hirelens.plans import ingest as I
from hirelens.schemas import CLEAN_COLUMNS
from hirelens.sources import csvfiles, feed, sheets, textblock


def test_csv_round_trip_and_null_tokens(spark, tmpdir_path):
    df = spark.createDataFrame(
        [("1", 'say "hi", ok', "line1\nline2"), ("2", "NA", None), ("3", "", "nan")],
        "ID string, a string, b string")
    path = os.path.join(tmpdir_path, "out")
    feed.write_csv(df, path)
    back = csvfiles.read_csv(spark, path, "ID string, a string, b string")
    got = sorted(tuple(r) for r in back.collect())
    assert got == [("1", 'say "hi", ok', "line1\nline2"), ("2", None, None), ("3", None, None)]
    kept = csvfiles.read_csv(spark, path, "ID string, a string, b string", null_tokens=[])
    assert sorted(tuple(r) for r in kept.collect())[1] == ("2", "NA", None)


def test_column_selection(spark):
    df = spark.createDataFrame([(1, 2)], "id int, title int")
    up = feed.upper_columns(df)
    assert up.columns == ["ID", "TITLE"]
    assert feed.select_tolerant(up, ["TITLE", "MISSING", "ID"]).columns == ["TITLE", "ID"]
    try:
        feed.select_strict(up, ["ID", "MISSING"])
        raise AssertionError("strict select must fail on a missing column")
    except Exception as e:
        assert "MISSING" in str(e)


def test_union_aligned(spark):
    a = spark.createDataFrame([(1, "x")], "ID int, A string")
    b = spark.createDataFrame([(2, "y")], "ID int, B string")
    got = sorted(tuple(r) for r in feed.union_aligned([a, b]).collect())
    assert got == [(1, "x", None), (2, None, "y")]


def test_flatten_structs(spark):
    df = spark.createDataFrame([(1, (2, (3, "z")), [1, 2])],
                               "id int, a struct<b:int, c:struct<d:int, e:string>>, l array<int>")
    flat = feed.flatten_structs(df)
    assert flat.columns == ["id", "a.b", "a.c.d", "a.c.e", "l"]
    assert tuple(flat.collect()[0]) == (1, 2, 3, "z", [1, 2])


def _landed_posting(i, title, city, region):
    return {"id": str(i), "title": title, "date_created": "2025-02-03T09:00:00",
            "organization": "Org", "url": f"https://x/{i}", "seniority": "Associate",
            "linkedin_org_size": "51-200 employees", "employment_type": ["FULL_TIME", "PART_TIME"],
            "locations_raw": [{"@type": "Place", "address": {"addressLocality": city,
                                                             "addressRegion": region,
                                                             "streetAddress": None}}]}


def _land(root):
    os.makedirs(os.path.join(root, "job_category=Data Engineer"))
    os.makedirs(os.path.join(root, "job_category=Data Analyst"))
    with open(os.path.join(root, "job_category=Data Engineer", "a.json"), "w") as f:
        f.write(json.dumps(_landed_posting(1, "Senior Data Engineer", "Sídney", "NSW")) + "\n")
        f.write(json.dumps(_landed_posting(2, "Metadata Analyst", "Perth", "WA")) + "\n")
        f.write("{broken json\n")
    with open(os.path.join(root, "job_category=Data Analyst", "b.json"), "w") as f:
        f.write(json.dumps(_landed_posting(3, "Junior Data Analyst", "Perth", "WA")) + "\n")


def test_landed_json_ingest(spark, tmpdir_path):
    root = os.path.join(tmpdir_path, "landing")
    _land(root)
    raw = feed.read_landed_json(spark, root)
    assert raw.count() == 4  # malformed record kept as nulls (PERMISSIVE)
    out = I.ingest(raw, None)
    assert out.columns == CLEAN_COLUMNS
    got = {r.ID: r for r in out.collect()}
    assert sorted(got) == ["1", "3"]  # title filter drops 'Metadata Analyst' and the broken row
    assert got["1"].CITY == "Sydney" and got["1"].STATE == "NSW"
    assert got["1"].EMPLOYMENT_TYPE == "FULL_TIME, PART_TIME" and got["1"].ORG_SIZE == "51-200"
    assert got["3"].JOB_CATEGORY == "Data Analyst"
    # second run against the stored rows appends nothing (idempotent)
    again = I.ingest(raw, out)
    assert again.count() == 0


def test_streaming_ingest(spark, tmpdir_path):
    from hirelens.streaming import start_ingest_stream
    root = os.path.join(tmpdir_path, "landing")
    _land(root)
    target = os.path.join(tmpdir_path, "clean")
    q = start_ingest_stream(spark, root, target, os.path.join(tmpdir_path, "chk"))
    q.awaitTermination(120)
    first = spark.read.parquet(target)
    assert sorted(r.ID for r in first.collect()) == ["1", "3"]
    # a new file with one known and one new posting: only the new one lands
    with open(os.path.join(root, "job_category=Data Engineer", "c.json"), "w") as f:
        f.write(json.dumps(_landed_posting(1, "Senior Data Engineer", "Perth", "WA")) + "\n")
        f.write(json.dumps(_landed_posting(4, "Lead Data Scientist", "Perth", "WA")) + "\n")
    q = start_ingest_stream(spark, root, target, os.path.join(tmpdir_path, "chk"))
    q.awaitTermination(120)
    assert sorted(r.ID for r in spark.read.parquet(target).collect()) == ["1", "3", "4"]


def test_sheets_first_per_description(spark, tmpdir_path):
    folder = os.path.join(tmpdir_path, "sheets")
    os.makedirs(folder)
    pd.DataFrame({"Job_Title": ["Data Analyst", "Data Analyst", "Data Engineer"],
                  "Job_Description": ["SQL and Python", "SQL and Python", "Spark, Airflow"]}
                 ).to_csv(os.path.join(folder, "s1.csv"), index=False)
    pd.DataFrame({"Job_Title": ["Data Analyst"], "Job_Description": ["Excel, communication"]}
                 ).to_csv(os.path.join(folder, "s2.csv"), index=False)
    pd.DataFrame({"Job_Title": ["x"], "Job_Description": ["master"]}).to_csv(
        os.path.join(folder, "master.csv"), index=False)
    df = sheets.read_sheets(spark, folder, master="master.csv")
    assert df.count() == 3
    from hirelens.plans.enrich import top_job_skills
    top = {r.job_title: tuple(r)[1:] for r in top_job_skills(df).collect()}
    assert top["Data Analyst"] == ("excel, python, sql", "communication")  # one description each: ties by name
    assert top["Data Engineer"] == ("airflow, spark", "")
    assert top["Data Scientist"] == ("", "")


def test_sheets_by_name_in_workbook_order(spark, tmpdir_path):
    folder = os.path.join(tmpdir_path, "book")
    for sub in ("x", "y"):
        os.makedirs(os.path.join(folder, sub))
    write = lambda path, **cols: pd.DataFrame(cols).to_csv(os.path.join(folder, path), index=False)
    write("sheet_1.csv", Job_Title=["m"], Job_Description=["master"])
    write("sheet_2.csv", Job_Description=["d2", "d2", "line\nbreak"], Job_Title=["t2", "t2b", "t3"])
    write("x/sheet_3.csv", Job_Title=["t3"], Job_Description=["d3"], Extra=["e"])
    write("y/sheet_3.csv", Job_Title=["t3y"], Job_Description=["d3"])
    write("sheet_10.csv", Job_Title=["t10"], Job_Description=["d10"])
    got = [(r.sheet_no, r.Job_Title, r.Job_Description, r.Extra) for r in sheets.later_first(sheets.read_sheets(spark, folder)).collect()]
    assert got == [(4, "t10", "d10", None), (3, "t3y", "d3", None), (2, "t3", "d3", "e"), (1, "t2", "d2", None), (1, "t3", "line\nbreak", None)]
    listed = [os.path.join(folder, "sheet_10.csv"), os.path.join(folder, "sheet_2.csv")]
    assert [r.Job_Title for r in sheets.read_sheets(spark, listed, skip=1).collect()] != ["t10"]
    assert {r.Job_Title for r in sheets.read_sheets(spark, listed, skip=0).collect()} == {"t10", "t2", "t3"}


def test_malformed_records_are_counted(spark, tmpdir_path):
    from hirelens.sources.feed import corrupt_counts
    folder = os.path.join(tmpdir_path, "feed", "job_category=Data Engineer")
    os.makedirs(folder)
    with open(os.path.join(folder, "a.json"), "w") as f:
        f.write(json.dumps(_landed_posting(1, "Data Engineer", "Perth", "WA")) + "\n{broken\n")
    got = corrupt_counts(spark, os.path.dirname(folder)).collect()
    assert [(r.job_category, r.records, r.malformed) for r in got] == [("Data Engineer", 2, 1)]


def test_arrays_print_as_python_lists(spark):
    import re
    from hirelens import functions as HF
    from hirelens import rules
    from hirelens.sources.feed import places_text
    names = ["Perth", "O'Connor", 'a "b"', "it's \"x\"", "back\\slash", "tab\tnl\n", None, ""]
    places = [[{"@type": "Place", "address": {"addressLocality": n, "addressRegion": r, "streetAddress": None}}]
              for n in names for r in ("WA", "O'x", None)] + [None, [], [None]]
    df = spark.createDataFrame([(i, p) for i, p in enumerate(places)],
                               "i int, p array<struct<`@type`:string,address:struct<addressLocality:string,addressRegion:string,streetAddress:string>>>")
    text = places_text("p")
    got = df.select("i", text.alias("t"), HF.city_from_locations(text).alias("c")).orderBy("i").collect()
    for r, p in zip(got, places):
        want = None if p is None else str(p)
        assert r.t == want
        m = re.search(rules.CITY_TEXT_PATTERN, want or "")
        assert r.c == (m[1] if m else None)
    lists = [["FULL_TIME", None], ["A", "B"], [], None]
    e = spark.createDataFrame([(i, x) for i, x in enumerate(lists)], "i int, e array<string>")
    assert [r[0] for r in e.orderBy("i").select(HF.employment_type_from_array("e")).collect()] == ["FULL_TIME, None", "A, B", "", "nan"]


def test_only_the_failing_value_gets_the_default(spark):
    from hirelens.plans.enrich import apply_to_distinct, translate_columns
    calls = []

    def fn(s):
        if (s == "bad").any():
            raise ValueError(calls)
        return s.str.upper()
    df = spark.createDataFrame([("a",), ("bad",), ("c",), ("a",), (None,)], "v string").coalesce(1)
    got = {r.value: (r.out, r.failed) for r in apply_to_distinct(df, "v", fn, "out", default="none").collect()}
    assert got == {"a": ("A", False), "bad": ("none", True), "c": ("C", False)}
    two = spark.createDataFrame([("a", "bad"), ("", None), ("na", "c")], "CITY string, STATE string")
    kept = [tuple(r) for r in translate_columns(two, ["CITY", "STATE"], variant="v2", translator=fn).collect()]
    assert sorted(kept, key=str) == sorted([("A", "bad"), ("NA", None), ("NA", "C")], key=str)
    v1 = [tuple(r) for r in translate_columns(two, ["CITY", "STATE"], variant="v1", translator=fn).collect()]
    assert sorted(v1, key=str) == sorted([("A", "NA"), ("NA", "NA"), ("NA", "C")], key=str)


def py_csv_block(text, prefix="job_title", n=3):
    """Brute force with Python's own line splitting and csv module."""
    lines = text.strip().splitlines()
    hdr = next((i for i, l in enumerate(lines) if l.lower().startswith(prefix)), None)
    block = lines[hdr:hdr + n + 1] if hdr is not None else lines
    body = [l for l in block[1:] if l.strip()]
    return [tuple((r + [None] * 3)[:3]) for r in csv.reader(io.StringIO("\n".join(body)))]


def test_csv_block_matches_python(spark):
    texts = [
        "Sure! Here it is:\njob_title,Top 5 Technical Skills,Top 5 Soft Skills\n"
        'Data Analyst,"SQL, Excel",Communication\nData Scientist,"Python, ML",Curiosity\n'
        "Data Engineer,Spark,Teamwork\nThanks!",
        "JOB_TITLE,a,b\nx,1,2",
        "no header here\nrow,one,two\n\nrow,three,four",
        "   ",
    ]
    df = spark.createDataFrame(list(enumerate(texts)), "answer_id long, text string")
    out = textblock.csv_block_rows(df, ["answer_id"], "text")
    got = {}
    for r in out.orderBy("answer_id", "row_no").collect():
        got.setdefault(r.answer_id, []).append((r.job_title, r.technical_skills, r.soft_skills))
    for i, t in enumerate(texts):
        assert got.get(i, []) == py_csv_block(t), i


def test_ingest_variants(spark, tmpdir_path):
    root = os.path.join(tmpdir_path, "landing")
    _land(root)
    raw = feed.read_landed_json(spark, root).withColumn("seniority", F.lit("NA"))
    v2 = {r.ID: r for r in I.ingest(raw, None, variant="v2").collect()}
    assert v2["1"].SENIORITY == "NA"           # 'na' text -> 'NA'
    # v1 needs every raw column; v2 skips a missing one
    short = raw.drop("linkedin_org_slug")
    with pytest.raises(Exception, match="LINKEDIN_ORG_SLUG"):
        I.ingest(short, None, variant="v1").collect()
    assert I.ingest(short.withColumn("linkedin_org_slug", F.lit(None).cast("string")), None,
                    variant="v2").count() == 2
    full = feed.upper_columns(raw).withColumn("LOCATIONS_RAW", F.lit(None).cast("string"))
    v1 = {r.ID: r for r in I.ingest(full, None, variant="v1").collect()}
    assert v1["1"].SENIORITY == "NA" and v1["1"].CITY == "NA"   # CSV null token, then null -> 'NA'
    v2b = {r.ID: r for r in I.ingest(full, None, variant="v2").collect()}
    assert v2b["1"].CITY is None                                   # v2 keeps null


def test_streaming_ingest_empty_first_batch(spark, tmpdir_path):
    from hirelens.streaming import start_ingest_stream
    root = os.path.join(tmpdir_path, "landing")
    os.makedirs(os.path.join(root, "job_category=Data Engineer"))
    with open(os.path.join(root, "job_category=Data Engineer", "a.json"), "w") as f:
        f.write(json.dumps(_landed_posting(1, "Metadata Analyst", "Perth", "WA")) + "\n")
    target, chk = os.path.join(tmpdir_path, "clean"), os.path.join(tmpdir_path, "chk")
    start_ingest_stream(spark, root, target, chk).awaitTermination(120)   # nothing matches
    with open(os.path.join(root, "job_category=Data Engineer", "b.json"), "w") as f:
        f.write(json.dumps(_landed_posting(2, "Data Engineer", "Perth", "WA")) + "\n")
    start_ingest_stream(spark, root, target, chk).awaitTermination(120)
    assert [r.ID for r in spark.read.parquet(target).collect()] == ["2"]
