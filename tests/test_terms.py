"""Skill terms by one pattern (A-8), terms scored without a lexicon, and CSV
records inside texts (S-11, F-13), against plain versions."""

import csv
import io
import math
import random
import re

from pyspark.sql import functions as F

from hirelens.operators import skills
from hirelens.sources import textblock

TERMS = ["data", "data modeling", "data modeling tools", "modeling", "r", "c++", "sql", "power bi", "bi", "machine learning", "learning sql"]


def plain_terms(text, terms):
    w = [x for x in re.split(r"[^\w]|_", text.lower()) if x]
    return {t for t in terms if any(w[i:i + len(t.split())] == t.split() for i in range(len(w)))}


def test_matched_terms_equal_word_sequences(spark):
    rng = random.Random(8)
    terms = [t for t in TERMS if t != "c++"]
    pieces = ["data", "Data", "modeling", "tools", "R", "r2", "sql", "SQL", "power", "bi", "machine", "learning", "é", "ü1", "database"]
    seps = [" ", ", ", "-", "\n", "  ", "/", "_", ". ", "12 "]
    texts = ["".join(rng.choice(pieces) + rng.choice(seps) for _ in range(rng.randint(0, 12))) for _ in range(400)] + ["", None, "x" * 50000 + " sql"]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    got = {r.i: r.m for r in df.select("i", skills.matched_terms(F.col("t"), terms).alias("m")).collect()}
    for i, t in enumerate(texts):
        if t is None:
            assert got[i] is None
        else:
            assert len(got[i]) == len(set(got[i])) and set(got[i]) == plain_terms(t, terms), t


def test_scored_terms(spark):
    rng = random.Random(9)
    common, own = ["the", "and", "work", "team"], {"a": ["spark", "deep learning"], "b": ["excel"], None: ["sales"]}
    rows = []
    for i in range(300):
        g = rng.choice(["a", "b", None])
        rows.append((g, " ".join(rng.sample(common, 2) + [rng.choice(own[g])] * rng.randint(0, 2) + [rng.choice(["noise", "deep"])])))
    rows.append(("a", None))
    df = spark.createDataFrame(rows, "g string, t string")
    got = skills.scored_terms(df, "g", "t", k=4, min_docs=2).collect()
    docs = [(g, {x for n in (1, 2) for x in (" ".join(w[i:i + n]) for i in range(len(w) - n + 1))})
            for g, t in rows for w in [(t or "").split()]]
    want = []
    for g in own:
        size, n = sum(h == g for h, _ in docs), len(docs)
        scored = []
        for term in {x for h, s in docs if h == g for x in s}:
            a, df_ = sum(h == g and term in s for h, s in docs), sum(term in s for _, s in docs)
            if a < 2 or a * n <= size * df_:
                continue
            cells = [(a, size * df_), (size - a, size * (n - df_)), (df_ - a, (n - size) * df_), (n - size - df_ + a, (n - size) * (n - df_))]
            scored.append((-round(2 * sum(o * math.log(o * n / e) for o, e in cells if o), 6), term, a, df_))
        want += [(g, t, a, d, -s) for s, t, a, d in sorted(scored)[:4]]
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))
    assert {(r.g, r.term) for r in got} >= {("a", "spark"), ("a", "deep learning"), ("b", "excel"), (None, "sales")}


def test_csv_records_equal_the_csv_module(spark):
    rng = random.Random(10)
    value = lambda: rng.choice(["a", "", "x,y", 'say "hi"', "two\nlines", "cr\r\nlf", '"', "\n", "é", "q\r"])
    tables = [[[value() for _ in range(3)] for _ in range(rng.randint(1, 5))] for _ in range(150)]
    texts = []
    for t in tables:
        out = io.StringIO()
        csv.writer(out, lineterminator=rng.choice(["\n", "\r\n"]), quoting=rng.choice([csv.QUOTE_ALL, csv.QUOTE_MINIMAL])).writerows(t)
        texts.append(out.getvalue())
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    got = {r.i: r.x for r in df.select("i", textblock.csv_records(F.col("t")).alias("x")).collect()}
    for i, t in enumerate(tables):
        assert [next(csv.reader(io.StringIO(x, newline=""))) for x in got[i] if x] == t


def test_a_quoted_field_over_two_lines_is_one_row(spark):
    text = 'Sure!\nJob_Title,technical_skills,soft_skills\n"Data\nEngineer","a, ""b""",x\nData Analyst,c,d\nend'
    df = spark.createDataFrame([(1, text), (2, 'k,v\n"a\nb",1\n\nc,2'), (3, None), (4, 'Job_Title,x\n"never, closed\nnext')], "id int, text string")
    got = textblock.csv_block_rows(df, ["id"], "text").orderBy("id", "row_no").collect()
    assert [tuple(r) for r in got][:4] == [(1, 0, "Data\nEngineer", 'a, "b"', "x"), (1, 1, "Data Analyst", "c", "d"),
                                           (2, 0, "a\nb", "1", None), (2, 1, "c", "2", None)]
    assert [r.id for r in got[4:]] == [4]
