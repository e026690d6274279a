"""Scalar functions and rule tables, one case per branch and edge case."""

import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from hirelens import functions as HF
from hirelens import rules


def one_col(spark, values, expr_fn, schema="x string"):
    df = spark.createDataFrame([(v,) for v in values], schema)
    return [r[0] for r in df.select(expr_fn(F.col("x"))).collect()]


CITY_CASES = [
    ("New South Wales", "Sydney"), ("capital australia", "Canberra"), ("BARZBIN", "Brisbane"),
    ("Queensland", "Brisbane"), ("South Australia", "Adelaide"),
    ("Australian Capital Territory", "Canberra"), ("Victoria", "Melbourne"),
    ("Northern Territory", "Darwin"), ("West Australia", "Perth"),
    ("Launceston, Tasmania", "Hobart"), ("No Regrets", "Unknown"),
    ("Other Side of the Moon", "Unknown"), ("Greater Sydney Area", "Sydney"),
    ("Melbourne CBD", "Melbourne"), ("Brisbane City", "Brisbane"), ("Canberra", "Canberra"),
    ("Perth", "Perth"), ("North Adelaide", "Adelaide"), ("Darwin City", "Darwin"),
    ("Hobart", "Hobart"), ("Woden", "Woden"), ("Newcastle", "Newcastle"), (None, None),
    ("new south wales area", "new south wales area"),  # equality rules need the whole value
]


def test_city_rules_every_branch(spark):
    got = one_col(spark, [c for c, _ in CITY_CASES], HF.city_standardized)
    assert got == [e for _, e in CITY_CASES]


def test_city_rule_order_first_match_wins(spark):
    # 'tasmania' (rule 10) is checked before 'hobart' (rule 20)
    assert one_col(spark, ["Hobart, Tasmania"], HF.city_standardized) == ["Hobart"]
    # 'sydney' (rule 13) before 'melbourne' (rule 14)
    assert one_col(spark, ["Sydney to Melbourne"], HF.city_standardized) == ["Sydney"]


def test_state_rules(spark):
    rows = [("of", "Perth"), ("ON", "Brisbane"), ("Australia", "Sydney"), ("na", "Melbourne"),
            ("of", "Canberra"), ("on", "Adelaide"), ("australia", "Hobart"), ("NA", "Darwin"),
            ("of", "Woden"), ("NA", "Unknown"), ("na", None), ("of", "Newcastle"),
            ("NSW", "Sydney"), (None, "Sydney"), ("of", "perth")]
    df = spark.createDataFrame(rows, "STATE string, CITY_STANDARDIZED string")
    got = [r[0] for r in df.select(HF.state_standardized("STATE", "CITY_STANDARDIZED")).collect()]
    assert got == ["WA", "QLD", "NSW", "VIC", "ACT", "SA", "TAS", "NT", "ACT", "UNKNOWN", "UNKNOWN",
                   "of", "NSW", None, "of"]


def test_seniority_label_map(spark):
    vals = ["No Experience", " entry level ", "Entry Level", "intermediate", "Senior Level",
            "senior", "Manager", "EXECUTIVE", "manager/executive", "Not Applicable", "junk", None, ""]
    got = one_col(spark, vals, HF.seniority_label)
    assert got == ["No Experience", "Entry Level", "Entry Level", "Intermediate", "Senior", "Senior",
                   "Manager/Executive", "Manager/Executive", "Manager/Executive", "Not Applicable",
                   "Not Applicable", "Not Applicable", "Not Applicable"]


def test_seniority_category_rules(spark):
    cases = [
        (None, "Not Applicable"), ("", "Not Applicable"),
        ("Minimum experience 2 years", "Entry Level"), ("association level", "Entry Level"),
        ("Associate", "Entry Level"), ("medium-high level", "Intermediate"),
        ("executive", "Manager/Executive"), ("Mid-Senior level", "Intermediate"),
        ("Mid-Senior_Level", "Intermediate"), ("mid_senior_level", "Not Applicable"), ("entry_level", "Entry Level"),
        ("first job", "Entry Level"), ("senior", "Senior"), ("No Experience", "No Experience"),
        ("1 year", "Entry Level"), ("3-5 years", "Intermediate"), ("5+ years", "Intermediate"),
        ("10 years", "Senior"), ("internship", "Not Applicable"), ("na", "Not Applicable"),
    ]
    got = one_col(spark, [c for c, _ in cases], HF.seniority_category)
    assert got == [e for _, e in cases]


def py_city(text):
    # brute-force reference for the text-form rule, with Python's re
    if text is None:
        return None
    m = re.search(rules.CITY_TEXT_PATTERN, str(text))
    if not m:
        return None
    city = m.group(1)
    if any(s in city.lower() for s in rules.SYDNEY_SPELLINGS):
        return "Sydney"
    return city


def py_state(text):
    m = re.search(rules.STATE_TEXT_PATTERN, str(text))
    return m.group(1).replace("'", "").strip() if m else None


def place(city, state):
    return ("{'@type': 'Place', 'address': {'addressLocality': '%s', 'addressRegion': '%s', "
            "'streetAddress': None}}" % (city, state))


LOCATION_TEXTS = [
    None, "", "[]", "not a list",
    "[" + place("Perth", "WA") + "]",
    "[" + place("Sídney", "NSW") + "]",
    "[" + place("悉尼", "新南威尔士州") + "]",
    "[" + place("Sidney", " NSW ") + "]",
    "[" + place("Perth", "WA") + ", " + place("Darwin", "NT") + "]",
    "[" + place("", "") + "]",
    "[{'address': {'addressLocality':'Hobart', 'addressRegion': 'TAS', 'streetAddress': '1 Main St'}}]",
    "[" + place("Alice\rSprings", "NT") + "]",         # '.' crosses \r as in Python
    "[" + place("Alice\nSprings", "NT") + "]",         # but not \n
]


def test_city_from_locations_matches_python(spark):
    got = one_col(spark, LOCATION_TEXTS, HF.city_from_locations)
    assert got == [py_city(t) for t in LOCATION_TEXTS]
    # greedy capture with several places runs to the last region marker
    assert got[8].startswith("Perth', 'addressRegion'") and got[8].endswith("Darwin")


def test_state_from_locations_matches_python(spark):
    got = one_col(spark, LOCATION_TEXTS, HF.state_from_locations)
    expected = [None if t is None else py_state(t) for t in LOCATION_TEXTS]
    assert got == expected
    assert got[7] == "NSW"  # no-break spaces stripped like str.strip()


def test_strip_unicode_whitespace(spark):
    vals = ["  a  ", " b ", "\tc\n", "\x1cd\x1f", "e", None]
    assert one_col(spark, vals, HF.strip) == [v.strip() if v is not None else None for v in vals]


def test_employment_type_and_org_size(spark):
    emp = ["['FULL_TIME', 'PART_TIME']", "['CONTRACTOR']", None, "[]", "FULL_TIME"]
    assert one_col(spark, emp, HF.employment_type_text) == [
        "FULL_TIME, PART_TIME", "CONTRACTOR", "nan", "", "FULL_TIME"]
    arr = spark.createDataFrame([(["FULL_TIME", "PART_TIME"],), (None,), ([],)], "x array<string>")
    assert [r[0] for r in arr.select(HF.employment_type_from_array("x")).collect()] == [
        "FULL_TIME, PART_TIME", "nan", ""]
    sizes = ["51-200 employees", "10,001+ employees", None, "Employees 5", " 2-10 employees "]
    assert one_col(spark, sizes, HF.org_size_text) == ["51-200", "10,001+", "nan", "Employees 5", "2-10"]
    assert one_col(spark, [None], lambda c: HF.text_or_token(c, "None")) == ["None"]


def test_title_filters(spark):
    titles = ["Senior Data Engineer", "DATA SCIENTIST II", "Metadata Analyst", "Data Engineering Lead",
              "Junior data analyst", "数Data Analyst", "Data Analyst数", "Big-Data Analyst", None]
    py = re.compile(r"\bData Engineer\b|\bData Scientist\b|\bData Analyst\b", re.IGNORECASE)
    got = one_col(spark, titles, HF.title_matches)
    assert got == [None if t is None else bool(py.search(t)) for t in titles]
    like = one_col(spark, titles, HF.title_contains)
    assert like[2] is True and like[3] is True  # substring form is wider
    assert got[2] is False and got[3] is False


def test_missing_as_na(spark):
    vals = [None, "", "nan", " NA ", "Sydney", "None"]
    assert one_col(spark, vals, HF.missing_as_na) == ["NA", "NA", "nan", " NA ", "Sydney", "None"]
    assert one_col(spark, vals, lambda c: HF.missing_as_na(c, ["nan", "na"])) == [
        "NA", "NA", "NA", "NA", "Sydney", "None"]


def test_json_path_and_default(spark):
    vals = ['{"choices": [{"message": {"content": " Senior "}}]}', "not json", '{"choices": []}', None]
    path = "$.choices[0].message.content"
    assert one_col(spark, vals, lambda c: HF.json_path(c, path)) == [" Senior ", None, None, None]
    assert one_col(spark, vals, lambda c: HF.json_path_or(c, path, "Not Applicable")) == [
        " Senior ", "Not Applicable", "Not Applicable", "Not Applicable"]


def test_dates(spark):
    vals = ["2025-03-04T23:30:00", "2025-03-04T01:00:00+10:00", "garbage", None]
    assert one_col(spark, vals, HF.date_from_text) == [
        dt.date(2025, 3, 4), dt.date(2025, 3, 4), None, None]
    d = spark.createDataFrame([(dt.date(2025, 3, 9),), (dt.date(2025, 3, 10),), (None,)], "x date")
    assert [r[0] for r in d.select(HF.week_start("x")).collect()] == [
        dt.date(2025, 3, 3), dt.date(2025, 3, 10), None]
    assert [r[0] for r in d.select(HF.month_of("x"), ).collect()] == [3, 3, None]


def test_url_encoding(spark):
    from urllib.parse import quote
    texts = ["Data Engineer", "a&b", "/~*-._", "1+1=2?", "é 数", "", "%2F%7E+", "'\"<>\n"]
    assert one_col(spark, texts, HF.url_encoded) == [quote(t) for t in texts]


@pytest.mark.parametrize("kind,text,out", rules.CITY_RULES)
def test_each_city_rule_alone(spark, kind, text, out):
    value = text.upper() if kind == "equals" else f"xx {text.upper()} yy"
    assert one_col(spark, [value], HF.city_standardized) == [out]


def test_date_texts(spark):
    texts = ["2025-01-06T23:30:00", "2025-01-06", "2025-01-06 10:00:00+05:00", "2025/1/6", "1/6/2025 10:00", "20250106", "6 Jan 2025",
             "Jan 6, 2025 9:00", "2025-13-01", "2025-01-06x", "x", "", None]
    got = one_col(spark, texts, HF.date_from_text)
    day = dt.date(2025, 1, 6)
    assert got == [day] * 8 + [None] * 5


def test_year_bands_have_no_upper_end(spark):
    texts = ["6 years", "2147483648 years", "99999999999999999999 years", "2 years"]
    assert one_col(spark, texts, HF.seniority_category) == ["Senior", "Senior", "Senior", "Entry Level"]
