"""Warehouse models: differential (reduced vs naive M-3), fallback path,
seniority matching and mart properties, on hand-made postings."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from hirelens.plans import enrich, models
from hirelens.schemas import CLEAN_COLUMNS, CLEAN_SCHEMA, FACT_COLUMNS


def posting(i, title="Data Engineer", cat="Data Engineer", day=dt.date(2025, 1, 6), city="Sydney",
            state="NSW", sen="entry level", org="Org A"):
    v = {c: None for c in CLEAN_COLUMNS}
    v.update(ID=str(i), TITLE=title, JOB_CATEGORY=cat, JOB_DATE=day, CITY=city, STATE=state,
             SENIORITY=sen, ORGANIZATION=org, URL=f"u{i}")
    return tuple(v[c] for c in CLEAN_COLUMNS)


@pytest.fixture()
def clean(spark):
    d = dt.date
    data = [
        posting(1), posting(1),                                   # exact duplicate
        posting(2, city="Greater Sydney Area", state="of"),        # Sydney via LIKE, placeholder state
        posting(2, city="New South Wales", state="TAS"),           # same posting, other raw city/state
        posting(3, city="Perth", state="na", sen="executive"),
        posting(4, city=None, state="WA"),                         # null city: dropped by inner join
        posting(5, sen="Mid-Senior level"),                        # mixed case: no exact match
        posting(6, sen=None),
        posting(7, city="Woden", state="on", day=d(2025, 1, 13), cat="Data Analyst"),
        posting(8, city="Hobart", state=None, day=d(2025, 1, 27), cat="Data Analyst"),
        posting(9, city="Darwin", state="australia", day=None, cat="Data Scientist"),
    ]
    return spark.createDataFrame(data, CLEAN_SCHEMA)


@pytest.fixture()
def seniority(spark):
    # 'entry level' maps to two labels: MAX picks 'Intermediate'
    return spark.createDataFrame(
        [("entry level", "Entry Level"), ("entry level", "Intermediate"),
         ("executive", "Manager/Executive"), ("mid-senior level", "Intermediate")],
        "SENIORITY string, SENIORITY_STANDARDIZED string")


def as_set(df):
    return sorted(tuple(r) for r in df.select(*sorted(df.columns)).collect())


def test_fact_reduced_equals_naive(spark, clean, seniority):
    fast = models.fact_postings(clean, seniority)
    naive = models.fact_postings_naive(clean, seniority)
    assert fast.columns == FACT_COLUMNS == naive.columns
    assert as_set(fast) == as_set(naive)
    got = {r.ID: (r.CITY, r.STATE, r.SENIORITY) for r in fast.collect()}
    assert "4" not in got and "5" not in got and "6" not in got
    # the state is a property of the standardized city: max(NSW, TAS) over all Sydney rows
    assert got["1"] == ("Sydney", "TAS", "Intermediate")
    assert got["3"] == ("Perth", "WA", "Manager/Executive")
    assert got["7"] == ("Woden", "ACT", "Intermediate")


def test_fact_large_side_fallback(spark, clean, seniority, monkeypatch):
    monkeypatch.setattr(models, "BROADCAST_MAX_ROWS", 1)
    slow = models.fact_postings(clean, seniority)
    assert as_set(slow) == as_set(models.fact_postings_naive(clean, seniority))


def nulls_everywhere(spark):
    """Postings and a dictionary with nulls on every side."""
    rows = [posting(i, city=city, state=state, sen=sen)
            for i, (city, state, sen) in enumerate(
                (c, s, e) for c in ("Perth", "Nowhere", None) for s in ("WA", "na", None)
                for e in ("entry level", "unlabelled", "half", "Mid-Senior level", None))]
    clean = spark.createDataFrame(rows + rows[:7], CLEAN_SCHEMA)
    dictionary = spark.createDataFrame(
        [("entry level", "Entry Level"), ("unlabelled", None), ("half", None), ("half", "Senior"), (None, "Senior"), (None, None)],
        "SENIORITY string, SENIORITY_STANDARDIZED string")
    return clean, dictionary


@pytest.mark.parametrize("limit", [10**6, 0])
def test_fact_rows_do_not_depend_on_size(spark, monkeypatch, limit):
    clean, dictionary = nulls_everywhere(spark)
    monkeypatch.setattr(models, "BROADCAST_MAX_ROWS", limit)
    for sen in (dictionary, None):
        naive = models.fact_postings_naive(clean, enrich.seniority_dictionary(clean) if sen is None else sen)
        got = models.fact_postings(clean, sen)
        key = lambda df: sorted(map(str, df.select(*FACT_COLUMNS).collect()))
        assert key(got) == key(naive)
        want = naive.select("JOB_CATEGORY", "ID").distinct().collect()
        assert set(models.fact_rows(clean, ["JOB_CATEGORY", "ID"], sen).collect()) == set(want)


def test_marts_without_sides_run_nothing_early(spark):
    clean, _ = nulls_everywhere(spark)
    plan = models.fact_rows(clean, ["JOB_CATEGORY", "ID"])._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Exchange" not in plan
    with pytest.raises(ValueError):
        models.fact_rows(clean, ["CITY"])


def test_external_classifier_runs_once_per_level(spark, clean, tmp_path):
    def classify(values):
        import uuid
        for v in values:
            (tmp_path / f"{v.replace(' ', '_')}-{uuid.uuid4().hex}").touch()
        return values.map(lambda v: "senior")
    models.fact_postings(clean, enrich.seniority_dictionary(clean, classify)).collect()
    calls = [p.name.rsplit("-", 1)[0] for p in tmp_path.iterdir()]
    assert len(calls) == len(set(calls)) > 0


def test_casefold_seniority(spark, clean, seniority):
    fact = models.fact_postings(clean, seniority, seniority_match="casefold")
    got = {r.ID: r.SENIORITY for r in fact.collect()}
    assert got["5"] == "Intermediate"


def test_derived_seniority_dictionary(spark, clean):
    d = enrich.seniority_dictionary(clean)
    got = sorted((r[0] or "", r[1]) for r in d.collect())
    assert got == [("", "Not Applicable"), ("entry level", "Entry Level"),
                   ("executive", "Manager/Executive"), ("mid-senior level", "Intermediate")]


def test_custom_classifier_with_failures(spark, clean):
    def classify(s):
        if s.str.contains("exec").any():
            raise RuntimeError("service down")
        return s.map(lambda x: "Senior Level")
    d = enrich.seniority_dictionary(clean.filter(F.col("SENIORITY") != "executive"), classify)
    got = dict((r[0], r[1]) for r in d.collect())
    assert got["entry level"] == "Senior" and got["mid-senior level"] == "Senior"


def test_marts_and_properties(spark, clean, seniority):
    fact = models.fact_postings(clean, seniority)
    by_type = {r.JOB_CATEGORY: r.total_jobs for r in models.jobs_by_type(fact).collect()}
    assert by_type == {"Data Engineer": 3, "Data Analyst": 2, "Data Scientist": 1}
    by_state = models.jobs_by_state(fact).collect()
    assert sum(r.total_jobs for r in by_state) >= sum(by_type.values())
    by_city = models.jobs_by_city(fact).collect()
    assert [(r.JOB_CATEGORY, r.CITY) for r in by_city] == sorted((r.JOB_CATEGORY, r.CITY) for r in by_city)
    daily = models.jobs_daily(fact)
    assert daily.columns == ["date", "month", "Year", "JOB_CATEGORY", "total_jobs"]
    wow = models.jobs_wow_trend(daily).collect()
    da = [r for r in wow if r.JOB_CATEGORY == "Data Analyst"]
    assert [(r.week_start, r.total_jobs_this_week, r.total_jobs_last_week) for r in da] == [
        (dt.date(2025, 1, 13), 1, None), (dt.date(2025, 1, 27), 1, 1)]
    ds = [r for r in wow if r.JOB_CATEGORY == "Data Scientist"]
    assert ds[0].week_start is None


def test_base_city_state_and_links(spark, clean):
    city = models.base_city(clean)
    assert city.columns == ["CITY", "CITY_STANDARDIZED", "STATE"]
    assert city.count() == clean.select("CITY", "STATE").distinct().count()
    state = {(r[0], r[1]) for r in models.base_state(city).collect()}
    assert ("Sydney", "NSW") in state and ("Perth", "WA") in state and ("Woden", "ACT") in state
    links = models.job_links(clean).collect()
    assert len(links) == len({(r.ID, r.TITLE, r.JOB_CATEGORY, r.URL) for r in links})
