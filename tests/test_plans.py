"""Plan shape: the properties the design relies on at scale, read from the
physical plans of the registered queries."""

import contextlib
import io
import re

import pytest

import __spark_entry__ as E
from conftest import SF0001
from hirelens.plans.registry import QUERIES


def plan_of(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def live_nodes(df) -> list[tuple[str, str]]:
    """(name, description) of every operator the query will run, walking
    the physical plan (the initial adaptive plan). Inputs that are already
    materialized (cached) are leaves here, so their plans do not count."""
    out = []

    def walk(p):
        if p.nodeName() == "AdaptiveSparkPlan":
            walk(p.initialPlan())
            return
        out.append((p.nodeName(), p.toString().split("\n")[0]))
        ch = p.children()
        for i in range(ch.size()):
            walk(ch.apply(i))

    walk(df._jdf.queryExecution().executedPlan())
    return out


def shuffles(nodes) -> list[str]:
    return [d for n, d in nodes if n == "Exchange"]


@pytest.fixture(scope="module")
def frames(spark):
    q = {name: E.queries()[name] for name in QUERIES}
    return {name: fn(spark, SF0001) for name, fn in q.items()}


@pytest.fixture(scope="module")
def plans(frames):
    return {name: plan_of(df) for name, df in frames.items()}


def test_fact_table_shuffles_postings_once(frames):
    nodes = live_nodes(frames["q_int_data"])
    ex = shuffles(nodes)
    # one hash shuffle of posting rows, plus the round-robin spread of the
    # single-row-group test file
    assert len([d for d in ex if "hashpartitioning" in d]) == 1, ex
    assert all("hashpartitioning" in d or "RoundRobinPartitioning" in d for d in ex), ex
    assert not [n for n, _ in nodes if n == "SortAggregate"]
    assert any(n == "HashAggregate" and "partial_max" in d for n, d in nodes)


def test_distinct_counts_are_two_level(frames):
    ex = [d for d in shuffles(live_nodes(frames["q_by_type"])) if "hashpartitioning" in d]
    # (category, ID), then category; the fact table's own GROUP BY is removed
    # by Catalyst here (a distinct count ignores duplicates), so at most one
    # more shuffle
    assert len(ex) <= 3, ex
    assert any("ID#" in d for d in ex)


def test_top_k_is_limited_before_the_shuffle(plans):
    for name in ("q_feed_cap", "q_feed_cap_week", "q_top_skills"):
        assert re.search(r"WindowGroupLimit[\s\S]*?Partial", plans[name]), name


def test_scans_read_only_needed_columns(plans):
    for name, p in plans.items():
        for table, schema in re.findall(
                r"Location: InMemoryFileIndex \[file:[^\]]*/([a-z_]+)\.parquet\][\s\S]*?ReadSchema: struct<([^>]*)>", p):
            n = len(re.split(r",(?![^<]*>)", schema))
            if table == "lineitem":
                assert n <= 4, (name, schema)
            if table == "documents":
                assert "embedding" not in schema


def test_no_row_at_a_time_python(plans):
    for name, p in plans.items():
        if name == "q_distinct_function":  # its point is a Python function, over distinct values
            continue
        assert not re.search(r"BatchEvalPython|ArrowEvalPython|MapInPandas|FlatMapGroupsInPandas", p), name


def test_rule_tables_are_expressions_not_joins(plans):
    # the city rules never become a join side: no scan of a rules table
    p = plans["q_base_city"]
    assert "LocalTableScan" not in p and "CASE WHEN" in p
