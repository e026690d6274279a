"""Relational operators: anti join, lookups, dedupe, ordered concat,
windows, top-k."""

import datetime as dt

from pyspark.sql import functions as F

from hirelens import operators as O


def rows(df, order=None):
    out = [tuple(r) for r in df.collect()]
    return sorted(out, key=lambda r: tuple((x is None, x) for x in r))


def test_anti_join_null_semantics(spark):
    new = spark.createDataFrame([("1", "a"), ("2", "b"), ("2", "b2"), (None, "n")], "ID string, v string")
    stored = spark.createDataFrame([("1",), (None,), ("1",)], "ID string")
    # null-safe: a null ID on both sides is a match, so it is dropped
    assert rows(O.anti_join_new(new, stored, "ID")) == [("2", "b"), ("2", "b2")]
    # plain equality keeps the null-ID row
    assert rows(O.anti_join_new(new, stored, "ID", null_safe=False)) == [
        ("2", "b"), ("2", "b2"), (None, "n")]


def test_anti_join_idempotent(spark):
    new = spark.createDataFrame([("1",), ("2",), ("3",)], "ID string")
    stored = spark.createDataFrame([("1",)], "ID string")
    first = O.anti_join_new(new, stored, "ID")
    second = O.anti_join_new(new, stored.unionByName(first), "ID")
    assert second.count() == 0


def test_dictionary_lookup_defaults(spark):
    df = spark.createDataFrame([(1, "sídney"), (2, "perth"), (3, None)], "k int, c string")
    d = spark.createDataFrame([("sídney", "Sydney"), ("sídney", "Sydney")], "value string, translated string")
    assert rows(O.dictionary_lookup(df, "c", d, default="keep")) == [(1, "Sydney"), (2, "perth"), (3, None)]
    assert rows(O.dictionary_lookup(df, "c", d, default="na")) == [(1, "Sydney"), (2, "NA"), (3, "NA")]


def test_distinct_and_collapse_max(spark):
    df = spark.createDataFrame([("a", "x", "NSW"), ("a", "x", "NSW"), ("a", "y", "of"), ("b", None, None)],
                               "k string, v string, s string")
    assert O.distinct_rows(df).count() == 3
    got = rows(O.collapse_max(df, ["k"], {"v": "v", "s": "s"}))
    # byte order: lower case sorts above upper case
    assert got == [("a", "y", "of"), ("b", None, None)]


def test_first_per_key_keeps_first(spark):
    df = spark.createDataFrame(
        [(1, "s1", "d1", "x"), (2, "s1", "d1", "y"), (3, "s1", "d2", "z"), (0, "s2", "d1", "w")],
        "row_no long, sheet string, Job_Description string, Job_Title string")
    got = rows(O.first_per_key(df, ["sheet", "Job_Description"], ["row_no"]))
    assert got == [(0, "s2", "d1", "w"), (1, "s1", "d1", "x"), (3, "s1", "d2", "z")]
    assert O.first_per_key(df, ["sheet", "Job_Description"], ["row_no"]).columns == df.columns


def test_first_per_key_nulls_and_orders(spark):
    """Against a plain loop: null keys, null and negative order values, order
    columns that fit one number and ones that don't."""
    import random
    rnd = random.Random(2)
    rows_ = [(i, rnd.choice(["a", "ab", "", None]), rnd.choice(["b", "", "c", None]), rnd.choice([None, -5, 0, 7]), rnd.choice("xyz"))
             for i in range(200)]
    df = spark.createDataFrame(rows_, "id long, k string, t string, o int, w string").repartition(4)
    for order in (["o", "id"], ["w", "id"], ["id"]):
        pos = [df.columns.index(c) for c in order]
        key = lambda r: [(r[p] is not None, r[p] if r[p] is not None else 0) for p in pos]
        want = {}
        for r in rows_:
            if (r[1], r[2]) not in want or key(r) < key(want[r[1], r[2]]):
                want[r[1], r[2]] = r
        got = O.first_per_key(df, ["k", "t"], order).collect()
        assert sorted(map(str, map(tuple, got))) == sorted(map(str, want.values()))


def test_ordered_distinct(spark):
    df = spark.createDataFrame(
        [("Data Analyst", "b", 2), ("Data Analyst", "a", 1), ("Data Analyst", "b", 3),
         ("Data Scientist", "z", 5)], "role string, text string, pos long")
    long_form = rows(O.ordered_distinct(df, "role", "text", ["pos"]))
    assert long_form == [("Data Analyst", "a", 1), ("Data Analyst", "b", 2), ("Data Scientist", "z", 5)]


def test_lag_trend_gap_zero_and_null_week(spark):
    d = dt.date
    weekly = spark.createDataFrame([
        ("DA", d(2025, 1, 6), 4), ("DA", d(2025, 1, 13), 0), ("DA", d(2025, 1, 27), 5),  # gap week
        ("DA", None, 7), ("DS", d(2025, 1, 6), 2)],
        "JOB_CATEGORY string, week_start date, total_jobs_this_week long")
    out = O.lag_trend(weekly, "JOB_CATEGORY", "week_start", "total_jobs_this_week",
                      "last", "diff", "pct")
    got = {(r.JOB_CATEGORY, r.week_start): (r.last, r.diff, r.pct) for r in out.collect()}
    assert got[("DA", d(2025, 1, 6))] == (None, None, None)
    assert got[("DA", d(2025, 1, 13))] == (4, -4, -1.0)
    assert got[("DA", d(2025, 1, 27))] == (0, 5, None)        # zero base -> null ratio
    assert got[("DA", None)] == (5, 2, 0.4)                    # null week sorts last
    assert got[("DS", d(2025, 1, 6))] == (None, None, None)
    # differences telescope: sum of diffs = last - first present week
    da = [v[1] for (c, _), v in got.items() if c == "DA" and v[1] is not None]
    assert sum(da) == 7 - 4


def test_top_k_per_group_ties_and_skew(spark):
    df = spark.range(0, 10000).select(
        F.when(F.col("id") < 9000, F.lit("hot")).otherwise(F.lit("cold")).alias("g"),
        (F.col("id") % 7).alias("score"), F.col("id"))
    out = O.top_k_per_group(df, ["g"], [F.col("score").desc(), F.col("id").asc()], 3)
    got = rows(out.select("g", "id"))
    assert got == [("cold", 9001), ("cold", 9008), ("cold", 9015), ("hot", 6), ("hot", 13), ("hot", 20)]


def test_recent_capped(spark):
    base = dt.datetime(2024, 1, 2, 12, 0, 0)
    data = [(i, base - dt.timedelta(hours=i), "a" if i % 2 else "b") for i in range(60)]
    df = spark.createDataFrame(data, "event_id long, ts timestamp_ntz, event_type string")
    out = O.recent_capped(df, "ts", "event_type", "event_id", window_hours=24, limit=5)
    got = rows(out.select("event_type", "event_id"))
    assert got == [("a", 1), ("a", 3), ("a", 5), ("a", 7), ("a", 9),
                   ("b", 0), ("b", 2), ("b", 4), ("b", 6), ("b", 8)]
    wide = O.recent_capped(df, "ts", "event_type", "event_id", window_hours=24, limit=100)
    assert wide.count() == 25  # hours 0..24 inclusive


def test_checked_broadcast(spark):
    small = spark.range(10)
    assert O.measured_size(small)[0] == 10
    hinted = O.broadcast_if_small(small)
    plan = hinted._jdf.queryExecution().analyzed().toString()
    assert "broadcast" in plan.lower()
    big = O.broadcast_if_small(small, max_rows=5)
    assert "broadcast" not in big._jdf.queryExecution().analyzed().toString().lower()


def test_preview_head_and_tail(spark):
    df = spark.range(0, 100).withColumnRenamed("id", "k")
    assert [r.k for r in O.preview(df, 3, [("k", True)]).collect()] == [0, 1, 2]
    assert [r.k for r in O.preview(df, 2, [("k", True)], tail=True).collect()] == [98, 99]
    assert O.preview(df, 4).count() == 4


def test_anti_join_large_batch_gives_the_same_rows(spark, monkeypatch):
    from hirelens.operators import joins
    new = spark.createDataFrame([("1", 1), ("2", 2), ("2", 3), (None, 4), ("9", 5)], "ID string, n int")
    for stored_ids in ([("1",), (None,), ("1",), ("7",)], [("1",)], []):
        stored = spark.createDataFrame(stored_ids, "ID string")
        for null_safe in (True, False):
            got = []
            for limit in (10**6, 0):
                monkeypatch.setattr(joins, "BROADCAST_MAX_ROWS", limit)
                got.append(rows(O.anti_join_new(new, stored, "ID", null_safe=null_safe)))
            known = {i for i, in stored_ids if null_safe or i is not None}
            assert got[0] == got[1] == sorted([r for r in [("1", 1), ("2", 2), ("2", 3), (None, 4), ("9", 5)] if r[0] not in known], key=str)
