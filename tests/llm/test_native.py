"""Exact dedup (op 7) and URL filters (op 2)."""

import datetime
import hashlib
import inspect

import duckdb
import pytest

from hirelens.llm import exact_dedup, queries, url_filter

from .conftest import EDGE_ROWS, SF


@pytest.mark.parametrize("name", sorted(queries.llm_oracle_sql()))
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    rel = con.execute(queries.llm_oracle_sql()[name])
    cols = [d[0] for d in rel.description]
    df = queries.LLM_QUERIES[name](spark, SF)
    assert sorted(df.columns) == sorted(cols)
    assert sorted(map(str, df.select(*cols).collect())) == sorted(
        str(r) for r in spark.createDataFrame(rel.fetchall(), df.select(*cols).schema).collect())


@pytest.mark.parametrize("module", [exact_dedup, url_filter])
def test_native_modules_run_no_python_on_executors(module):
    code = inspect.getsource(module)
    for word in ("udf", "mapIn", "applyIn", ".rdd", "pandas", "numpy"):
        assert word not in code


def expected_dedup(rows):
    groups = {}
    for r in rows:
        groups.setdefault(r[1] or "", []).append(r[0])
    out = []
    for r in rows:
        ids = groups[r[1] or ""]
        known = [i for i in ids if i is not None]
        keep = max(known) if known else None
        out.append((r[0], keep, len(ids), r[0] == keep, hashlib.sha256((r[1] or "").encode()).hexdigest()))
    return sorted(map(str, out))


def test_exact_dedup_edges(spark, edge):
    assert sorted(str(tuple(r)) for r in exact_dedup.exact_dedup(edge).collect()) == expected_dedup(EDGE_ROWS)


def test_exact_dedup_empty(spark, empty):
    assert exact_dedup.exact_dedup(empty).count() == 0


def test_exact_dedup_splits_buckets_and_keeps_answers(spark):
    rows = [(i, f"text {i % 300}", None, None, None) for i in range(1000)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    scratch = exact_dedup.Scratch(spark, "test-index")
    index = exact_dedup.build_index(df, scratch, capacity=16, max_bits=8)[0].collect()
    held = {}
    for e in index:
        held[e.bucket] = held.get(e.bucket, 0) + 1
        assert e.bucket == ((e.key % (1 << 64)) >> 56) >> (8 - e.depth) << (8 - e.depth)
    assert len(held) > 16 and max(held.values()) <= 16 and len({e.depth for e in index}) > 1
    got = exact_dedup.exact_dedup(df, capacity=16, max_bits=8).collect()
    assert sorted(str(tuple(r)) for r in got) == expected_dedup(rows)


def test_texts_of_one_key_are_told_apart_by_their_bytes(spark, monkeypatch):
    """Colliding keys: every text of a length has the same key."""
    from pyspark.sql import functions as F
    monkeypatch.setattr(exact_dedup, "_key", lambda body: F.shiftleft(F.length(body).cast("long"), 58))
    rows = [(i, f"text {i % 7}" if i % 3 else f"longer text {i % 40}", None, None, None) for i in range(300)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    got = exact_dedup.exact_dedup(df, capacity=2).collect()
    assert sorted(str(tuple(r)) for r in got) == expected_dedup(rows)


def test_answers_come_through_the_directory_and_lone_texts_stay(spark, monkeypatch):
    rows = [(i, f"text {max(i, 5)}", None, None, None) for i in range(50)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    scratch = exact_dedup.Scratch(spark, "test-index")
    index, directory, bits = exact_dedup.build_index(df, scratch, capacity=4)
    sent = exact_dedup.chains(df, index, directory, bits).collect()
    assert [(r.group_size, r.keep_id) for r in sent] == [(6, 5)]
    build = exact_dedup.build_index
    monkeypatch.setattr(exact_dedup, "build_index", lambda *a: (lambda i, d, b: (i, d.where("false"), b))(*build(*a)))
    assert exact_dedup.exact_dedup(df, capacity=4).count() == 0


def test_one_key_in_one_bucket(spark):
    """Copies of one text can't be split apart; they are one entry."""
    df = spark.createDataFrame([(i, "same") for i in range(500)], "doc_id long, text string")
    got = exact_dedup.exact_dedup(df, capacity=1, max_bits=4).collect()
    assert len(got) == 500 and {(r.keep_id, r.group_size) for r in got} == {(499, 500)} and sum(r.kept for r in got) == 1


D = lambda n: datetime.date(2024, 1, 1) + datetime.timedelta(days=n)
EVENTS = "list string, kind string, value string, action string, at date, note string"


def events(spark, rows):
    return spark.createDataFrame([(*r, "extra") for r in rows], EVENTS)


def captures(spark, rows):
    return spark.createDataFrame([(*r, 1, "x") for r in rows], "page_id long, url string, fetched date, slice int, lists string")


def test_url_filter_cases(spark):
    listed = events(spark, [
        ("block", "host", "A.com", "add", D(10)), ("block", "host", "a.com", "remove", D(50)),
        ("block", "host", "a.com", "add", D(80)), ("block", "host", "a.com", "add", D(90)),
        ("block", "domain", "b.org", "add", D(0)), ("allow", "prefix", "x.b.org/ok", "add", D(20)),
        ("block", "host", "c.net", "add", D(5)), ("block", "host", "c.net", "remove", D(5)),
        ("watch", "host", "d.net", "add", D(5)), ("watch", "host", "d.net", "add", D(5)),
        (None, "host", "d.net", "add", D(0)), ("block", "host", None, "add", D(0)), ("block", "host", "d.net", "add", None)])
    rows = [(1, "http://a.com/", D(9)), (2, "http://A.com/x", D(10)), (3, "https://a.com?q", D(49)), (4, "http://a.com", D(50)),
            (5, "http://a.com/", D(400)), (6, "http://x.b.org/ok/page", D(19)), (7, "http://x.b.org/ok/page#top", D(20)),
            (8, "http://x.b.org/okay", D(30)), (9, "http://xb.org/", D(30)), (10, "http://c.net:80/", D(6)),
            (11, "http://d.net/", D(6)), (12, None, D(6)), (13, "not a url", D(6)), (14, "http://a.com/", None), (None, "http://b.org", D(1)),
            (2, "http://A.com/x", D(10))]
    got = sorted((str(r.page_id), r.n_active, r.lists, r.dropped) for r in url_filter.url_filter(captures(spark, rows), listed).collect())
    want = {1: (0, "", False), 2: (1, "block", True), 3: (1, "block", True), 4: (0, "", False), 5: (1, "block", True),
            6: (1, "block", True), 7: (2, "allow,block", False), 8: (1, "block", True), 9: (0, "", False), 10: (0, "", False),
            11: (1, "watch", False), 12: (0, "", False), 13: (0, "", False), 14: (0, "", False), None: (1, "block", True)}
    assert got == sorted((str(r[0]), *want[r[0]]) for r in rows)


def test_hosts_and_paths_of_urls(spark):
    listed = events(spark, [("block", "host", "Bad.com.", "add", D(0)), ("block", "prefix", "OK.com/Ad/", "add", D(0)),
                            ("block", "host", "[::1]", "add", D(0)), ("block", "domain", "evil.net", "add", D(0)),
                            ("block", "prefix", "ok.com/a//b", "add", D(0))])
    cases = {"http://bad.com/x": True, "http://u@bad.com/": True, "http://u:p@bad.com/x": True, "http://bad.com./": True, "http://BAD.com:80": True,
             "http://u@x@bad.com?q": True, "http://bad.com@good.com/": False, "http://good.com/?u@bad.com": False, "http://good.com/x@bad.com/": False,
             "http://ok.com/Ad": True, "http://ok.com/Ad/q": True, "http://ok.com/Ad/": True, "http://ok.com/aD/q": False, "http://ok.com/Adx": False,
             "http://ok.com//Ad": False, "http://ok.com/a//b/c": True, "http://ok.com/a/b": False, "http://[::1]:8080/": True, "http://[::2]/": False,
             "http://a.evil.net./": True, "http://u@evil.net:1/": True, "http://notevil.net/": False, "http:///x": False, "http://": False}
    rows = [(i, u, D(1)) for i, u in enumerate(cases)]
    got = {r.url: r.dropped for r in url_filter.url_filter(captures(spark, rows), listed).collect()}
    assert got == cases


def test_url_filter_empty_sides(spark):
    none = events(spark, [])
    some = captures(spark, [(1, "http://a.com", D(1))])
    assert [r.dropped for r in url_filter.url_filter(some, none).collect()] == [False]
    assert url_filter.url_filter(captures(spark, []), events(spark, [("block", "host", "a.com", "add", D(0))])).count() == 0
    assert url_filter.intervals(none).count() == 0


def test_intervals_match_a_plain_walk(spark):
    import random
    rnd = random.Random(1)
    rows = [("block", "host", rnd.choice("ab") + ".com", rnd.choice(["add", "remove"]), D(rnd.randrange(60))) for _ in range(80)]
    caps = [(i, f"http://{rnd.choice('ab')}.com/{i}", D(rnd.randrange(70))) for i in range(200)]
    got = {r.page_id: r.dropped for r in url_filter.url_filter(captures(spark, caps), events(spark, rows)).collect()}
    for i, url, day in caps:
        past = [(at, action == "remove") for _, _, v, action, at in rows if v == url[7:12] and at <= day]
        assert got[i] == bool(past and not max(past)[1])
