"""Personal data (13): base spans against the plain patterns, added spans on
made texts, estimation of the labelers."""

import hashlib
import random
import re
import time

import numpy as np
import pandas as pd

from hirelens.llm import pii, queries
from hirelens.llm._shared import Scratch

from .conftest import EDGE_ROWS, SF

PATTERNS = (("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
            ("card", r"[0-9]([\x20-]?[0-9])+"), ("phone", r"\+[0-9][\x20().0-9-]+[0-9]"))


def plain_base(text):
    found = []
    for order, (kind, pattern) in enumerate(PATTERNS):
        for m in re.finditer(pattern, text):
            d = [int(c) for c in m[0] if c in "0123456789"]
            odd = sum(d[-1::-2]) + sum(sum(divmod(2 * x, 10)) for x in d[-2::-2])
            if {"email": True, "ip": kind == "ip" and all(int(p) <= 255 for p in m[0].split(".")),
                    "card": 12 <= len(d) <= 19 and odd % 10 == 0, "phone": 9 <= len(d) <= 15}[kind]:
                found.append((m.start(), order, f"{kind}:{m.start()}:{m.end()}"))
    return [x for _, _, x in sorted(found)]


def expected(rows):
    out = []
    for d, text in rows:
        base = plain_base(text or "")
        out.append((d, *(sum(x.startswith(k) for x in base) for k, _ in PATTERNS), hashlib.sha256(",".join(base).encode()).hexdigest()))
    return sorted(map(str, out))


def test_base_spans_on_random_texts():
    rng = random.Random(13)
    pieces = ["@", "@", "a", "b.c", ".", ".", "-", "+", "+4", " ", "1", "23", "255", "256", "4111111111111111", "4111 1111-1111 1111", "(0)",
              "x@y.z", "é", "１", "٣", "%", "\n", "10.0.0.1", "+1 (212) 555-0101", "@a.b@c.d"]
    for _ in range(4000):
        text = "".join(rng.choice(pieces) for _ in range(rng.randint(0, 14)))
        assert pii.scan(text)[0] == ",".join(plain_base(text)), repr(text)


def test_very_long_numbers():
    zeros = "0" * 6000
    assert pii.scan(f"{zeros}1.2.3.{zeros}255 9{zeros}.1.1.1")[0] == f"ip:0:{12_009}"


def test_time_is_linear_in_the_text():
    for unit in ("x", "1", "a@", "1.", "+1 ", "1 ", "-", ". ", "Mr A", "A1", "(0", "at dot "):
        began = time.time()
        pii.scan(unit * (400_000 // len(unit)))
        assert time.time() - began < 8, unit


def test_query_op13(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    got = queries.op13_pii(spark, SF)
    assert got.columns == ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"]
    got = got.collect()
    assert sorted(str(tuple(r)[:6]) for r in got) == expected(rows)
    base = {d: plain_base(t or "") for d, t in rows}
    for r in got:  # base spans stay, and texts without any get none
        assert set(base[r.doc_id]) <= set(r.spans.split(",")) | {""}


def test_op13_edges(spark, edge, empty, tmpdir_path):
    rows = [(r[0], r[1]) for r in EDGE_ROWS] + [(50, "a@b.co 10.1.2.3"), (50, "a@b.co 10.1.2.3"), (51, "z" * 100000 + "@b.co"), (52, "10.1.2.3.4.5.6.7")]
    spark.createDataFrame([(d, t, None, None, 0) for d, t in rows], "doc_id long, text string, base string, id string, n_chars long").write.parquet(
        f"{tmpdir_path}/documents.parquet")
    assert sorted(str(tuple(r)[:6]) for r in queries.op13_pii(spark, tmpdir_path).collect()) == expected(rows)
    assert len(pii.find_personal_data(edge, Scratch(spark, "test-pii")).collect()) == len(EDGE_ROWS)
    assert pii.find_personal_data(empty, Scratch(spark, "test-pii")).collect() == []


def corpus():
    """(text, personal) with candidates of the looser forms in both roles."""
    rng = random.Random(5)
    first, last = ["Anna", "Peter", "Maria", "John", "Laura"], ["Schmidt", "Miller", "Lopez", "Martin", "Novak"]
    for i in range(600):
        who = f"{rng.choice(first)} {rng.choice(last)}"
        number = f"0{rng.randint(10, 99)} {rng.randint(100, 999)} {rng.randint(1000, 9999)}"
        yield rng.choice([f"please call my phone {number} today", f"contact Mr {who} soon", f"write to {who.split()[0].lower()} (at) mail (dot) org now",
                          f"her address is {rng.randint(1, 99)} Oak Street here", f"email {who.split()[0].lower()}@mail.example.org or phone +49 30 {rng.randint(1000000, 9999999)}"]), True
        yield rng.choice([f"version v0{rng.randint(10, 99)} {rng.randint(100, 999)} {rng.randint(1000, 9999)}x of the build",
                          f"isbn page order 0{rng.randint(10, 99)}-{rng.randint(10, 99)}-{rng.randint(10, 99)}", f"invoice total 000-00-0000 page {i}",
                          f"build 300.400.{i}.1 release", f"order {rng.randint(10**15, 10**16 - 1)}a"]), False


def test_added_spans_are_found_and_others_left(spark):
    rows = [(i, t, p) for i, (t, p) in enumerate(corpus())]
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string")
    got = {r.id: r for r in pii.find_personal_data(docs, Scratch(spark, "test-pii")).collect()}
    added = {i: set(filter(None, r.spans.split(","))) - set(filter(None, r.base.split(","))) for i, r in got.items()}
    loose = [i for i, t, p in rows if p and not got[i].base]
    assert sum(bool(added[i]) for i in loose) >= 0.9 * len(loose)
    clean = [i for i, _, p in rows if not p]
    assert sum(bool(added[i]) for i in clean) <= 0.05 * len(clean)


def test_estimation_recovers_the_labelers():
    rng = np.random.default_rng(1)
    truth = rng.random(20_000) < 0.3
    accuracy = [0.95, 0.6, 0.85, 0.7, 0.9, 0.55, 0.8]
    votes = np.array([np.where(rng.random(len(truth)) < a, truth, ~truth) for a in accuracy]).T
    table = pd.DataFrame({"kind": "x", "votes": ["".join("2" if v else "0" for v in row) for row in votes]})
    found = pii.estimate(table.groupby(["kind", "votes"]).size().reset_index(name="n"))
    for i, a in enumerate(accuracy):
        assert abs(found.rates[i, 1, pii.YES] - a) < 0.03 and abs(found.rates[i, 0, pii.NO] - a) < 0.03
    said = np.array([found.posterior["x", v] for v in table["votes"]]) > 0.5
    assert (said == truth).mean() > 0.96
    assert pii.estimate(table.iloc[:0].assign(n=0)).posterior == {}
