"""Conversation repair (11) and prefix trie (12) against plain versions."""

import hashlib
import heapq
import random
import re
import time
import zlib

import pytest

from hirelens.llm import conversation_repair as cr, prefix_trie as pt, queries
from hirelens.llm._shared import Scratch

from .conftest import SF

SCHEMA = "conv_id long, turn long, role string, text string"
INK = re.compile(r"[^\x20\x09-\x0D]")


def cheapest(rows):
    """(cost, edits) of rows [(initial, fault)] by a plain best-first search
    over all edit sequences."""
    heap, seen = [(0, "", 0, "")], set()
    after = lambda q, x: {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}.get((q, x))
    while True:
        cost, path, i, q = heapq.heappop(heap)
        if (i, q) in seen:
            continue
        seen.add((i, q))
        if i == len(rows) and q in ("", "a"):
            return cost, path
        for x in "ua":
            if after(q, x):
                heapq.heappush(heap, (cost + 3, path + "I", i, after(q, x)))
        if i < len(rows):
            initial, fault = rows[i]
            heapq.heappush(heap, (cost + 4, path + "D", i + 1, q))
            if fault not in ("blank", "duplicate"):
                more = 3 * (fault == "truncated")
                if after(q, initial):
                    heapq.heappush(heap, (cost + more, path + "K", i + 1, after(q, initial)))
                for x in "ua":
                    if after(q, x):
                        heapq.heappush(heap, (cost + 3 + more, path + "R", i + 1, after(q, x)))


def plain_repair(rows):
    """The contract's figures for one conversation's rows (turn, role, text)."""
    rows = sorted(((t, " " if r is None else r, " " if x is None else x) for t, r, x in rows),
                  key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
    seen, faults = set(), []
    for _, role, text in rows:
        ink = INK.findall(text)
        faults.append("blank" if not ink else "duplicate" if (role, text) in seen else "truncated" if ink[-1] not in ".!?" else None)
        seen.add((role, text))
    initials = [(r[1] or " ")[0] for r in rows]
    turns = {r[0] for r in rows if r[0] is not None}
    cost, audit = cheapest(list(zip(initials, faults)))
    out, left, i = [], [e for e in audit if e != "D"], 0
    due = [] if not left else (["s"] if len(left) % 2 else []) + ["u", "a"] * (len(left) // 2)
    for e in audit:
        if e != "I":
            _, role, text = rows[i]
            i += 1
        if e != "D":
            x = due[len(out)]
            out.append((role if e == "K" else {"u": "user", "a": "assistant"}[x]) + ":" + ("" if e == "I" else text))
    return (max(turns) - min(turns) + 1 - len(turns) if turns else 0, faults.count("blank"), faults.count("duplicate"),
            faults.count("truncated"), sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])),
            cost, audit, hashlib.sha256("\n".join(out).encode()).hexdigest())


def plain_op11(rows):
    text = lambda v: " " if v is None else str(v)
    convs = {r[0]: [] for r in rows}
    for c, turn, role, words in rows:
        how = zlib.crc32(f"{text(c)}:{text(turn)}".encode()) % 20
        role, words = text(role), text(words)
        if how == 0:
            continue
        words = "" if how == 1 else re.sub("[.!?]", "", words) if how == 2 else words
        convs[c] += [(turn, "user" if how == 4 else role, words)] * (2 if how == 3 else 1)
    return sorted(map(str, ((c, *plain_repair(r)) for c, r in convs.items())))


EDGE = [(1, None, "system", "Be kind."), (1, 0, "user", "hi?"), (1, 2, None, None), (1, 2, "assistant", "Yes."), (1, 9, "assistant", "Yes."),
        (2, 0, "", "x" * 100000 + "."), (2, 1, "user", ""), (2, 1, "user", ""), (3, 5, "assistant", "one.　"), (3, 5, "assistant", " \n"),
        (None, 1, "user", "no id."), (None, None, "tool", "no id\x0b"), (4, 0, "system", "only"), (5, None, None, None),
        (6, 0, "user", "ünï?"), (6, 1, "assistant", "ok."), (6, 2, "user", "ünï?"), (6, 3, "assistant", "ok."), (-7, 3, "ursula", "a."),
        (-7, 4, "assistant", "b!"), *[(20 + i, t, r, f"{r} {i} {t}.") for i in range(12) for t, r in enumerate(["system", "user", "assistant", "user"])]]


def spread(spark, rows):
    """The rows with extra columns whose names clash with inner ones."""
    from pyspark.sql import functions as F
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    for c in ("conv", "place", "held", "block", "edit", "code", "what", "paths", "key", "depth", "bits"):
        df = df.withColumn(c, F.lit("extra"))
    return df


def test_search_finds_the_cheapest_and_ascii_least():
    rng = random.Random(11)
    kinds = [(x, f) for x in "suax" for f in (None, "truncated")] + [("u", "blank")]
    code = {(x, None): x for x in "suax"} | {(x, "truncated"): x.upper() for x in "suax"} | {("u", "blank"): "d"}
    for _ in range(400):
        rows = [rng.choice(kinds) for _ in range(rng.randint(0, 9))]
        cost, path = cr.search("".join(code[r] for r in rows), 0, cr.END)
        assert (cost, path[::2]) == cheapest(rows)


def test_blocks_give_the_same_as_one_search(monkeypatch):
    rng = random.Random(12)
    kinds = {"s": ("s", None), "u": ("u", None), "a": ("a", None), "x": ("x", None), "U": ("u", "truncated"), "d": ("u", "blank")}
    for n in (1, 5, 9, 27, 40):
        for _ in range(6):
            codes = [rng.choice("suaxUd") for _ in range(n)]
            level = [cr.entries("".join(codes[i:i + 3]), i == 0, i + 3 >= n) for i in range(0, n, 3)]
            levels = [level]
            while len(levels[-1]) > 1:
                levels.append([cr.combine(levels[-1][i:i + 3]) for i in range(0, len(levels[-1]), 3)])
            cost = [e.split(",") for e in levels[-1][0].split(";")]
            assert [int(e[2]) for e in cost if e[:2] == ["0", "4"]] == [cheapest([kinds[c] for c in codes])[0]]


def test_search_of_a_block_is_quick():
    began = time.time()
    for codes in ("u" * cr.BLOCK, "x" * cr.BLOCK, "aU" * (cr.BLOCK // 2), "sd" * (cr.BLOCK // 2)):
        cr.entries(codes, False, False)
    assert time.time() - began < 20


def test_query_op11(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    got = queries.op11_conversation_repair(spark, SF)
    assert got.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    assert sorted(str(tuple(r)) for r in got.collect()) == plain_op11(rows)


@pytest.mark.parametrize("block", [2, 32])
def test_op11_edges(spark, tmpdir_path, monkeypatch, block):
    monkeypatch.setattr(cr, "BLOCK", block)
    spread(spark, EDGE).write.parquet(f"{tmpdir_path}/conversations.parquet")
    got = queries.op11_conversation_repair(spark, tmpdir_path)
    assert sorted(str(tuple(r)) for r in got.collect()) == plain_op11(EDGE)


def test_op11_long_conversation(spark, monkeypatch):
    rng = random.Random(13)
    rows = [(1, t, rng.choice(["user", "assistant", "assistant", "system", "tool"]), rng.choice(["a.", "b.", "c", "", f"{t}.", f"{t}"])) for t in range(500)]
    monkeypatch.setattr(cr, "BLOCK", 4)
    scratch = Scratch(spark, "test-repair")
    got = cr.report(cr.repair(spark.createDataFrame(rows, SCHEMA), scratch)).collect()
    assert [tuple(r)[1:] for r in got] == [plain_repair([r[1:] for r in rows])]


def test_op11_empty_table(spark):
    scratch = Scratch(spark, "test-repair")
    assert cr.report(cr.repair(spark.createDataFrame([], SCHEMA), scratch)).collect() == []


def test_repair_returns_the_rows_themselves(spark):
    rows = [(1, 0, "user", "hi."), (1, 1, "user", "there."), (1, 2, "assistant", "")]
    got = cr.repair(spark.createDataFrame(rows, SCHEMA), Scratch(spark, "test-repair")).orderBy("place", "step").collect()
    assert [(r.edit, r.role, r.text) for r in got] == [("K", "user", "hi."), ("R", "assistant", "there."), ("D", "assistant", "")]


def plain_trie(built):
    """Rows of the trie of {conv: [(role, text), ..]}."""
    nodes = {}
    for c in sorted(built):
        for d in range(len(built[c]) + 1):
            nodes.setdefault(tuple(built[c][:d]), []).append(c)
    out = []
    for prefix, members in nodes.items():
        d = len(prefix)
        below = [p for p in nodes if p[:d] == prefix]
        ends = [c for c in members if len(built[c]) == d]
        leaves = [p for p in below if not any(x[:len(p)] == p and len(x) == len(p) + 1 for x in below)]
        out.append((members[0], d, nodes[prefix[:-1]][0] if d else None, len(members), sum(len(p) == d + 1 for p in below),
                    len(leaves), sum((len(nodes[p]) - 1) * len(p[-1][1].encode()) for p in below if p),
                    hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest()))
    return sorted(map(str, out))


def plain_op12(rows):
    own = {}
    for c, t, r, x in sorted((r for r in rows if r[0] is not None), key=lambda r: (r[0], r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")):
        own.setdefault(c, []).append((r or "", x or ""))
    h = {c: zlib.crc32(str(c).encode()) % 9 for c in own}
    return plain_trie({c: own.get(c - (c % 5 if c >= 0 else -(-c % 5)), [])[:h[c]] + own[c][h[c]:] for c in own})


def test_query_op12(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    got = queries.op12_prefix_trie(spark, SF)
    assert [f"{n} {t}" for n, t in got.dtypes] == ["conv_id bigint", "depth bigint", "parent_conv_id bigint", "n_convs bigint", "n_children bigint",
                                                   "n_leaves bigint", "saved_tokens bigint", "ends_sha256 string"]
    assert sorted(str(tuple(r)) for r in got.collect()) == plain_op12(rows)


@pytest.mark.parametrize("block, shard", [(2, 3), (64, 1024)])
def test_op12_edges(spark, tmpdir_path, monkeypatch, block, shard):
    monkeypatch.setattr(pt, "BLOCK", block)
    monkeypatch.setattr(pt, "SHARD", shard)
    spread(spark, EDGE).write.parquet(f"{tmpdir_path}/conversations.parquet")
    got = queries.op12_prefix_trie(spark, tmpdir_path)
    assert sorted(str(tuple(r)) for r in got.collect()) == plain_op12(EDGE)


def test_op12_empty_table(spark, tmpdir_path):
    spark.createDataFrame([], SCHEMA).write.parquet(f"{tmpdir_path}/conversations.parquet")
    assert queries.op12_prefix_trie(spark, tmpdir_path).collect() == []


def test_trie_of_long_shared_conversations(spark, monkeypatch):
    """Many copies and long prefixes, in small shards and blocks."""
    rng = random.Random(14)
    stem = [("user", f"turn {i}") for i in range(150)]
    built = {}
    for c in range(60):
        cut = rng.choice([0, 1, 40, 64, 65, 128, 150])
        built[c] = stem[:cut] + [("assistant", rng.choice("abc"))] * rng.randint(0, 3)
    from pyspark.sql import functions as F
    turns = spark.createDataFrame([(c, i, r, x) for c, s in built.items() for i, (r, x) in enumerate(s)], "conv long, place long, role string, text string")
    turns = turns.select("conv", "place", pt.turn_key("role", "text").alias("turn"), F.octet_length("text").cast("long").alias("size"))
    convs = spark.createDataFrame([(c, len(s)) for c, s in built.items()], "conv long, held long")
    monkeypatch.setattr(pt, "BLOCK", 16)
    monkeypatch.setattr(pt, "SHARD", 4)
    got = pt.prefix_trie(convs, turns, Scratch(spark, "test-trie"))
    got = got.select("conv", "depth", "parent_conv", "n_convs", "n_children", "n_leaves", "saved", "ends_sha256").collect()
    assert sorted(str(tuple(r)) for r in got) == plain_trie(built)
