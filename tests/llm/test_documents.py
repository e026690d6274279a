"""N-gram join (3), mixing (4), quality classifier (8) and line dedup (9)
against brute force on small tables."""

import collections
import random
import re
import zlib

import numpy as np
import pytest

from hirelens.llm import _shared, line_dedup, mixing, ngram_join, quality_classifier as qc, queries
from hirelens.llm._shared import Scratch, components, key_filter, passes

from .conftest import EDGE_ROWS, SF

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def lowered(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def shingle_set(text):
    w = WORD.findall(lowered(text))
    return {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def brute_join(rows):
    sets = [shingle_set(t) for _, t in rows]
    comp = list(range(len(rows)))

    def root(i):
        while comp[i] != i:
            i = comp[i]
        return i
    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 80 * len(sets[i] | sets[j]):
                comp[root(i)] = root(j)
    ids = collections.defaultdict(list)
    for i, (d, _) in enumerate(rows):
        if d is not None:
            ids[root(i)].append(d)
    return sorted(str((d, len(sets[i]), min(ids[root(i)]) if ids[root(i)] else None)) for i, (d, _) in enumerate(rows))


def join_rows(df):
    return sorted(str((r.doc_id, r.n_shingles, r.component_id)) for r in df.collect())


def test_query_op3(spark):
    rows = [tuple(r) for r in queries.table(spark, SF, "documents").select("doc_id", "text").collect()]
    assert join_rows(queries.op3_ngram_join(spark, SF)) == brute_join(rows)


def test_op3_edges(spark, edge):
    assert join_rows(ngram_join.ngram_join(edge)) == brute_join([(r[0], r[1]) for r in EDGE_ROWS])


def test_op3_empty(spark, empty):
    assert ngram_join.ngram_join(empty).count() == 0


@pytest.mark.parametrize("seed", [1, 3, 4])
def test_op3_groups_of_near_copies(spark, seed, monkeypatch):
    """Chains of near copies, where many links are not with the hub, around a
    passage that unrelated texts share."""
    monkeypatch.setattr(ngram_join, "STAR_ROUNDS", seed - 1)
    rnd = random.Random(seed)
    passage = [f"p{i}" for i in range(30)]
    rows = []
    for g in range(6):
        words = [f"w{rnd.randrange(3000)}" for _ in range(rnd.choice([20, 60, 120]))]
        for _ in range(25):
            words = list(words)
            for _ in range(rnd.choice([0, 1, 1, 2, 3])):
                words[rnd.randrange(len(words))] = f"w{rnd.randrange(3000)}"
            rows.append((len(rows), " ".join(words)))
    for _ in range(40):
        rows.append((len(rows), " ".join(passage + [f"x{rnd.randrange(9000)}" for _ in range(rnd.choice([3, 8, 40]))])))
    rnd.shuffle(rows)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert join_rows(ngram_join.ngram_join(df)) == brute_join(rows)


def test_labels_of_the_join_are_not_forced_through_the_driver(spark, edge, monkeypatch):
    def refuse(df):
        raise AssertionError("labels grow with the corpus")
    monkeypatch.setattr(ngram_join.F, "broadcast", refuse)
    assert join_rows(ngram_join.ngram_join(edge)) == brute_join([(r[0], r[1]) for r in EDGE_ROWS])


def test_prefixes_of_linked_sets_meet():
    rnd = np.random.default_rng(0)
    order = rnd.integers(0, 200, 1 << ngram_join.SKETCH_BITS).astype(np.uint8)
    for n in range(1, 60):
        s = np.unique(rnd.integers(0, 1 << 63, n).astype(np.uint64))
        for _ in range(5):
            t = np.unique(np.concatenate([s[rnd.random(len(s)) > 0.1], rnd.integers(0, 1 << 63, n // 12).astype(np.uint64)]))
            both = len(np.intersect1d(s, t))
            if both and 100 * both >= 80 * (len(s) + len(t) - both):
                assert len(np.intersect1d(ngram_join.prefix(s, order), ngram_join.prefix(t, order)))


def test_components_of_a_long_path(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(0, 300)] + [(1000, 1001), (1001, 1000)], "a long, b long")
    got = {r.node: r.comp for r in components(edges, Scratch(spark, "test-comp"), "x").collect()}
    assert got == {**{i: 0 for i in range(301)}, 1000: 1000, 1001: 1000}


def test_components_of_paths_with_shuffled_ids(spark):
    rnd = random.Random(7)
    ids = [rnd.sample(range(k * 1000, k * 1000 + 400), 400) for k in range(3)] + [[*range(5101, 5300), 5000]]
    edges = spark.createDataFrame([e for path in ids for e in zip(path, path[1:])], "a long, b long")
    scratch = Scratch(spark, "test-comp")
    got = {r.node: r.comp for r in components(edges, scratch, "x").collect()}
    assert got == {i: min(path) for path in ids for i in path}
    rounds = [int(tag.split("-")[1]) for tag in scratch.tags if tag != "x-edges"]
    assert max(rounds) < 20


def test_a_round_of_components_joins_twice(spark):
    """Small tables are broadcast, and the driver holds them: labels meet in sums where they can."""
    plans = []

    class Seen(Scratch):
        def save(self, df, tag):
            plans.append((tag, df._jdf.queryExecution().optimizedPlan().toString()))
            return super().save(df, tag)
    edges = spark.createDataFrame([(1, 2), (2, 3), (5, 4), (6, 6)], "a long, b long")
    assert sorted(map(tuple, components(edges, Seen(spark, "test-comp"), "x").collect())) == [(1, 1), (2, 1), (3, 1), (4, 4), (5, 4)]
    rounds = [p for tag, p in plans if tag not in ("x-edges", "x-0")]
    # the labels' own join stands in both parts of the sum, and is the same there
    assert rounds and all(len(re.findall(r"Join Inner", p)) == 3 and "Union" in p for p in rounds)


# mixing


def filled(sources, total):
    """{source: (size, weight)}: how far each fills up when water rises by
    weight and stops at twice its size; the level is found by bisection."""
    low, high = 0.0, 2 * total + 1
    for _ in range(300):
        level = (low + high) / 2
        low, high = (level, high) if sum(min(w * level, 2 * n) for n, w in sources.values()) < total else (low, level)
    return {s: min(w * high, 2 * n) for s, (n, w) in sources.items()}


def check_mix(rows, got, share=1.5):
    """rows: (doc_id, source, text); got: rows of the query."""
    size = collections.Counter()
    for _, s, t in rows:
        size[s] += len(WORD.findall(t or ""))
    names = sorted(size, key=lambda s: (s is None, (s or "").encode("utf-32-be")))
    goal = filled({s: (size[s], (5, 2, 1)[i % 3]) for i, s in enumerate(names)}, share * sum(size.values()))
    assert sum(goal.values()) == pytest.approx(share * sum(size.values()))
    assert collections.Counter((r.doc_id, r.size) for r in got) == collections.Counter((d, len(WORD.findall(t or ""))) for d, _, t in rows)
    assert all(0 <= r.taken <= 2 * r.size for r in got)
    taken = collections.Counter()
    by_key = {(d, len(WORD.findall(t or ""))): s for d, s, t in rows}
    for r in got:
        s = by_key[r.doc_id, r.size]
        taken[s] += r.taken
        assert r.source_size == size[s] and r.target == pytest.approx(goal[s])
    for s in names:
        assert abs(taken[s] - goal[s]) <= 0.5


def test_query_op4(spark):
    rows = [tuple(r) for r in queries.table(spark, SF, "documents").select("doc_id", "source", "text").collect()]
    got = queries.op4_mixing(spark, SF).collect()
    check_mix(rows, got)
    assert sorted(map(str, queries.op4_mixing(spark, SF).collect())) == sorted(map(str, got))
    assert all(r.taken == sum(x["to"] - x["from"] for x in r.pieces) for r in got)


def test_op4_shards_follow_the_words(spark, monkeypatch):
    """Shards of about as many words, as the splitting tree says, whose blocks
    are whole and in one shard only."""
    monkeypatch.setattr(mixing, "SHARD_WORDS", 3000)
    docs = queries.table(spark, SF, "documents")
    m = mixing.mix(docs, Scratch(spark, "test-mix"), block_words=100)
    rows = m.documents.collect()
    words = sum(r.taken for r in rows)
    assert m.shards == -(-words // 3000)
    held, homes = collections.Counter(), collections.defaultdict(set)
    for r in rows:
        for x in r.pieces:
            held[x.shard] += x["to"] - x["from"]
            homes[r.source, x["pass"], x.block].add(x.shard)
    assert all(len(s) == 1 for s in homes.values()) and set(held) == set(range(m.shards))
    assert max(held.values()) <= 1.3 * words / m.shards
    quota = np.diff(np.array(m.sources["upto"].tolist()), axis=1, prepend=0)
    drawn = collections.Counter((s, k) for (s, _, _), ks in homes.items() for k in ks)
    assert all(drawn[s, k] == quota[i, k] for i, s in enumerate(m.sources["source"]) for k in range(m.shards))


def test_op4_plans_a_very_large_corpus():
    """Far more words than the drawing library takes as single blocks."""
    import pandas as pd
    sizes = pd.DataFrame({"source": ["a", "b", None], "source_size": [10 ** 14, 3 * 10 ** 13, 5], "n_rows": [10 ** 10, 10 ** 9, 1]})
    words = 1.5 * (13 * 10 ** 13 + 5)
    plan = mixing.plan_sources(sizes, 1.5, 2.0, max(4096, -(-int(words) // mixing.MOST_BLOCKS)), 1000, 4)
    assert plan["draws"].sum() < 10 ** 9 and [u[-1] for u in plan["upto"]] == plan["draws"].tolist()


def test_op4_rows_that_share_a_key_keep_their_other_columns(spark):
    rows = [(1, "one two three", "a", 13, k % 3) for k in range(9000)] + [(2, "four five", "a", 9, 7)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, n_chars long, extra int")
    m = mixing.mix(df, Scratch(spark, "test-mix"))
    out = collections.Counter((r.doc_id, r.extra) for r in mixing.mixed_rows(df, m).collect())
    taken = collections.Counter()
    for r in m.documents.collect():
        taken[r.doc_id] += len(r.pieces)
    assert set(out) == {(1, 0), (1, 1), (1, 2), (2, 7)}
    assert sum(n for (d, _), n in out.items() if d == 1) == taken[1] and min(out.values()) > 0


def test_op4_edges(spark, edge):
    got = mixing.mix(edge, Scratch(spark, "test-mix"), block_words=7, shards=5).documents.collect()
    check_mix([(r[0], r[3], r[1]) for r in EDGE_ROWS], got)


def test_op4_empty(spark, empty):
    assert mixing.mix(empty, Scratch(spark, "test-mix")).documents.count() == 0


def test_op4_shards_hold_disjoint_blocks_and_texts_match(spark, edge):
    m = mixing.mix(edge, Scratch(spark, "test-mix"), block_words=10, shards=8)
    drawn = [(r.source, x["pass"], x.block, x.shard, x["to"] - x["from"]) for r in m.documents.collect() for x in r.pieces]
    home = collections.defaultdict(set)
    for s, p, b, k, _ in drawn:
        home[s, p, b].add(k)
    assert all(len(k) == 1 for k in home.values())
    words = collections.Counter()
    for s, p, b, _, n in drawn:
        words[s, p, b] += n
    assert max(words.values()) == 10
    quota = np.array(m.sources["upto"].tolist())[:, -1]
    assert (quota == m.sources["draws"].to_numpy()).all()
    per_shard = collections.Counter(next(iter(k)) for k in home.values())
    assert max(per_shard.values()) - min(per_shard.values()) <= 3
    out = mixing.mixed_rows(edge, m)
    assert out.columns == edge.columns
    rows = out.collect()
    assert sum(len(WORD.findall(r.text)) for r in rows) == sum(n for *_, n in drawn)
    whole = {r[1] for r in EDGE_ROWS if r[1]}
    assert all(any(r.text in t for t in whole) and r.n_chars == len(r.text) for r in rows)


def test_op4_texts_leave_workers_in_small_batches(spark, edge, monkeypatch):
    """Each pandas UDF of the mix answers a large batch in several small ones,
    with the same values; texts are UTF-8 on both sides, wide characters too."""
    import pandas as pd
    made, whole = [], mixing.F.pandas_udf
    monkeypatch.setattr(mixing.F, "pandas_udf", lambda f, kind: (made.append(f), whole(f, kind))[1])
    mixing.mixed_rows(edge, mixing.mix(edge, Scratch(spark, "test-mix")))
    pack, cut, unpack = made
    rnd = random.Random(4)
    texts = [" ".join(rnd.choice(("日本", "word", "é")) + str(rnd.random()) for _ in range(400)).encode() for _ in range(600)] + [None, b""]
    packed = list(pack(iter([pd.Series(texts, dtype=object), pd.Series([], dtype=object)])))
    plain = list(unpack(iter(packed)))
    n = len(packed[0])
    parts = list(unpack(cut(iter([(packed[0], pd.Series([2] * n), pd.Series([5] * n))]))))
    for out in (packed, plain, parts):
        assert all(sum(map(len, s.iloc[:-1])) < mixing.STEP for s in out)
    assert len(plain) > 4 and [t for s in plain for t in s] == [t or b"" for t in texts]
    assert [t for s in parts for t in s] == [b" ".join(t.split(b" ")[2:5]) for t in texts[:n]]


def test_targets_reshare_until_none_is_above():
    got = mixing.targets([100, 10, 1000, 0], [5, 2, 1, 5], 1665)
    assert got == pytest.approx([200, 20, 1445, 0])


def test_split_tree_is_exact():
    counts = np.array([1000, 3, 0, 77])
    tree = mixing.split_tree(counts, 7, 1)
    assert (tree.sum(0) == counts).all() and (tree >= 0).all() and np.ptp(tree.sum(1)) <= 3
    assert (tree == mixing.split_tree(counts, 7, 1)).all()


# quality classifier


def test_query_op8_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    got = {r.doc_id: r for r in queries.op8_quality_classifier(spark, sf).collect()}
    labels = {r.doc_id: r.quality for r in queries.table(spark, sf, "labels").collect()}
    assert all(r.held_out == (zlib.crc32(str(d).encode()) % 4 == 2) for d, r in got.items())
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in got.values())
    held = [(got[d].predicted, q) for d, q in labels.items() if d in got and got[d].held_out]
    assert np.mean([p == q for p, q in held]) >= 0.97
    assert np.mean([p for p, q in held if q == 1]) >= 0.98


def test_op8_edges(spark, edge, empty):
    labels = spark.createDataFrame([(5, 1, "x"), (8, 0, "x"), (8, 1, "x"), (9, 0, "x"), (6, 1, "x"), (None, 1, "x"), (4, None, "x"), (3, 7, "x")],
                                   "doc_id long, quality int, text string")
    model = qc.train(edge, labels)
    got = qc.classify(edge, model).collect()
    assert sorted(str(r.doc_id) for r in got) == sorted(str(r[0]) for r in EDGE_ROWS)
    assert all(0 <= r.score <= 1 for r in got)
    assert [r.held_out for r in got if r.doc_id is None] == [False, False]
    assert qc.classify(empty, model).count() == 0
    blank = qc.train(empty, labels)
    assert {r.score for r in qc.classify(edge, blank).collect()} == {0.5}
    assert qc.classify(edge.drop("n_chars"), model).count() == len(EDGE_ROWS)
    assert qc.accepted(edge, model, threshold=0.0).columns == edge.columns


def test_the_driver_gives_back_what_fitting_and_filters_held(spark, edge, monkeypatch):
    """The driver keeps a model and a bitmap, not the rows that they were made of."""
    calls, fit = [], qc.fit
    monkeypatch.setattr(qc, "fit", lambda *a: (calls.append("fit"), fit(*a))[1])
    monkeypatch.setattr(qc, "release", lambda: calls.append("released"))
    monkeypatch.setattr(_shared, "release", lambda: calls.append("released"))
    qc.train(edge, spark.createDataFrame([(5, 1), (9, 0), (6, 1)], "doc_id long, quality int"))
    assert calls == ["fit", "released"]
    keys = np.array([3, -7, 1 << 40])
    bitmap = key_filter(spark.createDataFrame([(int(k),) for k in keys], "k long"), "k")
    assert passes(bitmap, keys).all() and not passes(bitmap, keys + 1).any()
    assert calls == ["fit", "released", "released"]


def test_op8_learns_only_from_rows_that_are_not_held_out(spark, edge):
    ids = [d for d in range(1, 10) if zlib.crc32(str(d).encode()) % 4 == 2]
    labels = spark.createDataFrame([(d, d % 2) for d in ids], "doc_id long, quality int")
    assert qc.train(edge, labels).w.any() == np.False_


def test_op8_pairs_in_linear_time():
    """The sum-of-squares identity equals the sum over all pairs."""
    rng = np.random.default_rng(1)
    n = qc.SLOTS + qc.N_STATS
    m = qc.Machine(0.3, rng.normal(size=n), rng.normal(size=(n, qc.RANK)), np.zeros(qc.N_STATS), np.ones(qc.N_STATS))
    got = [qc.features("one two three two, Ünï 12 ###", 30.0), qc.features("", None)]
    slots, values, first = m.rows(got)
    raw = m.raw(slots, values, first)[0]
    for k, (a, z) in enumerate(zip(first, [*first[1:], len(slots)])):
        s, x = slots[a:z], values[a:z]
        want = 0.3 + sum(m.w[i] * v for i, v in zip(s, x)) + sum(
            (m.v[s[i]] @ m.v[s[j]]) * x[i] * x[j] for i in range(len(s)) for j in range(i))
        assert raw[k] == pytest.approx(want)


# line dedup


def brute_lines(rows):
    """rows: (doc_id, text)"""
    places = collections.defaultdict(set)
    mark = lambda t: (t is None, t)

    def chunks(t):
        lines, start = (t or "").split("\n"), 0
        for k, end in enumerate(line_dedup.chunk_ends(lines)):
            yield k, lines[start:end]
            start = end
    for d, t in rows:
        if t:
            for k, c in chunks(t):
                if len(c) > 1:
                    places["\n".join(c)].add((d is None, d or 0, mark(t), k))
    out = []
    for d, t in rows:
        if t is None:
            out.append((d, None))
            continue
        kept = []
        for k, c in chunks(t):
            p = places.get("\n".join(c))
            first = min((x[:2] for x in p)) if p else None
            if len(c) == 1 or not t or ((d is None, d or 0) == first and k == min(x[3] for x in p if x[:2] == first)):
                kept += c
        out.append((d, "\n".join(kept)))
    return sorted(map(str, out))


def test_query_op9(spark):
    rows = [tuple(r) for r in queries.table(spark, SF, "documents").select("doc_id", "text").collect()]
    got = queries.op9_line_dedup(spark, SF).collect()
    assert {r.doc_id: r.text for r in got} == brute_passages(rows)
    assert all(r.n_chars == len(r.text) for r in got if r.n_removed)
    assert sum(r.n_removed for r in got) > 0


def test_op9_edges(spark, edge):
    got = line_dedup.line_dedup(edge, Scratch(spark, "test-lines"))
    assert got.columns == edge.columns + ["n_lines", "n_removed"]
    assert sorted(str((r.doc_id, r.text)) for r in got.collect()) == sorted(str((r[0], r[1])) for r in EDGE_ROWS)


def test_op9_empty(spark, empty):
    assert line_dedup.line_dedup(empty, Scratch(spark, "test-lines")).count() == 0


def test_op9_shared_runs_of_lines(spark):
    rnd = random.Random(4)
    shared = [[f"line {g} {i}" for i in range(12)] for g in range(3)]
    rows = []
    for d in range(60):
        own = [f"own {d} {i} {rnd.random()}" for i in range(rnd.randrange(6))]
        at = rnd.randrange(len(own) + 1)
        rows.append((d if d else None, "\n".join(own[:at] + rnd.choice([*shared, ["a"] * 9, []]) + own[at:])))
    df = spark.createDataFrame([(d, t, 1) for d, t in rows], "doc_id long, text string, chunk int").repartition(4)
    got = line_dedup.line_dedup(df, Scratch(spark, "test-lines")).collect()
    assert sorted(str((r.doc_id, r.text)) for r in got) == brute_lines(rows)
    assert sum(r.n_removed for r in got) > 200


def test_op9_passages_of_50_words(spark):
    """Of a repeated passage of 50 words or more nothing stays but at its first
    place, whatever stands around it and however many lines it has."""
    rnd = random.Random(9)
    say = lambda n: " ".join(f"w{rnd.randrange(10 ** 6)}" for _ in range(n))
    passages = [[say(60)], [say(30), say(25)], [say(20), "", say(20), say(15)], [say(5), say(70), say(4)], [say(9) for _ in range(14)]]
    own = {d: [[say(7)], [say(55)], [say(8)]] for d in range(1, 41)}
    rows = [(d, "\n".join(own[d][0] + passages[d % 5] + own[d][1] + passages[(d + 1) % 5] + own[d][2])) for d in own]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = {r.doc_id: r.text for r in line_dedup.line_dedup(df, Scratch(spark, "test-lines")).collect()}
    seen = set()
    for d in sorted(own):
        want = list(own[d][0])
        for p, after in ((d % 5, own[d][1]), ((d + 1) % 5, own[d][2])):
            want += ([] if p in seen else passages[p]) + after
            seen.add(p)
        assert got[d].split("\n") == want


def test_op9_spans_reach_every_line():
    rnd = random.Random(3)
    for _ in range(200):
        lines = [" ".join(["w"] * rnd.choice([0, 1, 3, 12, 30, 60])) for _ in range(rnd.randrange(1, 12))]
        words = [len(x.split()) for x in lines]
        for a in range(len(lines)):
            for z in range(a + 1, len(lines) + 1):
                if sum(words[a:z]) >= line_dedup.WORDS and words[a] and words[z - 1]:
                    inside = [x for x in line_dedup.spans(lines) if a <= x[0] and x[1] <= z]
                    assert set(range(a, z)) == {k for x in inside for k in range(*x)}


def brute_passages(rows):
    """rows: (doc_id, text), ids not repeated. What is left by the definition:
    of chunks of two lines or more and of all runs of 50 words or more, the
    lines of every place but the first go."""
    places = collections.defaultdict(list)
    for d, t in sorted(rows):
        lines = (t or "").split("\n")
        words = [len(x.split()) for x in lines]
        ends = line_dedup.chunk_ends(lines).tolist() if t else []
        found = {(a, z) for a, z in zip([0, *ends], ends) if z - a > 1}
        for a in range(len(lines)):
            held = 0
            for z in range(a + 1, len(lines) + 1):
                held += words[z - 1]
                if held >= 50 and words[a] and words[z - 1]:
                    found.add((a, z))
        for a, z in sorted(found):
            places["\n".join(lines[a:z]), z - a].append((d, a, z))
    gone = {(d, k) for (first, *others) in places.values() for d, a, z in others
            if d != first[0] or a >= first[2] for k in range(a, z)}
    return {d: t and "\n".join(x for k, x in enumerate(t.split("\n")) if (d, k) not in gone) for d, t in rows}


def test_query_op9_leaves_no_passage(spark):
    rows = [tuple(r) for r in queries.table(spark, SF, "documents").select("doc_id", "text").collect()]
    assert len({d for d, _ in rows}) == len(rows)
    assert {r.doc_id: r.text for r in queries.op9_line_dedup(spark, SF).collect()} == brute_passages(rows)


def test_repeated_ids_are_not_collected(spark, monkeypatch):
    """One row of an id reaches the driver (op 8), and the pieces of rows that
    repeat are in no array together (mixing)."""
    rows = [(i, f"text {i} " + "word " * (k % 3), "a", 9) for i in range(20) for k in range(30)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, n_chars long").repartition(4)
    labels = spark.createDataFrame([(i, i % 2) for i in range(20)], "doc_id long, quality int")
    sizes, whole = [], type(df).toPandas
    monkeypatch.setattr(type(df), "toPandas", lambda self: (lambda out: (sizes.append(len(out)), out)[1])(whole(self)))
    qc.train(df, labels)
    assert 0 < max(sizes) <= 20
    out = mixing.mixed_rows(df, mixing.mix(df, Scratch(spark, "test-mixing"), shards=4))
    assert "collect_list" not in out._jdf.queryExecution().toString()
    assert out.count() > 0
