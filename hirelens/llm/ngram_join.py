"""N-gram Jaccard join by set-relation skipping.

A document's set is its distinct five-word shingles (64-bit hashes). Two
documents link at a Jaccard similarity of 0.8 or more; the answer is the
classes of documents that links connect.

1. Equal sets are one class and are handled once.
2. A set is ordered by a global order, rare shingles first (counts over all
   documents in a table of fixed size, so the order is approximate but the
   same everywhere). Two sets that link share a shingle among the first
   n - ceil(0.8 n) + 1 of each (prefix positions); the rest of the index is
   skipped. The index lists hold classes by prefix shingle, laid out in blocks
   by size, and a set looks only at blocks whose sizes can link with it. An
   entry keeps its position: two sets of n and n' shingles whose first common
   one stands at positions p and p' (from 0) share min(n - p, n' - p') at most,
   so entries where that is less than a link needs, 4/9 (n + n'), are skipped.
   For the smaller set of a pair that leaves the first ninth of its positions,
   and a list without such an entry is skipped whole.
3. Answers by relation. In each list the sets are first compared with one hub
   only, the set that has the list's shingle first. Sets that link with the
   hub are its highly similar sets: their answers contain the hub's, so within
   the hub's component nothing more is compared. Only lists that still hold
   several components are looked at again, and there the pairs across
   components are compared until none is left. So no link between components
   is lost, and a group of n near copies costs about n comparisons in place of
   n^2 / 2.

A map task keeps one hub for each shingle, so the shuffle gets at most one
entry of a shingle from each task, however many documents hold it.

Words are ``[^\\x20\\x09-\\x0D]+`` after lower-casing A-Z. Fewer than five words
are one shingle, the whole sequence.

Defined results: null, empty and blank texts have no shingles and link with
nothing; rows that share an id but not a text are separate documents;
repeated rows repeat; a null id takes part, and a component of null ids only
has a null id; an empty table gives an empty result. Other columns are not
looked at.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hirelens.llm._shared import Scratch, components, key_filter, passes, released

WORDS = 5
SKETCH_BITS = 22
SLOT_BITS = 12
FLUSH = 4_000_000  # postings that a map task holds
STAR_ROUNDS = 2
SMALLER = "9 * pos <= n"
LEAST_BUCKETS = 64
MAY_LINK = "9 * least(n - pos, n2 - pos2) >= 4 * (n + n2) AND 5 * least(n, n2) >= 4 * greatest(n, n2)"

_M = np.uint64(0x9E3779B97F4A7C15)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(text: str | None) -> np.ndarray:
    """Sorted distinct shingle hashes of a whole text."""
    # bytes.lower touches A-Z only, and bytes.split cuts at \x20 and \x09-\x0D
    words = text.encode("utf-8", "surrogatepass").lower().split() if text else []
    if not words:
        return np.zeros(0, dtype=np.uint64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), dtype=np.uint64, count=len(words))
    k = min(WORDS, len(h))
    s = np.full(len(h) - k + 1, k, dtype=np.uint64)
    for i in range(k):
        s = s * _M + h[i:len(h) - k + 1 + i]
    return np.unique(_mix(s))


def _fingerprint(s: np.ndarray) -> tuple[int, int]:
    a, z = np.frombuffer(xxhash.xxh3_128_digest(s.tobytes()), dtype=np.int64).tolist()
    return a, z


def _pack(*arrays) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(b"".join(a.tobytes() for a in arrays))


def _unpack(blob: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(blob)


def _count_cells(batches):
    """How often each cell of the fixed table is hit, in slots of cells."""
    total = np.zeros(1 << SKETCH_BITS, dtype=np.int64)
    mask = np.uint64((1 << SKETCH_BITS) - 1)
    for b in batches:
        for lo in range(0, len(b), 1000):  # bounds the hashes held at once
            got = np.concatenate([shingles(t) for t in b["text"].iloc[lo:lo + 1000]])
            np.add.at(total, (got & mask).astype(np.int64), 1)
    slots = total.reshape(-1, 1 << SLOT_BITS)
    used = np.flatnonzero(slots.any(axis=1))
    for lo in range(0, len(used), 64):
        part = used[lo:lo + 64]
        yield pd.DataFrame({"slot": part.astype(np.int32), "counts": [_pack(slots[i]) for i in part]})


def _levels(batches):
    """Sum the counts of a slot (rows come sorted by slot) and round them to
    quarters of a power of two."""
    slot, total = None, None

    def out():
        return pd.DataFrame({"slot": [slot], "levels": [np.floor(4 * np.log2(total + 1)).astype(np.uint8).tobytes()]})
    for b in batches:
        for k, blob in zip(b["slot"], b["counts"]):
            if k != slot:
                if slot is not None:
                    yield out()
                slot, total = k, np.zeros(1 << SLOT_BITS, dtype=np.int64)
            total += np.frombuffer(_unpack(blob), dtype=np.int64)
    if slot is not None:
        yield out()


def _global_order(texts: DataFrame, buckets: int) -> np.ndarray:
    rows = (texts.mapInPandas(released(_count_cells), "slot int, counts binary")
            .repartition(buckets, "slot").sortWithinPartitions("slot")
            .mapInPandas(released(_levels), "slot int, levels binary")).collect()  # 4 MB, whatever the input
    order = np.zeros(1 << SKETCH_BITS, dtype=np.uint8)
    for slot, levels in rows:
        order[slot << SLOT_BITS:(slot + 1) << SLOT_BITS] = np.frombuffer(levels, dtype=np.uint8)
    return order


def prefix(s: np.ndarray, order: np.ndarray) -> np.ndarray:
    """The first n - ceil(0.8 n) + 1 shingles of a set in the global order, as
    40-bit tokens (two shingles that share a token only add a candidate)."""
    level = order[(s & np.uint64(len(order) - 1)).astype(np.int64)].astype(np.uint64)
    key = (level << np.uint64(56)) | (s >> np.uint64(8))
    p = len(s) - (4 * len(s) + 4) // 5 + 1
    return s[np.argsort(key, kind="stable")[:p]] >> np.uint64(24)


def _sets(order: np.ndarray):
    def run(batches):
        for b in batches:
            rows = []
            for doc_id, text in zip(b["doc_id"], b["text"]):
                s = shingles(text)
                tokens = prefix(s, order) if len(s) else s
                five = tokens.view(np.uint8).reshape(-1, 8)[:, :5]
                rows.append((doc_id, len(s), *_fingerprint(s), five.tobytes()))
            yield pd.DataFrame(rows, columns=["doc_id", "n", "f0", "f1", "prefix"])
    return run


def _tokens(five: bytes) -> np.ndarray:
    out = np.zeros((len(five) // 5, 8), dtype=np.uint8)
    out[:, :5] = np.frombuffer(five, dtype=np.uint8).reshape(-1, 5)
    return out.view(np.uint64)[:, 0]


def _runs(tokens: np.ndarray, cids: np.ndarray, at: np.ndarray):
    """Postings sorted by token and class, and where each token's run starts."""
    by = np.lexsort((cids, tokens))
    tokens, cids, at = tokens[by], cids[by], at[by]
    new = np.ones(len(tokens), dtype=bool)
    new[1:] = tokens[1:] != tokens[:-1]
    return tokens, cids, at, new


def _shared(new: np.ndarray) -> np.ndarray:
    """Which postings have a token that several classes hold."""
    return ~(new & np.append(new[1:], True))


def _postings(buckets: int):
    """Postings by bucket of the token, one for each token and task: the
    smallest class is the task's hub. Where a task holds several classes of a
    token, all of them are known to share it and come out at once, and the
    hub is marked as out."""
    def run(batches):
        tokens, cids, at, held = [], [], [], 0

        def flush():
            t, c, p, new = _runs(np.concatenate(tokens), np.concatenate(cids), np.concatenate(at))
            several = _shared(new)
            yield pd.DataFrame({"bucket": np.int32(-1), "token": t[several].view(np.int64), "cid": c[several],
                                "pos": p[several], "data": None})
            t, c, p, out = t[new], c[new], p[new], several[new]
            bucket = (_mix(t) % np.uint64(buckets)).astype(np.int64)
            by = np.argsort(bucket, kind="stable")
            cuts = np.searchsorted(bucket[by], np.arange(buckets + 1))
            rows = [(k, len(own), _pack(np.diff(t[own], prepend=np.uint64(0)), c[own], p[own], out[own]))
                    for k, own in ((k, by[cuts[k]:cuts[k + 1]]) for k in range(buckets)) if len(own)]
            yield pd.DataFrame({"bucket": np.array([r[0] for r in rows], dtype=np.int32), "token": np.int64(0),
                                "cid": np.array([r[1] for r in rows], dtype=np.int64), "pos": np.int32(0), "data": [r[2] for r in rows]})
        for b in batches:
            for cid, five in zip(b["cid"], b["prefix"]):
                t = _tokens(five)
                tokens.append(t)
                cids.append(np.full(len(t), cid, dtype=np.int64))
                at.append(np.arange(len(t), dtype=np.int32))
                held += len(t)
                if held >= FLUSH:
                    yield from flush()
                    tokens, cids, at, held = [], [], [], 0
        if held:
            yield from flush()
    return run


def _meet(batches):
    """The tokens of a bucket that come from several tasks (rows sorted by
    bucket), without the postings that are out already."""
    bucket, tokens, cids, at = None, [], [], []

    def out():
        # the mark is the lowest bit of the position
        t, c, p, new = _runs(np.concatenate(tokens), np.concatenate(cids), np.concatenate(at))
        keep = _shared(new) & (p & 1 == 0)
        return pd.DataFrame({"token": t[keep].view(np.int64), "cid": c[keep], "pos": (p[keep] >> 1).astype(np.int32)})
    for b in batches:
        for k, n, data in zip(b["bucket"], b["cid"], b["data"]):
            if k != bucket:
                if tokens:
                    yield out()
                bucket, tokens, cids, at = k, [], [], []
            raw = _unpack(data)
            tokens.append(np.cumsum(np.frombuffer(raw, dtype=np.uint64, count=n), dtype=np.uint64))
            cids.append(np.frombuffer(raw, dtype=np.int64, count=n, offset=8 * n))
            pos = np.frombuffer(raw, dtype=np.int32, count=n, offset=16 * n).astype(np.int64)
            at.append(2 * pos + np.frombuffer(raw, dtype=np.bool_, count=n, offset=20 * n))
    if tokens:
        yield out()


def _fetch(bitmap: np.ndarray, null_too: bool):
    def run(batches):
        for b in batches:
            known = b["doc_id"].notna().to_numpy()
            keep = np.where(known, passes(bitmap, b["doc_id"].fillna("0").astype(np.int64).to_numpy()), null_too) if len(b) else known
            b = b[keep]
            f = [_fingerprint(shingles(t)) for t in b["text"]]
            yield pd.DataFrame({"doc_id": b["doc_id"], "f0": np.array([x[0] for x in f], dtype=np.int64),
                                "f1": np.array([x[1] for x in f], dtype=np.int64),
                                "text": [_pack(np.frombuffer((t or "").encode("utf-8", "surrogatepass"), dtype=np.uint8)) for t in b["text"]]})
    return run


def _compare(batches):
    known: dict = {}

    def of(cid, text):
        if cid not in known:
            if len(known) >= 512:
                known.clear()
            known[cid] = shingles(_unpack(text).decode("utf-8", "surrogatepass"))
        return known[cid]
    for b in batches:
        linked = []
        for a, ta, z, tz in zip(b["a"], b["ta"], b["b"], b["tb"]):
            x, y = of(a, ta), of(z, tz)
            shared = len(np.intersect1d(x, y, assume_unique=True))
            linked.append(100 * shared >= 80 * (len(x) + len(y) - shared))
        yield pd.DataFrame({"a": b["a"], "b": b["b"], "linked": np.array(linked, dtype=bool)})


class _Join:
    def __init__(self, docs: DataFrame, scratch: Scratch, id_col: str, text_col: str):
        self.scratch = scratch
        self.texts = docs.select(F.col(id_col).cast("long").cast("string").alias("doc_id"), F.col(text_col).alias("text"))
        self.buckets = max(LEAST_BUCKETS, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))

    def classes(self) -> None:
        order = _global_order(self.texts, self.buckets)
        self.sets = self.scratch.save(
            self.texts.mapInPandas(released(_sets(order)), "doc_id string, n long, f0 long, f1 long, prefix binary")
            .withColumn("doc_id", F.col("doc_id").cast("long")), "sets")
        grouped = (self.sets.where("n > 0").groupBy("f0", "f1", "n")
                   .agg(F.min("doc_id").alias("rep"), F.first("prefix").alias("prefix")))
        self.all = self.scratch.save(grouped.withColumn("cid", F.monotonically_increasing_id()), "classes")
        # the prefixes are with the classes now, and soon in the lists
        self.sets = self.scratch.save(self.sets.drop("prefix"), "rows")
        self.scratch.drop("sets")

    def lists(self) -> None:
        """(token, cid, pos, n) of every token that several classes hold."""
        rows = self.scratch.save(self.all.select("cid", "prefix").mapInPandas(
            released(_postings(self.buckets)), "bucket int, token long, cid long, pos int, data binary"), "postings")
        self.all = self.scratch.save(self.all.drop("prefix"), "names")
        self.scratch.drop("classes")
        met = (rows.where("bucket >= 0").select("bucket", "cid", "data")
               .repartition(self.buckets, "bucket").sortWithinPartitions("bucket").mapInPandas(released(_meet), "token long, cid long, pos int"))
        live = rows.where("bucket < 0").select("token", "cid", "pos").union(met)
        self.live = self.scratch.save(live.join(self.all.select("cid", "n"), "cid"), "live")
        self.scratch.drop("postings")

    def compare(self, pairs: DataFrame, tag: str) -> DataFrame:
        """(a, b, linked) by the whole sets of both."""
        pairs = self.scratch.save(pairs, f"{tag}-pairs")
        need = pairs.select(F.explode(F.array("a", "b")).alias("cid")).distinct()
        need = self.scratch.save(self.all.select("cid", "rep", "f0", "f1").join(need, "cid", "left_semi"), f"{tag}-need")
        found = (self.texts.mapInPandas(released(_fetch(key_filter(need.where("rep IS NOT NULL"), "rep"),
                                               need.where("rep IS NULL").limit(1).count() > 0)),
                                        "doc_id string, f0 long, f1 long, text binary"))
        on = [found["f0"] == need["f0"], found["f1"] == need["f1"], found["doc_id"].cast("long").eqNullSafe(need["rep"])]
        # rows that repeat id and text give a class several times; the answers are the same
        texts = self.scratch.save(found.join(need, on).select("cid", "text"), f"{tag}-texts")
        got = (pairs.join(texts.select(F.col("cid").alias("a"), F.col("text").alias("ta")), "a")
               .join(texts.select(F.col("cid").alias("b"), F.col("text").alias("tb")), "b"))
        out = self.scratch.save(got.mapInPandas(released(_compare), "a long, b long, linked boolean").distinct(), f"{tag}-compared")
        for part in ("texts", "need", "pairs"):
            self.scratch.drop(f"{tag}-{part}")
        return out

    def open_lists(self, label: DataFrame | None) -> DataFrame:
        """The postings of tokens whose classes are in several components, each
        with the list's hub ``x``: the class that has the token first."""
        if label is None:
            rows = self.live.withColumn("comp", F.col("cid"))
        else:
            # labels grow with the corpus: Spark broadcasts them below its own threshold only
            rows = self.live.join(label.withColumnRenamed("node", "cid"), "cid", "left").withColumn("comp", F.coalesce("comp", "cid"))
        several = rows.groupBy("token").agg(
            F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.max(F.expr(SMALLER)).alias("early"),
            F.min(F.struct("pos", "cid", "n", "comp")).alias("x")).where("lo < hi AND early")
        return rows.join(several.select("token", "x"), "token")

    def stars(self, rows: DataFrame) -> DataFrame:
        """For each class the hub of another component that it meets in most
        lists."""
        met = (rows.where("comp <> x.comp")
               .withColumns({"n2": F.col("x.n"), "pos2": F.col("x.pos")}).where(MAY_LINK)
               .groupBy("cid", F.col("x.cid").alias("hub")).agg(F.count("*").alias("times")))
        best = met.groupBy("cid").agg(F.max(F.struct("times", (-F.col("hub")).alias("h"))).alias("best"))
        hub = -F.col("best.h")
        return best.select(F.least("cid", hub).alias("a"), F.greatest("cid", hub).alias("b")).distinct()

    def across(self, rows: DataFrame) -> DataFrame:
        """All pairs across components that share a list and may link: the
        early entries of smaller sets meet larger sets of their own block of
        sizes and of the next one."""
        block = F.floor(F.log(F.col("n").cast("double")) / F.lit(float(np.log(1.25))))
        x = rows.select("token", F.col("cid").alias("x"), F.col("comp").alias("cx"), "n", "pos", block.alias("block"))
        y = rows.where(SMALLER).select("token", F.col("cid").alias("y"), F.col("comp").alias("cy"), F.col("n").alias("n2"),
                                       F.col("pos").alias("pos2"), F.explode(F.array(block, block + 1)).alias("block"))
        return (x.join(y, ["token", "block"]).where("cx <> cy AND (n2 < n OR n2 = n AND y < x)").where(MAY_LINK)
                .select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct())


def ngram_join(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id) for every row."""
    scratch = Scratch(docs.sparkSession, "ngram-join")
    j = _Join(docs, scratch, id_col, text_col)
    j.classes()
    j.lists()
    label, done = None, None
    for r in range(STAR_ROUNDS + 1):
        rows = scratch.save(j.open_lists(label), f"open-{r}")
        pairs = scratch.save(j.stars(rows) if r < STAR_ROUNDS else j.across(rows), f"met-{r}")
        if done is not None:
            pairs = pairs.join(done.select("a", "b"), ["a", "b"], "left_anti")
        found = j.compare(pairs, f"round-{r}")
        done = found if done is None else done.union(found)
        label = components(done.where("linked"), scratch, f"comp-{r}")
    named = j.all.select("cid", "rep", "f0", "f1", "n").join(label.withColumnRenamed("node", "cid"), "cid", "left") \
        .withColumn("comp", F.coalesce("comp", "cid"))
    least = named.groupBy("comp").agg(F.min("rep").alias("component_id"))
    answer = named.join(least, "comp").select("f0", "f1", "n", "component_id")
    rows = j.sets.select("doc_id", "f0", "f1", "n").join(answer, ["f0", "f1", "n"], "left")
    return scratch.finish(rows.select(
        "doc_id", F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id")), "answer")
