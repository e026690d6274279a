"""Mixing sources to target weights by a multivariate-hypergeometric splitting tree.

1. Targets. Sources by code point (null last) weigh 5, 2, 1, repeating, and
   share ``share`` of all words; a target stops at ``most`` times its
   source's words and the excess is shared again by weight.
2. Blocks. The documents of a source stand in a seeded order; every
   ``block_words`` words of that stream are one block, so blocks hold an exact
   number of words. A source gives whole passes over its blocks and, for the
   rest, the first blocks of a seeded permutation; the last one is cut so that
   the words drawn are the target, rounded to a whole word.
3. Shards. A binary tree splits the pool of drawn blocks: each node hands its
   left half a multivariate-hypergeometric draw of its block counts, down to
   one leaf for each output shard. Every leaf's counts are exact and all
   leaves sum to the pool. A shard draws, from each source, the next run of
   that source's permuted blocks, so draws are disjoint.
4. Within a shard, blocks are ordered by a seeded hash.

Sizes. A shard holds about ``SHARD_WORDS`` words, or more on a corpus that
would have over ``MOST_SHARDS`` shards (``shards`` sets another number), and is
one task. A block holds ``block_words`` words, or more on a corpus
of so many that it would have over ``MOST_BLOCKS`` blocks: the library that
draws takes pools of less than 10^9.

The per-source plan (one row for each source, with its shards' quotas) is the
only thing on the driver. Word positions come from sums in small hashed groups
of documents and in ranges of groups, so a source with a third of all documents
is spread over many tasks.

Defined results: a null text has no words; a document without words, or of a
source without words, is taken 0 times and is in no shard; null sources are one
source, the last; a null doc_id is kept; rows that share id, source and text are
separate documents, numbered in the order of a hash of their other columns; an
empty table gives an empty result. Reruns on the same rows agree.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hirelens.llm._shared import Scratch, release
from hirelens.operators.joins import broadcast_if_small

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)
GROUP_DOCS = 1024
RANGE_GROUPS = 1024
SHARD_WORDS = 1 << 22
MOST_SHARDS = 1 << 18
MOST_BLOCKS = 1 << 28
COPIES = 4096
CHUNK = 512
STEP = 1 << 20
BROADCAST_SOURCES = 10_000


def targets(sizes: list[int], weights: list[float], total: float, most: float = 2.0) -> list[float]:
    """Shares of ``total`` by weight, none above ``most`` times its size."""
    out, free = [0.0] * len(sizes), [i for i, n in enumerate(sizes) if n > 0]
    left = min(total, most * sum(sizes))
    while free:
        unit = left / sum(weights[i] for i in free)
        full = [i for i in free if unit * weights[i] > most * sizes[i]]
        if not full:
            for i in free:
                out[i] = unit * weights[i]
            break
        for i in full:
            out[i] = most * sizes[i]
            left -= out[i]
        free = [i for i in free if i not in set(full)]
    return out


def split_tree(counts: np.ndarray, shards: int, seed: int) -> np.ndarray:
    """(shards, sources) block counts: each node's left half is drawn without
    replacement from the node's pool."""
    def split(pool: np.ndarray, leaves: int, node: int) -> list[np.ndarray]:
        if leaves == 1:
            return [pool]
        left = leaves // 2
        n = int(pool.sum()) * left // leaves
        drawn = np.random.default_rng([seed, node]).multivariate_hypergeometric(pool, n, method="marginals")
        return split(drawn, left, 2 * node) + split(pool - drawn, leaves - left, 2 * node + 1)
    return np.stack(split(counts.astype(np.int64), shards, 1)) if len(counts) else np.zeros((shards, 0), dtype=np.int64)


def _turn(n: int, rng: np.random.Generator) -> tuple[int, int]:
    """A seeded permutation of 0..n-1: k -> (a k + b) mod n with a prime to n."""
    a = int(rng.integers(1, n)) if n > 1 else 1
    while math.gcd(a, n) != 1:
        a += 1
    return a % n if n > 1 else 1, int(rng.integers(0, n))


def plan_sources(sizes: pd.DataFrame, share: float, most: float, block_words: int, shards: int, seed: int) -> pd.DataFrame:
    """One row for each source: its target, its draws and where they go."""
    rows = []
    words = [int(n) for n in sizes["source_size"]]
    weights = [float(WEIGHTS[i % len(WEIGHTS)]) for i in range(len(words))]
    for i, (n_words, goal) in enumerate(zip(words, targets(words, weights, share * sum(words), most))):
        n = -(-n_words // block_words)
        want = round(goal)
        turns, draws, cut = [], 0, 0
        if want:
            rng = np.random.default_rng([seed, i])
            passes, rest = divmod(want, n_words)
            turns = [_turn(n, rng) for _ in range(passes + (rest > 0))]
            draws = passes * n
            if rest:
                a, b = turns[-1]
                short = block_words * n - n_words  # words that the last block lacks
                rank = (a * (n - 1) + b) % n
                held = lambda q: q * block_words - (short if q > rank else 0)
                q = -(-rest // block_words)
                q += held(q) < rest
                draws, cut = draws + q, held(q) - rest
        rows.append((goal, n, draws, cut, [t[0] for t in turns], [t[1] for t in turns]))
    out = pd.DataFrame(rows, columns=["target", "blocks", "draws", "cut", "mul", "add"])
    quota = split_tree(out["draws"].to_numpy(), shards, seed)
    out["upto"] = list(np.cumsum(quota, axis=0).T.tolist()) if len(out) else []
    return pd.concat([sizes.reset_index(drop=True), out], axis=1)


@dataclass
class Mix:
    """``documents``: doc_id, source, mark, copies (rows of that key), copy (0,
    1, .. among them), size, source_size, target, taken, pieces (shard, pass,
    block, from, to; word positions). ``sources``: the per-source plan."""
    documents: DataFrame
    sources: pd.DataFrame
    shards: int


def _repeated(n: str, out: str) -> tuple:
    """0 .. n - 1 as rows, by two steps so that no array holds them all."""
    return (F.explode(F.expr(f"sequence(0L, ({n} - 1) div {COPIES})")).alias("_chunk"),
            F.explode(F.expr(f"sequence(_chunk * {COPIES}, least({n}, (_chunk + 1) * {COPIES}) - 1)")).alias(out))


def _shard_of(upto: list[list[int]]) -> str:
    """SQL for the shard of ``draw``, from the shards' last draws of each source
    (constant arrays, searched by chunks, then in one chunk)."""
    arrays = lambda rows: "array(" + ", ".join(f"cast(split('{','.join(map(str, r))}', ',') AS array<bigint>)" for r in rows) + ")"
    ends = arrays([u[CHUNK - 1::CHUNK] or [2 ** 62] for u in upto])
    chunk = f"{CHUNK} * size(filter({ends}[nth], x -> x <= draw))"
    return f"{chunk} + size(filter(slice({arrays(upto)}[nth], {chunk} + 1, {CHUNK}), x -> x <= draw))"


def mix(docs: DataFrame, scratch: Scratch, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        share: float = 1.5, most: float = 2.0, block_words: int = 4096, shards: int | None = None, seed: int = 4) -> Mix:
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(source_col).cast("string").alias("source"),
                       mark(F.col(text_col)).alias("mark"),
                       F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORD)), F.lit(0)).cast("long").alias("size"))
    rows = scratch.save(rows.groupBy("doc_id", "source", "mark", "size").agg(F.count("*").alias("copies")), "rows")
    sizes = (rows.groupBy("source").agg(F.sum(F.col("size") * F.col("copies")).alias("source_size"), F.count("*").alias("n_rows"))
             .orderBy(F.col("source").asc_nulls_last()).toPandas())  # a row for each source
    words = share * float(sum(int(n) for n in sizes["source_size"]))
    shards = shards or min(max(1, math.ceil(words / SHARD_WORDS)), MOST_SHARDS)
    block_words = max(block_words, math.ceil(words / MOST_BLOCKS))
    plan = plan_sources(sizes, share, most, block_words, shards, seed)
    table = spark.createDataFrame(
        [(i, r.source, int(r.source_size), int(r.n_rows), float(r.target), int(r.blocks), int(r.draws), int(r.cut), r.mul, r.add)
         for i, r in enumerate(plan.itertuples())],
        "nth int, source string, source_size long, n_rows long, target double, blocks long, draws long, cut long, "
        "mul array<long>, add array<long>")
    if len(plan) <= BROADCAST_SOURCES:  # beyond it, the join shuffles
        table = F.broadcast(table)
    placed = (rows.join(table.withColumnRenamed("source", "named"), F.col("source").eqNullSafe(F.col("named"))).drop("named")
              .withColumn("order", F.xxhash64(F.lit(seed), "doc_id", "mark"))
              .withColumn("group", F.expr(f"pmod(order, n_rows div {GROUP_DOCS} + 1)"))
              .withColumn("words", F.col("size") * F.col("copies")))
    before = lambda w: w.rowsBetween(Window.unboundedPreceding, -1)
    within = before(Window.partitionBy("source", "group").orderBy("order", "doc_id", "mark", "size"))
    groups = placed.groupBy("source", "group").agg(F.sum("words").alias("held")).withColumn("range", F.expr(f"group div {RANGE_GROUPS}"))
    ranges = groups.groupBy("source", "range").agg(F.sum("held").alias("held"))
    ranges = ranges.select(F.col("source").alias("s"), F.col("range").alias("r"), F.sum("held").over(
        before(Window.partitionBy("source").orderBy("range"))).alias("ranges_ahead"))
    groups = groups.withColumn("groups_ahead", F.sum("held").over(before(Window.partitionBy("source", "range").orderBy("group"))))
    groups = groups.join(ranges, F.col("source").eqNullSafe(F.col("s")) & (F.col("range") == F.col("r"))).select(
        F.col("source").alias("s"), F.col("group").alias("g"),
        (F.coalesce("ranges_ahead", F.lit(0)) + F.coalesce("groups_ahead", F.lit(0))).alias("ahead"))
    chunk, copy = _repeated("copies", "copy")
    at = (placed.withColumn("before", F.coalesce(F.sum("words").over(within), F.lit(0)))
          .join(groups, F.col("source").eqNullSafe(F.col("s")) & (F.col("group") == F.col("g")))
          .select("*", chunk).select("*", copy)
          .withColumn("first", F.col("ahead") + F.col("before") + F.col("copy") * F.col("size")))
    shard = _shard_of([list(u) for u in plan["upto"]]) if len(plan) else "0"
    pieces = F.expr(f"""
        CASE WHEN size = 0 OR draws = 0 THEN cast(array() AS array<struct<shard:int,pass:int,block:bigint,from:bigint,to:bigint>>)
        ELSE filter(flatten(transform(sequence(0, size(mul) - 1), p ->
          transform(sequence(first div {block_words}, (first + size - 1) div {block_words}), k -> transform(
            array(p * blocks + (mul[p] * k + add[p]) % blocks), draw -> struct(
              {shard} AS shard, p AS pass, k AS block,
              greatest(k * {block_words} - first, 0L) AS from,
              CASE WHEN draw >= draws THEN 0L ELSE least(size, (k + 1) * {block_words} - first,
                CASE WHEN draw = draws - 1 THEN least((k + 1) * {block_words}, source_size) - cut - first ELSE size END) END AS to))[0]))),
          x -> x.to > x.from) END""")
    documents = at.withColumn("pieces", pieces)
    documents = documents.withColumn("taken", F.expr("aggregate(pieces, 0L, (n, x) -> n + x.to - x.from)"))
    documents = scratch.save(documents.select("doc_id", "source", "mark", "copies", "copy", "size", "source_size", "target", "taken", "pieces"),
                             "documents")
    scratch.drop("rows")
    return Mix(documents, plan, shards)


def mark(text):
    """What tells texts of one doc_id apart, null from empty included."""
    return F.when(text.isNull(), F.lit(0)).otherwise(F.xxhash64(text))


def _stepwise(make):
    """A pandas UDF's function: ``make()``'s function of one row's values, over
    the rows of a task. Results leave in batches of about ``STEP`` bytes, so that
    a worker and its executor hold few of them at once, however many rows a
    batch had that came in. Texts come and go as UTF-8, never as strings."""
    def run(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
        for columns in batches:
            one, out, held = make(), [], 0
            for row in zip(*(columns if isinstance(columns, tuple) else (columns,))):
                out.append(one(*row))
                held += len(out[-1] or "")
                if held >= STEP:
                    yield pd.Series(out, dtype=object)
                    out, held = [], 0
            if out:
                yield pd.Series(out, dtype=object)
            del columns, out
            release()
    return run


def _packed():
    pack = zstandard.ZstdCompressor(level=3).compress
    return lambda t: pack(t or b"")


def _unpacked():
    return zstandard.ZstdDecompressor().decompress


def _cut():
    """The words from ``start`` to ``end`` of a packed text, with what stands
    between them; null where there is no text to cut."""
    pack, plain, word = zstandard.ZstdCompressor(level=3).compress, zstandard.ZstdDecompressor().decompress, re.compile(WORD.encode())

    def cut(t, start, end):
        if t is None:
            return None
        t = plain(t)
        spans = [m.span() for i, m in enumerate(word.finditer(t)) if i in (start, end - 1)]
        return pack(t[spans[0][0]:spans[-1][1]])
    return cut


def mixed_rows(docs: DataFrame, m: Mix, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
               length_col: str | None = "n_chars", seed: int = 4) -> DataFrame:
    """The mix as rows of ``docs``: one for each piece drawn, its text cut to
    the piece, dealt out by shard (one task each) and in seeded order there.

    Texts move packed: once to their pieces, by a join on the row's key, and
    once to their shards. Only keys that several rows share are numbered first;
    equal rows of such a key are counted before they move."""
    def key(doc_id, source, text_mark):
        """Null-free parts of a row's key, which grouping and join are dealt by."""
        return [F.coalesce(doc_id, F.lit(0)).alias("i"), doc_id.isNull().alias("ni"), F.coalesce(source, F.lit("")).alias("s"),
                source.isNull().alias("ns"), text_mark.alias("k")]
    parts = ["i", "ni", "s", "ns", "k"]
    drawn = m.documents.where("taken > 0").select(*key(F.col("doc_id"), F.col("source"), F.col("mark")), "copies", "copy", "size", "pieces")
    own = key(F.col(id_col).cast("long"), F.col(source_col).cast("string"), mark(F.col(text_col)))
    at = {c: f"o{j}" for j, c in enumerate(docs.columns) if c != text_col}  # apart from the names used here
    others = list(at.values())
    rows = docs.select(*own, *[F.col(f"`{c}`").alias(o) for c, o in at.items()], F.col(text_col).alias("whole"))
    packed = F.pandas_udf(_stepwise(_packed), "binary")(F.col("whole").cast("binary")).alias("packed")
    once = rows.select(*parts, *others, packed).join(drawn.where("copies = 1").drop("copies", "copy").hint("shuffle_hash"), parts)

    shared = broadcast_if_small(drawn.where("copies > 1 AND copy = 0").select(*parts))
    kinds = (rows.join(shared, parts, "left_semi").select(*parts, *others, packed).withColumn("kind", F.xxhash64(*others))
             .groupBy(*parts, "kind").agg(F.count("*").alias("n"), *[F.first(c).alias(c) for c in (*others, "packed")]))
    ahead = Window.partitionBy(*parts).orderBy("kind").rowsBetween(Window.unboundedPreceding, -1)
    chunk, nth = _repeated("n", "nth")
    numbered = (kinds.withColumn("ahead", F.coalesce(F.sum("n").over(ahead), F.lit(0))).select("*", chunk).select("*", nth)
                .select(*parts, (F.col("ahead") + F.col("nth")).alias("copy"), *others, "packed"))
    again = numbered.join(drawn.where("copies > 1").drop("copies"), [*parts, "copy"])
    columns = [*others, "packed", "size"]
    x = once.select(*columns, "pieces").union(again.select(*columns, "pieces")).select(*columns, F.explode("pieces").alias("x"))
    partly = (F.col("x.from") > 0) | (F.col("x.to") < F.col("size"))
    cut = F.pandas_udf(_stepwise(_cut), "binary")(F.when(partly, F.col("packed")), "x.from", "x.to")
    order = F.xxhash64(F.lit(seed), at[source_col], "x.pass", "x.block")
    dealt = (x.select(*others, F.coalesce(cut, "packed").alias("packed"), "x.shard", order.alias("order"), F.col("x.from").alias("from"))
             .repartitionById(m.shards, "shard").sortWithinPartitions("shard", "order", "from")
             .withColumn("text", F.pandas_udf(_stepwise(_unpacked), "binary")("packed").cast("string")))
    value = {text_col: F.col("text")}
    if length_col in docs.columns:
        value[length_col] = F.length("text").cast(docs.schema[length_col].dataType)
    return dealt.select(*[(value[c] if c in value else F.col(at[c])).alias(c) for c in docs.columns])
