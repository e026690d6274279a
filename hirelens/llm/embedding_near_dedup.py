"""Embedding near-dedup by lattice hashing.

Each of ``tables`` hash tables projects the unit vector to 8 dimensions by a
seeded Gaussian matrix and decodes the point to the nearest point of the E8
lattice; that point is the vector's cell. A vector is stored in its own cell
and also looks into the ``probes`` neighbouring cells that its residue points
to most. Two vectors that meet in a cell are a candidate pair; a pair of
128-bit sign sketches drops pairs that are far apart before the shuffle, and
the cosine of the rest is computed in double precision. No pair below the
threshold is linked.

With the defaults, a pair at cosine 0.9 exactly meets with probability about
0.98 and one at 0.97 nearly always (measured in the tests and the README).
Equal vectors are one class from the start, so copies cost one vector.

Defined results: a vector that is null, empty, zero or has a null or
non-finite component links with nothing; vectors of different lengths don't
link; equal vectors link with each other; repeated ids stay separate rows; a
null id counts as a vector, and its component has the smallest id that is not
null; an empty table gives an empty result. Other columns are not looked at.
"""

from __future__ import annotations

import itertools

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hirelens.llm._shared import Scratch, components

SKETCH_FAR = 38  # of 128 bits; 5 standard deviations above the mean at cosine 0.9


def _roots() -> np.ndarray:
    """The 240 shortest vectors of E8."""
    whole = []
    for i, j in itertools.combinations(range(8), 2):
        for s, t in itertools.product((1, -1), repeat=2):
            v = np.zeros(8)
            v[i], v[j] = s, t
            whole.append(v)
    half = [v for v in itertools.product((0.5, -0.5), repeat=8) if sum(x < 0 for x in v) % 2 == 0]
    return np.array(whole + half)


def _d8(x: np.ndarray) -> np.ndarray:
    """Nearest points with whole coordinates of even sum: round, and where the
    sum is odd round the worst coordinate the other way."""
    near = np.rint(x)
    off = x - near
    odd = np.flatnonzero(near.sum(axis=1) % 2 != 0)
    worst = np.abs(off[odd]).argmax(axis=1)
    near[odd, worst] += np.where(off[odd, worst] >= 0, 1, -1)
    return near


def e8_nearest(x: np.ndarray) -> np.ndarray:
    """Nearest points of E8, the union of D8 and D8 moved by one half."""
    a, b = _d8(x), _d8(x - 0.5) + 0.5
    nearer = ((x - a) ** 2).sum(axis=1) <= ((x - b) ** 2).sum(axis=1)
    return np.where(nearer[:, None], a, b)


def _cell(points: np.ndarray, salt: int) -> np.ndarray:
    """A 64-bit key of each lattice point; equal keys are checked later."""
    twice = np.rint(points * 2).astype(np.int64).view(np.uint64)
    h = np.full(points.shape[:-1], (salt * 0x9E3779B97F4A7C15 + 1) % (1 << 64), dtype=np.uint64)
    for k in range(8):
        h = (h ^ twice[..., k]) * np.uint64(0xD6E8FEB86659FD93)
        h ^= h >> np.uint64(32)
    return h.view(np.int64)


def hash_cells(unit: np.ndarray, tables: int, probes: int, width: float, seed: int) -> np.ndarray:
    """(vector, table, 1 + probes) cells; the first is the vector's own."""
    roots = _roots()
    rng = np.random.default_rng([seed, unit.shape[1]])
    out = np.empty((len(unit), tables, 1 + probes), dtype=np.int64)
    for t in range(tables):
        y = unit @ (rng.normal(size=(unit.shape[1], 8)) / width) + rng.random(8) * 2
        home = e8_nearest(y)
        near = np.argsort(-((y - home) @ roots.T), axis=1, kind="stable")[:, :probes]
        salt = t * 1_000_003 + unit.shape[1]
        out[:, t, 0] = _cell(home, salt)
        out[:, t, 1:] = _cell(home[:, None, :] + roots[near], salt)
    return out


def _sketch(unit: np.ndarray, seed: int) -> np.ndarray:
    planes = np.random.default_rng([seed, 1, unit.shape[1]]).normal(size=(unit.shape[1], 128))
    return np.packbits(unit @ planes >= 0, axis=1).view(np.int64)


def _hashed(tables: int, probes: int, width: float, seed: int):
    def run(batches):
        for b in batches:
            vecs = [np.frombuffer(v, dtype=np.float64) for v in b["vec"]]
            for dim in sorted({len(v) for v in vecs}):
                at = [i for i, v in enumerate(vecs) if len(v) == dim]
                unit = np.stack([vecs[i] for i in at])
                unit = unit / np.linalg.norm(unit / np.abs(unit).max(axis=1, keepdims=True), axis=1, keepdims=True) \
                    / np.abs(unit).max(axis=1, keepdims=True)
                cells, sketch = hash_cells(unit, tables, probes, width, seed), _sketch(unit, seed)
                n = tables * (1 + probes)
                yield pd.DataFrame({"cell": cells.reshape(-1), "cid": np.repeat(b["cid"].to_numpy()[at], n),
                                    "home": np.tile(np.arange(1 + probes) == 0, len(at) * tables),
                                    "s0": np.repeat(sketch[:, 0], n), "s1": np.repeat(sketch[:, 1], n)})
    return run


def _to_bytes(batches):
    for b in batches:
        out = []
        for v in b["vec"]:
            x = None if v is None else np.asarray(v, dtype=np.float64)  # a null component reads as nan
            good = x is not None and len(x) and np.isfinite(x).all() and x.any()
            out.append(x.tobytes() if good else None)
        yield b.assign(vec=out)


def _cosine(batches):
    for b in batches:
        out = np.empty(len(b))
        for i, (x, y) in enumerate(zip(b["va"], b["vb"])):
            x, y = np.frombuffer(x), np.frombuffer(y)
            if len(x) != len(y):
                out[i] = -1
                continue
            x, y = x / np.abs(x).max(), y / np.abs(y).max()
            out[i] = np.dot(x, y) / np.sqrt(np.dot(x, x) * np.dot(y, y))
        yield pd.DataFrame({"a": b["a"], "b": b["b"], "cosine": out})


def embedding_near_dedup(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding",
                         threshold: float = 0.9, tables: int = 5, probes: int = 24, width: float = 1.0,
                         seed: int = 20) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for every row."""
    scratch = Scratch(vectors.sparkSession, "embedding-near-dedup")
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vec_col).cast("array<double>").alias("raw"))
    grouped = rows.groupBy("raw").agg(F.count("*").alias("copies"), F.min("vec_id").alias("rep"))
    classes = scratch.save(
        grouped.select(F.monotonically_increasing_id().alias("cid"), "raw", "copies", "rep"), "classes")
    vec = classes.select("cid", F.col("raw").alias("vec")).mapInPandas(_to_bytes, "cid long, vec binary").dropna()
    vec = scratch.save(vec, "vec")
    cells = scratch.save(vec.mapInPandas(_hashed(tables, probes, width, seed),
                                         "cell long, cid long, home boolean, s0 long, s1 long"), "cells")
    own = cells.where("home").select("cell", F.col("cid").alias("x"), F.col("s0").alias("x0"), F.col("s1").alias("x1"))
    met = (cells.join(own, "cell").where("cid <> x")
           .where(f"bit_count(s0 ^ x0) + bit_count(s1 ^ x1) <= {SKETCH_FAR}")
           .select(F.least("cid", "x").alias("a"), F.greatest("cid", "x").alias("b")).distinct())
    pairs = (met.join(vec.select(F.col("cid").alias("a"), F.col("vec").alias("va")), "a")
             .join(vec.select(F.col("cid").alias("b"), F.col("vec").alias("vb")), "b")
             .mapInPandas(_cosine, "a long, b long, cosine double").where(F.col("cosine") >= threshold))
    links = scratch.save(pairs, "links").select("a", "b")
    scratch.drop("cells")
    size = classes.select("cid", "copies")
    both = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    linked = (both.join(size.withColumnRenamed("cid", "b"), "b").groupBy(F.col("a").alias("cid"))
              .agg(F.sum("copies").alias("others")))
    label = components(links, scratch, "comp").withColumnRenamed("node", "cid")
    named = label.join(classes.select("cid", "rep"), "cid")
    smallest = named.groupBy("comp").agg(F.min("rep").alias("component_id"))
    answer = (classes.join(vec.select("cid", F.lit(True).alias("good")), "cid", "left")
              .join(linked, "cid", "left").join(named.join(smallest, "comp").select("cid", "component_id"), "cid", "left")
              .select("raw", "good", "rep", F.coalesce("others", F.lit(0)).alias("others"), "copies", "component_id"))
    # a class whose vector is bad links with nothing: each row is its own component
    by_row = rows.join(
        answer, rows["raw"].eqNullSafe(answer["raw"]), "inner").select(
        "vec_id",
        F.when(F.col("good"), F.col("others") + F.col("copies") - 1).otherwise(0).cast("long").alias("n_links"),
        F.when(F.col("good"), F.coalesce("component_id", "rep")).otherwise(F.col("vec_id")).alias("component_id"))
    return scratch.finish(by_row.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id"))), "answer")
