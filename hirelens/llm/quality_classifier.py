"""Quality classifier: factorisation machine.

A text's features are its hashed words (lower case, 2^14 slots, unit length),
statistics of its structure and its length column. The score is the logistic
of w0 + sum w_i x_i + 1/2 sum_f ((sum v_if x_i)^2 - sum v_if^2 x_i^2): the
pairwise interactions of all features through ``RANK`` factors in time linear
in the features, by the sum-of-squares identity.

It is fitted on ``SAMPLE`` labelled rows at most (those of the smallest seeded
hash of the id), none with crc32(id as text) mod 4 = 2. Labels, lang, source
and id are never inputs of a score. Whole texts are read.

Defined results: null text counts as empty; an empty text gets the score of
its statistics; a null or missing length has a feature of its own; a null id
is not held out; conflicting labels of one id count as 0, other values and
nulls are ignored; without usable labels every score is 0.5; repeated rows
repeat; an empty table gives an empty result. Other columns are not looked at.
"""

from __future__ import annotations

import zlib
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hirelens.llm._shared import release, released, ship_package

SLOTS = 1 << 14
RANK = 8
SAMPLE = 8000
EPOCHS = 12
THRESHOLD = 0.7
N_STATS = 18

# classes of bytes: 0 other (beyond ASCII), 1 lower, 2 upper, 3 digit, 4 space, 5 line end, 6 sentence marks, 7 other marks
_KIND = np.zeros(256, dtype=np.uint8)
_KIND[:128] = 7
for _i, _chars in ((1, b"abcdefghijklmnopqrstuvwxyz"), (2, b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"), (3, b"0123456789"),
                   (4, b" \t\r\f\v"), (5, b"\n"), (6, b".,;:?'\"()-")):
    _KIND[list(_chars)] = _i


def features(text: str | None, length: float | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(word slots, word values, statistics)."""
    text = text or ""
    raw = text.encode("utf-8", "replace")
    kind = np.bincount(_KIND[np.frombuffer(raw, dtype=np.uint8)], minlength=8) / max(1, len(raw))
    words = text.lower().split()
    count = Counter(words)
    n = max(1, len(words))
    upper = sum(map(str.isupper, text.split()))
    marked = sum(not w[-1].isalnum() for w in words)
    plain = sum(map(str.isalpha, words))
    lone = sum(len(w) == 1 and not w.isalnum() for w in words)
    repeats = sum(map(str.__eq__, words, words[1:]))
    lines = text.split("\n")
    stats = np.array([
        np.log1p(len(text)) / 5, np.log1p(len(words)) / 5, sum(map(len, words)) / n / 10,
        kind[1], kind[2], kind[3], kind[4], kind[6], kind[7], upper / n, marked / n, plain / n, lone / n, repeats / n,
        len(count) / n, max(count.values(), default=0) / n,
        np.log1p(max(0.0, length)) / 5 if length is not None and length == length else 0.0,
        1.0 if length is None or length != length else 0.0])
    slots = np.fromiter((zlib.crc32(w.encode("utf-8", "replace")) % SLOTS for w in count), dtype=np.int64, count=len(count))
    values = np.log1p(np.fromiter(count.values(), dtype=np.float64, count=len(count)))
    if len(slots):
        whole = np.bincount(slots, weights=values, minlength=SLOTS) if len(slots) > 2000 else None
        if whole is not None:
            slots = np.flatnonzero(whole)
            values = whole[slots]
        values = values / np.sqrt((values * values).sum())
    return slots, values, stats


@dataclass
class Machine:
    bias: float
    w: np.ndarray
    v: np.ndarray
    mean: np.ndarray
    spread: np.ndarray

    def rows(self, got: list) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(slots, values, first entry of each row) of several texts."""
        stat = np.clip((np.stack([g[2] for g in got]) - self.mean) / self.spread, -4, 4) / 4
        at = np.arange(N_STATS) + SLOTS
        slots = np.concatenate([x for g in got for x in (g[0], at)])
        values = np.concatenate([x for g, s in zip(got, stat) for x in (g[1], s)])
        ends = np.cumsum([len(g[0]) + N_STATS for g in got])
        return slots, values, np.concatenate([[0], ends[:-1]])

    def raw(self, slots, values, first):
        vx = self.v[slots] * values[:, None]
        s = np.add.reduceat(vx, first, axis=0)
        pairs = 0.5 * ((s * s).sum(1) - np.add.reduceat((vx * vx).sum(1), first))
        return self.bias + np.add.reduceat(self.w[slots] * values, first) + pairs, s, vx

    def score(self, got: list) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.raw(*self.rows(got))[0], -30, 30))) if got else np.zeros(0)


def fit(got: list, labels: np.ndarray, seed: int = 8, rate: float = 0.1, decay: float = 1e-4, batch: int = 128) -> Machine:
    """Logistic loss by AdaGrad; the order of rows and the start are seeded."""
    rng = np.random.default_rng(seed)
    n = SLOTS + N_STATS
    zero = Machine(0.0, np.zeros(n), np.zeros((n, RANK)), np.zeros(N_STATS), np.ones(N_STATS))
    if not got or labels.min() == labels.max():
        return zero
    stat = np.stack([g[2] for g in got])
    m = Machine(0.0, np.zeros(n), rng.normal(scale=0.05, size=(n, RANK)), stat.mean(0), np.maximum(stat.std(0), 1e-3))
    gw, gv, gb = np.full(n, 1e-6), np.full((n, RANK), 1e-6), 1e-6
    for _ in range(EPOCHS):
        order = rng.permutation(len(got))
        for lo in range(0, len(order), batch):
            pick = order[lo:lo + batch]
            slots, values, first = m.rows([got[i] for i in pick])
            z, s, vx = m.raw(slots, values, first)
            err = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - labels[pick]) / len(pick)
            of = np.repeat(np.arange(len(pick)), np.diff(np.append(first, len(slots))))
            used, to = np.unique(slots, return_inverse=True)
            ev = err[of] * values
            dw = np.bincount(to, weights=ev, minlength=len(used)) + decay * m.w[used]
            part = ev[:, None] * (s[of] - vx)
            dv = np.stack([np.bincount(to, weights=part[:, f], minlength=len(used)) for f in range(RANK)], axis=1) + decay * m.v[used]
            gw[used] += dw * dw
            gv[used] += dv * dv
            gb += err.sum() ** 2
            m.w[used] -= rate * dw / np.sqrt(gw[used])
            m.v[used] -= rate * dv / np.sqrt(gv[used])
            m.bias -= rate * err.sum() / np.sqrt(gb)
    return m


def held_out(id_col):
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def _columns(docs: DataFrame, id_col: str, text_col: str, length_col: str | None) -> DataFrame:
    length = F.col(length_col).cast("double") if length_col in docs.columns else F.lit(None).cast("double")
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), length.alias("length"))


def _featured(batches):
    for b in batches:
        got = [features(t, n) for t, n in zip(b["text"], b["length"])]
        yield pd.DataFrame({"label": b["label"], "doc_id": b["doc_id"], "slots": [g[0].astype(np.int32).tobytes() for g in got],
                            "vals": [g[1].astype(np.float32).tobytes() for g in got], "stats": [g[2].tobytes() for g in got]})


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", length_col: str | None = "n_chars",
          label_col: str = "quality", sample: int = SAMPLE) -> Machine:
    ship_package(docs.sparkSession)
    usable = (labels.select(F.col(id_col).cast("long").alias("doc_id"), F.col(label_col).cast("int").alias("label"))
              .where("doc_id IS NOT NULL AND label IN (0, 1)").groupBy("doc_id").agg(F.min("label").alias("label"))
              .where(~held_out(F.col("doc_id"))))
    known = _columns(docs, id_col, text_col, length_col).select("doc_id").distinct()
    chosen = (usable.join(known, "doc_id", "left_semi").withColumn("o", F.xxhash64(F.lit(8), "doc_id"))
              .orderBy("o", "doc_id").limit(sample).select("doc_id", "label"))
    rows = (_columns(docs, id_col, text_col, length_col).join(F.broadcast(chosen), "doc_id")  # ``sample`` rows at most
            .mapInPandas(released(_featured), "label int, doc_id long, slots binary, vals binary, stats binary"))
    one = rows.groupBy("doc_id", "label").agg(F.min(F.struct("slots", "vals", "stats")).alias("x"))  # of rows that repeat an id
    got = one.select("doc_id", "label", "x.*").toPandas().sort_values("doc_id", ignore_index=True)
    machine = fit([(np.frombuffer(a, np.int32).astype(np.int64), np.frombuffer(v, np.float32).astype(np.float64), np.frombuffer(s))
                   for a, v, s in zip(got["slots"], got["vals"], got["stats"])], got["label"].to_numpy(dtype=np.float64))
    del got
    release()  # the driver lives on
    return machine


def _scorer(machine: Machine):
    def score(text: pd.Series, length: pd.Series) -> pd.Series:
        out = np.zeros(len(text))
        for lo in range(0, len(text), 256):
            part = slice(lo, lo + 256)
            out[part] = machine.score([features(t, n) for t, n in zip(text.iloc[part], length.iloc[part])])
        return pd.Series(out)
    return score


def classify(docs: DataFrame, machine: Machine, id_col: str = "doc_id", text_col: str = "text",
             length_col: str | None = "n_chars", threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row."""
    ship_package(docs.sparkSession)
    rows = _columns(docs, id_col, text_col, length_col)
    score = F.pandas_udf(_scorer(machine), "double")
    return (rows.select("doc_id", score("text", "length").alias("score"))
            .select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                    F.when(F.col("score") >= threshold, 1).otherwise(0).alias("predicted")))


def accepted(docs: DataFrame, machine: Machine, text_col: str = "text", length_col: str | None = "n_chars",
             threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that score ``threshold`` or more, unchanged."""
    ship_package(docs.sparkSession)
    length = F.col(length_col).cast("double") if length_col in docs.columns else F.lit(None).cast("double")
    score = F.pandas_udf(_scorer(machine), "double")
    return docs.where(score(F.col(text_col), length) >= threshold)
