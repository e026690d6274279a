"""Line dedup by content-defined chunks of lines.

A rolling hash over the hashes of each two neighbouring lines chooses the
chunk boundaries of a text (one line in ``DIVISOR`` ends a chunk, and the last
line does), so the same run of lines is cut the same way wherever it stands.
A chunk of two lines or more that occurs again anywhere in the corpus is
removed, except at its first place (smallest id, then place in the text), once
its bytes have been compared with those of the first place.

So is every run of lines of ``WORDS`` words or more, one line included: for
each line, the shortest such runs that start and that end with it are looked
for, which together hold all lines of any longer repeated passage. Blank lines
at the ends of a passage stay, and so do repeated lines of fewer words outside
chunks.

Places meet by a 128-bit key of their lines. Only places whose key may repeat
move; those of a text that go on in the same first text become one run, and
the lines of a run are compared one by one with those of the first place. The
texts of all documents move once, for the removal.

Defined results: null text stays null and an empty text stays empty; a line
whose place's key repeats but whose bytes differ stays; rows that repeat both id and
text are one place, so they keep or lose the same chunks; a null id comes
after all ids; a text that loses all its lines is empty; every row and every
other column stays; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hirelens.llm._shared import Scratch, key_filter, passes, released

DIVISOR = 3
WORDS = 50  # lines of so many words are a passage


def chunk_ends(lines: list[str]) -> np.ndarray:
    """For each chunk, the line number after its last line."""
    h = np.fromiter((xxhash.xxh64_intdigest(x.encode("utf-8", "surrogatepass")) for x in lines), dtype=np.uint64, count=len(lines))
    before = np.concatenate([np.zeros(1, np.uint64), h[:-1]])
    roll = (h * np.uint64(0x9E3779B97F4A7C15)) ^ (before * np.uint64(0xC2B2AE3D27D4EB4F))
    roll ^= roll >> np.uint64(33)
    ends = np.flatnonzero(roll % np.uint64(DIVISOR) == 0) + 1
    return ends if len(ends) and ends[-1] == len(lines) else np.append(ends, len(lines))


def spans(lines: list[str]) -> list[tuple[int, int]]:
    """(first line, line after the last) of what is looked for elsewhere: the
    chunks of two lines or more, and for each line (of blank ones in a row, the
    outermost) the shortest runs of ``WORDS`` words that start and end with it."""
    ends = chunk_ends(lines).tolist()
    found = {(a, z) for a, z in zip([0, *ends], ends) if z - a > 1}
    words = np.fromiter((len(x.split()) for x in lines), dtype=np.int64, count=len(lines))
    total = np.concatenate([np.zeros(1, np.int64), np.cumsum(words)])
    if total[-1] >= WORDS:
        full = words > 0  # of blank lines in a row, the first starts runs and the last ends some
        opens = np.flatnonzero(full | np.concatenate([[True], full[:-1]]))
        closes = np.flatnonzero(full | np.concatenate([full[1:], [True]])) + 1
        to = np.searchsorted(total, total[opens] + WORDS)
        since = np.searchsorted(total, total[closes] - WORDS, side="right") - 1
        found.update((a, z) for a, z in zip(opens.tolist(), to.tolist()) if z <= len(lines))
        found.update((a, z) for a, z in zip(since.tolist(), closes.tolist()) if a >= 0)
    return sorted(found)


def _keyed(text: str):
    """(first line, line after the last, 128-bit key) of the spans of a text."""
    lines = text.split("\n")
    own = [xxhash.xxh3_128_digest(x.encode("utf-8", "surrogatepass")) for x in lines]
    for a, z in spans(lines):
        yield a, z, xxhash.xxh3_128_digest(b"".join(own[a:z]))


def _keys(batches):
    for b in batches:
        raw = b"".join(key for text in b["text"] if text for _, _, key in _keyed(text))
        yield pd.DataFrame({"k0": np.frombuffer(raw, dtype=np.int64)[::2]})


def _places(bitmap: np.ndarray):
    def run(batches):
        for b in batches:
            at, keys = [], []
            for n, text in enumerate(b["text"]):
                for a, z, key in _keyed(text) if text else ():
                    at.append((n, a, z))
                    keys.append(key)
            at = np.array(at, dtype=np.int64).reshape(-1, 3)
            key = np.frombuffer(b"".join(keys), dtype=np.int64).reshape(-1, 2)
            good = passes(bitmap, key[:, 0])
            at, key = at[good], key[good]
            out = b[["i", "no", "mark"]].iloc[at[:, 0]].reset_index(drop=True)
            yield out.assign(start=at[:, 1].astype(np.int32), end=at[:, 2].astype(np.int32), k0=key[:, 0], k1=key[:, 1])
    return run


def _runs(batches):
    """The spans of a text that stand elsewhere as few runs: spans that go on
    in the same text there become one, and a run whose lines are all in others
    is left out."""
    columns = ["i", "no", "mark", "hi", "hno", "hmark", "start", "end", "from"]
    for b in batches:
        rows = []
        for i, no, mark, *lists in zip(b["i"], b["no"], b["mark"], b["hi"], b["hno"], b["hmark"], b["start"], b["end"], b["from"]):
            open_, merged = {}, []
            for hi, hno, hmark, a, z, f in sorted(zip(*[x.tolist() for x in lists]), key=lambda x: x[3:5]):
                run = open_.get((hi, hno, hmark, a - f))
                if run is not None and a <= run[4]:
                    run[4] = max(run[4], z)
                else:
                    run = open_[hi, hno, hmark, a - f] = [hi, hno, hmark, a, z, f]
                    merged.append(run)
            merged.sort(key=lambda x: (x[3], -x[4]))
            at, k = 0, 0
            while k < len(merged):  # the run that reaches furthest among those that start in time
                best = None
                at = max(at, merged[k][3])
                while k < len(merged) and merged[k][3] <= at:
                    if merged[k][4] > at and (best is None or merged[k][4] > best[4]):
                        best = merged[k]
                    k += 1
                if best is not None:
                    rows.append((i, no, mark, *best))
                    at = best[4]
        yield pd.DataFrame(rows, columns=columns)


def _cut(text: pd.Series, start: pd.Series, end: pd.Series) -> pd.Series:
    out = []
    for t, starts, ends in zip(text, start, end):
        lines = t.split("\n")
        out.append(["\n".join(lines[a:z]) for a, z in zip(starts, ends)])
    return pd.Series(out, dtype=object)


def _passing(bitmap: np.ndarray):
    return F.pandas_udf(lambda key: pd.Series(passes(bitmap, key.to_numpy())), "boolean")


def _without(text: pd.Series, start: pd.Series, head: pd.Series) -> pd.DataFrame:
    rows = []
    for t, starts, heads in zip(text, start, head):
        if t is None:
            rows.append((None, 0, 0))
            continue
        lines = t.split("\n")
        if starts is None or not len(starts):
            rows.append((t, len(lines), 0))
            continue
        gone = set()
        for a, h in zip(starts, heads):
            gone.update(k for k, line in enumerate(h.split("\n"), int(a)) if k < len(lines) and lines[k] == line)
        rows.append(("\n".join(x for k, x in enumerate(lines) if k not in gone), len(lines), len(gone)))
    return pd.DataFrame(rows, columns=["text", "n_lines", "n_removed"])


def line_dedup(docs: DataFrame, scratch: Scratch, id_col: str = "doc_id", text_col: str = "text",
               length_col: str | None = "n_chars") -> DataFrame:
    """The rows of ``docs`` with the text that is left, the length column set
    to it, and ``n_lines`` and ``n_removed`` (lines before, lines removed)."""
    mark = F.when(F.col(text_col).isNull(), F.lit(0)).otherwise(F.xxhash64(text_col))
    name = [F.coalesce(F.col(id_col).cast("long"), F.lit(0)).alias("i"), F.col(id_col).cast("long").isNull().alias("no"), mark.alias("mark")]
    rows = docs.select(*name, F.col(text_col).alias("text"))
    often = scratch.save(rows.select("text").mapInPandas(released(_keys), "k0 long").groupBy("k0").agg(F.count("*").alias("n"))
                         .where("n > 1").select("k0"), "often")
    places = scratch.save(rows.mapInPandas(released(_places(key_filter(often, "k0"))),
                                           "i long, no boolean, mark long, start int, end int, k0 long, k1 long"), "places")
    at = F.struct("no", "i", "mark", "start")
    first = scratch.save(places.groupBy("k0", "k1").agg(F.min(at).alias("first"), F.max(at).alias("last"))
                         .where("first <> last").drop("last"), "first")
    # a run of lines that overlaps its first place is no other place
    again = (places.join(first, ["k0", "k1"]).where(at != F.col("first"))
             .where("i <> first.i OR no <> first.no OR mark <> first.mark OR start >= first.start + end - start"))
    listed = again.groupBy("i", "no", "mark").agg(F.collect_set(F.struct(
        F.col("first.i").alias("hi"), F.col("first.no").alias("hno"), F.col("first.mark").alias("hmark"),
        "start", "end", F.col("first.start").alias("from"))).alias("x"))
    runs = scratch.save(
        listed.select("i", "no", "mark", *[F.col(f"x.{c}").alias(c) for c in ("hi", "hno", "hmark", "start", "end", "from")])
        .mapInPandas(released(_runs), "i long, no boolean, mark long, hi long, hno boolean, hmark long, start int, end int, from int"), "runs")
    head = ["hi", "hno", "hmark"]
    runs = runs.withColumn("to", F.expr("`from` + `end` - start"))
    wanted = runs.select(*head, "from", "to").distinct().groupBy(*head).agg(F.collect_list(F.struct("from", "to")).alias("x"))
    named = rows.withColumnsRenamed({"i": "hi", "no": "hno", "mark": "hmark"})
    seen = _passing(key_filter(runs.select(F.xxhash64(*head).alias("key")), "key"))
    texts = (named.where("text IS NOT NULL").where(seen(F.xxhash64(*head))).join(wanted, head)
             .withColumn("cut", F.pandas_udf(_cut, "array<string>")("text", "x.from", "x.to"))
             .select(*head, F.explode(F.arrays_zip(F.col("x.from").alias("from"), F.col("x.to").alias("to"), "cut")).alias("y"))
             .groupBy(*head, F.col("y.from").alias("from"), F.col("y.to").alias("to")).agg(F.first("y.cut").alias("head")))
    texts = scratch.save(texts, "texts")
    gone = (runs.join(texts, [*head, "from", "to"]).groupBy("i", "no", "mark")
            .agg(F.collect_list(F.struct("start", "head")).alias("gone")))
    gone = scratch.save(gone, "gone").withColumnsRenamed({"i": "_i", "no": "_n", "mark": "_m"})
    for done in ("often", "places", "first", "runs", "texts"):
        scratch.drop(done)
    own = docs.select(F.struct(*docs.columns).alias("row"), *[c.alias(n) for c, n in zip(name, ("_d", "_o", "_k"))])
    joined = own.join(gone, (F.col("_d") == F.col("_i")) & (F.col("_o") == F.col("_n")) & (F.col("_k") == F.col("_m")), "left")
    left = F.pandas_udf(_without, "text string, n_lines long, n_removed long")
    out = joined.select("row", left(F.col("row").getField(text_col), "gone.start", "gone.head").alias("left"))
    value = {text_col: F.col("left.text")}
    if length_col in docs.columns:
        value[length_col] = F.when(F.col("left.n_removed") > 0, F.length("left.text").cast(docs.schema[length_col].dataType)) \
            .otherwise(F.col("row").getField(length_col))
    return out.select(*[value.get(c, F.col("row").getField(c)).alias(c) for c in docs.columns if c not in ("n_lines", "n_removed")],
                      "left.n_lines", "left.n_removed")
