"""Token-ID output as static range asymmetric numeral system files.

Texts become ids with the tokenizers library; the ids of all documents, in
ascending doc_id order, are stored in blocks. One frequency table, counted
over the whole corpus and scaled to 2^18, serves every block. A block holds
whole documents, ``BLOCK_TOKENS`` ids or more; token i belongs to lane
i mod LANES, each lane is a 64-bit rANS state, and all lanes of a block share
one stream of 32-bit words. Every ``STEPS`` steps a checkpoint keeps the lane
states and the word position, so that the segments between checkpoints decode
side by side, and a CRC-32 of the ids guards the block.

The files (under one folder): ``freq`` (sym, freq) and ``blocks`` (part,
block, doc_ids, lens, n_tokens, states, words_at, words, crc) as Parquet, in
ascending doc_id order by (part, block).

Defined results: null text counts as empty and yields the end id alone; a
null doc_id comes after all others; rows that share a doc_id stay separate
documents, ordered by length and checksum; an empty table gives empty files
and an empty result. Other columns are not looked at.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from hirelens.llm._pretokens import is_plain, pretokens
from hirelens.llm._shared import Scratch

BITS = 18
LANES = 2048
STEPS = 64
BLOCK_TOKENS = 1 << 19
PART_TOKENS = 1 << 23
WORDS_KEPT = 500_000  # words that a worker remembers
GROUP_CHARS = 6_000_000
PART_WORDS = 100_000
COUNTS = -1  # in place of a document's length: a task's counts of all symbols
LOW = np.uint64(1 << 31)

_workers: dict = {}


class _Encoder:
    """Whole texts to ids, the end id after each. A text's ids are those of its
    pre-tokens, one after the other, so the library encodes each word once:
    texts are taken in groups, a group's distinct words are looked up among
    those known, new ones go to the library together, and the ids are laid out
    by word number. A text with characters outside the plain set or with the
    string of an added token goes to the library whole."""

    def __init__(self, path: str, end_id: int):
        from tokenizers import Tokenizer
        self.lib = Tokenizer.from_file(path)
        self.added = [t.content for t in self.lib.get_added_tokens_decoder().values()]
        self.feed = self._ids("\n")[0]
        self.end = np.uint32(end_id)
        self._forget()

    def _forget(self) -> None:
        # no pre-token is empty: the empty word stands for the end of a text
        self.known: dict[str, bytes] = {"": self.end.tobytes()}
        self.unkept = 0

    def _ids(self, text: str) -> np.ndarray:
        return np.array(self.lib.encode_batch_fast([text], add_special_tokens=False)[0].ids, dtype=np.uint32)

    def _encode(self, words: list[str]) -> dict[str, bytes]:
        """Pre-tokens that are not blank hold no line feed, and a line feed
        between them is a pre-token of its own, so one text of all of them
        gives their ids, parted by the line feed's."""
        blank = [w for w in words if w.isspace()]
        out = {w: self._ids(w).tobytes() for w in blank}
        solid = [w for w in words if w not in out] if blank else words
        ids = self._ids("\n".join(solid))
        cuts = np.flatnonzero(ids == self.feed)
        if solid and len(cuts) != len(solid) - 1:
            out.update((w, self._ids(w).tobytes()) for w in solid)
        elif solid:
            raw = ids.tobytes()
            out.update(zip(solid, [raw[a:z] for a, z in zip([0, *(4 * cuts + 4).tolist()], [*(4 * cuts).tolist(), len(raw)])]))
        return out

    def _look_up(self, words: list[str]) -> list[bytes]:
        parts = list(map(self.known.get, words))
        new = [w for w, p in zip(words, parts) if p is None]
        if new:
            got = self._encode(new)
            if len(self.known) < WORDS_KEPT:
                self.known.update(got)
            else:  # rare words, mostly: the frequent ones came early
                self.unkept += len(got)
                if self.unkept > 8 * WORDS_KEPT:  # the texts have changed
                    self._forget()
            parts = [got[w] if p is None else p for w, p in zip(words, parts)]
        return parts

    def group(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, where each text's ids end)."""
        sizes, odd, parts, waiting = [], {}, [], []
        for t in texts:
            t = t or ""
            if not is_plain(t) or any(x in t for x in self.added):
                odd[len(sizes) + len(odd)] = t
                continue
            words = pretokens(t)
            sizes.append(len(words) + 1)
            waiting += words
            waiting.append("")
            if len(waiting) >= PART_WORDS:  # then as packed text
                parts.append(pa.array(waiting, type=pa.string()))
                waiting = []
        parts.append(pa.array(waiting, type=pa.string()))
        coded = pa.chunked_array(parts).combine_chunks().dictionary_encode()
        of_word = self._look_up(coded.dictionary.to_numpy(zero_copy_only=False).tolist())
        codes = coded.indices.to_numpy(zero_copy_only=False)
        flat = np.frombuffer(b"".join(of_word), dtype=np.uint32)
        size = np.fromiter(map(len, of_word), dtype=np.int64, count=len(of_word)) // 4
        of = size[codes]  # ids of each word of the group
        ends = np.cumsum(of)
        at = np.repeat((np.cumsum(size) - size)[codes] - ends + of, of)
        at += np.arange(len(at))
        ids = flat[at]
        last = ends[np.cumsum(sizes, dtype=np.int64) - 1]
        if not odd:
            return ids, last
        cut = iter(np.split(ids, last)[:-1])
        every = [np.append(self._ids(odd[k]), self.end) if k in odd else next(cut) for k in range(len(texts))]
        return np.concatenate(every), np.cumsum([len(x) for x in every])

    def __call__(self, texts: pd.Series) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """The texts' ids group by group; a group has GROUP_CHARS characters or
        a text more."""
        sizes = texts.str.len().fillna(0).to_numpy().cumsum()
        cuts = np.flatnonzero(np.diff(sizes // GROUP_CHARS, append=np.inf)) + 1
        for a, z in zip([0, *cuts.tolist()], cuts.tolist()):
            yield self.group(texts.iloc[a:z].tolist())


def _encoder(path: str, end_id: int) -> _Encoder:
    if (path, end_id) not in _workers:
        _workers[path, end_id] = _Encoder(path, end_id)
    return _workers[path, end_id]


def _ids_of(path: str, end_id: int, n_symbols: int):
    kind = np.uint16 if n_symbols <= 1 << 16 else np.uint32

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        enc, pack = _encoder(path, end_id), zstandard.ZstdCompressor(level=1).compress
        columns, total = ["doc_id", "n_tokens", "crc", "ids"], np.zeros(n_symbols, dtype=np.int64)
        for b in batches:
            rows, doc_ids = [], iter(b["doc_id"])
            for ids, ends in enc(b["text"]) if len(b) else ():
                total += np.bincount(ids, minlength=n_symbols)
                whole, small = memoryview(ids.astype("<u4").tobytes()), memoryview(ids.astype(kind).tobytes())
                wide, ends = np.dtype(kind).itemsize, ends.tolist()
                for a, z in zip([0, *ends], ends):
                    rows.append((next(doc_ids), z - a, zlib.crc32(whole[4 * a:4 * z]), pack(small[wide * a:wide * z])))
            yield pd.DataFrame(rows, columns=columns)
        yield pd.DataFrame([(None, COUNTS, 0, pack(total.tobytes()))], columns=columns)
    return run


def _unpack(blob: bytes, n_symbols: int) -> np.ndarray:
    kind = np.uint16 if n_symbols <= 1 << 16 else np.uint32
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), dtype=kind)


def _counts(batches):
    for b in batches:
        for blob in b["ids"]:
            total = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), dtype=np.int64)
            sym = np.flatnonzero(total)
            yield pd.DataFrame({"sym": sym.astype(np.int32), "n": total[sym]})


def scaled(counts: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Frequencies that sum to 2^bits, at least 1 for each symbol that occurs.
    Rounding errors go to the most frequent symbols, in a fixed order."""
    size = 1 << bits
    used = np.flatnonzero(counts)
    out = np.zeros(len(counts), dtype=np.int64)
    if not len(used):
        return out
    if len(used) > size:
        raise ValueError(f"{len(used)} symbols don't fit {bits} bits")
    room = size - len(used)
    total = int(counts[used].sum())
    out[used] = 1 + np.array([int(c) * room // total for c in counts[used].tolist()], dtype=np.int64)
    out[used[np.argmax(counts[used])]] += size - int(out.sum())
    return out


class Coder:
    """rANS over one shared frequency table."""

    def __init__(self, freq: np.ndarray, bits: int = BITS):
        self.bits = np.uint64(bits)
        self.freq = freq.astype(np.uint64)
        ends = np.cumsum(freq)
        self.start = (ends - freq).astype(np.uint64)
        self.slot = np.repeat(np.arange(len(freq)), freq).astype(np.uint16 if len(freq) <= 1 << 16 else np.uint32)
        self.most = int(np.argmax(freq))

    def encode(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(states by checkpoint and lane, word position by checkpoint, words)."""
        steps = -(-len(ids) // LANES)
        sym = np.full(steps * LANES, self.most, dtype=np.int64)
        sym[:len(ids)] = ids
        f, c = (t[sym].reshape(steps, LANES) for t in (self.freq, self.start))
        top = f << (np.uint64(63) - self.bits)
        x = np.full(LANES, LOW, dtype=np.uint64)
        words, states = [None] * steps, {}
        for t in range(steps - 1, -1, -1):
            full = x >= top[t]
            words[t] = x[full].astype(np.uint32)
            x = np.where(full, x >> np.uint64(32), x)
            q = x // f[t]
            x = (q << self.bits) + (x - q * f[t]) + c[t]
            if t % STEPS == 0:
                states[t] = x
        at = np.cumsum([0, *map(len, words)])[:-1]
        marks = range(0, steps, STEPS)
        return np.stack([states[t] for t in marks]), at[::STEPS].astype(np.int64), np.concatenate(words)

    def decode(self, states: np.ndarray, at: np.ndarray, words: np.ndarray, n: int) -> np.ndarray:
        """All segments step together, each from its own checkpoint."""
        steps = -(-n // LANES)
        x, at = states.copy(), at.copy()
        out = np.empty((len(at), STEPS, LANES), dtype=np.uint32)
        mask, lane = np.uint64((1 << int(self.bits)) - 1), np.arange(LANES)
        for t in range(min(STEPS, steps)):
            live = len(at) if (len(at) - 1) * STEPS + t < steps else len(at) - 1
            y = x[:live]
            low = y & mask
            sym = self.slot[low]
            out[:live, t] = sym
            y = self.freq[sym] * (y >> self.bits) + low - self.start[sym]
            need = y < LOW
            rank = np.cumsum(need, axis=1, dtype=np.int32)
            take = (at[:live, None] + rank - 1)[need]
            y[need] = (y[need] << np.uint64(32)) | words[take]
            at[:live] += rank[:, -1]
            x[:live] = y
        return out.reshape(-1, LANES)[:steps].reshape(-1)[:n]


def _blocks(freq: np.ndarray, n_symbols: int):
    def run(batches):
        from pyspark import TaskContext
        coder, part, block = Coder(freq), TaskContext.get().partitionId(), 0
        docs, held = [], 0

        def flush():
            ids = np.concatenate([d[2] for d in docs]).astype(np.uint32)
            states, at, words = coder.encode(ids)
            return pd.DataFrame([(part, block, [d[0] for d in docs], [d[1] for d in docs], len(ids), states.tobytes(),
                                  at.tobytes(), words.tobytes(), zlib.crc32(ids.tobytes()))],
                                columns=["part", "block", "doc_ids", "lens", "n_tokens", "states", "words_at", "words", "crc"])
        for b in batches:
            for doc_id, n, blob in zip(b["doc_id"], b["n_tokens"], b["ids"]):
                docs.append((doc_id, int(n), _unpack(blob, n_symbols)))
                held += int(n)
                if held >= BLOCK_TOKENS:
                    yield flush()
                    docs, held, block = [], 0, block + 1
        if docs:
            yield flush()
    return run


def write_tokens(docs: DataFrame, path: str, scratch: Scratch, vocabulary: str, end_id: int,
                 n_symbols: int, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Write the files of ``docs`` under ``path``."""
    rows = docs.select(F.col(id_col).cast("long").cast("string").alias("doc_id"), F.col(text_col).alias("text"))
    ids = scratch.save(rows.mapInPandas(_ids_of(vocabulary, end_id, n_symbols),
                                        "doc_id string, n_tokens long, crc long, ids binary")
                       .withColumn("doc_id", F.col("doc_id").cast("long")), "ids")
    count = ids.where(F.col("n_tokens") == COUNTS).select("ids").mapInPandas(_counts, "sym int, n long").groupBy("sym").agg(F.sum("n").alias("n"))
    got = count.toPandas()  # a row for each symbol of the vocabulary at most
    counts = np.zeros(n_symbols, dtype=np.int64)
    counts[got["sym"].to_numpy()] = got["n"].to_numpy()
    freq = scaled(counts)
    used = np.flatnonzero(freq)
    docs.sparkSession.createDataFrame(
        [(int(s), int(freq[s])) for s in used], "sym int, freq long").coalesce(1).write.parquet(f"{path}/freq")
    parts = max(1, -(-int(counts.sum()) // PART_TOKENS))
    order = [F.col("doc_id").asc_nulls_last(), F.col("n_tokens"), F.col("crc")]
    (ids.where(F.col("n_tokens") > 0).repartitionByRange(parts, *order).sortWithinPartitions(*order)
     .withColumn("doc_id", F.col("doc_id").cast("string"))
     .mapInPandas(_blocks(freq, n_symbols),
                  "part int, block int, doc_ids array<string>, lens array<bigint>, n_tokens long, "
                  "states binary, words_at binary, words binary, crc long")
     .withColumn("doc_ids", F.col("doc_ids").cast("array<bigint>"))
     .write.parquet(f"{path}/blocks"))
    scratch.drop("ids")


def read_tokens(spark: SparkSession, path: str, n_symbols: int, with_ids: bool = False) -> DataFrame:
    """Documents of the files: (part, block, pos, doc_id, n_tokens, start, ids_crc32
    and, if asked for, ids as an array)."""
    got = spark.read.parquet(f"{path}/freq").toPandas()
    freq = np.zeros(n_symbols, dtype=np.int64)
    freq[got["sym"].to_numpy()] = got["freq"].to_numpy()

    def decode(batches):
        coder = Coder(freq) if len(got) else None
        for b in batches:
            for r in b.itertuples(index=False):
                ids = coder.decode(np.frombuffer(r.states, dtype=np.uint64).reshape(-1, LANES),
                                   np.frombuffer(r.words_at, dtype=np.int64),
                                   np.frombuffer(r.words, dtype=np.uint32), int(r.n_tokens))
                raw = memoryview(ids.astype("<u4").tobytes())
                if zlib.crc32(raw) != r.crc:
                    raise ValueError(f"block {r.part}/{r.block}: checksum differs")
                ends = np.cumsum(np.asarray(r.lens, dtype=np.int64))
                starts = ends - np.asarray(r.lens, dtype=np.int64)
                out = pd.DataFrame({"part": r.part, "block": r.block, "pos": np.arange(len(ends), dtype=np.int32),
                                    "doc_id": list(r.doc_ids),
                                    "n_tokens": ends - starts, "before": starts,
                                    "ids_crc32": [zlib.crc32(raw[4 * a:4 * z]) for a, z in zip(starts.tolist(), ends.tolist())]})
                if with_ids:
                    out["ids"] = [ids[a:z].tolist() for a, z in zip(starts, ends)]
                yield out
    blocks = spark.read.parquet(f"{path}/blocks")
    docs = blocks.withColumn("doc_ids", F.col("doc_ids").cast("array<string>")).mapInPandas(
        decode, "part int, block int, pos int, doc_id string, n_tokens long, before long, "
                              "ids_crc32 long" + (", ids array<bigint>" if with_ids else ""))
    sizes = blocks.select("part", "block", "n_tokens")
    by_part = sizes.groupBy("part").agg(F.sum("n_tokens").alias("held"))  # a row for each file
    ahead = by_part.select("part", (F.sum("held").over(Window.orderBy("part")) - F.col("held")).alias("ahead"))
    w = Window.partitionBy("part").orderBy("block")
    starts = (sizes.withColumn("within", F.sum("n_tokens").over(w) - F.col("n_tokens"))
              .join(ahead, "part").select("part", "block", (F.col("within") + F.col("ahead")).alias("first")))
    return (docs.join(starts, ["part", "block"])
            .withColumn("doc_id", F.col("doc_id").cast("long"))
            .withColumn("start", F.col("first") + F.col("before")).drop("first", "before"))
