"""Byte-level BPE encoding and decoding by a global distinct-word shuffle.

1. Texts become pre-tokens with positions. A segment holds the texts of
   about ``SEGMENT`` pre-tokens: its distinct words, and for each text the
   word number at every position.
2. The words of all segments meet by hash bucket; each distinct word is
   encoded once there, and its ids go back to the segments that hold it.
3. Each segment puts its texts together by position, and decodes the ids
   through the token-byte table.

A segment names a word once, however often it occurs, so a frequent word costs
the shuffle no more than a rare one. The word numbers stay where they were
written (a table bucketed by segment), and only words and their ids move.

Defined results: null text counts as empty (no ids); a null doc_id is kept;
repeated rows give repeated rows; a text of any length is one row of one
segment; an empty table gives an empty result. Other columns are not looked
at. A word whose bytes the ranks can't produce can't occur: the ranks hold
every single byte.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hirelens.llm._pretokens import PATTERN, pretokens
from hirelens.llm._shared import Scratch, released

SEGMENT = 1_000_000
PART = 100_000  # pre-tokens held as text at once, or one text
LEAST_BUCKETS = 64
MOST_BUCKETS = 16_384  # beyond, a segment's words would be a row each; Spark's limit is 100,000

_cache: dict = {}


def load_ranks(path: str) -> dict[bytes, int]:
    """Token bytes and ids of a rank file (bounded by the vocabulary)."""
    if path not in _cache:
        with open(path, "rb") as f:
            _cache[path] = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
    return _cache[path]


def _library(path: str):
    key = ("library", path)
    if key not in _cache:
        import tiktoken
        _cache[key] = tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=load_ranks(path), special_tokens={})
    return _cache[key]


def _pack(*arrays: np.ndarray) -> bytes:
    z = zstandard.ZstdCompressor(level=3)
    return z.compress(b"".join(np.asarray(x).tobytes() for x in arrays))


def _unpack(blob: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(blob)


def _words_blob(words: list[str]) -> bytes:
    """Word lengths as planes of bytes, then the words."""
    raw = [w.encode() for w in words]
    lens = np.array([len(w) for w in raw], dtype=np.uint32)
    return _pack(lens.view(np.uint8).reshape(-1, 4).T, np.frombuffer(b"".join(raw), dtype=np.uint8))


def _words_of(blob: bytes, n: int) -> list[bytes]:
    data = _unpack(blob)
    ends = (np.cumsum(_planes(data, n)) + 4 * n).tolist()
    return [data[a:z] for a, z in zip([4 * n, *ends], ends)]


def _segments(buckets: int, size: int):
    """Rows of a segment: one for each bucket with its words, one for each text
    with its word numbers, one with the bucket of each number. A word's number
    is its rank by frequency in the segment, which packs best."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext
        base, count = TaskContext.get().partitionId() << 32, 0
        seg = _Segment(buckets)
        for b in batches:
            for doc_id, text in zip(b["doc_id"], b["text"]):
                seg.add(doc_id, text)
                if seg.held >= size:
                    yield seg.rows(base + count)
                    seg, count = _Segment(buckets), count + 1
        if seg.ids:
            yield seg.rows(base + count)
    return run


class _Segment:
    """The texts of a segment as numbers of its words, in order of appearance."""

    def __init__(self, buckets: int):
        self.buckets, self.number, self.codes, self.ids, self.sizes, self.held = buckets, {}, [], [], [], 0
        self.waiting: list[str] = []

    def add(self, doc_id, text: str | None) -> None:
        words = pretokens(text) if text else []
        self.ids.append(doc_id)
        self.sizes.append(len(words))
        self.held += len(words) + 1
        self.waiting += words
        if len(self.waiting) >= PART:
            self._number()

    def _number(self) -> None:
        coded = pa.array(self.waiting, type=pa.string()).dictionary_encode()
        self.waiting = []
        known = self.number
        own = [known.setdefault(w, len(known)) for w in coded.dictionary.to_numpy(zero_copy_only=False).tolist()]
        self.codes.append(np.array(own, dtype=np.uint32)[coded.indices.to_numpy(zero_copy_only=False)])

    def rows(self, segment: int) -> pd.DataFrame:
        self._number()
        codes, words = np.concatenate(self.codes), list(self.number)
        by = np.argsort(-np.bincount(codes, minlength=len(words)), kind="stable")
        rank = np.empty(len(words), dtype=np.uint32)
        rank[by] = np.arange(len(words), dtype=np.uint32)
        words, codes = [words[i] for i in by.tolist()], rank[codes]
        bucket = pd.util.hash_array(np.array(words, dtype=object)) % np.uint64(self.buckets) if words else np.zeros(0, np.uint64)
        order = np.argsort(bucket, kind="stable")
        cuts = np.searchsorted(bucket[order], np.arange(self.buckets + 1, dtype=np.uint64))
        rows = [(segment, -2, None, len(words), _pack(bucket.astype(np.uint32)))]
        for k in range(self.buckets):
            if cuts[k] < cuts[k + 1]:
                own = [words[i] for i in order[cuts[k]:cuts[k + 1]]]
                rows.append((segment, k, None, len(own), _words_blob(own)))
        at = 0
        for doc_id, n in zip(self.ids, self.sizes):
            # bytes in planes: the low bytes of all numbers, then the next ones
            rows.append((segment, -1, doc_id, n, _pack(codes[at:at + n].view(np.uint8).reshape(-1, 4).T)))
            at += n
        return pd.DataFrame(rows, columns=["segment", "bucket", "doc_id", "n", "data"])


def _encode(path: str):
    """Each distinct word of a bucket once; the rows come sorted by bucket."""
    def run(batches):
        one = _library(path)._core_bpe.encode_single_piece
        bucket, known = None, {}
        for b in batches:
            rows = []
            for segment, k, n, data in zip(b["segment"], b["bucket"], b["n"], b["data"]):
                if k != bucket:
                    bucket, known = k, {}
                words = _words_of(data, int(n))
                got = []
                for w in words:
                    ids = known.get(w)
                    if ids is None:
                        ids = known[w] = np.array(one(w), dtype=np.uint32).tobytes()
                    got.append(ids)
                flat = np.frombuffer(b"".join(got), dtype=np.uint32)
                rows.append((segment, k, n, len(flat), _pack(np.array([len(x) // 4 for x in got], dtype=np.uint32).view(np.uint8).reshape(-1, 4).T,
                                                             flat.view(np.uint8).reshape(-1, 4).T)))
            yield pd.DataFrame(rows, columns=["segment", "bucket", "n", "n_ids", "data"])
    return run


def _planes(raw: bytes, n: int, offset: int = 0) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(raw, dtype=np.uint8, count=4 * n, offset=offset).reshape(4, n).T).view(np.uint32)[:, 0]


def _together(path: str, with_ids: bool):
    def run(texts: pd.DataFrame, words: pd.DataFrame) -> pd.DataFrame:
        key = ("bytes", path)
        if key not in _cache:
            _cache[key] = {i: w for w, i in load_ranks(path).items()}
        token = _cache[key].__getitem__
        ids, lens = [], []
        for r in words.sort_values("bucket").itertuples():
            raw = _unpack(r.data)
            lens.append(_planes(raw, int(r.n)))
            ids.append(_planes(raw, int(r.n_ids), 4 * int(r.n)))
        of, said = [], []  # a word's ids and their decimal text, by word number
        if lens:
            flat, ends = np.concatenate(ids).tolist(), np.cumsum(np.concatenate(lens)).tolist()
            bucket = np.frombuffer(_unpack(texts.loc[texts["bucket"] == -2, "data"].iloc[0]), dtype=np.uint32)
            of = [None] * len(bucket)
            for number, a, z in zip(np.argsort(bucket, kind="stable").tolist(), [0, *ends], ends):
                of[number] = flat[a:z]
            said = [",".join(map(str, x)) for x in of]
        texts = texts[texts["bucket"] == -1]
        n_of = np.array([len(x) for x in of], dtype=np.int64)
        rows = []
        for doc_id, n, data in zip(texts["doc_id"], texts["n"], texts["data"]):
            number = _planes(_unpack(data), int(n))
            codes = number.tolist()
            full = [i for c in codes for i in of[c]]
            row = [doc_id, int(n_of[number].sum()) if codes else 0,
                   hashlib.sha256(",".join(map(said.__getitem__, codes)).encode()).hexdigest(),
                   hashlib.sha256(b"".join(map(token, full))).hexdigest()]
            rows.append(row + [full] * with_ids)
        return pd.DataFrame(rows, columns=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"] + ["ids"] * with_ids)
    return run


def encode_decode(docs: DataFrame, ranks_path: str, id_col: str = "doc_id", text_col: str = "text",
                  segment: int = SEGMENT, buckets: int | None = None, with_ids: bool = False) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256[, ids]) for every row."""
    spark = docs.sparkSession
    scratch = Scratch(spark, "byte-bpe")
    shuffle = int(spark.conf.get("spark.sql.shuffle.partitions"))
    buckets = buckets or min(max(LEAST_BUCKETS, 2 * shuffle), MOST_BUCKETS)
    rows = docs.select(F.col(id_col).cast("long").cast("string").alias("doc_id"), F.col(text_col).alias("text"))
    name = f"byte_bpe_{uuid.uuid4().hex}"
    (rows.mapInPandas(released(_segments(buckets, segment)), "segment long, bucket int, doc_id string, n long, data binary")
     .write.option("compression", "uncompressed").option("path", scratch.path("segments"))
     .bucketBy(min(shuffle, MOST_BUCKETS), "segment").sortBy("segment").saveAsTable(name))
    try:
        table = spark.table(name)
        words = (table.where("bucket >= 0").select("segment", "bucket", "n", "data")
                 .repartition(buckets, "bucket").sortWithinPartitions("bucket")
                 .mapInPandas(released(_encode(ranks_path)), "segment long, bucket int, n long, n_ids long, data binary"))
        schema = "doc_id string, n_tokens long, ids_sha256 string, decoded_sha256 string"
        return scratch.save(
            table.where("bucket < 0").select("segment", "bucket", "doc_id", "n", "data").groupBy("segment")
            .cogroup(words.groupBy("segment"))
            .applyInPandas(_together(ranks_path, with_ids), schema + (", ids array<bigint>" if with_ids else ""))
            .withColumn("doc_id", F.col("doc_id").cast("long")), "result")
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
        scratch.drop("segments")
