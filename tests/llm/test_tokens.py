"""Token output (op 1) and byte-level BPE (op 6) against the libraries."""

import base64
import hashlib
import zlib

import numpy as np
import pytest

public_tokenizers = pytest.importorskip("public_tokenizers")

from hirelens.llm import byte_bpe, queries, token_output  # noqa: E402
from hirelens.llm._pretokens import PATTERN, pretokens  # noqa: E402
from hirelens.llm._shared import Scratch  # noqa: E402

from .conftest import EDGE_ROWS, SF  # noqa: E402


def library():
    from tokenizers import Tokenizer
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def tiktoken_library():
    import tiktoken
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
    return tiktoken.Encoding("t", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def expected_output(rows):
    """rows: (doc_id, text) in file order."""
    lib, start, out = library(), 0, []
    for doc_id, text in rows:
        ids = np.array(lib.encode(text or "", add_special_tokens=False).ids + [2], dtype="<u4")
        out.append((doc_id, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    return out


def test_pattern_is_the_published_one():
    assert PATTERN == public_tokenizers.PATTERN


def test_plain_pattern_equals_the_published_one():
    import regex
    for c in [*range(0x250), 0x2014, 0x2019, 0x20ac]:
        s = f"a{chr(c)} {chr(c)}{chr(c)}1 {chr(c)}é  \n{chr(c)} 's{chr(c)}"
        assert pretokens(s) == regex.findall(PATTERN, s)


def test_query_op1(spark):
    docs = sorted(tuple(r) for r in queries.table(spark, SF, "documents").select("doc_id", "text").collect())
    got = sorted(tuple(r) for r in queries.op1_token_output(spark, SF).collect())
    assert got == expected_output(docs)


def written(spark, df):
    scratch = Scratch(spark, "test-tokens")
    path = scratch.path("files")
    token_output.write_tokens(df, path, scratch, public_tokenizers.path("byte_bpe_50k.json"), 2, 50257)
    return token_output.read_tokens(spark, path, 50257, with_ids=True)


def test_op1_edges(spark, edge, monkeypatch):
    monkeypatch.setattr(token_output, "BLOCK_TOKENS", 64)
    got = written(spark, edge).orderBy("start").collect()
    lib = library()
    key = lambda r: (r[0] is None, r[0] or 0, len(lib.encode(r[1] or "", add_special_tokens=False).ids))
    want = expected_output(sorted(((r[0], r[1]) for r in EDGE_ROWS), key=key))
    assert [(r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in got] == want
    assert all(zlib.crc32(np.array(r.ids, dtype="<u4").tobytes()) == r.ids_crc32 for r in got)


def test_op1_empty(spark, empty):
    assert written(spark, empty).count() == 0


def test_coder_round_trip():
    rng = np.random.default_rng(0)
    for n in (1, 5, token_output.LANES, token_output.LANES * token_output.STEPS * 3 + 17):
        ids = np.minimum(rng.zipf(1.3, n), 999)
        coder = token_output.Coder(token_output.scaled(np.bincount(ids, minlength=1000)))
        assert (coder.decode(*coder.encode(ids), n) == ids).all()


def test_coder_one_symbol():
    ids = np.full(3000, 7)
    coder = token_output.Coder(token_output.scaled(np.bincount(ids, minlength=9)))
    assert (coder.decode(*coder.encode(ids), 3000) == 7).all()


def test_scaled_keeps_rare_symbols():
    f = token_output.scaled(np.array([10**12, 0, 1, 1]))
    assert f.sum() == 1 << token_output.BITS and f[1] == 0 and (f[[0, 2, 3]] > 0).all()


def expected_bpe(rows):
    lib, out = tiktoken_library(), []
    for doc_id, text in rows:
        ids = lib.encode_ordinary(text or "")
        out.append((str(doc_id), len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
                    hashlib.sha256((text or "").encode()).hexdigest()))
    return sorted(out)


def bpe_rows(df):
    return sorted((str(r.doc_id), r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in df.collect())


def test_query_op6(spark):
    docs = [tuple(r) for r in queries.table(spark, SF, "documents").select("doc_id", "text").collect()]
    assert bpe_rows(queries.op6_byte_bpe(spark, SF)) == expected_bpe(docs)


def test_op6_edges_in_many_segments(spark, edge):
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    want = expected_bpe([(r[0], r[1]) for r in EDGE_ROWS])
    assert bpe_rows(byte_bpe.encode_decode(edge, path, segment=8, buckets=3)) == want
    assert bpe_rows(byte_bpe.encode_decode(edge, path)) == want


def test_op6_empty(spark, empty):
    assert byte_bpe.encode_decode(empty, public_tokenizers.path("byte_bpe_multi_50k.tiktoken")).count() == 0


def test_op6_text_without_spaces(spark):
    rows = [(1, "xq" * 500_000), (2, "short"), (3, "\u65e5\u672c\u8a9e" * 30_000)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert bpe_rows(byte_bpe.encode_decode(df, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), buckets=3)) == expected_bpe(rows)


def test_op1_strings_of_added_tokens(spark):
    from tokenizers import Tokenizer
    lib = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    rows = [(1, "a <|endoftext|> b"), (2, "plain words"), (3, "<|endoftext|>"), (4, "x<|endoftext|><|endoftext|>\n<|endoftext"), (5, None),
            (6, "\u65e5\u672c <|endoftext|> \xfc")]
    got = written(spark, spark.createDataFrame(rows, "doc_id long, text string").repartition(2)).orderBy("start").collect()
    assert [list(r.ids) for r in got] == [lib.encode(t or "", add_special_tokens=False).ids + [2] for _, t in rows]
    assert list(got[0].ids) == [64, 220, 50256, 275, 2]
