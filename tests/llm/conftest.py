import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

SF = "/root/testdata/sf0.001"

# Texts that every operator on documents meets: nulls, empty, blank, ties,
# repeated rows, odd characters and a very long one.
EDGE_ROWS = [
    (1, None, "en", "a", 0), (2, "", "en", "a", 0), (3, " \n\t ", None, "b", 4), (4, "one", "en", None, 3),
    (5, "Don't  stop — 12½ ünï　日本語 <|endoftext|>\r\n\x1c\x85x", "de", "b", None),
    (6, "same text here for two rows ok", "en", "b", 30), (7, "same text here for two rows ok", "en", "c", 30),
    (7, "same text here for two rows ok", "en", "c", 30), (None, "a row without an id", "en", "c", 19),
    (None, None, None, None, None),
    (8, "long " * 30000 + "end", "en", "a", 150003), (9, "x" * 20000, "en", "a", 20000),
]
EDGE_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture()
def edge(spark):
    """The edge rows, with extra columns whose names clash with inner ones."""
    from pyspark.sql import functions as F
    df = spark.createDataFrame(EDGE_ROWS, EDGE_SCHEMA).repartition(3)
    for c in ("id", "key", "body", "size", "n", "row", "segment", "bucket", "part", "start", "block", "cid", "tokens"):
        df = df.withColumn(c, F.lit("extra"))
    return df


@pytest.fixture()
def empty(spark):
    return spark.createDataFrame([], EDGE_SCHEMA)


@pytest.fixture(autouse=True)
def few_buckets(monkeypatch):
    """Small tables need few tasks; no result depends on the number."""
    from hirelens.llm import byte_bpe, ngram_join
    monkeypatch.setattr(byte_bpe, "LEAST_BUCKETS", 4)
    monkeypatch.setattr(ngram_join, "LEAST_BUCKETS", 4)
