"""A training-data pipeline over ``documents``: quality classifier, line dedup,
n-gram Jaccard join, mixing, byte-level BPE.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is
written as Parquet and read again as the next stage's ``docs``. All stages but
the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hirelens.llm._shared import Scratch
from hirelens.llm.byte_bpe import encode_decode
from hirelens.llm.line_dedup import line_dedup
from hirelens.llm.mixing import mix, mixed_rows
from hirelens.llm.ngram_join import ngram_join
from hirelens.llm.quality_classifier import accepted, train
from hirelens.llm.queries import table, vocabulary


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier accepts, unchanged."""
    return accepted(docs, train(docs, table(spark, sf_dir, "labels")))


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without chunks of lines that stand elsewhere already."""
    return line_dedup(docs, Scratch(spark, "pipeline-lines")).select(*docs.columns)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates: the one whose id names
    the class. Rows that share an id stay together if one of them stays; rows
    without an id, which no class is named after, stay if their class has no id."""
    found = ngram_join(docs)
    stay = (found.where(F.col("doc_id").eqNullSafe(F.col("component_id")))
            .select(F.col("doc_id").alias("stays")).distinct())
    return docs.join(stay, docs["doc_id"].eqNullSafe(stay["stays"]), "left_semi")


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix of all sources: a row for each piece of a document that it
    takes, once for each time it takes it."""
    return mixed_rows(docs, mix(docs, Scratch(spark, "pipeline-mixing")))


def bpe_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every row encoded and decoded: (doc_id, n_tokens, ids_sha256, decoded_sha256)."""
    return encode_decode(docs, vocabulary("byte_bpe_multi_50k.tiktoken"))


STAGES = [
    ("quality_classifier", quality_stage),
    ("line_dedup", line_dedup_stage),
    ("ngram_join", near_dedup_stage),
    ("mixing", mixing_stage),
    ("byte_bpe", bpe_stage),
]

# The classifier is fitted and the mix is drawn from seeded permutations, which
# SQL can't express; tests/llm/test_pipeline.py checks every stage.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch = Scratch(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (name, stage) in enumerate(STAGES):
        docs = scratch.save(stage(spark, docs, sf_dir), f"{k}-{name}")
        if k > 1:
            scratch.drop(f"{k - 2}-{STAGES[k - 2][0]}")
    return docs
