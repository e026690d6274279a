"""Continuous form of the daily ingest (the source runs it as a daily
batch poll): landed JSON files are read as a stream and every micro-batch
runs the same ingest plan inside ``foreachBatch``, appending to a parquet
table.

Replaying a micro-batch after a failure is harmless: the batch is
anti-joined against the postings already in the target, so IDs that were
appended before the failure are not appended again.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from hirelens.plans.ingest import ingest
from hirelens.schemas import CLEAN_SCHEMA, LANDED_JSON_SCHEMA


def _target_exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.exists(jvm.org.apache.hadoop.fs.Path(os.path.join(path, "_SUCCESS"))) or (
        fs.exists(p) and len(fs.listStatus(p)) > 0)


def start_ingest_stream(spark: SparkSession, landing_root: str, target_path: str,
                        checkpoint_location: str, *, variant: str = "v2",
                        category_col: str = "job_category", available_now: bool = True,
                        schema: T.StructType = LANDED_JSON_SCHEMA) -> StreamingQuery:
    """Stream ``<landing_root>/<category_col>=<title>/*.json`` into the clean
    postings table at ``target_path`` (parquet, append)."""
    full = schema.add(T.StructField(category_col, T.StringType(), True)) \
        if category_col not in schema.fieldNames() else schema
    feed = (spark.readStream.schema(full).option("mode", "PERMISSIVE")
            .option("basePath", landing_root).json(landing_root))

    def load(batch: DataFrame, epoch_id: int) -> None:
        # explicit schema: a target holding only an empty first batch has no
        # parquet footer to infer it from
        stored = (spark.read.schema(CLEAN_SCHEMA).parquet(target_path)
                  if _target_exists(spark, target_path) else None)
        new = ingest(batch, stored, variant=variant)
        new.write.mode("append").parquet(target_path)

    writer = feed.writeStream.foreachBatch(load).option("checkpointLocation", checkpoint_location)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()
