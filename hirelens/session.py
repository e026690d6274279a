"""Session settings and the shared checkpoint folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

# Settings a job of this package wants; applied by ``build_session`` only.
# Queries never change the session they are given.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    # checkpoint files of small sides are removed once no plan references them
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


# Settings for a large cluster (about 100 TB of input, ~1000 executors):
# AQE re-plans joins from runtime sizes, coalesces small shuffle partitions
# and splits skewed ones; partitions target ~256 MiB so they fit executor
# memory and spill rarely.
CLUSTER_CONF = {
    **DEFAULT_CONF,
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(256 * 1024 * 1024),
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(512 * 1024 * 1024),
    "spark.sql.files.maxPartitionBytes": str(256 * 1024 * 1024),
    "spark.sql.autoBroadcastJoinThreshold": str(64 * 1024 * 1024),
    "spark.sql.parquet.filterPushdown": "true",
}


def shuffle_partitions_for(shuffle_bytes: int, target_bytes: int = 256 * 1024 * 1024,
                           minimum: int = 200) -> int:
    """Initial shuffle partition count for an expected shuffle volume; AQE
    coalesces what turns out smaller."""
    return max(minimum, -(-shuffle_bytes // target_bytes))


def build_session(master: str = "local[*]", app: str = "hirelens",
                  shuffle_partitions: int | None = None, conf: dict | None = None) -> SparkSession:
    b = SparkSession.builder.master(master).appName(app)
    for k, v in {**DEFAULT_CONF, **(conf or {})}.items():
        b = b.config(k, v)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The reliable checkpoint folder: the one the cluster names in
    ``spark.checkpoint.dir``. A private folder is created only when none is
    set and the master is local (tests); on a cluster a missing setting is
    an error, since a machine-local folder would not survive executor loss.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
    elif sc.master.startswith("local"):
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="hirelens-ckpt-"))
    else:
        raise RuntimeError("spark.checkpoint.dir is not set; name a shared folder")
    return sc.getCheckpointDir()


def checkpointed(df: DataFrame) -> DataFrame:
    """Materialize ``df`` in the shared checkpoint folder and cut its
    lineage, so a lost executor re-reads it instead of recomputing.

    The frame is persisted while the checkpoint is written: without it the
    checkpoint write would compute the plan a second time."""
    from pyspark import StorageLevel
    ensure_checkpoint_dir(df.sparkSession)
    held = df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return held.checkpoint(eager=True)
    finally:
        held.unpersist()


def file_system(spark: SparkSession, path: str):
    """(Hadoop file system, Hadoop path) of a path."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder name below the shared checkpoint folder; what is written
    there goes when the application ends."""
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    fs, p = file_system(spark, path)
    fs.deleteOnExit(p)
    return path


def written(df: DataFrame, name: str) -> tuple[DataFrame, int, int]:
    """``df`` as a Parquet table in the shared folder, with its row count and
    an upper estimate of its bytes in memory, both observed on the write: one
    pass, and lineage ends at the files."""
    path, seen = shared_folder(df.sparkSession, name), Observation()
    widths = [F.coalesce(F.octet_length(F.col(f"`{c}`").cast("string")), F.lit(0)) + F.lit(16) for c in df.columns]
    total = sum(widths[1:], widths[0])
    df.observe(seen, F.count(F.lit(1)).alias("rows"), F.sum(total.cast("long")).alias("bytes")).write.parquet(path)
    got = seen.get
    return df.sparkSession.read.schema(df.schema).parquet(path), int(got["rows"] or 0), int(got["bytes"] or 0)
