"""Helpers of the operators: tables in the shared folder, shipping the package
to executors, fixed-size key filters and connected components."""

from __future__ import annotations

import ctypes
import io
import os
import uuid
import zipfile

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from hirelens.session import ensure_checkpoint_dir

_SHIPPED: set[str] = set()
_TRIM = getattr(ctypes.CDLL(None), "malloc_trim", None)  # where the system's library has it


def release() -> None:
    """Give memory that this process has freed back to the system; a worker, and
    the driver, lives on for later stages and would keep its largest size otherwise."""
    pa.default_memory_pool().release_unused()
    if _TRIM is not None:
        _TRIM(0)


def released(fn):
    """``fn`` over the batches of a task, with :func:`release` behind the last."""
    def run(batches):
        yield from fn(batches)
        release()
    return run


def _shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share, as the cluster names it."""
    return (spark.conf.get("spark.checkpoint.dir", None) or ensure_checkpoint_dir(spark)).rstrip("/")


def _at(spark: SparkSession, path: str):
    """(Hadoop file system, Hadoop path) of a path."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors once per application, through the
    shared folder, so that functions run in Python workers can be imported
    there."""
    sc = spark.sparkContext
    top = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    if sc.applicationId in _SHIPPED or not os.path.isdir(top):  # imported from a shipped archive
        return
    data = io.BytesIO()
    with zipfile.ZipFile(data, "w") as z:
        for d, _, names in os.walk(os.path.join(top, "hirelens")):
            for n in names:
                if n.endswith(".py"):
                    z.write(os.path.join(d, n), os.path.relpath(os.path.join(d, n), top))
    fs, path = _at(spark, f"{_shared_folder(spark)}/hirelens-{uuid.uuid4().hex}.zip")
    fs.deleteOnExit(path)
    out = fs.create(path)
    out.write(bytearray(data.getvalue()))
    out.close()
    sc.addPyFile(fs.makeQualified(path).toString())
    _SHIPPED.add(sc.applicationId)


class Scratch:
    """Tables of one run in the shared folder that the cluster names.

    A written table cuts the lineage: a lost executor costs only the tasks
    that read it. What is left is removed when the application ends.
    """

    def __init__(self, spark: SparkSession, name: str):
        ship_package(spark)
        self.spark = spark
        self.tags: set[str] = set()
        self.root = f"{_shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
        self._fs, path = _at(spark, self.root)
        self._fs.deleteOnExit(path)

    def path(self, tag: str) -> str:
        return f"{self.root}/{tag}"

    def save(self, df: DataFrame, tag: str) -> DataFrame:
        df.write.option("compression", "zstd").mode("overwrite").parquet(self.path(tag))
        self.tags.add(tag)
        return self.read(tag, df.schema)

    def read(self, tag: str, schema=None) -> DataFrame:
        reader = self.spark.read if schema is None else self.spark.read.schema(schema)
        return reader.parquet(self.path(tag))

    def finish(self, df: DataFrame, tag: str) -> DataFrame:
        """Write a last (small) table and remove all others of this run."""
        out = self.save(df, tag)
        for other in self.tags - {tag}:
            self.drop(other)
        return out

    def drop(self, tag: str) -> None:
        """Remove a table that no later plan reads."""
        self.tags.discard(tag)
        self._fs.delete(_at(self.spark, self.path(tag))[1], True)


FILTER_BITS = 24


def key_filter(keys: DataFrame, col: str, bits: int = FILTER_BITS) -> np.ndarray:
    """A bitmap of fixed size (2^bits bits, 2 MB) with one bit for each 64-bit
    key of ``col``. It lets through every key, and a few others when it is
    full; an exact join follows wherever it is used. Its size, and the rows
    sent to the driver (2^bits / 64 at most), don't depend on the input."""
    cell = F.col(col).bitwiseAND(F.lit((1 << bits) - 1))
    words = (keys.select(cell.alias("c"))
             .select(F.shiftright("c", 6).alias("w"),
                     F.expr("shiftleft(1L, cast(c & 63 as int))").alias("b"))
             .groupBy("w").agg(F.bit_or("b").alias("b")))
    out = np.zeros(1 << (bits - 6), dtype=np.int64)
    got = words.toPandas()
    out[got["w"].to_numpy(dtype=np.int64)] = got["b"].to_numpy(dtype=np.int64)
    del got
    release()
    return out.view(np.uint64)


def passes(bitmap: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Which int64 or uint64 keys the bitmap lets through."""
    k = np.asarray(keys).astype(np.int64, copy=False).view(np.uint64)
    c = k & np.uint64(len(bitmap) * 64 - 1)
    return (bitmap[c >> np.uint64(6)] >> (c & np.uint64(63))) & np.uint64(1) == 1


def components(edges: DataFrame, scratch: Scratch, tag: str) -> DataFrame:
    """Connected components of ``edges`` (a, b: long): (node, comp) with the
    smallest node of the component, for nodes that have an edge.

    Each round, a node and the node that its label names both take the
    smallest label's label among the node's neighbours (so whole trees are
    hooked, whatever the order of the ids along a path), and the label of its
    own label. Labels only shrink; the rounds end when none changes. The
    labels are a written table each round. A node of very many edges is summed
    before the shuffle, and its joins are split by the adaptive plan. What the
    neighbours send and a node's own label meet in one sum, without a join.
    """
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    both = scratch.save(both.where("a <> b").distinct(), f"{tag}-edges")
    label = scratch.save(
        both.groupBy("a").agg(F.min("b").alias("m"))
        .select(F.col("a").alias("node"), F.least("a", "m").alias("comp")), f"{tag}-0")
    r = 0
    while True:
        r += 1
        over = label.join(label.select(F.col("node").alias("comp"), F.col("comp").alias("over")), "comp")
        near = (both.join(over.select(F.col("node").alias("b"), "over"), "b")
                .select(F.col("a").alias("node"), F.col("over").alias("to"), F.lit(None).cast("long").alias("comp")))
        own = over.select("node", F.col("over").alias("to"), "comp")
        sent = near.union(own).groupBy("node").agg(F.min("to").alias("to"), F.max("comp").alias("comp"))
        sent = sent.select(F.explode(F.array(
            F.struct("node", "to", F.col("comp").alias("was")),
            F.struct(F.col("comp").alias("node"), "to", F.lit(None).cast("long").alias("was")))).alias("x")).select("x.*")
        new = scratch.save(
            sent.groupBy("node").agg(F.min("to").alias("to"), F.max("was").alias("was"))
            .select("node", F.least("to", "was").alias("comp"), (F.col("to") < F.col("was")).alias("changed")),
            f"{tag}-{r}")
        changed = new.where("changed").limit(1).count()
        scratch.drop(f"{tag}-{r - 1}")
        label = new.select("node", "comp")
        if not changed:
            return label


def ordinals(df: DataFrame, key: str, order: list, bounds: list, scratch: Scratch, tag: str) -> DataFrame:
    """``df`` with ``place`` (0, 1, .. among the rows of its key in ``order``)
    and ``held`` (how many rows the key has).

    Rows are dealt out by ranges of the key and ``bounds`` (short columns in
    the same order as ``order``) and sorted in their range, so a key of very
    many rows is spread over many tasks; a key's place in a range follows from
    the counts of its earlier ranges, one small row for each range. Null keys
    are one key. The result is read from a written table."""
    name = F.col(key).asc_nulls_first()
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    laid = (df.repartitionByRange(tasks, name, *[b.asc_nulls_first() for b in bounds])
            .sortWithinPartitions(name, *[o.asc_nulls_first() for o in order])
            .withColumn("_at", F.monotonically_increasing_id()))
    laid = scratch.save(laid, tag).withColumn("_range", F.shiftright("_at", 33))
    of_key = Window.partitionBy("_key")
    runs = laid.groupBy(F.col(key).alias("_key"), F.col("_range").alias("_r")).agg(F.min("_at").alias("_from"), F.count("*").alias("_n"))
    runs = runs.select("_key", "_r", "_from", F.sum("_n").over(of_key).alias("held"), F.coalesce(
        F.sum("_n").over(of_key.orderBy("_r").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_ahead"))
    same = F.col(key).eqNullSafe(F.col("_key")) & (F.col("_range") == F.col("_r"))
    return (laid.join(runs, same).withColumn("place", F.col("_ahead") + F.col("_at") - F.col("_from"))
            .drop("_at", "_range", "_key", "_r", "_from", "_ahead"))
