"""Distinct counts kept day by day (A-3, A-5, M-9): a load adds its own state
and never reads the loads before it.

Every ID has a whole number of its own, given out densely (kept table ``ids``)
and, within a load, in the order of the keys it comes with, so the IDs of a key
fill few ranges of numbers; with any other numbers the counts are the same and
the states larger.
A state is, for each key, the bitmap of the numbers seen: a row for each key and
range of 32,768 numbers, at most 4 KB. Bitmaps of any loads are merged by OR, so
counts over any set of loads and any coarser key are exact, however often an ID
comes back. A load that is repeated replaces its own states
(:func:`hirelens.sources.loads.write_load`); numbers are only ever added.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hirelens.operators.joins import anti_join_new, broadcast_if_small
from hirelens.session import file_system, written
from hirelens.sources.loads import read_loads, write_load

IDS = "id string, n long"


def _has_ids(spark: SparkSession, root: str) -> bool:
    fs, path = file_system(spark, f"{root}/ids")
    return fs.exists(path)


def _ids(spark: SparkSession, root: str) -> DataFrame:
    schema = T._parse_datatype_string(IDS)
    return spark.read.schema(schema).parquet(f"{root}/ids") if _has_ids(spark, root) else spark.createDataFrame([], schema)


def number_new(ids: DataFrame, root: str, keys: list[str] | None = None) -> DataFrame:
    """Give every value of ``ids`` (id) that has no number the next free ones,
    in the order of the last and the first ``keys`` it comes with, and return
    the table of all numbers. Values are counted by task and each task's run of
    numbers starts behind those of the tasks before it: one small row for each
    task."""
    spark, known = ids.sparkSession, _ids(ids.sparkSession, root)
    new = ids.where("id IS NOT NULL")
    if _has_ids(spark, root):
        new = anti_join_new(new, known, "id")
    mine = F.struct(*[F.col(f"`{c}`") for c in keys or ["id"]])
    new, n, _ = written(new.groupBy("id").agg(F.max(mine).alias("_last"), F.min(mine).alias("_first")), "new-ids")
    if n:
        order = ["_last", "_first", "id"]
        new, _, _ = written(new.repartitionByRange(*order).sortWithinPartitions(*order)
                            .select("id", F.monotonically_increasing_id().alias("_at")), "dealt-ids")
        start = known.select(F.coalesce(F.max("n") + 1, F.lit(0)).alias("n")).first()["n"]
        runs = new.groupBy(F.shiftright("_at", 33).alias("_run")).agg(F.count("*").alias("_n"), F.min("_at").alias("_from"))
        ahead = F.coalesce(F.sum("_n").over(Window.orderBy("_run").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        runs = broadcast_if_small(runs.select("_run", "_from", ahead.alias("_ahead")))
        dense = (F.lit(start) + F.col("_ahead") + F.col("_at") - F.col("_from")).alias("n")
        new.join(runs, F.shiftright("_at", 33) == F.col("_run")).select("id", dense).write.mode("append").parquet(f"{root}/ids")
    return _ids(spark, root)


def add_load(rows: DataFrame, root: str, load: str, keys: list[str], id_col: str = "ID") -> int:
    """Add the states of one load's rows, or replace them; returns how many
    rows of state it has. Rows without an ID keep their key and count nothing.

    The numbers of a state meet before they become a bitmap: a task that built
    bitmaps of its own rows would send 4 KB for each key and range it has seen."""
    day, _, _ = written(rows.select(*keys, F.col(id_col).cast("string").alias("_id")).distinct(), "day")
    numbers = number_new(day.withColumnRenamed("_id", "id"), root, keys)
    numbered = day.join(numbers, F.col("_id") == F.col("id"), "left").select(*keys, F.bitmap_bucket_number("n").alias("bucket"), "n")
    states = numbered.repartition(*keys, "bucket").groupBy(*keys, "bucket").agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("n")).alias("bits"))
    return write_load(states, f"{root}/states", load)


def read_states(spark: SparkSession, root: str, key_schema: T.StructType) -> DataFrame:
    """All states: the keys, bucket, bits and the load they came by."""
    schema = T.StructType([*key_schema.fields, T.StructField("bucket", T.LongType()), T.StructField("bits", T.BinaryType())])
    return read_loads(spark, f"{root}/states", schema)


def count_states(states: DataFrame, keys: list, alias: str = "total_jobs") -> DataFrame:
    """Exact distinct IDs for each of ``keys`` (any columns or expressions over
    the states' keys): bitmaps of a bucket are merged, then counted."""
    named = states.select(*keys, "bucket", "bits")
    names = [c for c in named.columns if c not in ("bucket", "bits")]
    merged = named.groupBy(*names, "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))
    return merged.groupBy(*names).agg(F.sum(F.bitmap_count("bits")).alias(alias))
