"""Rerunnable loads (S-8, S-9, S-14): a store is a Parquet folder with one
partition for each load, named by the load's date. A load replaces the rows of
its own partition and touches no other, so a load that is repeated, after a
failure or with a changed batch, leaves the same rows as if it had run once."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hirelens.operators.joins import anti_join_new
from hirelens.session import file_system

LOAD = "LOAD_DATE"


def _exists(spark: SparkSession, path: str) -> bool:
    fs, p = file_system(spark, path)
    return fs.exists(p)


def _column_names(spark: SparkSession, root: str) -> list[str] | None:
    """The stored columns, from the footer of one file; None without files."""
    fs, p = file_system(spark, root)
    files = fs.listFiles(p, True) if fs.exists(p) else None
    while files is not None and files.hasNext():
        path = files.next().getPath()
        if path.getName().endswith(".parquet") and "/_temporary/" not in path.toString() and "/.spark-staging" not in path.toString():
            return spark.read.parquet(path.toString()).columns
    return None


def read_loads(spark: SparkSession, root: str, schema: T.StructType, load_col: str = LOAD) -> DataFrame:
    """All rows of the store with the load they came by; no rows before the
    first load. A filter on ``load_col`` prunes partitions."""
    full = T.StructType([*schema.fields, T.StructField(load_col, T.StringType())])
    if not _exists(spark, root):
        return spark.createDataFrame([], full)
    return spark.read.schema(full).parquet(root)


def write_load(batch: DataFrame, root: str, load: str, load_col: str = LOAD) -> int:
    """Make ``batch`` the content of one load (S-8, S-14) and return its rows.

    The batch's column list must equal the stored one, in order (P-14). Files
    are staged beside the store and take the partition's place when the whole
    batch is written (dynamic partition overwrite), so a write that fails
    changes nothing. A batch without rows empties its partition."""
    spark = batch.sparkSession
    stored = _column_names(spark, root)
    if stored is not None and [c.upper() for c in stored] != [c.upper() for c in batch.columns]:
        raise ValueError(f"column mismatch for {root}: {stored} != {batch.columns}")
    seen = Observation()
    (batch.observe(seen, F.count(F.lit(1)).alias("rows")).withColumn(load_col, F.lit(load))
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(load_col).parquet(root))
    rows = int(seen.get["rows"])
    if not rows:
        fs, p = file_system(spark, f"{root}/{load_col}={load}")
        fs.delete(p, True)
    return rows


def load_new(batch: DataFrame, root: str, load: str, key: str = "ID", load_col: str = LOAD) -> int:
    """Load the rows of ``batch`` whose key no other load holds (J-4). The
    load's own partition is left out of the comparison and pruned from its
    scan, or a repeated load would find its own rows and write none."""
    spark = batch.sparkSession
    fs, p = file_system(spark, root)
    own = {f"{load_col}={load}", "_SUCCESS", "_temporary"}
    if not fs.exists(p) or all(f.getPath().getName() in own for f in fs.listStatus(p)):
        return write_load(batch, root, load, load_col)  # no other load
    stored = read_loads(spark, root, batch.schema, load_col).where(F.col(load_col) != load)
    return write_load(anti_join_new(batch, stored, key), root, load, load_col)


def load_table(spark: SparkSession, root: str, name: str) -> DataFrame:
    """The store as a table of the catalog, with all partitions known so far."""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} USING parquet LOCATION '{root}'")
    spark.sql(f"ALTER TABLE {name} RECOVER PARTITIONS")
    spark.catalog.refreshTable(name)
    return spark.table(name)
