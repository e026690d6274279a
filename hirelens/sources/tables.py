"""Table access: driver parquet tables, named sources, and the table / view
sinks (S-8, S-9, S-12 ... S-15)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

DRIVER_TABLES = ["region", "nation", "customer", "supplier", "part", "orders",
                 "lineitem", "events", "documents", "embeddings", "pages",
                 "benchmark", "labels", "conversations"]


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Parquet scan of a driver table; column pruning and filter pushdown
    come from the projections and filters applied later."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def append_table(df: DataFrame, table: str, *, check_columns: bool = True,
                 bucket_by: str | None = None, buckets: int | None = None, path: str | None = None) -> None:
    """Append sink (S-8). When the table exists, its column list must equal
    the batch's, in order (P-14).

    With ``bucket_by``/``buckets`` the table is written hash-bucketed on that
    column. The daily anti join then reads the stored IDs already
    partitioned by ID, so only the (small) new batch is shuffled, however
    large the stored table grows."""
    spark = df.sparkSession
    if check_columns and spark.catalog.tableExists(table):
        stored = spark.table(table).columns
        if [c.upper() for c in stored] != [c.upper() for c in df.columns]:
            raise ValueError(f"column mismatch for {table}: {stored} != {df.columns}")
    w = df.write.mode("append")
    if path:
        w = w.option("path", path)
    if bucket_by and buckets:
        w = w.bucketBy(buckets, bucket_by).sortBy(bucket_by)
    w.saveAsTable(table)


def replace_table(df: DataFrame, table: str, path: str | None = None) -> None:
    """Replace sink (S-9) and table materialization (S-14); with ``path`` the
    table's files lie there instead of in the warehouse folder."""
    w = df.write.mode("overwrite")
    (w.option("path", path) if path else w).saveAsTable(table)


def materialize_view(df: DataFrame, name: str) -> DataFrame:
    """View materialization (S-15): a named lazy plan."""
    df.createOrReplaceTempView(name)
    return df.sparkSession.table(name)
