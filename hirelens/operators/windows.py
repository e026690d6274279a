"""Window operators (W-1 ... W-3)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def lag_trend(df: DataFrame, partition: str, order: str, value: str,
              prev: str, diff: str, ratio: str) -> DataFrame:
    """Previous value over the rows present (not the calendar), difference
    and safe ratio (null when the base is null or 0).

    Nulls of the order column sort last, as in the warehouse. The three
    expressions share one window specification, so Spark plans a single
    Window operator; it runs on an aggregate (one row per category and
    week), never on raw postings.
    """
    w = Window.partitionBy(partition).orderBy(F.col(order).asc_nulls_last())
    last = F.lag(value).over(w)
    return (df.withColumn(prev, last)
              .withColumn(diff, F.col(value) - last)
              .withColumn(ratio, F.col(diff) / F.nullif(F.col(prev), F.lit(0))))
