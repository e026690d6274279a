"""Top-k operators (O-5, S-2)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top_k_per_group(df: DataFrame, partition: list[str], order: list[Column], k: int,
                    rank_col: str | None = None) -> DataFrame:
    """Keep the first ``k`` rows per group by ``order`` (row_number <= k).

    Spark plans ``row_number() <= k`` with a partial group limit before the
    shuffle, so each map task forwards at most k rows per group: a hot group
    costs k rows of shuffle per task, not its size.
    """
    rn = F.row_number().over(Window.partitionBy(*partition).orderBy(*order))
    out = df.withColumn("_rn", rn).filter(F.col("_rn") <= k)
    return out.withColumnRenamed("_rn", rank_col) if rank_col else out.drop("_rn")


def recent_capped(df: DataFrame, ts: str, partition: str, id_col: str, *,
                  window_hours: int, limit: int, as_of: Column | None = None) -> DataFrame:
    """Capped fetch (S-2): rows in the look-back window ending at ``as_of``
    (default: the newest timestamp, as a scalar subquery), newest first, at
    most ``limit`` per ``partition`` value, ties by ``id_col``."""
    end = as_of if as_of is not None else df.select(F.max(ts)).scalar()
    start = end - F.expr(f"INTERVAL {int(window_hours)} HOURS")
    recent = df.filter(F.col(ts) >= start)
    return top_k_per_group(recent, [partition], [F.col(ts).desc(), F.col(id_col).asc()], limit)



def preview(df: DataFrame, n: int = 5, order: list[tuple[str, bool]] | None = None, *,
            tail: bool = False) -> DataFrame:
    """O-4: the first (or last) ``n`` rows by ``order`` = [(column,
    ascending), ...]. Spark rows have no order, so a tail needs one; it is
    the first rows of the reversed order (Spark plans order + limit as a
    per-task top-n and one merge of n rows per task)."""
    def cols(o, flip=False):
        return [F.col(c).asc_nulls_last() if asc != flip else F.col(c).desc_nulls_first()
                for c, asc in o]
    if tail:
        if not order:
            raise ValueError("tail needs an explicit order")
        return df.orderBy(*cols(order, flip=True)).limit(n).orderBy(*cols(order))
    return (df.orderBy(*cols(order)) if order else df).limit(n)
