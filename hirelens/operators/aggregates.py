"""Aggregations (A-3, A-4, A-7)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hirelens.operators.dedupe import first_per_key


def count_distinct_by(df: DataFrame, keys: list[str], col: str = "ID",
                      alias: str = "total_jobs") -> DataFrame:
    """Exact COUNT(DISTINCT col) per group (A-3). Spark plans it as two
    aggregations (by keys+col, then by keys), both combined map-side, so a
    hot group is spread over the distinct values before it is counted."""
    return df.groupBy(*keys).agg(F.countDistinct(col).alias(alias))


def sum_by(df: DataFrame, keys: list[str], col: str, alias: str) -> DataFrame:
    """SUM per group as BIGINT (A-4)."""
    return df.groupBy(*keys).agg(F.sum(col).cast("bigint").alias(alias))


def row_counts(df: DataFrame, steps: dict[str, Column]) -> DataFrame:
    """(step, rows): how many rows meet each condition, in one pass (A-9)."""
    counts = df.agg(*[F.count_if(cond).alias(f"c{i}") for i, cond in enumerate(steps.values())])
    pairs = F.array(*[F.struct(F.lit(name).alias("step"), F.col(f"c{i}").alias("rows")) for i, name in enumerate(steps)])
    return counts.select(F.explode(pairs).alias("s")).select("s.*")


def ordered_distinct(df: DataFrame, group: str, text: str, order: list[str]) -> DataFrame:
    """Unique texts per group with the order key of their first appearance
    (A-7, long form): one row per (group, text) carrying ``first_<order>``.

    Sorting the result by (group, first keys) and joining the texts with a
    newline gives the concatenated text; that string is never built in one
    task, since a group's text is unbounded.
    """
    first = first_per_key(df.select(group, text, *order), [group, text], order)
    return first.select(group, text, *[F.col(f"`{c}`").alias(f"first_{c}") for c in order])
