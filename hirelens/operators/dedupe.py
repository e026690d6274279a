"""Distinct and dedupe operators (A-1, A-2, A-6)."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def distinct_rows(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """SELECT DISTINCT on whole rows, nulls equal (A-1)."""
    return (df.select(*cols) if cols else df).distinct()


def collapse_max(df: DataFrame, keys: list[str], maxima: dict[str, str]) -> DataFrame:
    """GROUP BY ``keys`` with independent MAX per output column (A-2).

    MAX skips nulls and compares strings byte-wise. It is combined
    map-side, so a hot key is reduced before the shuffle.
    """
    return df.groupBy(*keys).agg(*[F.max(src).alias(out) for out, src in maxima.items()])


# bits of the integral types
_BITS = {"tinyint": 8, "smallint": 16, "int": 32, "bigint": 64}


def digest(*cols: str) -> Column:
    """SHA-256 of several values; null differs from every text, and lengths
    keep neighbouring values apart."""
    parts = []
    for c in cols:
        text = F.col(f"`{c}`").cast("string")
        parts += [F.coalesce(F.octet_length(text).cast("string"), F.lit("null")), F.lit(":"), F.coalesce(text, F.lit(""))]
    return F.sha2(F.concat(*parts), 256)


def order_key(df: DataFrame, order: list[str]) -> Column | None:
    """Several whole-number columns as one decimal in the same order (nulls
    first), which a hash aggregate can take the MIN of; None if they are of
    other types. Columns whose types are too wide together are packed by the
    ranges of their values (one scan of these columns alone), or not at all if
    those are too wide as well."""
    types = dict(df.dtypes)
    bits = [_BITS.get(types[c]) for c in order]
    if None in bits:
        return None
    if sum(b + 1 for b in bits) <= 124:
        low, spans = [-(2 ** (b - 1)) for b in bits], [2 ** (b + 1) for b in bits]
    else:
        ends = df.agg(*[f(f"`{c}`").alias(f"{f.__name__}{i}") for i, c in enumerate(order) for f in (F.min, F.max)]).first()
        low = [ends[f"min{i}"] or 0 for i in range(len(order))]
        spans = [(ends[f"max{i}"] or 0) - low[i] + 2 for i in range(len(order))]
        if math.prod(spans) >= 10 ** 38:
            return None
    out = None
    for c, least, span in zip(order, low, spans):
        # 0 for null, else 1 more than the distance from the least value
        part = F.coalesce(F.col(f"`{c}`").cast("decimal(20,0)") + F.lit(str(1 - least)).cast("decimal(20,0)"),
                          F.lit(0).cast("decimal(21,0)"))
        out = part.cast("decimal(38,0)") if out is None else \
            (out * F.lit(str(span)).cast("decimal(38,0)") + part).cast("decimal(38,0)")
    return out


def first_per_key(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Keep the first row per ``keys`` by ``order`` (A-6, pandas
    ``drop_duplicates(keep='first')`` with an explicit row order).

    The least order value of each key is found on digests of the keys, combined
    map-side (by a hash aggregate where the order is of whole numbers, see
    :func:`order_key`), and the rows that have it are joined back, so a text
    is neither sorted nor carried through an aggregate, and a duplicate-heavy
    key never lands whole in one task. Order columns must be unique within a
    key for a deterministic result.
    """
    packed = order_key(df, order)
    mine = packed if packed is not None else F.struct(*[F.col(f"`{c}`") for c in order])
    rows = df.withColumns({"_key": digest(*keys), "_first": mine})
    first = rows.groupBy(F.col("_key").alias("_k")).agg(F.min("_first").alias("_f"))
    return rows.join(first, (F.col("_key") == F.col("_k")) & F.col("_first").eqNullSafe(F.col("_f")), "left_semi").select(*df.columns)
