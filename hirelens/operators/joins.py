"""Join operators: checked broadcast, incremental anti join (J-4) and
defaulted dictionary lookup (J-5)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hirelens.session import written

# A side is broadcast only when a measured size is under both limits.
BROADCAST_MAX_ROWS = 2_000_000
BROADCAST_MAX_BYTES = 64 * 1024 * 1024


def _size_row(df: DataFrame, tag: int) -> DataFrame:
    widths = [F.coalesce(F.octet_length(F.col(f"`{c}`").cast("string")), F.lit(0)) + F.lit(16)
              for c in df.columns]
    row_bytes = widths[0] if len(widths) == 1 else sum(widths[1:], widths[0])
    return df.agg(F.lit(tag).alias("t"), F.count(F.lit(1)).alias("n"), F.sum(row_bytes).alias("b"))


def measured_sizes(*frames: DataFrame) -> list[tuple[int, int]]:
    """Row count and an upper estimate of the in-memory bytes of each frame,
    measured by distributed aggregates in one job; one small row per frame
    reaches the driver."""
    parts = [_size_row(df, i) for i, df in enumerate(frames)]
    u = parts[0]
    for p in parts[1:]:
        u = u.unionByName(p)
    got = {r["t"]: (int(r["n"] or 0), int(r["b"] or 0)) for r in u.collect()}
    return [got[i] for i in range(len(frames))]


def measured_size(df: DataFrame) -> tuple[int, int]:
    """:func:`measured_sizes` of one frame."""
    return measured_sizes(df)[0]


def broadcast_if_small(df: DataFrame, max_rows: int = BROADCAST_MAX_ROWS,
                       max_bytes: int = BROADCAST_MAX_BYTES) -> DataFrame:
    """Write ``df`` once to the shared folder, measured on the way, and hint a
    broadcast only when it is under both limits; beyond them the plain join
    stays (sort-merge, with AQE skew splitting). Either way the join reads
    the written copy instead of recomputing ``df``."""
    out, n, b = written(df, "side")
    return F.broadcast(out) if (n <= max_rows and b <= max_bytes) else out


_PACKED_TYPES = ("string", "bigint", "int", "smallint", "tinyint")


def _slot(key: str, packed: bool) -> tuple[Column, Column]:
    """A key as (slot, bit). A key written as a plain whole number shares its
    slot, one of 64 neighbours, with them and has a bit of its own; any other
    key has a slot of its own, and so has null (null)."""
    c = F.col(f"`{key}`")
    if not packed:
        return c, F.lit(1).cast("bigint")
    n = c.try_cast("bigint")
    whole = n.cast("string") == c.cast("string")
    slot = F.when(whole, F.concat(F.lit("#"), F.shiftright(n, 6).cast("string"))).otherwise(F.concat(F.lit("="), c.cast("string")))
    return slot, F.when(whole, F.call_function("shiftleft", F.lit(1).cast("bigint"), n.bitwiseAND(F.lit(63)).cast("int"))).otherwise(F.lit(1).cast("bigint"))


def anti_join_new(new: DataFrame, stored: DataFrame, key: str = "ID", *,
                  null_safe: bool = True) -> DataFrame:
    """Rows of ``new`` whose key is not among ``stored`` keys (J-4).

    Duplicates inside ``new`` are kept. With ``null_safe`` a null key on
    both sides counts as a match (the row is dropped); otherwise a null-key
    row is always kept.

    Only the batch's distinct keys are written beforehand (a scan of one
    column), packed (:func:`_slot`) and measured on the write. When they are few
    rows (the usual daily batch; neighbouring whole numbers share a row), they
    are broadcast to one scan of the stored side, which yields the
    matching keys only; nothing of the stored side is shuffled, however large
    it grows. A larger batch joins the distinct stored keys by shuffle, without
    one where the stored table is bucketed by the key.
    """
    batch = new
    packed = dict(new.dtypes)[key] == dict(stored.dtypes)[key] and dict(new.dtypes)[key] in _PACKED_TYPES
    slot, bit = _slot(key, packed)
    ids, n, size = written(batch.select(slot.alias("_slot"), bit.alias("_bit")).groupBy("_slot").agg(F.bit_or("_bit").alias("_bits")), "batch-keys")
    found = stored.select(F.col(key).alias("_stored_key"))
    if n <= BROADCAST_MAX_ROWS and size <= BROADCAST_MAX_BYTES:
        at, one = _slot("_stored_key", packed)
        held = F.col("_at").eqNullSafe(F.col("_slot")) & (F.col("_one").bitwiseAND(F.col("_bits")) != 0)
        hits = (found.select(at.alias("_at"), one.alias("_one")).join(F.broadcast(ids), held, "left_semi")
                .groupBy("_at").agg(F.bit_or("_one").alias("_hit")))
        same = slot.eqNullSafe(F.col("_at")) if null_safe else slot == F.col("_at")
        return batch.join(F.broadcast(hits), same & (bit.bitwiseAND(F.col("_hit")) != 0), "left_anti")  # no more rows than ``ids``
    out = batch.join(found.filter(F.col("_stored_key").isNotNull()).distinct(),
                     F.col(f"`{key}`") == F.col("_stored_key"), "left_anti")
    if null_safe:
        stored_has_null = found.filter(F.col("_stored_key").isNull()).select(
            (F.count(F.lit(1)) > 0).alias("has_null")).scalar()
        out = out.filter(F.col(f"`{key}`").isNotNull() | ~stored_has_null)
    return out


def dictionary_lookup(df: DataFrame, column: str, dictionary: DataFrame, *,
                      key_col: str = "value", value_col: str = "translated",
                      default: str = "keep", na_token: str = "NA") -> DataFrame:
    """Replace ``column`` by its dictionary value (J-5).

    ``default='keep'``: unmatched keeps the original (null stays null);
    ``default='na'``: unmatched or null becomes ``na_token``. The dictionary
    is reduced to one value per key (max) so the lookup cannot fan out.
    """
    d = (dictionary.groupBy(F.col(key_col).alias("_dk"))
                   .agg(F.max(value_col).alias("_dv")))
    d = broadcast_if_small(d)
    j = df.join(d, df[column] == d["_dk"], "left")
    if default == "na":
        new = F.coalesce(F.col("_dv"), F.lit(na_token))
    else:
        new = F.coalesce(F.col("_dv"), df[column])
    return j.select(*[new.alias(c) if c == column else df[c] for c in df.columns])
