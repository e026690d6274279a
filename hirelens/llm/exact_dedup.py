"""Exact dedup by an extendible-hash index on shared files.

A text's key is its 64-bit hash, and an index entry stands for all rows of one
key and length: how many there are, and the largest id. The directory looks at
the top bits of the key: buckets that hold more entries than ``capacity`` split,
which doubles the directory by one bit, until every bucket fits or the bits are
used up; rows of equal key can't be split apart and stay chained in one bucket.
The index is a table in the shared folder, ranged by bucket and sorted by key;
each owner task holds a contiguous key range. The bits follow the number of
entries, and beyond 2^34 entries the capacity does, so the directory has at most
2^20 rows.

Lookups go through the directory: it names the bucket of a row, and only rows
whose bucket has an entry of several rows for their key send their text there.
The texts of an entry are compared byte for byte (the text is a grouping key,
copies are merged before they move), so different texts of one key are links of
its chain and never false duplicates. A text that is alone is answered by the
index and never moves, as long as the entries of several rows fit a measured
broadcast; beyond it, the rows are joined by shuffle. Only DataFrame functions
are used.

Defined results: null text counts as empty; all rows with the same text form
one group and the one with the largest id stays; rows that repeat both id and
text are alike and get the same answer; a null id is below every id, and a
group of null ids only has a null ``keep_id`` with its rows kept; an empty
table gives an empty result. Other columns are not looked at.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hirelens.llm._shared import Scratch
from hirelens.operators.joins import broadcast_if_small

CAPACITY = 1 << 18
MOST_BUCKETS = 1 << 16
SPARE_BITS = 4  # buckets are uneven, so some split deeper than the mean


def _key(body):
    return F.xxhash64(body)


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.coalesce(F.col(text_col), F.lit(""))
    return (docs.select(F.col(id_col).cast("long").alias("id"), text.alias("body"))
            .withColumn("key", _key(F.col("body")))
            .withColumn("size", F.octet_length("body")))


def _cell(max_bits: int):
    return F.expr(f"shiftrightunsigned(key, {64 - max_bits})")


def directory(entries: DataFrame, capacity: int, max_bits: int) -> DataFrame:
    """(cell, bucket, depth) for every used cell of the top ``max_bits`` bits:
    ``depth`` is the fewest bits at which the cell's bucket holds ``capacity``
    entries or fewer. At most 2^max_bits rows, whatever the input."""
    cells = entries.groupBy(_cell(max_bits).alias("cell")) \
        .agg(F.count("*").alias("n"))
    levels = cells.withColumn("depth", F.explode(F.sequence(F.lit(0), F.lit(max_bits)))) \
        .withColumn("prefix", F.expr(f"shiftright(cell, {max_bits} - depth)"))
    fits = levels.groupBy("depth", "prefix").agg(F.sum("n").alias("held")) \
        .where((F.col("held") <= capacity) | (F.col("depth") == max_bits))
    fits = F.broadcast(fits.select("depth", "prefix"))  # 2^(max_bits + 1) rows at most
    return (levels.join(fits, ["depth", "prefix"], "left_semi")
            .groupBy("cell").agg(F.min("depth").alias("depth"))
            .withColumn("bucket", F.expr(
                f"shiftleft(shiftright(cell, {max_bits} - depth), {max_bits} - depth)")))


def build_index(docs: DataFrame, scratch: Scratch, id_col: str = "doc_id", text_col: str = "text",
                capacity: int = CAPACITY, max_bits: int | None = None) -> tuple[DataFrame, DataFrame, int]:
    """Write the index and its directory: entries (bucket, depth, key, size, n,
    top), one for each key and length with its rows and largest id; the
    directory (cell, bucket, depth); the bits that it looks at."""
    entries = scratch.save(_keyed(docs, id_col, text_col).select("id", "key", "size").groupBy("key", "size")
                           .agg(F.count("*").alias("n"), F.max("id").alias("top")), "entries")
    held = entries.count()
    capacity = max(capacity, -(-held // MOST_BUCKETS))
    max_bits = max_bits or max(1, (held // capacity).bit_length() + SPARE_BITS)
    rows = scratch.save(directory(entries, capacity, max_bits), "directory")
    index = (entries.withColumn("cell", _cell(max_bits)).join(F.broadcast(rows), "cell")  # 2^max_bits rows at most
             .repartitionByRange("bucket", "key").sortWithinPartitions("bucket", "key", "size")
             .select("bucket", "depth", "key", "size", "n", "top"))
    index = scratch.save(index, "index")
    scratch.drop("entries")
    return index, rows, max_bits


def chains(docs: DataFrame, index: DataFrame, rows: DataFrame, max_bits: int, id_col: str = "doc_id",
           text_col: str = "text") -> DataFrame:
    """The different texts of every entry of several rows: (bucket, key, size,
    sha, keep_id, group_size), by comparing their bytes."""
    shared = broadcast_if_small(index.where("n > 1").select("bucket", "key", "size"))
    sent = (_keyed(docs, id_col, text_col).withColumn("cell", _cell(max_bits)).join(F.broadcast(rows.select("cell", "bucket")), "cell")
            .join(shared, ["bucket", "key", "size"], "left_semi"))
    texts = sent.groupBy("bucket", "key", "size", "body").agg(F.max("id").alias("keep_id"), F.count("*").alias("group_size"))
    return texts.select("bucket", "key", "size", F.sha2("body", 256).alias("sha"), "keep_id", "group_size")


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                capacity: int = CAPACITY, max_bits: int | None = None) -> DataFrame:
    """Every row with (doc_id, keep_id, group_size, kept, text_sha256)."""
    scratch = Scratch(docs.sparkSession, "exact-dedup")
    index, rows, bits = build_index(docs, scratch, id_col, text_col, capacity, max_bits)
    linked = scratch.save(chains(docs, index, rows, bits, id_col, text_col), "chains")
    own = _keyed(docs, id_col, text_col).select("id", "key", "size", F.sha2("body", 256).alias("sha"))
    own = own.withColumn("cell", _cell(bits)).join(F.broadcast(rows.select("cell", "bucket")), "cell")
    found = own.join(linked, ["bucket", "key", "size", "sha"], "left")
    alone = F.col("group_size").isNull()  # no other row has its key
    keep = F.when(alone, F.col("id")).otherwise(F.col("keep_id"))
    return found.select(F.col("id").alias("doc_id"), keep.alias("keep_id"), F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
                        F.col("id").eqNullSafe(keep).alias("kept"), F.col("sha").alias("text_sha256"))
