"""CSV files read by many tasks (S-4, S-10): records are cut by quote parity, so
a quoted field may hold line breaks wherever a file is split, and column types
come from all values by a type lattice, as a data frame library infers them.

1. Lines are scanned in splits. A split's lines hold an odd or even number of
   quotes; the parity of all splits before it tells whether a split begins
   inside a quoted field. One small row for each split is gathered.
2. Where a file's lines all have even quotes, every line is a record and nothing
   but Spark's own functions runs. Otherwise the lines of a split pass in
   batches, carrying the quote state; a record that crosses into another split is
   put together from its parts, one or two a split.
3. Records are parsed by Spark's CSV parser; the first one of each file is its
   header.

Lines end with LF or CRLF. A quote that is never closed runs to the end of its
file. Blank records are skipped.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hirelens import rules
from hirelens.operators.joins import BROADCAST_MAX_BYTES, BROADCAST_MAX_ROWS
from hirelens.session import written

OPTIONS = {"escape": '"'}
PARTS = "file long, split long, no long, kind string, record string"


def _lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    text = spark.read.option("lineSep", "\n").text(path)
    return text.select(F.xxhash64("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split"), "value")


def _odd_quotes(value: str) -> Column:
    return (F.length(value) - F.length(F.replace(F.col(value), F.lit('"'), F.lit("")))) % 2


def _cutter():
    """The function that cuts the lines of splits into records (made here, so
    that tasks get it by value)."""
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Records and parts of records, from lines in the order of their
        split: a part is a ``head`` (ends a record of an earlier split), a
        ``tail`` (goes on in the next one) or goes ``through`` a whole split."""
        at, held, is_open, begun_open, no = None, [], 0, False, 0

        def rows(offsets, lines, kinds):
            n = len(kinds)
            record = pc.binary_join(pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), lines), "\n")
            return pa.RecordBatch.from_arrays(
                [pa.array(np.full(n, at[0]), pa.int64()), pa.array(np.full(n, at[1]), pa.int64()), pa.array(no + offsets[:-1], pa.int64()),
                 pa.array(kinds, pa.string()), record], names=["file", "split", "no", "kind", "record"])

        def rest():
            lines = pa.concat_arrays(held)
            return rows(np.array([0, len(lines)]), lines, ["through" if begun_open else "tail"])
        for batch in batches:
            file, split, inside, odd = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("file", "split", "inside", "odd"))
            turns = np.flatnonzero((file[1:] != file[:-1]) | (split[1:] != split[:-1])) + 1
            for lo, hi in zip([0, *turns], [*turns, len(file)]):
                if lo == hi:
                    continue
                if (file[lo], split[lo]) != at:
                    if held:
                        yield rest()
                    at, held, begun_open, no = (file[lo], split[lo]), [], bool(inside[lo]), 0
                    is_open = int(begun_open)
                after = (is_open + np.cumsum(odd[lo:hi].astype(np.int64))) % 2  # inside quotes behind each line
                is_open = int(after[-1])
                ends = np.flatnonzero(after == 0) + 1
                lines = batch.column("value").slice(lo, hi - lo)
                if not len(ends):
                    held.append(lines)
                    continue
                before = sum(len(x) for x in held)
                offsets = np.concatenate([[0], before + ends])
                whole = pa.concat_arrays([*held, lines.slice(0, ends[-1])])
                yield rows(offsets, whole, ["head" if begun_open else "whole"] + ["whole"] * (len(ends) - 1))
                held = [lines.slice(ends[-1])] if ends[-1] < len(lines) else []
                no, begun_open = no + int(offsets[-1]), False
        if held:
            yield rest()
    return cut


def csv_records(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(file, at, record) of all records that aren't blank; ``at`` grows with
    the place in the file."""
    lines = _lines(spark, path).withColumn("odd", _odd_quotes("value"))
    splits = lines.groupBy("file", "split").agg(F.sum("odd").alias("odd"))  # a row for each split
    before = Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    splits = splits.select("file", "split", F.col("odd").alias("_odd"), (F.coalesce(F.sum("odd").over(before), F.lit(0)) % 2 == 1).alias("inside"))
    splits, n, size = written(splits, "csv-splits")
    if not splits.where("_odd > 0").limit(1).count():
        # one line, one record; lines of a split keep their order
        cut = lines.select("file", "split", F.monotonically_increasing_id().alias("at"), F.col("value").alias("record"))
    else:
        if n <= BROADCAST_MAX_ROWS and size <= BROADCAST_MAX_BYTES:  # lines stay in their order
            known = lines.join(F.broadcast(splits), ["file", "split"])
        else:
            known = (lines.withColumn("_at", F.monotonically_increasing_id()).join(splits, ["file", "split"])
                     .repartition("file", "split").sortWithinPartitions("file", "split", "_at"))
        # written once: headers, types and rows are all read from it
        parts, _, _ = written(known.select("file", "split", "inside", "value", "odd").mapInArrow(_cutter(), PARTS), "csv-parts")
        # a record in parts begins with a tail; there are two parts a split at most
        run = F.sum(F.when(F.col("kind") == "tail", 1).otherwise(0)).over(
            Window.partitionBy("file").orderBy("split", F.col("kind") == "tail", "no").rowsBetween(Window.unboundedPreceding, 0))
        joined = (parts.where("kind <> 'whole'").withColumn("run", run).groupBy("file", "run")
                  .agg(F.sort_array(F.collect_list(F.struct("split", "no", "record"))).alias("x")))  # one record
        joined = joined.select("file", F.col("x")[0]["split"].alias("split"), F.col("x")[0]["no"].alias("at"),
                               F.array_join("x.record", "\n").alias("record"))
        cut = parts.where("kind = 'whole'").select("file", "split", F.col("no").alias("at"), "record").union(joined)
    record = F.regexp_replace("record", r"\r\z", "")
    return cut.select("file", F.struct("split", "at").alias("at"), record.alias("record")).where(~F.col("record").rlike(r"\A\s*\z"))


def _names(header: str, spark: SparkSession) -> list[str]:
    """The fields of a header record."""
    n = header.count(",") + 1
    schema = ", ".join(f"f{i} string" for i in range(n))
    row = spark.range(1).select(F.from_csv(F.lit(header), schema, OPTIONS).alias("r")).first()["r"]
    fields = list(row)
    while len(fields) > 1 and fields[-1] is None and n > 1 and header.count('"'):
        fields.pop()
    return [f if f is not None else f"_c{i}" for i, f in enumerate(fields)]


def csv_by_header(spark: SparkSession, path: str | list[str]) -> list[DataFrame]:
    """The records of all files as text fields: a frame for each different
    header, with ``_path`` (the file) and ``_at`` (grows with the place in it).
    All files are cut in the same passes, however many they are."""
    records = csv_records(spark, path)
    heads = records.groupBy("file").agg(F.min_by("record", "at").alias("header"), F.min("at").alias("first"))
    named = (spark.read.text(path).select(F.xxhash64("_metadata.file_path").alias("file"), F.col("_metadata.file_path").alias("_path"))
             .groupBy("file").agg(F.max("_path").alias("_path")))
    heads, n, size = written(heads.join(named, "file"), "csv-heads")  # a row for each file
    small = n <= BROADCAST_MAX_ROWS and size <= BROADCAST_MAX_BYTES
    out = []
    for row in heads.select("header").distinct().orderBy("header").collect():  # a row for each header
        mine = heads.where(F.col("header") == row["header"]).drop("header")
        body = records.join(F.broadcast(mine) if small else mine, "file").where("at > first")
        names = _names(row["header"], spark)
        fields = F.from_csv("record", ", ".join(f"f{i} string" for i in range(len(names))), OPTIONS)
        out.append(body.select("_path", F.col("at").alias("_at"), fields.alias("r")).select(
            "_path", "_at", *[F.col(f"r.f{i}").alias(c) for i, c in enumerate(names)]))
    return out


def csv_text(spark: SparkSession, path: str | list[str], with_place: bool = False) -> DataFrame:
    """Every record of files that share a header as text fields; with ``at``
    (grows with the place in the files, taken in the order of their paths) if
    asked for."""
    frames = csv_by_header(spark, path)
    if len(frames) > 1:
        raise ValueError(f"files with different headers: {[f.columns[2:] for f in frames]}")
    if not frames:
        return spark.createDataFrame([], "at struct<path:string,at:struct<split:long,at:long>>" if with_place else T.StructType([]))
    fields = [F.col(f"`{c}`") for c in frames[0].columns[2:]]
    return frames[0].select(*([F.struct(F.col("_path").alias("path"), F.col("_at").alias("at")).alias("at")] if with_place else []), *fields)


def null_tokens_out(df: DataFrame, tokens: list[str]) -> DataFrame:
    """Text values that are one of ``tokens`` become null."""
    text = {f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)}
    return df.select(*[F.when(~F.col(f"`{c}`").isin(tokens), F.col(f"`{c}`")).alias(c) if c in text and tokens else F.col(f"`{c}`")
                       for c in df.columns])


# Bits of the type lattice: what a value could be.
LONG, DOUBLE, BOOLEAN, TEXT, NULL, LARGE = 1, 2, 4, 8, 16, 32
WHOLE = r"\A\s*[+-]?[0-9]+\s*\z"
NUMBER = r"(?i)\A\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)(e[+-]?[0-9]+)?\s*\z|\A[+-]?inf(inity)?\z"
TRUTH = r"(?i)\A(true|false)\z"


def _kind(c: Column) -> Column:
    return (F.when(c.isNull(), NULL)
            .when(c.rlike(WHOLE), F.when(F.trim(c).try_cast("bigint").isNotNull(), LONG).otherwise(LARGE))
            .when(c.rlike(NUMBER), DOUBLE).when(c.rlike(TRUTH), BOOLEAN).otherwise(TEXT))


def meet(bits: int) -> str:
    """The narrowest type for all values of a column: whole numbers with
    missing values and columns without values are double, as there; numbers
    beyond 64 bits, and truth values beside numbers, are text."""
    some = bits & ~NULL
    if not some:
        return "double"
    if some == LONG:
        return "double" if bits & NULL else "bigint"
    if some == BOOLEAN:
        return "boolean"
    if not some & (TEXT | BOOLEAN) and some & DOUBLE:
        return "double"
    return "string"


def infer_types(df: DataFrame) -> dict[str, str]:
    """The type of each text column, from all its values in one pass."""
    texts = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    if not texts:
        return {}
    row = df.agg(*[F.bit_or(_kind(F.col(f"`{c}`"))).alias(f"b{i}") for i, c in enumerate(texts)]).first()
    return {c: meet(row[f"b{i}"] or NULL) for i, c in enumerate(texts)}


def cast_text(c: Column, to: str) -> Column:
    """A text as a value of the type, null if it isn't one."""
    if to == "double":
        plain = F.regexp_replace(F.trim(c), r"(?i)\A([+-]?)inf(inity)?\z", "$1Infinity")
        return F.regexp_replace(plain, r"\A\+", "").try_cast("double")
    return c if to == "string" else F.trim(c).try_cast(to)


def read_csv(spark: SparkSession, path: str | list[str], schema: T.StructType | str | None = None,
             null_tokens: list[str] | None = None) -> DataFrame:
    """S-4: header row, columns by name; quoted fields and line breaks
    round-trip with :func:`hirelens.sources.feed.write_csv`; the listed null
    tokens become null (default: those of the source's reader). Without a
    schema the types are inferred from all values (long, double, boolean or
    text); with one, columns are taken by place, and a value that is not of its
    column's type is null."""
    df = csv_text(spark, path)
    df = null_tokens_out(df, rules.CSV_NULL_TOKENS if null_tokens is None else null_tokens)
    if schema is None:
        types = infer_types(df)
        return df.select(*[cast_text(F.col(f"`{c}`"), types[c]).alias(c) for c in df.columns])
    wanted = T._parse_datatype_string(schema) if isinstance(schema, str) else schema
    have = [F.col(f"`{c}`") for c in df.columns] + [F.lit(None).cast("string")] * len(wanted.fields)
    return df.select(*[(have[i] if isinstance(f.dataType, T.StringType) else cast_text(have[i], f.dataType.simpleString())).alias(f.name)
                       for i, f in enumerate(wanted.fields)])
