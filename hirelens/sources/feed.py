"""Feed sources and sinks: landed JSON per category (S-1), flattening
(S-3), CSV write (S-5; the reader is in ``csvfiles``), column-name and column-list handling
(P-2, P-3, P-4) and outer-aligned union (U-ALL)."""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hirelens import rules
from hirelens.schemas import LANDED_JSON_SCHEMA
from hirelens.session import shared_folder


CORRUPT = "_corrupt_record"


def read_landed_json(spark: SparkSession, root: str, schema: T.StructType = LANDED_JSON_SCHEMA,
                     category_col: str = "job_category", corrupt_col: str | None = None) -> DataFrame:
    """S-1: one scan of a landing folder laid out as
    ``<root>/<category_col>=<title>/*.json``; the category comes from the
    folder name (partition discovery), so filters on it prune folders.
    A malformed record doesn't fail the run: its columns are null, and with
    ``corrupt_col`` its text is kept in that column; :func:`corrupt_counts`
    reports how many a category has.
    """
    full = T.StructType([*schema.fields, T.StructField(category_col, T.StringType(), True)]) \
        if category_col not in schema.fieldNames() else schema
    reader = spark.read.option("mode", "PERMISSIVE").option("basePath", root)
    if corrupt_col:
        full = T.StructType(full.fields + [T.StructField(corrupt_col, T.StringType(), True)])
        reader = reader.option("columnNameOfCorruptRecord", corrupt_col)
    return reader.schema(full).json(root)


def corrupt_counts(spark: SparkSession, root: str, schema: T.StructType = LANDED_JSON_SCHEMA,
                   category_col: str = "job_category") -> DataFrame:
    """Per category of a landing folder: records, and malformed ones."""
    # text lines, since the JSON reader doesn't answer for malformed records alone
    lines = spark.read.option("basePath", root).text(root).filter(F.trim("value") != "")
    fields = T.StructType(schema.fields + [T.StructField(CORRUPT, T.StringType(), True)])
    record = F.from_json("value", fields, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})
    return lines.groupBy(category_col).agg(F.count("*").alias("records"), F.count(record[CORRUPT]).alias("malformed"))


@dataclass
class Landed:
    """Good rows, rejected records (category, record, reason) and how many of
    each were seen on the one write that made both."""
    rows: DataFrame
    rejects: DataFrame
    counts: dict[str, int]


def land_json(spark: SparkSession, root: str, schema: T.StructType = LANDED_JSON_SCHEMA, *, required: tuple[str, ...] = ("id",),
              category_col: str = "job_category") -> Landed:
    """S-1 with a reject table: one scan of a landing folder, one write. Every
    record that isn't blank is a good row or a reject with its first reason:
    ``malformed`` (no JSON), ``not an object``, ``wrong type`` (a value that its
    column's type can't hold) or ``no <field>`` for a required one."""
    lines = spark.read.option("basePath", root).text(root).filter(F.trim("value") != "")
    fields = T.StructType(schema.fields + [T.StructField(CORRUPT, T.StringType(), True)])
    record = F.from_json("value", fields, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})
    value = F.try_parse_json("value")
    parsed = lines.select(category_col, "value", record.alias("r"), F.schema_of_variant(value).alias("kind"))
    reason = (F.when(F.col("kind").isNull(), "malformed").when(~F.col("kind").startswith("OBJECT"), "not an object")
              .when(F.col(f"r.{CORRUPT}").isNotNull(), "wrong type"))
    for c in required:
        reason = reason.when(F.col(f"r.`{c}`").isNull(), f"no {c}")
    parsed = parsed.select(category_col, "value", "r", reason.alias("reason")).withColumn("rejected", F.col("reason").isNotNull())
    seen, path = Observation(), shared_folder(spark, "landed")
    reasons = ["malformed", "not an object", "wrong type", *[f"no {c}" for c in required]]
    counts = [F.count(F.lit(1)).alias("records"), *[F.count_if(F.col("reason") == x).alias(x) for x in reasons]]
    parsed.observe(seen, *counts).write.partitionBy("rejected").parquet(path)
    back = spark.read.schema(parsed.schema).parquet(path)
    rows = back.where("NOT rejected").select(*[F.col(f"r.`{c}`").alias(c) for c in schema.fieldNames()], category_col)
    return Landed(rows, back.where("rejected").select(category_col, F.col("value").alias("record"), "reason"),
                  {k: int(v or 0) for k, v in seen.get.items()})


def merged_json_schema(df: DataFrame, column: str) -> T.StructType:
    """The schema of all JSON objects in a text column: each text's own schema,
    merged in one distributed aggregate. Decimal numbers are double; a field
    whose values are of types that don't meet, or always null, is text. Texts
    that hold no JSON object add nothing."""
    value = F.try_parse_json(F.col(f"`{column}`"))
    objects = F.when(F.schema_of_variant(value).startswith("OBJECT"), value)
    merged = df.select(F.schema_of_variant_agg(objects)).first()[0]
    if not merged.startswith("OBJECT<") or merged == "OBJECT<>":
        return T.StructType([])
    typed = re.sub(r"DECIMAL\(\d+, ?\d+\)|FLOAT", "DOUBLE", merged)
    typed = re.sub(r"\b(VOID|VARIANT|OBJECT<>)(?=[,>]|$)", "STRING", typed).replace("OBJECT<", "STRUCT<")
    return T._parse_datatype_string(typed)


def flatten_json(df: DataFrame, column: str, schema: T.StructType | None = None) -> DataFrame:
    """S-3 without a given schema: the text column's JSON objects as
    ``column.a.b`` columns; a missing key is null, lists stay as values."""
    schema = merged_json_schema(df, column) if schema is None else schema
    if not schema.fields:
        return df.drop(column)
    return flatten_structs(df.withColumn(column, F.from_json(F.col(f"`{column}`"), schema)))


def union_aligned(frames: list[DataFrame]) -> DataFrame:
    """U-ALL: union all by name; a column missing from a frame is null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def tag_categories(df: DataFrame, titles: list[str] | None = None, *, title_col: str = "TITLE",
                   category_col: str = "JOB_CATEGORY") -> DataFrame:
    """S-1 + P-1 + U-ALL over one table: each row appears once per target
    title it matches (whole word, case-insensitive), tagged with that title
    - the union of per-title fetches, computed in a single scan."""
    from hirelens.functions.text import title_matches
    titles = titles or rules.TARGET_TITLES
    tags = F.array(*[F.when(title_matches(F.col(title_col), [t]), F.lit(t)) for t in titles])
    base = df.drop(category_col) if category_col in df.columns else df
    return base.withColumn(category_col, F.explode(F.filter(tags, lambda x: x.isNotNull())))


def flatten_structs(df: DataFrame, sep: str = ".") -> DataFrame:
    """S-3: nested objects become ``a.b`` columns, lists stay as values."""
    def walk(dt: T.DataType, path: list[str]):
        if isinstance(dt, T.StructType):
            for f in dt.fields:
                yield from walk(f.dataType, path + [f.name])
        else:
            yield path
    cols = []
    for f in df.schema.fields:
        for path in walk(f.dataType, [f.name]):
            ref = F.col(".".join(f"`{p}`" for p in path))
            cols.append(ref.alias(sep.join(path)))
    return df.select(*cols)


def upper_columns(df: DataFrame) -> DataFrame:
    """P-2."""
    return df.toDF(*[c.upper() for c in df.columns])


def select_strict(df: DataFrame, cols: list[str]) -> DataFrame:
    """P-3: every listed column must exist (AnalysisException otherwise)."""
    return df.select(*[F.col(f"`{c}`") for c in cols])


def select_tolerant(df: DataFrame, cols: list[str]) -> DataFrame:
    """P-4: listed columns that exist, in list order."""
    present = set(df.columns)
    return df.select(*[F.col(f"`{c}`") for c in cols if c in present])


def python_repr(v: Column) -> Column:
    """A text as Python prints it inside a list: in single quotes, in double
    quotes if it has a single and no double quote, with backslash escapes for
    backslashes, the quote used and the common control characters."""
    text = v.cast("string")
    for raw, shown in (("\\", "\\\\"), ("\n", "\\n"), ("\r", "\\r"), ("\t", "\\t")):
        text = F.replace(text, F.lit(raw), F.lit(shown))
    single, double = F.contains(v, F.lit("'")), F.contains(v, F.lit('"'))
    return (F.when(v.isNull(), F.lit("None"))
            .when(single & ~double, F.concat(F.lit('"'), text, F.lit('"')))
            .otherwise(F.concat(F.lit("'"), F.replace(text, F.lit("'"), F.lit("\\'")), F.lit("'"))))


def places_text(col: Column | str) -> Column:
    """Text form of an ``array<struct<@type, address<...>>>`` as a Python
    list of dicts prints it (None for nulls), so the text-form city/state
    rules apply to landed arrays too."""
    c = F.col(col) if isinstance(col, str) else col
    q = python_repr

    def place(p: Column) -> Column:
        a = p["address"]
        return F.when(p.isNull(), F.lit("None")).otherwise(F.concat(F.lit("{'@type': "), q(p["@type"]), F.lit(", 'address': {'addressLocality': "),
                        q(a["addressLocality"]), F.lit(", 'addressRegion': "), q(a["addressRegion"]),
                        F.lit(", 'streetAddress': "), q(a["streetAddress"]), F.lit("}}")))
    return F.when(c.isNull(), F.lit(None).cast("string")).otherwise(
        F.concat(F.lit("["), F.array_join(F.transform(c, place), ", "), F.lit("]")))


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """S-5: header, no index column, quotes escaped by doubling, white space
    kept; empty strings are quoted so they stay distinct from nulls."""
    df.write.mode(mode).options(header=True, quoteAll=False, **CSV_OPTIONS).csv(path)


CSV_OPTIONS = {"escape": '"', "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}


def csv_line(cols: list[str]) -> Column:
    """One row as a line of CSV text, as :func:`write_csv` writes it (S-5)."""
    return F.to_csv(F.struct(*[F.col(f"`{c}`") for c in cols]), CSV_OPTIONS)


def csv_fields(line: str, names: list[str], skip: int = 0, null_tokens: list[str] | None = None) -> list[Column]:
    """The text fields of a CSV line after the first ``skip``, null tokens as
    null, as :func:`hirelens.sources.csvfiles.read_csv` reads them (S-4)."""
    tokens = rules.CSV_NULL_TOKENS if null_tokens is None else null_tokens
    schema = ", ".join(f"`f{i}` string" for i in range(skip + len(names)))
    row = F.from_csv(F.col(line), schema, CSV_OPTIONS)
    return [F.when(~row[f"f{skip + i}"].isin(tokens), row[f"f{skip + i}"]).alias(n) for i, n in enumerate(names)]
