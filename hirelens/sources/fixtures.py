"""Adapter from the driver's TPC-H-like tables to the posting tables.

Grain: one posting row per ``lineitem`` row, joined to its order and its
supplier. Posting IDs repeat across the lines of an order, the way a posting
repeats across the title categories it was fetched under. Every column is a
native expression over the joined row (an index into a short value list), so
the adapter is a single scan-join-project stage pair that grows with the
tables; nothing is sampled or filtered.

The value lists below are test-fixture content (ours), chosen so that every
city and state rule, the null paths and the greedy location capture are hit.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hirelens import functions as HF
from hirelens.schemas import CLEAN_COLUMNS, RAW_COLUMNS
from hirelens.session import written
from hirelens.sources.feed import CSV_OPTIONS
from hirelens.sources.tables import read_table

TITLES = ["Senior Data Engineer", "DATA SCIENTIST II", "Metadata Analyst",
          "Data Engineering Lead", "Junior data analyst", "Lead Data Scientist", None]
CATEGORIES = ["Data Engineer", "Data Scientist", "Data Analyst"]
CITIES = ["New South Wales", "Capital Australia", "Barzbin", "Queensland",
          "South Australia", "Australian Capital Territory", "Victoria",
          "Northern Territory", "West Australia", "Launceston, Tasmania",
          "No Regrets", "Other Side of the Moon", "Greater Sydney Area",
          "Melbourne", "Brisbane City", "Canberra", "Perth", "Adelaide", "Darwin",
          "Hobart", "Woden", "NA", "Newcastle", None]
STATES = ["NA", "of", "on", "Australia", "NSW", "Queensland", None]
EMPLOYMENT_TYPES = ["['FULL_TIME']", "['FULL_TIME', 'CONTRACTOR']", "['PART_TIME']", None]
ORG_SIZES = ["51-200 employees", "10,001+ employees", None]
SENIORITIES = ["executive", "Mid-Senior level", "entry level", "associate", "NA", "1 year", "3-5 years of experience",
               "10+ years", "99999999999 years", "minimum_experience", "first job", "association_level", "internship",
               "medium-high level", "senior", "manager/executive", "no experience", "", None]
NULL_DATE_MODULUS = 97
PLACE_PREFIX = "{'@type': 'Place', 'address': {'addressLocality': '"
PLACE_MIDDLE = "', 'addressRegion': '"
PLACE_SUFFIX = "', 'streetAddress': None}}"
URL_PREFIX = "https://example.com/"
TIME_OF_DAY = "T23:30:00"


def _sql_string(v: str | None) -> str:
    if v is None:
        return "CAST(NULL AS STRING)"
    return "'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _pick(values: list, key: Column) -> Column:
    """``values[key % len(values)]`` as a literal-array lookup (the array is
    one SQL literal, built in a single call)."""
    arr = F.expr("array(" + ", ".join(_sql_string(v) for v in values) + ")")
    return F.element_at(arr, (key % F.lit(len(values))).cast("int") + F.lit(1))


def _joined(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber")
    od = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    sp = read_table(spark, sf_dir, "supplier").select("s_suppkey", "s_name")
    # Plain equi-joins: Spark picks broadcast from file statistics when a
    # side is small and sort-merge otherwise; AQE splits skewed keys.
    return (li.join(od, li.l_orderkey == od.o_orderkey, "inner")
              .join(sp, li.l_suppkey == sp.s_suppkey, "inner"))


def joined_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The joined rows, written to the shared folder, for queries that go over
    the postings more than once: the join shuffles once, not in every pass."""
    return written(_joined(spark, sf_dir), "lineitem-joined")[0]


def _place(city: Column, state: Column) -> Column:
    return F.concat(F.lit(PLACE_PREFIX), F.coalesce(city, F.lit("")), F.lit(PLACE_MIDDLE),
                    F.coalesce(state, F.lit("")), F.lit(PLACE_SUFFIX))


def raw_feed(spark: SparkSession, sf_dir: str, joined: DataFrame | None = None) -> DataFrame:
    """The 44-column raw feed (all strings), plus the adapter's CITY/STATE
    ground truth as ``_CITY`` / ``_STATE``. ``joined``: the rows of
    :func:`joined_once`, else they are joined anew in every pass."""
    j = _joined(spark, sf_dir) if joined is None else joined
    pk, ln = F.col("l_partkey"), F.col("l_linenumber")
    ok = F.col("l_orderkey")
    id_ = ok.cast("string")
    city = _pick(CITIES, pk)
    state = _pick(STATES, pk + ln)
    place = _place(city, state)
    locations = (F.when(ok % 11 == 0, F.lit(None).cast("string"))
                  .when(ok % 11 == 1, F.concat(F.lit("["), place, F.lit(", "), place, F.lit("]")))
                  .otherwise(F.concat(F.lit("["), place, F.lit("]"))))
    date_created = F.when(pk % NULL_DATE_MODULUS == 0, F.lit(None).cast("string")).otherwise(
        F.concat(F.col("o_orderdate").cast("date").cast("string"), F.lit(TIME_OF_DAY)))
    values = {
        "ID": id_,
        "DATE_CREATED": date_created,
        "TITLE": _pick(TITLES, pk),
        "JOB_CATEGORY": _pick(CATEGORIES, ln),
        "ORGANIZATION": F.col("s_name"),
        "LOCATIONS_RAW": locations,
        "EMPLOYMENT_TYPE": _pick(EMPLOYMENT_TYPES, ln),
        "URL": F.concat(F.lit(URL_PREFIX), id_),
        "LINKEDIN_ORG_SIZE": _pick(ORG_SIZES, F.col("l_suppkey")),
        "SENIORITY": _pick(SENIORITIES, ok),
    }
    cols = [values.get(c, F.lit(None).cast("string")).alias(c) for c in RAW_COLUMNS]
    return j.select(*cols, city.alias("_CITY"), state.alias("_STATE"))


def clean_postings(spark: SparkSession, sf_dir: str, joined: DataFrame | None = None) -> DataFrame:
    """The 31-column clean postings table: CITY/STATE are the adapter's
    values, the other derived columns use the ingest functions."""
    raw = raw_feed(spark, sf_dir, joined)
    derived = {
        "JOB_DATE": HF.date_from_text("DATE_CREATED"),
        "CITY": F.col("_CITY"),
        "STATE": F.col("_STATE"),
        "EMPLOYMENT_TYPE": HF.employment_type_text("EMPLOYMENT_TYPE"),
        "ORG_SIZE": HF.org_size_text("LINKEDIN_ORG_SIZE"),
    }
    return raw.select(*[derived.get(c, F.col(c)).alias(c) for c in CLEAN_COLUMNS])


# A job description's title by its document; one target title has none.
DESCRIPTION_TITLES = ["Data Engineer", "Data Scientist", "Web Developer"]


def descriptions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document as a description row: one sheet per source, rows in
    document order."""
    docs = read_table(spark, sf_dir, "documents")
    return docs.select(F.col("source").alias("sheet_no"), F.col("doc_id").alias("row_no"),
                       _pick(DESCRIPTION_TITLES, F.col("doc_id")).alias("Job_Title"), F.col("text").alias("Job_Description"))


ANSWER_HEAD = "Here it is:\nJob_Title,technical_skills,soft_skills\nData Analyst,"
ANSWER_TAIL = "\nData Engineer,spark,\nData Scientist,python,curiosity\nThanks, all"


QUOTED_HEAD = 'Job_Title,technical_skills,soft_skills\n"Data\nAnalyst",'
QUOTED_TAIL = ',"say ""hi"", then\ngo"\nnot in the block'


def answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation turn, and for each one an answer that holds a CSV
    block between other lines (with a negative turn number), and one whose
    block has quoted line breaks (a negative number from -1000 down)."""
    conv = read_table(spark, sf_dir, "conversations")
    conv_id = F.col("conv_id").cast("string")
    block = F.concat(F.lit(ANSWER_HEAD), conv_id, F.lit(","), F.col("role"), F.lit(ANSWER_TAIL))
    quoted = F.concat(F.lit(QUOTED_HEAD), conv_id, F.lit(QUOTED_TAIL))
    return (conv.select("conv_id", F.col("turn").cast("int").alias("turn"), "text")
            .union(conv.select("conv_id", (-1 - F.col("turn")).cast("int").alias("turn"), block.alias("text")))
            .union(conv.select("conv_id", (-1000 - F.col("turn")).cast("int").alias("turn"), quoted.alias("text"))))


def json_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event with a JSON text whose keys and types depend on the event:
    a nested object, a list, a key of two types and texts without JSON."""
    ev = read_table(spark, sf_dir, "events")
    n = F.col("event_id") % 5
    text = (F.when(n == 0, F.concat(F.lit('{"user": {"id": '), F.col("user_id").cast("string"), F.lit(', "kind": "'), F.col("event_type"), F.lit('"}, "code": 7}')))
            .when(n == 1, F.concat(F.lit('{"code": "'), F.col("event_type"), F.lit('", "tags": ["a", "b"]}')))
            .when(n == 2, F.concat(F.lit('{"score": '), F.col("user_id").cast("string"), F.lit('.5, "gone": null}')))
            .when(n == 3, F.lit("no json")).otherwise(F.col("props")))
    return ev.select("event_id", text.alias("props"))


def land_records(spark: SparkSession, sf_dir: str, root: str) -> None:
    """Every raw posting as a JSON record in a landing folder by category;
    some are cut short, no object, of a wrong type or without an id."""
    raw = raw_feed(spark, sf_dir).select("ID", "TITLE", "JOB_CATEGORY", "ORGANIZATION")
    n = F.col("ID").cast("long") % 40
    whole = F.to_json(F.struct(F.col("ID").alias("id"), F.col("TITLE").alias("title"), F.col("ORGANIZATION").alias("organization")))
    line = (F.when(n == 0, F.left(whole, F.length(whole) - 2)).when(n == 1, F.lit("[1, 2]"))
            .when(n == 2, F.concat(F.left(whole, F.length(whole) - 1), F.lit(', "employment_type": 5}')))
            .when(n == 3, F.to_json(F.struct(F.col("TITLE").alias("title")))).otherwise(whole))
    raw.select(line.alias("value"), F.col("JOB_CATEGORY").alias("job_category")).write.partitionBy("job_category").text(root)


def csv_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every order line as a row whose columns a CSV reader infers as whole
    numbers, decimals, truth values and text, with quoted line breaks."""
    li = read_table(spark, sf_dir, "lineitem")
    note = F.concat(F.lit('say "'), F.col("l_linestatus"), F.lit('"\n'), F.col("l_returnflag"), F.lit(", "), F.col("l_partkey").cast("string"))
    return li.select(F.col("l_orderkey").alias("order_id"), F.col("l_linenumber").alias("line_no"), F.col("l_extendedprice").alias("price"),
                     F.when(F.col("l_partkey") % 5 != 0, F.col("l_suppkey")).alias("supplier"), (F.col("l_returnflag") == "R").alias("returned"),
                     F.concat("l_returnflag", F.col("l_linenumber").cast("string")).alias("code"), note.alias("note"))


def write_sheets(spark: SparkSession, sf_dir: str, folder: str) -> list[str]:
    """Every document as a row of a sheet for its source, in the order of
    their ids; the sheets' paths in the order of the sources' names."""
    docs = read_table(spark, sf_dir, "documents")
    rows = docs.select("source", "doc_id", _pick(DESCRIPTION_TITLES, F.col("doc_id")).alias("Job_Title"), F.col("text").alias("Job_Description"))
    rows = rows.repartitionByRange("source", "doc_id").sortWithinPartitions("source", "doc_id")
    rows.write.partitionBy("source").options(header=True, **CSV_OPTIONS).csv(folder)
    names = [r["source"] for r in docs.select("source").distinct().orderBy("source").collect()]  # a row for each sheet
    return [f"{folder}/source={n}" for n in names]
