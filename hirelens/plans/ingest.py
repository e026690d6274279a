"""Daily ingest (M-13) as one lazy plan: feed → upper-case names →
tolerant select → title filter → derived columns → strict select →
anti join against stored postings → translation → append.

Only the anti join shuffles (the stored side reduced to distinct IDs first);
everything else is a per-row projection or filter.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hirelens import functions as HF
from hirelens import rules
from hirelens.operators import anti_join_new
from hirelens.plans.enrich import translate_columns
from hirelens.schemas import CLEAN_COLUMNS, RAW_COLUMNS
from hirelens.sources.feed import places_text, select_strict, select_tolerant, upper_columns
from hirelens.sources.tables import append_table


def prepare_feed(raw: DataFrame, variant: str = "v2") -> DataFrame:
    """Steps 1-2: upper-case names and select the raw columns.

    v2 keeps the listed columns that exist (P-4). v1 requires all of them
    (P-3) and reads the feed back from its CSV copy, so every whole value
    equal to a CSV null token ('NA', 'nan', 'None', ...) becomes null; the
    round trip is applied as that column rule instead of a file write."""
    up = upper_columns(raw)
    if variant != "v1":
        return select_tolerant(up, RAW_COLUMNS)
    strict = select_strict(up, RAW_COLUMNS)
    return strict.select(*[_csv_nulls(strict, c) for c in RAW_COLUMNS])


def _csv_nulls(df: DataFrame, c: str):
    col = F.col(f"`{c}`")
    if isinstance(df.schema[c].dataType, T.StringType):
        return F.when(col.isin(rules.CSV_NULL_TOKENS), F.lit(None).cast("string")).otherwise(col).alias(c)
    return col


def clean_feed(feed: DataFrame, *, token: str = "nan") -> DataFrame:
    """Steps 3-5: title filter (P-6), derived columns (F-24, F-4, F-5, F-11,
    F-12) and the strict 31-column select (P-3). Landed arrays are read
    through their text form, so both feed shapes give the same result."""
    df = feed.filter(HF.title_matches("TITLE"))
    fields = {f.name: f.dataType for f in df.schema.fields}
    loc = F.col("LOCATIONS_RAW")
    if isinstance(fields.get("LOCATIONS_RAW"), T.ArrayType):
        loc = places_text(loc)
    emp = F.col("EMPLOYMENT_TYPE")
    emp_clean = (HF.employment_type_from_array(emp, token)
                 if isinstance(fields.get("EMPLOYMENT_TYPE"), T.ArrayType)
                 else HF.employment_type_text(emp, token))
    df = (df.withColumn("JOB_DATE", HF.date_from_text("DATE_CREATED"))
            .withColumn("CITY", HF.city_from_locations(loc))
            .withColumn("STATE", HF.state_from_locations(loc))
            .withColumn("EMPLOYMENT_TYPE", emp_clean)
            .withColumn("ORG_SIZE", HF.org_size_text("LINKEDIN_ORG_SIZE", token)))
    return select_strict(df, CLEAN_COLUMNS)


def stored_postings(stored: DataFrame) -> DataFrame:
    """S-6: the stored-table scan the ingest compares against, with the
    three title substring predicates (P-7); only ID and TITLE are read."""
    return stored.select("ID", "TITLE").filter(HF.title_contains("TITLE"))


def ingest(raw: DataFrame, stored: DataFrame | None = None, *, variant: str = "v2",
           translate: bool = True) -> DataFrame:
    """Steps 1-8 of the daily ingest; the caller appends the result."""
    batch = clean_feed(prepare_feed(raw, variant))
    if stored is not None:
        batch = anti_join_new(batch, stored_postings(stored), "ID", null_safe=True)
    if translate:
        batch = translate_columns(batch, variant=variant)
    return batch


def run_daily(raw: DataFrame, table: str, *, variant: str = "v2",
              buckets: int | None = None) -> DataFrame:
    """Steps 1-9: ingest against the stored table (when it exists) and
    append the new postings (S-8, with the column-list check P-14). With
    ``buckets`` the table is kept bucketed by ID, so the anti join never
    reshuffles the stored postings."""
    spark = raw.sparkSession
    stored = spark.table(table) if spark.catalog.tableExists(table) else None
    batch = ingest(raw, stored, variant=variant)
    append_table(batch, table, bucket_by="ID" if buckets else None, buckets=buckets)
    return batch
