"""Registered queries: one per operator / model of the survey, each a
function ``(spark, sf_dir) -> DataFrame`` over the driver tables."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hirelens import functions as HF
from hirelens import rules
from hirelens.operators import (
    anti_join_new, dictionary_lookup, first_per_key, ordered_distinct, preview, recent_capped, row_counts,
)
from hirelens.operators.skills import top_skills
from hirelens.plans import daystates, enrich, ingest, models
from hirelens.session import shared_folder, written
from hirelens.sources import fixtures
from hirelens.sources.csvfiles import read_csv
from hirelens.sources.feed import (
    csv_fields, csv_line, flatten_json, flatten_structs, land_json, tag_categories, union_aligned, write_csv,
)
from hirelens.sources.loads import load_new, read_loads
from hirelens.sources.sheets import later_first, read_sheets
from hirelens.sources.tables import append_table, materialize_view, read_table, replace_table
from hirelens.sources.textblock import csv_block_rows

# Postings dated before this day form the stored table the ingest compares
# against (the snapshot "already loaded"); the new batch is the whole feed.
STORED_BEFORE = dt.date(1998, 1, 1)
WEEK_HOURS = 7 * 24

Query = Callable[[SparkSession, str], DataFrame]


def _clean(spark, d):
    return fixtures.clean_postings(spark, d)


def _clean_once(spark, d, *columns):
    """Columns of the clean postings, written once for several passes."""
    return written(_clean(spark, d).select(*columns), "postings")[0]


def _fact(spark, d):
    clean = fixtures.clean_postings(spark, d, fixtures.joined_once(spark, d))
    profiles = written(models.posting_profiles(clean), "profiles")[0]
    return models.fact_postings(clean, profiles=profiles)


def _fact_rows(spark, d, *columns):
    return models.fact_rows(_clean(spark, d), list(columns))


def _before(clean):
    return clean.filter(F.col("JOB_DATE") < F.lit(STORED_BEFORE))


def _stored(spark, d):
    return _before(_clean(spark, d))


# --- sources, projections, filters -------------------------------------------

def q_title_regex(spark, d):
    raw = fixtures.raw_feed(spark, d)
    return raw.filter(HF.title_matches("TITLE")).select("ID", "TITLE", "JOB_CATEGORY")


def q_title_like(spark, d):
    return ingest.stored_postings(_clean(spark, d))


def _events(spark, d):
    return read_table(spark, d, "events").select("event_id", "ts", "user_id", "event_type")


def q_feed_cap(spark, d):
    ev = _events(spark, d)
    capped = recent_capped(ev, "ts", "event_type", "event_id",
                           window_hours=rules.FEED_WINDOW_HOURS, limit=rules.FEED_LIMIT)
    return capped.select("event_type", "event_id", "user_id")


def q_feed_cap_week(spark, d):
    ev = _events(spark, d)
    capped = recent_capped(ev, "ts", "event_type", "event_id",
                           window_hours=WEEK_HOURS, limit=rules.FEED_LIMIT)
    return capped.select("event_type", "event_id", "user_id")


def q_union_categories(spark, d):
    raw = fixtures.raw_feed(spark, d).select("ID", "TITLE")
    return tag_categories(raw)


def q_city_extract(spark, d):
    raw = fixtures.raw_feed(spark, d)
    return raw.select("ID", "LOCATIONS_RAW", HF.city_from_locations("LOCATIONS_RAW").alias("CITY"))


def q_state_extract(spark, d):
    raw = fixtures.raw_feed(spark, d)
    return raw.select("ID", "LOCATIONS_RAW", HF.state_from_locations("LOCATIONS_RAW").alias("STATE"))


def q_employment_type(spark, d):
    raw = fixtures.raw_feed(spark, d)
    return raw.select("ID", F.col("EMPLOYMENT_TYPE").alias("EMPLOYMENT_TYPE_RAW"),
                      HF.employment_type_text("EMPLOYMENT_TYPE").alias("EMPLOYMENT_TYPE"))


def q_org_size(spark, d):
    raw = fixtures.raw_feed(spark, d)
    return raw.select("ID", "LINKEDIN_ORG_SIZE", HF.org_size_text("LINKEDIN_ORG_SIZE").alias("ORG_SIZE"))


def q_job_date(spark, d):
    raw = fixtures.raw_feed(spark, d)
    return raw.select("ID", "DATE_CREATED", HF.date_from_text("DATE_CREATED").alias("JOB_DATE"))


def q_url_encode(spark, d):
    titles = fixtures.raw_feed(spark, d).select("TITLE").filter(F.col("TITLE").isNotNull()).distinct()
    return titles.select("TITLE", HF.url_encoded("TITLE").alias("TITLE_ENCODED"))


def q_json_path(spark, d):
    ev = read_table(spark, d, "events")
    return ev.select("event_id", HF.json_path("props", "$.k").alias("k"))


def q_json_flatten(spark, d):
    ev = read_table(spark, d, "events")
    nested = ev.select("event_id", "event_type", F.from_json("props", "k BIGINT").alias("props"))
    return flatten_structs(nested)


# --- joins and lookups ----------------------------------------------------------

def q_anti_join(spark, d):
    new = _clean(spark, d).select("ID", "TITLE", "JOB_CATEGORY", "JOB_DATE")
    stored = ingest.stored_postings(_stored(spark, d))
    return anti_join_new(new, stored, "ID", null_safe=True)


def _seniority_lookup(spark, d, default):
    clean = _clean(spark, d)
    dictionary = enrich.seniority_dictionary(clean)
    return dictionary_lookup(clean.select("ID", "SENIORITY"), "SENIORITY", dictionary,
                             key_col="SENIORITY", value_col="SENIORITY_STANDARDIZED",
                             default=default)


def q_dict_lookup_na(spark, d):
    return _seniority_lookup(spark, d, "na")


def q_dict_lookup_keep(spark, d):
    return _seniority_lookup(spark, d, "keep")


def _translated(spark, d, variant):
    clean = _clean(spark, d).select("ID", "CITY", "STATE", "ORGANIZATION", "SENIORITY")
    return enrich.translate_columns(clean, variant=variant)


def q_translate(spark, d):
    return _translated(spark, d, "v2")


def q_translate_v1(spark, d):
    return _translated(spark, d, "v1")


# --- models --------------------------------------------------------------------------

def q_base_city(spark, d):
    return models.base_city(_clean(spark, d))


def q_base_state(spark, d):
    return models.base_state(models.base_city(_clean(spark, d)))


def q_seniority_rules(spark, d):
    return enrich.seniority_dictionary(_clean(spark, d))


def q_seniority_labels(spark, d):
    levels = _clean(spark, d).select("SENIORITY").distinct()
    return levels.select("SENIORITY", HF.seniority_label("SENIORITY").alias("SENIORITY_LABEL"))


def q_int_data(spark, d):
    return _fact(spark, d)


def q_job_links(spark, d):
    return models.job_links(_clean(spark, d))


def q_by_city(spark, d):
    return models.jobs_by_city(_fact(spark, d))


def q_by_org(spark, d):
    return models.jobs_by_org(_fact_rows(spark, d, "ORGANIZATION", "JOB_CATEGORY", "ID"))


def q_by_state(spark, d):
    return models.jobs_by_state(_fact(spark, d))


def q_by_type(spark, d):
    return models.jobs_by_type(_fact_rows(spark, d, "JOB_CATEGORY", "ID"))


def q_daily(spark, d):
    return models.jobs_daily(_fact_rows(spark, d, "JOB_CATEGORY", "JOB_DATE", "ID"))


def q_wow(spark, d):
    return models.jobs_wow_trend(q_daily(spark, d))


def _ingested(spark, d, variant):
    joined = fixtures.joined_once(spark, d)
    raw = fixtures.raw_feed(spark, d, joined).drop("_CITY", "_STATE")
    return ingest.ingest(raw, _before(fixtures.clean_postings(spark, d, joined)), variant=variant)


def q_ingest(spark, d):
    return _ingested(spark, d, "v2")


def q_ingest_v1(spark, d):
    return _ingested(spark, d, "v1")


# --- text operators ---------------------------------------------------------------------

def q_first_per_key(spark, d):
    docs = read_table(spark, d, "documents")
    return first_per_key(docs, ["source", "text"], ["doc_id"])


def q_role_text(spark, d):
    conv = read_table(spark, d, "conversations")
    return ordered_distinct(conv, "role", "text", ["conv_id", "turn"])


def q_top_skills(spark, d):
    docs = read_table(spark, d, "documents").select("doc_id", "source", "text")
    return top_skills(docs, "source", "text", "doc_id")


def q_csv_block(spark, d):
    return csv_block_rows(fixtures.answers(spark, d), ["conv_id", "turn"], "text")


def q_top_job_skills(spark, d):
    return enrich.top_job_skills(enrich.role_descriptions(fixtures.descriptions(spark, d)))


# --- whole-operator checks ---------------------------------------------------------------

def q_union_aligned(spark, d):
    raw = fixtures.raw_feed(spark, d)
    parts = [raw.filter(F.col("JOB_CATEGORY") == c).select("ID", *extra)
             for c, extra in zip(fixtures.CATEGORIES, (["TITLE"], ["ORGANIZATION", "TITLE"], ["URL"]))]
    return union_aligned(parts)


def q_json_default(spark, d):
    ev = read_table(spark, d, "events")
    return ev.select("event_id", HF.json_path_or("props", "$.k", "none").alias("k"),
                     HF.json_path_or("props", "$.absent", "none").alias("absent"),
                     HF.json_path_or("event_type", "$.k", "none").alias("invalid"))


def q_csv_text(spark, d):
    fields = ["ID", "TITLE", "CITY", "SENIORITY"]
    rows = _clean(spark, d).select(*fields)
    lines = rows.select("ID", csv_line(fields).alias("line"))
    return lines.select("ID", "line", *csv_fields("line", fields[1:], skip=1))


def q_row_counts(spark, d):
    raw = fixtures.raw_feed(spark, d).select("ID", "TITLE", "DATE_CREATED")
    titled = HF.title_matches("TITLE")
    return row_counts(raw, {"feed": F.lit(True), "titled": titled,
                            "titled_with_date": titled & HF.date_from_text("DATE_CREATED").isNotNull()})


def q_distinct_function(spark, d):
    def code(cities):
        if (cities == "Canberra").any():
            raise ValueError("no code")
        return cities.str.upper().str[:3]
    out = enrich.apply_to_distinct(_clean(spark, d), "CITY", code, "code", default="none")
    return out.select(F.col("value").alias("CITY"), "code", "failed")


def _translator():
    """A pure stand-in for a translation client; one place it can't do."""
    def upper(values):
        if (values == "Canberra").any():
            raise ValueError("no translation")
        return values.str.upper()
    return upper


def q_translate_kept(spark, d):
    """All postings translated after the stored ones, by one kept dictionary."""
    clean = _clean_once(spark, d, "ID", "CITY", "STATE", "ORGANIZATION", "SENIORITY", "JOB_DATE")
    store = shared_folder(spark, "translations")
    enrich.translate_columns(clean.filter(F.col("JOB_DATE") < F.lit(STORED_BEFORE)), translator=_translator(), store=store)
    return enrich.translate_columns(clean.drop("JOB_DATE"), translator=_translator(), store=store)


def q_kept_calls(spark, d):
    """Values called and failed when a kept dictionary is asked for the stored
    postings, for all postings, and for all once more."""
    clean = _clean_once(spark, d, "CITY", "SENIORITY", "JOB_DATE")
    root = shared_folder(spark, "kept")
    runs = []
    for run, rows in enumerate([clean.filter(F.col("JOB_DATE") < F.lit(STORED_BEFORE)), clean, clean]):
        _, called, failed = enrich.kept_dictionary(rows, ["CITY", "SENIORITY"], _translator(), root)
        runs.append((run, called, failed))
    return spark.createDataFrame(runs, "run int, called long, failed long")


def q_scored_terms(spark, d):
    return enrich.role_terms(fixtures.descriptions(spark, d))


# --- stores, files and tables, written and read back ------------------------------------------

FIRST_LOAD, SECOND_LOAD = dt.date(1995, 1, 1), dt.date(1998, 1, 1)


def q_daily_loads(spark, d):
    """Two loads, each run again: the first with the same batch, the second
    with a changed one (postings without a city are gone from it)."""
    clean = _clean_once(spark, d, "ID", "TITLE", "JOB_CATEGORY", "JOB_DATE", "CITY")
    root = shared_folder(spark, "daily-loads")
    first, second = clean.filter(F.col("JOB_DATE") < FIRST_LOAD), clean.filter(F.col("JOB_DATE") < SECOND_LOAD)
    load_new(first, root, FIRST_LOAD.isoformat())
    load_new(first, root, FIRST_LOAD.isoformat())
    load_new(second, root, SECOND_LOAD.isoformat())
    load_new(second.filter(F.col("CITY").isNotNull()), root, SECOND_LOAD.isoformat())
    return read_loads(spark, root, clean.schema)


def q_csv_typed(spark, d):
    path = shared_folder(spark, "csv-typed")
    write_csv(fixtures.csv_feed(spark, d), path)
    return read_csv(spark, path)


def q_sheets(spark, d):
    paths = fixtures.write_sheets(spark, d, shared_folder(spark, "sheets"))
    return later_first(read_sheets(spark, paths)).select("sheet_no", "doc_id", "Job_Title", "Job_Description")


def q_replace_view(spark, d):
    """A table that is replaced, then appended to by a batch of the same
    columns (one of other columns is refused), under a view."""
    name = f"postings_{uuid.uuid4().hex}"
    clean = _clean(spark, d).select("ID", "TITLE", "JOB_CATEGORY", "JOB_DATE")
    old, new = clean.filter(F.col("JOB_DATE") < STORED_BEFORE), clean.filter(F.col("JOB_DATE") >= STORED_BEFORE)
    path = shared_folder(spark, name)
    replace_table(clean, name, path)
    replace_table(old, name, path)
    append_table(new, name, path=path)
    try:
        append_table(new.select("TITLE", "ID", "JOB_CATEGORY", "JOB_DATE"), name, path=path)
    except ValueError:
        return materialize_view(spark.table(name), f"v_{name}")
    raise AssertionError("columns in another order must be refused")


def q_marts(spark, d):
    return models.jobs_marts(_fact(spark, d))


def q_day_states(spark, d):
    """Distinct postings by category and year, and by category, from the
    states of three loads; the second load is added twice."""
    rows = _clean_once(spark, d, "JOB_CATEGORY", "JOB_DATE", "ID")
    root, keys = shared_folder(spark, "day-states"), ["JOB_CATEGORY", "JOB_DATE"]
    early, late = F.col("JOB_DATE") < FIRST_LOAD, F.col("JOB_DATE") < SECOND_LOAD
    daystates.add_load(rows.filter(early), root, FIRST_LOAD.isoformat(), keys)
    for _ in range(2):
        daystates.add_load(rows.filter(late & ~early), root, SECOND_LOAD.isoformat(), keys)
    daystates.add_load(rows.filter(~late | F.col("JOB_DATE").isNull()), root, "rest", keys)
    states = daystates.read_states(spark, root, rows.select(*keys).schema)
    year = F.year("JOB_DATE").cast("long").alias("Year")
    by_year = daystates.count_states(states, ["JOB_CATEGORY", year, F.lit("year").alias("level")])
    return by_year.union(daystates.count_states(states, ["JOB_CATEGORY", F.lit(None).cast("long").alias("Year"), F.lit("all").alias("level")]))


def q_json_merged(spark, d):
    return flatten_json(fixtures.json_events(spark, d), "props")


def q_landed(spark, d):
    """Records of a landing folder by category and reason of rejection (none:
    good rows), with the distinct IDs among them."""
    root = shared_folder(spark, "landing")
    fixtures.land_records(spark, d, root)
    landed = land_json(spark, root)
    if landed.rejects.count() + landed.rows.count() != landed.counts["records"]:
        raise AssertionError("rows and rejects must be all records")
    good = landed.rows.select(F.col("job_category").alias("JOB_CATEGORY"), F.lit(None).cast("string").alias("reason"), "id")
    bad = landed.rejects.select(F.col("job_category").alias("JOB_CATEGORY"), "reason", F.get_json_object("record", "$.id").alias("id"))
    return good.union(bad).groupBy("JOB_CATEGORY", "reason").agg(F.count("*").alias("records"), F.countDistinct("id").alias("ids"))


def q_preview(spark, d):
    ev = _events(spark, d)
    order = [("ts", True), ("event_id", True)]
    head, tail = preview(ev, 5, order), preview(ev, 5, order, tail=True)
    return head.withColumn("part", F.lit("head")).union(tail.withColumn("part", F.lit("tail")))


QUERIES: dict[str, Query] = {
    "q_title_regex": q_title_regex,
    "q_title_like": q_title_like,
    "q_feed_cap": q_feed_cap,
    "q_feed_cap_week": q_feed_cap_week,
    "q_union_categories": q_union_categories,
    "q_city_extract": q_city_extract,
    "q_state_extract": q_state_extract,
    "q_employment_type": q_employment_type,
    "q_org_size": q_org_size,
    "q_job_date": q_job_date,
    "q_url_encode": q_url_encode,
    "q_json_path": q_json_path,
    "q_json_flatten": q_json_flatten,
    "q_anti_join": q_anti_join,
    "q_dict_lookup_na": q_dict_lookup_na,
    "q_dict_lookup_keep": q_dict_lookup_keep,
    "q_translate": q_translate,
    "q_translate_v1": q_translate_v1,
    "q_base_city": q_base_city,
    "q_base_state": q_base_state,
    "q_seniority_rules": q_seniority_rules,
    "q_seniority_labels": q_seniority_labels,
    "q_int_data": q_int_data,
    "q_job_links": q_job_links,
    "q_by_city": q_by_city,
    "q_by_org": q_by_org,
    "q_by_state": q_by_state,
    "q_by_type": q_by_type,
    "q_daily": q_daily,
    "q_wow": q_wow,
    "q_ingest": q_ingest,
    "q_ingest_v1": q_ingest_v1,
    "q_first_per_key": q_first_per_key,
    "q_role_text": q_role_text,
    "q_top_skills": q_top_skills,
    "q_csv_block": q_csv_block,
    "q_top_job_skills": q_top_job_skills,
    "q_union_aligned": q_union_aligned,
    "q_json_default": q_json_default,
    "q_csv_text": q_csv_text,
    "q_row_counts": q_row_counts,
    "q_distinct_function": q_distinct_function,
    "q_translate_kept": q_translate_kept,
    "q_kept_calls": q_kept_calls,
    "q_scored_terms": q_scored_terms,
    "q_daily_loads": q_daily_loads,
    "q_csv_typed": q_csv_typed,
    "q_sheets": q_sheets,
    "q_replace_view": q_replace_view,
    "q_preview": q_preview,
    "q_marts": q_marts,
    "q_day_states": q_day_states,
    "q_json_merged": q_json_merged,
    "q_landed": q_landed,
}
