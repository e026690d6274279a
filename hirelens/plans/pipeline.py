"""Model run in dependency order (the warehouse project's ``run``), as plain
calls: shared results are materialized as tables (S-14), final marts as
views (S-15); row counts come from ``observe`` on the writes (A-9), not from
extra passes."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from hirelens.plans import enrich, models
from hirelens.session import written
from hirelens.sources.tables import materialize_view

TABLES = ["base_city", "base_state", "job_seniority", "int_postings", "int_job_links"]
VIEWS = ["mart_total_jobs_by_city", "mart_total_jobs_by_org", "mart_total_jobs_by_state",
         "mart_total_jobs_by_type", "mart_total_jobs_daily", "mart_total_jobs_wow_trend"]


def _save(df: DataFrame, name: str, counts: dict[str, int]) -> DataFrame:
    obs = Observation(name)
    df.observe(obs, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").saveAsTable(name)
    counts[name] = obs.get["rows"]
    return df.sparkSession.table(name)


def run_models(clean: DataFrame, seniority: DataFrame | None = None) -> dict[str, int]:
    """Build every model from the clean postings table. Without a seniority
    table, the dictionary is derived from the postings (M-11) and saved as
    ``job_seniority``. Returns the row count of each table written."""
    counts: dict[str, int] = {}
    profiles = written(models.posting_profiles(clean), "profiles")[0]
    city = _save(models.base_city(profiles), "base_city", counts)
    _save(models.base_state(city), "base_state", counts)
    if seniority is None:
        seniority = _save(enrich.seniority_dictionary(profiles), "job_seniority", counts)
    fact = _save(models.fact_postings(clean, seniority, profiles=profiles), "int_postings", counts)
    _save(models.job_links(clean), "int_job_links", counts)
    daily = materialize_view(models.jobs_daily(fact), "mart_total_jobs_daily")
    materialize_view(models.jobs_by_city(fact), "mart_total_jobs_by_city")
    materialize_view(models.jobs_by_org(fact), "mart_total_jobs_by_org")
    materialize_view(models.jobs_by_state(fact), "mart_total_jobs_by_state")
    materialize_view(models.jobs_by_type(fact), "mart_total_jobs_by_type")
    materialize_view(models.jobs_wow_trend(daily), "mart_total_jobs_wow_trend")
    return counts


def run_skills(descriptions: DataFrame, table: str = "mart_top_job_skills") -> int:
    """M-12: top skills per role from the deduplicated role descriptions,
    replacing ``table`` (S-9)."""
    counts: dict[str, int] = {}
    _save(enrich.top_job_skills(descriptions), table, counts)
    return counts[table]
