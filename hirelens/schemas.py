"""Column lists and StructTypes of the posting tables.

FIXED VALUES: the column lists must equal the source project's, in its order.
"""

from __future__ import annotations

from pyspark.sql import types as T

# Raw feed after flattening and upper-casing, in feed order (44 columns).
RAW_COLUMNS: list[str] = [
    "ID", "DATE_POSTED", "DATE_CREATED", "TITLE", "JOB_CATEGORY",
    "ORGANIZATION", "ORGANIZATION_URL", "DATE_VALIDTHROUGH", "LOCATIONS_RAW",
    "LOCATION_TYPE", "LOCATION_REQUIREMENTS_RAW", "EMPLOYMENT_TYPE", "URL",
    "SOURCE_TYPE", "SOURCE", "SOURCE_DOMAIN", "ORGANIZATION_LOGO",
    "CITIES_DERIVED", "REGIONS_DERIVED", "COUNTRIES_DERIVED",
    "LOCATIONS_DERIVED", "TIMEZONES_DERIVED", "LATS_DERIVED", "LNGS_DERIVED",
    "REMOTE_DERIVED", "RECRUITER_NAME", "RECRUITER_TITLE", "RECRUITER_URL",
    "LINKEDIN_ORG_EMPLOYEES", "LINKEDIN_ORG_URL", "LINKEDIN_ORG_SIZE",
    "LINKEDIN_ORG_SLOGAN", "LINKEDIN_ORG_INDUSTRY", "LINKEDIN_ORG_FOLLOWERS",
    "LINKEDIN_ORG_HEADQUARTERS", "LINKEDIN_ORG_TYPE", "LINKEDIN_ORG_FOUNDEDDATE",
    "LINKEDIN_ORG_SPECIALTIES", "LINKEDIN_ORG_LOCATIONS", "LINKEDIN_ORG_DESCRIPTION",
    "LINKEDIN_ORG_RECRUITMENT_AGENCY_DERIVED", "SENIORITY", "DIRECTAPPLY",
    "LINKEDIN_ORG_SLUG",
]

# Clean postings table (31 columns), the append target of the daily ingest.
CLEAN_COLUMNS: list[str] = [
    "ID", "TITLE", "JOB_CATEGORY", "JOB_DATE", "CITY", "STATE", "EMPLOYMENT_TYPE",
    "ORGANIZATION", "ORGANIZATION_URL", "URL", "SOURCE_TYPE", "SOURCE",
    "SOURCE_DOMAIN", "ORGANIZATION_LOGO", "REMOTE_DERIVED", "RECRUITER_NAME",
    "RECRUITER_TITLE", "RECRUITER_URL", "LINKEDIN_ORG_URL", "ORG_SIZE",
    "LINKEDIN_ORG_INDUSTRY", "LINKEDIN_ORG_HEADQUARTERS", "LINKEDIN_ORG_TYPE",
    "LINKEDIN_ORG_FOUNDEDDATE", "LINKEDIN_ORG_SPECIALTIES", "LINKEDIN_ORG_LOCATIONS",
    "LINKEDIN_ORG_DESCRIPTION", "LINKEDIN_ORG_RECRUITMENT_AGENCY_DERIVED",
    "SENIORITY", "DIRECTAPPLY", "LINKEDIN_ORG_SLUG",
]

# The three columns the fact table replaces by standardized values.
STANDARDIZED = ("CITY", "STATE", "SENIORITY")

# Group key of the fact table: the clean columns minus the standardized ones.
POSTING_KEY: list[str] = [c for c in CLEAN_COLUMNS if c not in STANDARDIZED]

# Output order of the fact table.
FACT_COLUMNS: list[str] = [
    "ID", "TITLE", "JOB_CATEGORY", "JOB_DATE", "EMPLOYMENT_TYPE",
    "CITY", "STATE", "SENIORITY",
    "ORGANIZATION", "ORGANIZATION_URL", "URL", "SOURCE_TYPE", "SOURCE",
    "SOURCE_DOMAIN", "ORGANIZATION_LOGO", "REMOTE_DERIVED", "RECRUITER_NAME",
    "RECRUITER_TITLE", "RECRUITER_URL", "LINKEDIN_ORG_URL", "ORG_SIZE",
    "LINKEDIN_ORG_INDUSTRY", "LINKEDIN_ORG_HEADQUARTERS", "LINKEDIN_ORG_TYPE",
    "LINKEDIN_ORG_FOUNDEDDATE", "LINKEDIN_ORG_SPECIALTIES", "LINKEDIN_ORG_LOCATIONS",
    "LINKEDIN_ORG_DESCRIPTION", "LINKEDIN_ORG_RECRUITMENT_AGENCY_DERIVED",
    "DIRECTAPPLY", "LINKEDIN_ORG_SLUG",
]

LINK_COLUMNS: list[str] = ["ID", "TITLE", "JOB_CATEGORY", "URL"]

RAW_SCHEMA = T.StructType([T.StructField(c, T.StringType(), True) for c in RAW_COLUMNS])

CLEAN_SCHEMA = T.StructType([
    T.StructField(c, T.DateType() if c == "JOB_DATE" else T.StringType(), True)
    for c in CLEAN_COLUMNS
])

SENIORITY_DICT_SCHEMA = T.StructType([
    T.StructField("SENIORITY", T.StringType(), True),
    T.StructField("SENIORITY_STANDARDIZED", T.StringType(), True),
])

# Landed JSON posting (lower-case names, nested location list), for S-1 / S-3.
ADDRESS = T.StructType([
    T.StructField("addressLocality", T.StringType(), True),
    T.StructField("addressRegion", T.StringType(), True),
    T.StructField("streetAddress", T.StringType(), True),
])
PLACE = T.StructType([
    T.StructField("@type", T.StringType(), True),
    T.StructField("address", ADDRESS, True),
])
LANDED_JSON_SCHEMA = T.StructType(
    [T.StructField(c.lower(), T.StringType(), True) for c in RAW_COLUMNS
     if c not in ("JOB_CATEGORY", "LOCATIONS_RAW", "EMPLOYMENT_TYPE")]
    + [
        T.StructField("locations_raw", T.ArrayType(PLACE), True),
        T.StructField("employment_type", T.ArrayType(T.StringType()), True),
    ]
)
