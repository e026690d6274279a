"""Rule tables and literal values.

FIXED VALUES: everything in this module must equal the source project's
values for identical results. They are stated plainly, in the source's
order; ``hirelens.functions.standardize`` turns them into column
expressions (CASE chains and literal maps), so no rule table is ever
joined or shuffled.
"""

from __future__ import annotations

# --- fixed values: city standardization ------------------------------------
# Evaluated in order on lower(CITY); the first rule that matches wins; when
# none matches the original CITY is kept (a null CITY stays null).
# ("equals", text) compares the whole lower-cased value,
# ("contains", text) is LIKE '%text%'.
CITY_RULES: list[tuple[str, str, str]] = [
    ("equals", "new south wales", "Sydney"),
    ("equals", "capital australia", "Canberra"),
    ("equals", "barzbin", "Brisbane"),
    ("equals", "queensland", "Brisbane"),
    ("equals", "south australia", "Adelaide"),
    ("equals", "australian capital territory", "Canberra"),
    ("equals", "victoria", "Melbourne"),
    ("equals", "northern territory", "Darwin"),
    ("equals", "west australia", "Perth"),
    ("contains", "tasmania", "Hobart"),
    ("equals", "no regrets", "Unknown"),
    ("equals", "other side of the moon", "Unknown"),
    ("contains", "sydney", "Sydney"),
    ("contains", "melbourne", "Melbourne"),
    ("contains", "brisbane", "Brisbane"),
    ("contains", "canberra", "Canberra"),
    ("contains", "perth", "Perth"),
    ("contains", "adelaide", "Adelaide"),
    ("contains", "darwin", "Darwin"),
    ("contains", "hobart", "Hobart"),
]

# --- fixed values: state standardization -----------------------------------
# A state whose lower-case form is one of these placeholders is replaced by
# the state of its standardized city (exact, case-sensitive city match, in
# this order); a remaining 'na' becomes 'UNKNOWN'; anything else is kept.
STATE_PLACEHOLDERS: list[str] = ["of", "on", "australia", "na"]
STATE_BY_CITY: list[tuple[str, str]] = [
    ("Perth", "WA"),
    ("Brisbane", "QLD"),
    ("Sydney", "NSW"),
    ("Melbourne", "VIC"),
    ("Canberra", "ACT"),
    ("Adelaide", "SA"),
    ("Hobart", "TAS"),
    ("Darwin", "NT"),
    ("Woden", "ACT"),
]
STATE_NA_TOKEN = "na"
STATE_UNKNOWN = "UNKNOWN"

# --- fixed values: seniority label map --------------------------------------
# Keys are compared after strip, lower-case and removal of spaces, so the key
# 'entry level' can never match; it is kept because the source has it.
SENIORITY_LABELS: list[tuple[str, str]] = [
    ("noexperience", "No Experience"),
    ("entrylevel", "Entry Level"),
    ("entry level", "Entry Level"),
    ("intermediate", "Intermediate"),
    ("seniorlevel", "Senior"),
    ("senior", "Senior"),
    ("manager", "Manager/Executive"),
    ("executive", "Manager/Executive"),
    ("manager/executive", "Manager/Executive"),
]
SENIORITY_DEFAULT = "Not Applicable"

# --- fixed values: seniority categories and classification rules ------------
SENIORITY_CATEGORIES: list[str] = [
    "No Experience", "Entry Level", "Intermediate", "Senior",
    "Manager/Executive", "Not Applicable",
]
# substring rules, checked first, on lower(text) with '_' read as ' '
SENIORITY_CONTAINS_RULES: list[tuple[str, str]] = [
    ("minimum experience", "Entry Level"),
    ("association", "Entry Level"),
    ("associate", "Entry Level"),
]
# whole-value examples
SENIORITY_EXAMPLES: list[tuple[str, str]] = [
    ("medium-high level", "Intermediate"),
    ("executive", "Manager/Executive"),
    ("mid-senior level", "Intermediate"),
    ("entry level", "Entry Level"),
    ("minimum experience", "Entry Level"),
    ("association level", "Entry Level"),
    ("associate", "Entry Level"),
    ("first job", "Entry Level"),
]
# years of experience: 0-2 Entry Level, 3-5 Intermediate, 6+ Senior
SENIORITY_YEAR_BANDS: list[tuple[int, int | None, str]] = [
    (0, 2, "Entry Level"),
    (3, 5, "Intermediate"),
    (6, None, "Senior"),
]
YEARS_PATTERN = r"(\d+)\s*(?:-\s*\d+\s*)?\+?\s*years?"

# --- fixed values: posting titles and location text --------------------------
TARGET_TITLES: list[str] = ["Data Engineer", "Data Scientist", "Data Analyst"]
SYDNEY_SPELLINGS: list[str] = ["sidney", "sídney", "悉尼"]
SYDNEY = "Sydney"
CITY_TEXT_PATTERN = r"'addressLocality':\s*'(.*)',\s'addressRegion':"
STATE_TEXT_PATTERN = r"'addressRegion':\s*(.*)',\s'streetAddress'"

# --- fixed values: null tokens -------------------------------------------------
NAN_TOKEN = "nan"           # text of a missing value after a string cast
NONE_TOKEN = "None"         # text of a None object after a string cast
NA_TOKEN = "NA"             # written for untranslatable values
TRANSLATE_SKIP_TOKENS: list[str] = ["nan", "na"]
CSV_NULL_TOKENS: list[str] = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
]

# --- fixed values: feed parameters -----------------------------------------------
FEED_LIMIT = 100            # rows per title per fetch, no paging
FEED_WINDOW_HOURS = 24      # look-back window (a 7-day variant is kept as an option)
TOP_SKILLS = 5

# --- skills lexicon (ours; the source asks a hosted model instead) ----------------
TECHNICAL_SKILLS: list[str] = [
    "sql", "python", "r", "scala", "java", "spark", "hadoop", "kafka", "airflow",
    "aws", "azure", "gcp", "docker", "kubernetes", "linux",
    "git", "excel", "tableau", "power bi", "statistics", "machine learning",
    "deep learning", "etl", "data modeling", "data warehousing", "pandas",
    "numpy", "tensorflow", "pytorch", "apache", "api", "json", "html",
]
SOFT_SKILLS: list[str] = [
    "communication", "teamwork", "collaboration", "leadership",
    "problem solving", "critical thinking", "attention to detail",
    "time management", "adaptability", "creativity", "curiosity",
    "stakeholder management", "presentation", "storytelling", "mentoring",
]
