"""Column → Column functions: every scalar transformation of the pipeline is
a native Spark expression."""

from hirelens.functions.dates import date_from_text, month_of, week_start, year_of
from hirelens.functions.location import (
    city_from_locations, state_from_locations,
)
from hirelens.functions.standardize import (
    city_standardized, seniority_category, seniority_label, state_standardized,
)
from hirelens.functions.text import (
    employment_type_from_array, employment_type_text, json_path, json_path_or,
    missing_as_na, org_size_text, strip, text_or_token, title_contains,
    title_matches, title_pattern, url_encoded,
)

__all__ = [
    "city_from_locations", "city_standardized",
    "date_from_text", "employment_type_from_array", "employment_type_text",
    "json_path", "json_path_or", "missing_as_na", "month_of", "org_size_text",
    "seniority_category", "seniority_label", "state_from_locations",
    "state_standardized", "strip", "text_or_token", "title_contains",
    "title_matches", "title_pattern", "url_encoded", "week_start", "year_of",
]
