"""Date functions (F-24 ... F-27)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from hirelens.functions.text import _c


def date_from_text(col: Column | str) -> Column:
    """Calendar date of a timestamp text as written (F-24), so no
    session-time-zone shift: ISO forms, month/day/year, a bare yyyymmdd, and
    month names, each with an optional time; other text -> null."""
    c = F.trim(_c(col))
    time = r"(?:[T ,]+[0-9].*)?$"
    iso = F.when(c.rlike(r"^\d{4}-\d{2}-\d{2}" + time), F.substring(c, 1, 10).try_cast("date"))

    def other(pattern: str, form: str) -> Column:
        found = F.regexp_extract(c, f"^({pattern}){time}", 1)
        return F.when(found != "", F.try_to_timestamp(found, F.lit(form)).cast("date"))
    return F.coalesce(
        iso, other(r"\d{4}/\d{1,2}/\d{1,2}", "yyyy/M/d"), other(r"\d{1,2}/\d{1,2}/\d{4}", "M/d/yyyy"),
        other(r"\d{8}", "yyyyMMdd"), other(r"\d{1,2} [A-Z][a-z]{2} \d{4}", "d MMM yyyy"),
        other(r"[A-Z][a-z]{2} \d{1,2}, \d{4}", "MMM d, yyyy"))


def week_start(col: Column | str) -> Column:
    """Monday of the week, as a DATE (F-27)."""
    return F.trunc(_c(col), "week")


def month_of(col: Column | str) -> Column:
    return F.month(_c(col)).cast("bigint")


def year_of(col: Column | str) -> Column:
    return F.year(_c(col)).cast("bigint")
