"""String column functions (F-rows of the survey). All return native Column
expressions, so they stay inside whole-stage codegen."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from hirelens import rules

# Unicode whitespace as Python's str.strip() sees it: Java's (?U)\s plus the
# four information separators \x1c-\x1f.
_WS = r"[\s\x1c-\x1f]"
_STRIP_PATTERN = rf"(?U)^{_WS}+|{_WS}+$"


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def strip(col: Column | str) -> Column:
    """Remove leading and trailing Unicode whitespace (F-9); plain ``trim``
    only removes the ASCII space."""
    return F.regexp_replace(_c(col), _STRIP_PATTERN, "")


def text_or_token(col: Column | str, token: str = rules.NAN_TOKEN) -> Column:
    """Cast to string, writing a missing value as ``token`` (F-10)."""
    return F.coalesce(_c(col).cast("string"), F.lit(token))


def employment_type_text(col: Column | str, token: str = rules.NAN_TOKEN) -> Column:
    """``['FULL_TIME', 'PART_TIME']`` -> ``FULL_TIME, PART_TIME``; null -> token (F-11).

    Works on the text form of a list. For a real ``array<string>`` use
    :func:`employment_type_from_array`.
    """
    return strip(F.regexp_replace(text_or_token(col, token), r"[\[\]']", ""))


def employment_type_from_array(col: Column | str, token: str = rules.NAN_TOKEN) -> Column:
    """Same result as :func:`employment_type_text` for an ``array<string>``."""
    c = _c(col)
    return F.when(c.isNull(), F.lit(token)).otherwise(
        strip(F.regexp_replace(F.array_join(c, ", ", rules.NONE_TOKEN), r"[\[\]']", "")))


def org_size_text(col: Column | str, token: str = rules.NAN_TOKEN) -> Column:
    """``51-200 employees`` -> ``51-200``; null -> token (F-12). The word is
    removed case-sensitively wherever it occurs."""
    return strip(F.regexp_replace(text_or_token(col, token), "employees", ""))


def title_pattern(titles: list[str] | None = None) -> str:
    """Case-insensitive whole-word alternation with Unicode word boundaries."""
    titles = titles or rules.TARGET_TITLES
    return "(?iU)" + "|".join(rf"\b{re.escape(t)}\b" for t in titles)


def title_matches(col: Column | str, titles: list[str] | None = None) -> Column:
    """Whole-word, case-insensitive match of any title (P-6); null -> null,
    so a filter drops it."""
    return _c(col).rlike(title_pattern(titles))


def title_contains(col: Column | str, titles: list[str] | None = None) -> Column:
    """``lower(TITLE) LIKE '%data engineer%' OR ...`` (P-7), wider than P-6."""
    titles = titles or rules.TARGET_TITLES
    lc = F.lower(_c(col))
    cond = None
    for t in titles:
        term = lc.contains(t.lower())
        cond = term if cond is None else (cond | term)
    return cond


def missing_as_na(col: Column | str, tokens: list[str] | None = None) -> Column:
    """Null or empty -> 'NA' (F-18). With ``tokens`` (for example
    ``['nan', 'na']``) a value whose stripped lower-case text is a token is
    also written 'NA'; otherwise the value is kept."""
    c = _c(col)
    cond = c.isNull() | (c == "")
    if tokens:
        cond = cond | F.lower(strip(c)).isin(tokens)
    return F.when(cond, F.lit(rules.NA_TOKEN)).otherwise(c)


def json_path(col: Column | str, path: str) -> Column:
    """JSON path navigation (F-16); malformed JSON or a missing path -> null."""
    return F.get_json_object(_c(col), path)


def json_path_or(col: Column | str, path: str, default: str) -> Column:
    """F-16 with a default for invalid JSON or a missing member (F-17)."""
    return F.coalesce(json_path(col, path), F.lit(default))


def url_encoded(col: Column | str) -> Column:
    """Percent encoding of a filter value in a URL (F-15): letters, digits and
    ``_.-~/`` stay, every other UTF-8 byte becomes ``%XX`` (a space ``%20``).

    Spark's encoder is the one for forms, which differs in five characters."""
    c = F.url_encode(_c(col))
    for form, plain in (("+", "%20"), ("*", "%2A"), ("%7E", "~"), ("%2F", "/")):
        c = F.replace(c, F.lit(form), F.lit(plain))
    return c
