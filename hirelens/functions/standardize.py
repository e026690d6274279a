"""Rule tables of ``hirelens.rules`` as column expressions (P-9 ... P-12).

Each rule table becomes one CASE chain or literal map, evaluated row by row
inside generated code; nothing is joined or broadcast.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from hirelens import rules
from hirelens.functions.text import _c, strip


def _chain(pairs: list[tuple[Column, str]], otherwise: Column) -> Column:
    expr = None
    for cond, value in pairs:
        expr = F.when(cond, F.lit(value)) if expr is None else expr.when(cond, F.lit(value))
    return otherwise if expr is None else expr.otherwise(otherwise)


def city_standardized(col: Column | str = "CITY") -> Column:
    """Ordered city rules on lower(CITY), first match wins, else CITY (P-9)."""
    c = _c(col)
    lc = F.lower(c)
    pairs = [
        ((lc == text) if kind == "equals" else lc.contains(text), out)
        for kind, text, out in rules.CITY_RULES
    ]
    return _chain(pairs, c)


def state_standardized(state: Column | str = "STATE",
                       city_std: Column | str = "CITY_STANDARDIZED") -> Column:
    """Placeholder state + known standardized city -> state code; remaining
    'na' -> 'UNKNOWN'; else STATE (P-10)."""
    s, cs = _c(state), _c(city_std)
    ls = F.lower(s)
    placeholder = ls.isin(rules.STATE_PLACEHOLDERS)
    pairs = [(placeholder & (cs == city), code) for city, code in rules.STATE_BY_CITY]
    pairs.append((ls == rules.STATE_NA_TOKEN, rules.STATE_UNKNOWN))
    return _chain(pairs, s)


def _label_map() -> Column:
    return F.create_map(*[F.lit(x) for kv in rules.SENIORITY_LABELS for x in kv])


def seniority_label(col: Column | str) -> Column:
    """Strip, lower, delete spaces, look up the label map, default
    'Not Applicable' (P-11)."""
    key = F.regexp_replace(F.lower(strip(_c(col))), " ", "")
    return F.coalesce(F.try_element_at(_label_map(), key), F.lit(rules.SENIORITY_DEFAULT))


def seniority_category(col: Column | str) -> Column:
    """Deterministic seniority classification of a raw level (P-12).

    Rules, in order: null or empty -> Not Applicable; read lower-case with
    '_' as ' '; substring rules; whole-value examples; a value that already
    names a category; years of experience (0-2, 3-5, 6+); else
    Not Applicable.
    """
    c = _c(col)
    norm = F.lower(F.regexp_replace(c, "_", " "))
    has_years = norm.rlike(rules.YEARS_PATTERN)
    # 38 digits hold any number of years that a text can mean
    years = F.when(has_years, F.regexp_extract(norm, rules.YEARS_PATTERN, 1).try_cast("decimal(38,0)"))
    pairs: list[tuple[Column, str]] = [(c.isNull() | (c == ""), rules.SENIORITY_DEFAULT)]
    pairs += [(norm.contains(t), label) for t, label in rules.SENIORITY_CONTAINS_RULES]
    pairs += [(norm == t, label) for t, label in rules.SENIORITY_EXAMPLES]
    pairs += [(norm == cat.lower(), cat) for cat in rules.SENIORITY_CATEGORIES]
    pairs += [((years >= lo) if hi is None else years.between(lo, hi), label)
              for lo, hi, label in rules.SENIORITY_YEAR_BANDS]
    return _chain(pairs, F.lit(rules.SENIORITY_DEFAULT))
