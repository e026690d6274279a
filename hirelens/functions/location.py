"""City and state from the text form of a location list (F-4, F-5).

The text form is what a Python list of dicts looks like when written as a
string, e.g. ``[{'@type': 'Place', 'address': {'addressLocality': 'Perth',
'addressRegion': 'WA', 'streetAddress': None}}]``. Both captures are greedy,
so with several places they run to the last region marker; this is the
defined behaviour.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from hirelens import rules
from hirelens.functions.text import _c, strip

# Python semantics for the Java regex: Unicode \s, and '.' stops only at \n.
PY_FLAGS = "(?Ud)"


def city_from_locations(col: Column | str) -> Column:
    """Greedy locality capture; no match -> null; Sydney spellings fixed."""
    c = _c(col)
    pattern = PY_FLAGS + rules.CITY_TEXT_PATTERN
    city = F.when(c.rlike(pattern), F.regexp_extract(c, pattern, 1))
    lc = F.lower(city)
    is_sydney = None
    for s in rules.SYDNEY_SPELLINGS:
        term = lc.contains(s)
        is_sydney = term if is_sydney is None else (is_sydney | term)
    return F.when(is_sydney, F.lit(rules.SYDNEY)).otherwise(city)


def state_from_locations(col: Column | str) -> Column:
    """Greedy region capture, quotes removed, stripped; no match -> null."""
    c = _c(col)
    pattern = PY_FLAGS + rules.STATE_TEXT_PATTERN
    raw = F.regexp_extract(c, pattern, 1)
    return F.when(c.rlike(pattern), strip(F.regexp_replace(raw, "'", "")))
