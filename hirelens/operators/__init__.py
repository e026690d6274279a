"""Relational operators composed from DataFrame primitives."""

from hirelens.operators.aggregates import (
    count_distinct_by, ordered_distinct, row_counts, sum_by,
)
from hirelens.operators.dedupe import collapse_max, digest, distinct_rows, first_per_key
from hirelens.operators.joins import (
    anti_join_new, broadcast_if_small, dictionary_lookup, measured_size, measured_sizes,
)
from hirelens.operators.topk import preview, recent_capped, top_k_per_group
from hirelens.operators.windows import lag_trend

__all__ = [
    "anti_join_new", "broadcast_if_small", "collapse_max", "count_distinct_by",
    "dictionary_lookup", "digest", "distinct_rows", "first_per_key", "lag_trend",
    "measured_size", "measured_sizes", "ordered_distinct", "preview",
    "recent_capped", "row_counts", "sum_by", "top_k_per_group",
]
