"""Operators on DataFrames, each one a composition of built-in Spark operators."""

from .aggregates import (
    any_flag,
    count_where,
    distinct_slots,
    flag_any,
    mean,
    merge_spellings,
    row_count,
    share_of_total,
)
from .joins import exclude_reversed, exists_other, fallback_attribute, left_join, not_in, semi_join
from .setops import precedence_union
from .windows import duplicate_rank, first_of_identity, first_per_key, has_duplicate, latest_per_key, rank_within

__all__ = [
    "any_flag",
    "count_where",
    "distinct_slots",
    "duplicate_rank",
    "exclude_reversed",
    "exists_other",
    "fallback_attribute",
    "first_of_identity",
    "first_per_key",
    "flag_any",
    "has_duplicate",
    "latest_per_key",
    "left_join",
    "mean",
    "merge_spellings",
    "not_in",
    "precedence_union",
    "rank_within",
    "row_count",
    "semi_join",
    "share_of_total",
]
