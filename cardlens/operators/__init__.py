from cardlens.operators.aggregates import (
    composition, count_by, top_by_sum, top_by_sum_pruned, unclassified, with_share, with_top_flag,
)
from cardlens.operators.clean import clean, clean_branch, clean_credit, clean_customer
from cardlens.operators.joins import fits_broadcast, hot_keys, lookup_join, shuffle_join
from cardlens.operators.quality import (
    apply_schema, cast_violations, key_violations, length_violations, unreadable, value_violations,
    violation_counts,
)
from cardlens.operators.updates import apply_updates, unmatched_updates, update_conflicts, update_violations

__all__ = [
    "apply_schema", "apply_updates", "cast_violations", "clean", "clean_branch", "clean_credit",
    "clean_customer", "composition", "count_by", "fits_broadcast", "hot_keys", "key_violations",
    "length_violations", "lookup_join", "shuffle_join", "top_by_sum", "top_by_sum_pruned", "unclassified",
    "unmatched_updates", "unreadable", "update_conflicts", "update_violations", "value_violations",
    "violation_counts", "with_share", "with_top_flag",
]
