"""Batch operators: ``op(df, ..., *, keys, time_col, durations, thresholds) -> DataFrame``."""

from rillet.operators.aggregations import group_sum_having, session_count, tumbling_count
from rillet.operators.changelog import (as_table, changelog_view, first_changes, json_record_checks, materialize,
                                        split_valid, upsert_by_other_key, validated_insert)
from rillet.operators.inference import predict, rule_risk, support_answers, transaction_prompt
from rillet.operators.joins import (interval_join, latest_per_key, lookup_join,
                                    per_key_pair_counts, regular_join, temporal_join)
from rillet.operators.over import (lag_over_tumble, latest_values, running_aggregate, running_count,
                                   running_sum_flag)
from rillet.operators.patterns import escalating, failures_then_success, min_run_reluctant
from rillet.operators.scan import Slices, next_rows, previous_value, rank_slices, running_totals

__all__ = [
    "as_table", "changelog_view", "escalating", "failures_then_success", "first_changes", "group_sum_having",
    "interval_join", "json_record_checks", "lag_over_tumble", "latest_per_key", "latest_values", 
    "lookup_join", "materialize", "min_run_reluctant", "next_rows", "per_key_pair_counts",
    "predict", "previous_value", "regular_join", "rule_risk", "running_aggregate", "running_count",
    "rank_slices", "running_sum_flag", "running_totals", "session_count", "Slices", "split_valid", "support_answers",
    "temporal_join", "transaction_prompt", "tumbling_count", "upsert_by_other_key", "validated_insert",
]
