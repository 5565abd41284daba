"""DataFrame -> DataFrame operators."""

from featurepipe.operators.cleaning import (
    cast_range, cast_ranges, changed_rows, drop_if_present, label_value, map_label, null_sentinels,
    repair_swap, strip_accents_cols,
)
from featurepipe.operators.features import (
    add_bucket, add_length, add_log, add_word_count, default_flags, flag_differs, flag_matches,
    flag_threshold, gold_projection, select_features,
)
from featurepipe.operators.gates import GateError, enforce, first_failure, gate_report, run_all_gates
from featurepipe.operators.hooks import HookRegistry, default_hooks
from featurepipe.operators.ordering import before_after, dedup_first, dense_index, head, top_k, with_row_id
from featurepipe.operators.relations import (
    clean_relation, count_members, join_counts, relation_from_column_docs, relation_from_record_docs,
    relation_summary,
)
from featurepipe.operators.stats import coverage, exact_median, impute_median, label_summary, profile

__all__ = [
    "GateError", "HookRegistry", "add_bucket", "add_length", "add_log", "add_word_count", "before_after",
    "cast_range", "cast_ranges", "changed_rows", "clean_relation", "count_members", "coverage",
    "dedup_first", "default_flags", "default_hooks", "dense_index", "drop_if_present", "enforce",
    "exact_median", "first_failure", "flag_differs", "flag_matches", "flag_threshold", "gate_report", "gold_projection",
    "head", "impute_median", "join_counts", "label_summary", "label_value", "map_label",
    "null_sentinels", "profile", "relation_from_column_docs", "relation_from_record_docs",
    "relation_summary", "repair_swap", "run_all_gates", "select_features", "strip_accents_cols",
    "top_k", "with_row_id",
]
