"""Generic operators: DataFrames and column names in, a DataFrame out. None of them runs an action."""

from .compose import group_composition, groups_per_partition, minority_labels, origin_composition
from .features import feature_matrix, first_per_key, last_per_key, repeat_flags, with_bounds
from .pairing import pair_rows, row_changes
from .pairs import pairwise_alignment
from .quality import classification_report, coverage, duplicates_of_key, foreign_key_violations, profile, rule_parts, run_rules, schema_differences, source_changes, value_changes, value_counts
from .repair import conform, content_hash, create_missing_parents, dedupe_keep_first, explode_multi_value, explode_targets, flag_duplicates, left_lookup, lenient, most_similar, null_invalid, repair_reference, resolve_ids, unpivot_flags, upsert, upsert_counts, upsert_keys
from .report import correlation_matrix, dataset_coverage, dataset_report, issue_lines
from .star import Dimension, Lookup, dimension_rows, fact_rows, flag_bridge, keep_dimension, with_late_members

__all__ = [name for name in dir() if not name.startswith("_")]
