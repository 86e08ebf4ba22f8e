from .asof import as_of_join
from .dedup import dedup_latest
from .extract import pending_counts, undated, window_filter
from .frequency import mode_by, top_per_group
from .history import current_versions, history_from_changes, scd2_step
from .joins import integrity_quarantine, integrity_tagged, integrity_valid, lookup_join, new_keys
from .merge import above_mark, keyed_update, merge_upsert
from .profile import (
    column_summary, duplicate_count, null_counts, peek, row_counts, value_counts,
)

__all__ = [
    "as_of_join", "above_mark", "column_summary", "current_versions", "dedup_latest", "duplicate_count",
    "history_from_changes", "integrity_quarantine", "integrity_tagged", "integrity_valid", "keyed_update",
    "lookup_join", "merge_upsert", "mode_by", "new_keys", "null_counts", "peek",
    "pending_counts", "row_counts", "scd2_step", "top_per_group", "value_counts",
    "undated", "window_filter",
]
