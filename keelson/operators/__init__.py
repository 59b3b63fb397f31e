"""keelson.operators: joins, keyed selection, ordering, versions, layout, quality, skew."""

from keelson.operators.joins import checked_broadcast, fits_broadcast, hot_keys, join_dim, orphans, salted_join
from keelson.operators.keyed import assert_unique, dedup_first, duplicate_keys, latest_by_key
from keelson.operators.layout import compact, write_sorted, zorder
from keelson.operators.ordered import batch_slice, row_ids, running_sum, sequential_id, top_groups
from keelson.operators.quality import dq_census, gate, reconcile, run_checks
from keelson.operators.skew import partition_profile, skew_profile
from keelson.operators.versions import (as_of, history, overwrite, restore, rows_by_version, snapshot_diff, upsert,
                                        upsert_metrics, upsert_partitions)

__all__ = [
    "checked_broadcast", "fits_broadcast", "hot_keys", "join_dim", "orphans", "salted_join",
    "assert_unique", "dedup_first", "duplicate_keys", "latest_by_key",
    "compact", "write_sorted", "zorder",
    "batch_slice", "row_ids", "running_sum", "sequential_id", "top_groups",
    "dq_census", "gate", "reconcile", "run_checks", "partition_profile", "skew_profile",
    "as_of", "history", "overwrite", "restore", "rows_by_version", "snapshot_diff", "upsert", "upsert_metrics",
    "upsert_partitions",
]
