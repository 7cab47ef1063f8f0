# The per-key scan itself stays in ``tidemark.operators.scan`` (a function of
# that name here would shadow the module).
from tidemark.operators.history import (OverlappingVersionsError, lookup_version, merge_timelines,
                                        overlapping_versions, replay_snapshots, require_disjoint, snapshot_check,
                                        snapshot_step)
from tidemark.operators.incremental import (after_high_water, append_new, high_water, merge_by_key,
                                            replace_by_key)
from tidemark.operators.latest import (eligible, latest_by_key, next_ids, number_within_key,
                                       overlay_latest, state_as_of)
from tidemark.operators.load import (DuplicateKeyError, append_rows, duplicate_keys, insert_absent,
                                     inspect_batch, new_rows, require_unique, stamp_load, upsert_latest)
from tidemark.operators.quality import (Check, QualityError, enforce, failing_rows, run_checks,
                                        run_checks_one_by_one)
from tidemark.operators.scan import Segments, fill_last, plan_segments, salt_readers
from tidemark.operators.sizing import fits, lookup_join

__all__ = [
    "Check", "DuplicateKeyError", "OverlappingVersionsError", "QualityError", "Segments", "after_high_water",
    "append_new", "append_rows", "duplicate_keys", "eligible", "enforce", "failing_rows", "fill_last", "fits",
    "high_water", "insert_absent", "inspect_batch", "latest_by_key", "lookup_join", "lookup_version",
    "merge_by_key", "merge_timelines", "new_rows", "next_ids", "number_within_key", "overlapping_versions",
    "overlay_latest", "plan_segments", "replace_by_key", "replay_snapshots", "require_disjoint",
    "require_unique", "run_checks", "run_checks_one_by_one", "salt_readers", "snapshot_check",
    "snapshot_step", "stamp_load", "state_as_of", "upsert_latest",
]
