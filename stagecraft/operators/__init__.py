"""DataFrame operators over the manifest: routing, duplicates, planning,
claiming, state transitions, monitoring and sizing."""

from .batches import (batch_file_lists, claim_next, eligible_files, manifest_preview, plan_batches,
                      routable_files, unplannable_files, valid_templates)
from .manifest import build_manifest, duplicate_files, duplicate_summary, listing_from_stage, route_files
from .monitor import (active_by_owner, attempted_files, error_files, load_log, load_stats, loading_files,
                      percent_complete, progress, progress_eta, stuck_files, target_counts, target_counts_text)
from .ranking import number_within
from .sizing import recommend_batch, size_profile
from .transitions import mark_complete, requeue_failed, reset_stuck, resume, suspend

__all__ = [
    "batch_file_lists", "claim_next", "eligible_files", "manifest_preview", "plan_batches", "routable_files",
    "unplannable_files", "valid_templates", "build_manifest", "duplicate_files", "duplicate_summary",
    "listing_from_stage", "route_files", "active_by_owner", "attempted_files", "error_files", "load_log",
    "load_stats", "loading_files", "percent_complete", "progress", "progress_eta", "stuck_files",
    "target_counts", "target_counts_text", "number_within", "recommend_batch", "size_profile",
    "mark_complete", "requeue_failed", "reset_stuck", "resume", "suspend",
]
