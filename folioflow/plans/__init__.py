"""Jobs (extract, transform, backfill, publish) and the registered queries."""

from folioflow.plans.jobs import (
    ExtractReport,
    audit_rows,
    backfill_changed,
    backfill_transform,
    changed_days,
    extract_frame,
    extract_job,
    extract_pages,
    publish,
    read_transformed_day,
    run_all,
    transform_frame,
    transform_job,
    with_every_key,
    write_followups,
    write_manifest,
)

__all__ = [
    "ExtractReport",
    "audit_rows",
    "backfill_changed",
    "backfill_transform",
    "changed_days",
    "extract_frame",
    "extract_job",
    "extract_pages",
    "publish",
    "read_transformed_day",
    "run_all",
    "transform_frame",
    "transform_job",
    "with_every_key",
    "write_followups",
    "write_manifest",
]
