"""Sources: landed response pages, request manifest, daily Parquet trees."""

from folioflow.sources.daily import PartitionNotFound, read_day, read_days, read_tree
from folioflow.sources.footers import day_files, footer_counts, footer_null_counts
from folioflow.sources.legacy import migrate_legacy_raw, read_legacy_tree, row_based_session
from folioflow.sources.manifest import followup_requests, request_manifest
from folioflow.sources.tables import read_table
from folioflow.sources.pages import (
    consolidated_counts,
    first_pages,
    missing_first_pages,
    missing_pages,
    normalise_pages,
    parse_pages,
    read_pages,
    repeated_pages,
    select_pages,
    single_copies,
    unnumbered_pages,
    usable,
)
from folioflow.sources.records import extra_keys, parse_records, read_records, unknown_keys

__all__ = [
    "PartitionNotFound",
    "consolidated_counts",
    "extra_keys",
    "day_files",
    "first_pages",
    "footer_counts",
    "footer_null_counts",
    "followup_requests",
    "missing_first_pages",
    "migrate_legacy_raw",
    "missing_pages",
    "normalise_pages",
    "parse_pages",
    "parse_records",
    "read_day",
    "read_legacy_tree",
    "read_days",
    "read_pages",
    "read_records",
    "repeated_pages",
    "read_table",
    "read_tree",
    "request_manifest",
    "row_based_session",
    "select_pages",
    "single_copies",
    "unknown_keys",
    "unnumbered_pages",
    "usable",
]
