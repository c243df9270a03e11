"""Sinks: daily Parquet, checked writes, audit table, catalog table, CSV."""

from folioflow.sinks.audit import append_audit, append_range_audit, audit_frame, read_audit
from folioflow.sinks.bucketed import bucket_sizes, create_bucketed, write_bucketed
from folioflow.sinks.catalog import add_partitions, publish_table
from folioflow.sinks.csv import read_csv, write_csv
from folioflow.sinks.daily import EmptyOutput, WriteResult, with_partition_columns, write_daily
from folioflow.sinks.gate import ChecksFailed, Measure, RowRule, check_rows, portfolio_measures, raw_measures, write_checked

__all__ = [
    "ChecksFailed",
    "EmptyOutput",
    "Measure",
    "RowRule",
    "WriteResult",
    "add_partitions",
    "append_audit",
    "append_range_audit",
    "audit_frame",
    "bucket_sizes",
    "check_rows",
    "create_bucketed",
    "portfolio_measures",
    "publish_table",
    "raw_measures",
    "read_audit",
    "read_csv",
    "with_partition_columns",
    "write_bucketed",
    "write_checked",
    "write_csv",
    "write_daily",
]
