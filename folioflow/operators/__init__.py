"""DataFrame → DataFrame operators (chain them with ``DataFrame.transform``)."""

from folioflow.operators.aggregate import (
    MissingColumns,
    asset_groups,
    finish_portfolio,
    portfolio_by_asset,
    require_columns,
)
from folioflow.operators.clean import clean_columns, conform, to_raw, unparsed_numbers
from folioflow.operators.flatten import add_run_metadata, flatten_results, run_headers
from folioflow.operators.present import ordered, top_rows
from folioflow.operators.quality import (
    CHECK_SCHEMA,
    check_columns_absent,
    check_columns_present,
    check_constant_date,
    check_duplicates,
    check_group_cardinality,
    check_negatives,
    check_not_empty,
    check_nulls,
    check_total,
    check_unparsed,
    distinct_count,
    distinct_values,
    dtypes_report,
    duplicate_count,
    negative_count,
    negative_rows,
    null_counts,
    quality_report,
    row_count,
    summary_stats,
    transformed_quality,
)
from folioflow.operators.reconcile import check_reconcile, reconcile, reconcile_with

__all__ = [
    "CHECK_SCHEMA",
    "MissingColumns",
    "add_run_metadata",
    "asset_groups",
    "check_columns_absent",
    "check_columns_present",
    "check_constant_date",
    "check_duplicates",
    "check_group_cardinality",
    "check_negatives",
    "check_not_empty",
    "check_nulls",
    "check_reconcile",
    "check_total",
    "check_unparsed",
    "clean_columns",
    "conform",
    "distinct_count",
    "distinct_values",
    "dtypes_report",
    "duplicate_count",
    "finish_portfolio",
    "flatten_results",
    "negative_count",
    "negative_rows",
    "null_counts",
    "ordered",
    "portfolio_by_asset",
    "quality_report",
    "reconcile",
    "reconcile_with",
    "require_columns",
    "row_count",
    "run_headers",
    "summary_stats",
    "transformed_quality",
    "to_raw",
    "top_rows",
    "unparsed_numbers",
]
