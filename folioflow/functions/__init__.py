"""Scalar Column functions (all JVM-side, no Python UDFs)."""

from folioflow.functions.dates import (
    as_date,
    compact_date_text,
    date_literal,
    iso_date_text,
    partition_columns,
    partition_date,
    partition_predicate,
    partition_range_predicate,
    partition_values,
    timestamp_literal,
)
from folioflow.functions.numbers import (
    add_sums,
    group_thousands,
    parse_number,
    parse_number_compat,
    parse_number_enus,
    parse_number_ptbr,
    strip_non_numeric,
    sum_double,
    sum_long,
    sums,
    to_number,
)
from folioflow.functions.requests import base64_text, request_json, request_token, request_url
from folioflow.functions.text import WHITESPACE, clean_text, strip_text

__all__ = [
    "WHITESPACE",
    "add_sums",
    "as_date",
    "base64_text",
    "clean_text",
    "compact_date_text",
    "date_literal",
    "group_thousands",
    "iso_date_text",
    "parse_number",
    "parse_number_compat",
    "parse_number_enus",
    "parse_number_ptbr",
    "partition_columns",
    "partition_date",
    "partition_predicate",
    "partition_range_predicate",
    "partition_values",
    "request_json",
    "request_token",
    "request_url",
    "strip_non_numeric",
    "strip_text",
    "sum_double",
    "sum_long",
    "sums",
    "timestamp_literal",
    "to_number",
]
