"""Table cleaning (P8, P9) and the raw-table projection."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioflow.functions.numbers import to_number
from folioflow.functions.text import clean_text
from folioflow.operators.flatten import add_run_metadata, flatten_results
from folioflow.schemas import NUMERIC_COLUMNS, RAW, TEXT_COLUMNS, quoted


def clean_columns(
    df: DataFrame,
    number_mode: str = "ptbr",
    numeric: tuple[str, ...] = NUMERIC_COLUMNS,
    text: tuple[str, ...] = TEXT_COLUMNS,
) -> DataFrame:
    """Parse the numeric columns and clean the text columns that exist.

    One ``withColumns`` of native expressions; absent columns are skipped.
    """
    types = dict((f.name, f.dataType) for f in df.schema.fields)
    exprs = {}
    for name in numeric:
        if name in types:
            exprs[name] = to_number(F.col(name), types[name], number_mode)
    for name in text:
        if name in types:
            exprs[name] = clean_text(F.col(name), types[name])
    return df.withColumns(exprs) if exprs else df


def unparsed_numbers(rows: DataFrame, number_mode: str = "ptbr", numeric: tuple[str, ...] = NUMERIC_COLUMNS) -> DataFrame:
    """Silent parse loss: per numeric column, rows whose text is there but parses to NULL.

    Text that is empty or ``'None'`` after trimming counts as missing, not
    as a failure.  One aggregation over the text rows, long form
    ``(column_name, unparsed)``.
    """
    types = dict((f.name, f.dataType) for f in rows.schema.fields)
    present = [c for c in numeric if c in types]
    counts = []
    for name in present:
        text = clean_text(F.col(name), types[name])
        failed = text.isNotNull() & (text != F.lit("")) & to_number(F.col(name), types[name], number_mode).isNull()
        counts.append(F.count_if(failed).alias(name))
    return rows.agg(*counts).unpivot([], present, "column_name", "unparsed")


def conform(df: DataFrame, schema=RAW, keep: tuple[str, ...] = ()) -> DataFrame:
    """Project to ``schema`` in order; missing columns become typed NULLs."""
    present = set(df.columns)
    cols = [
        (F.col(f.name).cast(f.dataType) if f.name in present else F.lit(None).cast(f.dataType)).alias(f.name)
        for f in schema.fields
    ]
    return df.select(*cols, *keep)


def to_raw(
    pages: DataFrame,
    run_timestamp: dt.datetime,
    number_mode: str = "ptbr",
    keep_index: bool = False,
    header_from_first_page: bool = True,
    extra: tuple[str, ...] = (),
) -> DataFrame:
    """Pages frame → raw rows: flatten, header, run metadata, clean, fixed schema and the keys ``extra`` as they came."""
    rows = flatten_results(pages, header_from_first_page)
    rows = add_run_metadata(rows, run_timestamp)
    rows = clean_columns(rows, number_mode)
    return conform(rows, RAW, keep=(*(("index",) if keep_index else ()), *map(quoted, extra)))
