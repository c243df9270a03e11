"""Fixed schemas of the feed: landed response pages, raw rows, portfolio rows.

Declared once so no job ever infers a schema from data (inference costs a
full extra pass over the input and drifts from day to day).
"""

from __future__ import annotations

from pyspark.sql.types import (
    ArrayType,
    DateType,
    DecimalType,
    DoubleType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
    VariantType,
)

# Exact arithmetic type of sums.  Sums over a decimal are independent of row
# order, so a re-run (or a retried task) gives bit-identical totals; numbers
# that it cannot hold exactly are summed beside it (functions/numbers.py).
NUMBER = DecimalType(36, 18)

CORRUPT_COLUMN = "_corrupt_record"

# One record of the ``results`` list, as text: the feed writes numbers in
# pt-BR notation ("0,490", "476.976.044").  A body may also hold them as JSON
# numbers; those are read with their token type (LANDED_RESULT) and become
# text that every number grammar reads alike (operators/flatten.py).
RESULT = StructType(
    [
        StructField("segment", StringType()),
        StructField("cod", StringType()),
        StructField("asset", StringType()),
        StructField("type", StringType()),
        StructField("part", StringType()),
        StructField("partAcum", StringType()),
        StructField("theoricalQty", StringType()),
    ]
)

LANDED_RESULT = StructType(
    [StructField(f.name, VariantType()) if f.name in ("part", "theoricalQty") else f for f in RESULT.fields]
)

PAGE_INFO = StructType(
    [
        StructField("pageNumber", LongType()),
        StructField("pageSize", LongType()),
        StructField("totalPages", LongType()),
        StructField("totalRecords", LongType()),
    ]
)

HEADER = StructType(
    [
        StructField("date", StringType()),
        StructField("theoricalQty", StringType()),
        StructField("reductor", StringType()),
    ]
)

# One landed response body.
PAGE = StructType(
    [
        StructField("page", PAGE_INFO),
        StructField("header", HEADER),
        StructField("results", ArrayType(RESULT)),
    ]
)

LANDED_PAGE = StructType(
    [
        StructField("page", PAGE_INFO),
        StructField("header", HEADER),
        StructField("results", ArrayType(LANDED_RESULT)),
        StructField(CORRUPT_COLUMN, StringType()),
    ]
)

def landed_page(extra: tuple[str, ...] = ()) -> StructType:
    """:data:`LANDED_PAGE` whose records also hold the keys ``extra``, of any type."""
    result = StructType(LANDED_RESULT.fields + [StructField(k, VariantType()) for k in extra])
    return StructType([StructField("results", ArrayType(result)) if f.name == "results" else f for f in LANDED_PAGE.fields])


# Raw table: one row per ticker code.
RAW = StructType(
    [
        StructField("segment", StringType()),
        StructField("cod", StringType()),
        StructField("asset", StringType()),
        StructField("type", StringType()),
        StructField("part", DoubleType()),
        StructField("partAcum", StringType()),
        StructField("theoricalQty", DoubleType()),
        StructField("extraction_date", DateType()),
        StructField("extraction_timestamp", TimestampNTZType()),
        StructField("data_date", StringType()),
        StructField("total_theoretical_qty", StringType()),
        StructField("reductor", StringType()),
    ]
)

# Hive-style daily partition columns; strings keep the zero padding.
PARTITION_COLUMNS = ("year", "month", "day")
PARTITIONS = StructType([StructField(c, StringType()) for c in PARTITION_COLUMNS])

# Transformed table: one row per asset.
PORTFOLIO = StructType(
    [
        StructField("acao", StringType()),
        StructField("qtd_codigo", LongType()),
        StructField("participacao", DoubleType()),
        StructField("qtd_teorica_total", LongType()),
        StructField("data", StringType()),
    ]
)

# Columns the transform needs, and those the raw rows carry but the
# portfolio table must not.
REQUIRED_COLUMNS = ("asset", "cod", "part", "theoricalQty")
DROPPED_COLUMNS = ("segment", "type", "partAcum")
NUMERIC_COLUMNS = ("part", "theoricalQty")
TEXT_COLUMNS = ("cod", "asset", "type", "segment")

# Audit rows appended after each write.
AUDIT = StructType(
    [
        StructField("source", StringType()),
        StructField("target", StringType()),
        StructField("partition_date", DateType()),
        StructField("run_timestamp", TimestampNTZType()),
        StructField("record_count", LongType()),
        StructField("schema_version", StringType()),
    ]
)


def with_index(schema: StructType) -> StructType:
    """``index`` as a leading data column."""
    return StructType([StructField("index", StringType())] + list(schema.fields))


def with_partitions(schema: StructType, leading: tuple[str, ...] = ()) -> StructType:
    """``schema`` plus the partition columns (and optional leading ones such as ``index``)."""
    extra = [StructField(c, StringType()) for c in leading] + list(PARTITIONS.fields)
    return StructType(list(schema.fields) + extra)


def with_extra(schema: StructType, extra: tuple[str, ...]) -> StructType:
    """``schema`` and the extra keys of the records, as text."""
    return StructType(schema.fields + [StructField(k, StringType()) for k in extra])


def quoted(name: str) -> str:
    """A column name for expressions, whatever signs it has."""
    return "`" + name.replace("`", "``") + "`"
