"""Records with whatever keys they carry.

The fixed schema reads the keys it knows.  A key that the API adds would be
dropped unseen, so records can also be read as VARIANT: :func:`unknown_keys`
reports every key outside the schema, and a run may keep such keys as text
columns of the raw table (``JobOptions.extra_columns``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructField, StructType, VariantType

from folioflow.schemas import CORRUPT_COLUMN, PAGE_INFO, PARTITION_COLUMNS, RAW, RESULT
from folioflow.sources.pages import JSON_OPTIONS, page_number

RECORDS_PAGE = StructType(
    [
        StructField("page", PAGE_INFO),
        StructField("results", ArrayType(VariantType())),
        StructField(CORRUPT_COLUMN, StringType()),
    ]
)

# A feed adds a key now and then; more than this many are values used as keys.
MAX_EXTRA_KEYS = 500


def read_records(spark: SparkSession, path: str | list[str], *, multi_line: bool = True, index: str | None = None) -> DataFrame:
    """Landed bodies → (``index``, ``page_number``, ``record`` VARIANT), one row per record; see :func:`~folioflow.sources.pages.read_pages`."""
    schema = StructType(RECORDS_PAGE.fields + [StructField("index", StringType())])
    df = spark.read.schema(schema).options(**JSON_OPTIONS).option("multiLine", multi_line).json(path)
    file_col = F.col("_metadata.file_name") if multi_line else F.lit(None).cast("string")
    return _records(df.withColumn("_source_file", file_col), F.coalesce(F.col("index"), F.lit(index).cast("string")))


def parse_records(df: DataFrame, body: str = "body", index: str | Column = "index") -> DataFrame:
    """Response bodies held in a text column → records."""
    index_col = F.col(index) if isinstance(index, str) else index
    parsed = df.select(index_col.alias("index"), F.inline(F.array(F.from_json(F.col(body), RECORDS_PAGE, JSON_OPTIONS))))
    return _records(parsed.withColumn("_source_file", F.lit(None).cast("string")), F.col("index"))


def _records(df: DataFrame, index: Column) -> DataFrame:
    used = df.where(F.col(CORRUPT_COLUMN).isNull())
    number = page_number(F.col("page.pageNumber"), F.col("_source_file"))
    return used.select(index.cast("string").alias("index"), number.alias("page_number"), F.explode("results").alias("record"))


def extra_fields(record: Column, known: tuple[str, ...]) -> Column:
    """The fields of a VARIANT record whose keys are not ``known``, as a map to VARIANT (NULL for what is no object)."""
    fields = F.try_variant_get(record, "$", "map<string,variant>")
    return F.map_filter(fields, lambda k, _: ~k.isin(*known)) if known else fields


def unknown_keys(records: DataFrame, known: tuple[str, ...] = tuple(RESULT.fieldNames())) -> DataFrame:
    """Keys outside the schema: (``index``, ``key``, ``kind``, ``records``).

    ``kind`` is the type that all values of the key share, ``VARIANT`` if they
    differ and ``VOID`` if all are null.  Only unknown fields are exploded, and
    one row per (index, key) and task is shuffled.
    """
    fields = records.select("index", F.explode(extra_fields(F.col("record"), known)).alias("key", "value"))
    return fields.groupBy("index", "key").agg(F.schema_of_variant_agg("value").alias("kind"), F.count(F.lit(1)).alias("records"))


def can_be_column(key: str) -> bool:
    """Whether an unknown key may become a raw column: no name of the table, whatever its case, and not empty."""
    taken = {n.lower() for n in (*RAW.fieldNames(), *PARTITION_COLUMNS, "index", "page_number")}
    return bool(key.strip()) and key.lower() not in taken


def extra_keys(records: DataFrame) -> tuple[str, ...]:
    """The unknown keys that may become columns, sorted; of keys equal up to case the first.

    Their number is checked before they come to the driver.
    """
    keys = unknown_keys(records).groupBy("key").agg(F.sum("records").alias("records"))
    found = [r["key"] for r in keys.select("key").orderBy("key").limit(MAX_EXTRA_KEYS + 1).collect()]
    if len(found) > MAX_EXTRA_KEYS:
        raise ValueError(f"more than {MAX_EXTRA_KEYS} unknown keys in the landed records")
    once: dict[str, str] = {}
    for key in found:
        if can_be_column(key):
            once.setdefault(key.lower(), key)
    return tuple(sorted(once.values()))
