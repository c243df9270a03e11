"""K5: publish a daily tree as an external catalog table.

The table is declared over the existing files (``LOCATION``) and its
partitions are discovered from the directories.  The data is never read
and rewritten onto its own path (that pattern can delete the data).
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from folioflow.schemas import PARTITION_COLUMNS, RAW


PARTITIONS_AT_ONCE = 200


def _quote(text: str) -> str:
    """Escape a path for a single-quoted SQL literal."""
    return text.replace("\\", "\\\\").replace("'", "\\'")


def _ddl(schema: StructType) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)


def _matches(spark: SparkSession, table: str, path: str, schema: StructType, part_cols: list[str]) -> bool:
    """Whether a table's entry has this location and these columns."""
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect()
    place = next((r["data_type"] for r in rows if r["col_name"] == "Location"), "")
    same = lambda p: re.sub("^file:/+", "/", p).rstrip("/")
    have = [(f.name, f.dataType.simpleString()) for f in spark.table(table).schema.fields]
    want = [(f.name, f.dataType.simpleString()) for f in schema.fields] + [(c, "string") for c in part_cols]
    return same(place) == same(path) and have == want


def add_partitions(spark: SparkSession, table: str, part_cols: list[str], days: tuple[tuple[str, ...], ...]) -> None:
    """Add these partitions to a table, many in a statement; those it has already stay."""
    specs = ["PARTITION (" + ", ".join(f"`{c}`='{_quote(v)}'" for c, v in zip(part_cols, day)) + ")" for day in days]
    for lo in range(0, len(specs), PARTITIONS_AT_ONCE):
        spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS " + " ".join(specs[lo : lo + PARTITIONS_AT_ONCE]))


def publish_table(
    spark: SparkSession,
    table: str,
    path: str,
    schema: StructType = RAW,
    leading: tuple[str, ...] = (),
    database_location: str | None = None,
    days: tuple[tuple[str, ...], ...] | None = None,
) -> DataFrame:
    """``CREATE TABLE IF NOT EXISTS .. USING parquet PARTITIONED BY .. LOCATION`` + partition sync.

    An entry of that name with another location or schema is replaced (its
    files are left alone), partitions that are gone are dropped from it.
    With ``days`` (values of the partition columns, as a write reports them) an
    entry that is there gets just these partitions: nothing else is listed.

    A missing database is created, at ``database_location`` when given
    (else the warehouse default).
    """
    part_cols = [*leading, *PARTITION_COLUMNS]
    columns = _ddl(schema) + ", " + ", ".join(f"`{c}` string" for c in part_cols)
    database = table.rsplit(".", 1)[0] if "." in table else None
    if database:
        where = f" LOCATION '{_quote(database_location)}'" if database_location else ""
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}{where}")
    location = _quote(path)
    known = spark.catalog.tableExists(table)
    if known and not _matches(spark, table, path, schema, part_cols):
        spark.sql(f"DROP TABLE {table}")  # external: only the entry goes, the files stay
        known = False
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {table} ({columns}) USING parquet "
        f"PARTITIONED BY ({', '.join(part_cols)}) LOCATION '{location}'"
    )
    if known and days is not None:
        add_partitions(spark, table, part_cols, days)
    else:
        spark.sql(f"MSCK REPAIR TABLE {table} SYNC PARTITIONS")
    spark.catalog.refreshTable(table)
    return spark.table(table)
