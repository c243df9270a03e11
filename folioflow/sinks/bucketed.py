"""Daily tables laid out by asset, so that aggregating and reconciling them shuffles nothing.

The rows of an asset are in one bucket of each day.  A group by asset, or by
day and asset, and a join by asset with a table of as many buckets then start
from the files as they lie.  Such a table pays off where a tree is aggregated
again and again; it costs one shuffle when it is written.

An asset with very many rows makes its bucket large, and aggregating it is one
task's work (in the memory of its groups): trees with such assets are better read as they are
(:func:`~folioflow.operators.aggregate.portfolio_by_asset` reduces a hot asset
where its rows lie).  :func:`bucket_sizes` shows it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from folioflow.schemas import PARTITION_COLUMNS, RAW, quoted
from folioflow.sinks.catalog import _ddl, _quote


def create_bucketed(
    spark: SparkSession, table: str, path: str, schema: StructType = RAW, key: str = "asset", buckets: int = 64
) -> None:
    """An external daily table with ``buckets`` buckets by ``key``, if it is not there yet.

    Its writes replace the days that they hold and no other.
    """
    if "." in table:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {table.rsplit('.', 1)[0]} LOCATION '{_quote(path.rstrip('/'))}_db'")
    columns = _ddl(schema) + ", " + ", ".join(f"`{c}` string" for c in PARTITION_COLUMNS)
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {table} ({columns}) USING parquet OPTIONS ('partitionOverwriteMode'='dynamic') "
        f"PARTITIONED BY ({', '.join(PARTITION_COLUMNS)}) CLUSTERED BY ({quoted(key)}) INTO {buckets} BUCKETS LOCATION '{_quote(path)}'"
    )


def layout(spark: SparkSession, table: str) -> tuple[str, int]:
    """Key and number of buckets of a table."""
    rows = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect()}
    if not rows.get("Num Buckets"):
        raise ValueError(f"{table} has no buckets")
    return rows["Bucket Columns"].strip("[]").strip("`"), int(rows["Num Buckets"])


def write_bucketed(df: DataFrame, table: str) -> None:
    """Write days (rows with the partition columns) into a bucketed table.

    Rows go by their bucket, and adaptive execution writes a large bucket (that
    of a hot asset) by several tasks, each a file, and several small ones by
    one: what a task sorts before writing does not grow with the table.
    """
    spark = df.sparkSession
    key, buckets = layout(spark, table)
    names = [quoted(c) for c in spark.table(table).columns]
    df.select(*names).hint("rebalance", buckets, key).write.insertInto(table, overwrite=True)


def bucket_sizes(spark: SparkSession, table: str) -> DataFrame:
    """(``bucket``, ``rows``): a bucket far beyond the others holds a hot asset."""
    key, buckets = layout(spark, table)
    bucket = F.pmod(F.hash(quoted(key)), F.lit(buckets)).alias("bucket")
    return spark.table(table).groupBy(bucket).agg(F.count(F.lit(1)).alias("rows"))
