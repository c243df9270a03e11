"""Raw trees written by the earlier pandas pipeline, and their one-off migration.

Those files differ from ours in two ways (both seen in files written by
pandas/pyarrow):

* a column that was entirely NULL on a day (``segment``, ``partAcum``) is
  stored with the Parquet NULL logical type on an INT32 column, while
  other days store text.  The vectorized reader refuses to read such a
  column as text; the row-based reader returns NULL for it, so a mixed
  tree is read in **one scan** with the declared text schema.
* the run timestamp is ``INT64 TIMESTAMP(NANOS)``, which Spark does not
  map to a timestamp; read as ``bigint`` it is the raw count since the
  epoch.  Older writers stored microseconds; the unit is read
  from the Parquet type of each file, never guessed from values: Spark
  reads microseconds as a timestamp and refuses nanoseconds, so one job over
  that column alone names the files of microseconds, however many days and
  writers the tree has.

:func:`migrate_legacy_raw` rewrites such a tree once into the current
layout; every later job reads the new tree with the vectorized reader.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from folioflow.functions.dates import partition_date
from folioflow.operators.clean import conform
from folioflow.schemas import PARTITION_COLUMNS, RAW, with_partitions
from folioflow.session import shared_dir
from folioflow.sinks.daily import WriteResult, write_daily
from folioflow.sources.daily import PartitionNotFound

BROADCAST_FILES = 100_000  # names (under 300 bytes each)

_EPOCH = dt.datetime(1970, 1, 1)
UNITS = ("ns", "us")

LEGACY_RAW = StructType(
    [StructField(f.name, LongType()) if f.name == "extraction_timestamp" else f for f in RAW.fields]
)


def whole_micros(c: Column) -> Column:
    """A count of nanoseconds as microseconds, rounded down."""
    return F.call_function("div", c - F.pmod(c, F.lit(1000)), F.lit(1000))


def epoch_count_to_ntz(c: Column, unit: str = "ns") -> Column:
    """A count of ``unit`` since the epoch → TIMESTAMP_NTZ (no time-zone shift), whole microseconds, rounded down."""
    if unit not in UNITS:
        raise ValueError(f"unit must be one of {UNITS}, got {unit!r}")
    micros = whole_micros(c) if unit == "ns" else c
    seconds = (micros.cast("decimal(20,0)") / F.lit(1_000_000)).cast("decimal(18,6)")
    return F.lit(_EPOCH).cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), seconds)


def row_based_session(spark: SparkSession) -> SparkSession:
    """A session of its own (same cluster, same catalog) that uses the row-based Parquet reader.

    It also reads nanosecond stamps as their raw count.  Other queries of
    ``spark`` keep their settings.
    """
    session = spark.newSession()
    session.conf.set("spark.sql.parquet.enableVectorizedReader", "false")
    session.conf.set("spark.sql.legacy.parquet.nanosAsLong", "true")
    session.conf.set("spark.sql.session.timeZone", spark.conf.get("spark.sql.session.timeZone"))
    return session


def microsecond_files(spark: SparkSession, path: str) -> DataFrame:
    """(``file``): the files under ``path`` whose time stamps are microseconds; one job, no list of days on the driver.

    A damaged file is not among them, and then fails where the tree is read.
    """
    probe = spark.newSession()
    probe.conf.set("spark.sql.legacy.parquet.nanosAsLong", "false")
    probe.conf.set("spark.sql.files.ignoreCorruptFiles", "true")  # a file of nanoseconds counts as one here
    stamps = probe.read.schema("extraction_timestamp timestamp_ntz").option("recursiveFileLookup", "true").parquet(path)
    shared_dir(spark)
    # the count is stored as well, or the column would not be read at all
    files = stamps.groupBy(F.col("_metadata.file_path").alias("file")).agg(F.count("extraction_timestamp").alias("stamps")).checkpoint()
    return files.select("file")


def read_legacy_tree(session: SparkSession, path: str) -> DataFrame:
    """The legacy raw tree as :data:`~folioflow.schemas.RAW` + partition columns, in one scan.

    ``session``: a :func:`row_based_session`.  Up to BROADCAST_FILES names of
    files are broadcast (counted); more are joined by name.
    """
    files = session.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").load(path)
    if files.select("path").isEmpty():
        raise PartitionNotFound(f"no day under {path}")
    micros = microsecond_files(session, path)
    micros = F.broadcast(micros) if micros.count() <= BROADCAST_FILES else micros
    nan_free = {c: F.nanvl(F.col(c), F.lit(None).cast("double")) for c in ("part", "theoricalQty")}
    names = with_partitions(LEGACY_RAW).fieldNames()
    df = session.read.schema(with_partitions(LEGACY_RAW)).parquet(path).select(*names, F.col("_metadata.file_path").alias("_file"))
    known = df.join(micros, F.col("_file") == F.col("file"), "left")
    stamp = F.col("extraction_timestamp")
    in_micros = F.when(F.col("file").isNotNull(), stamp).otherwise(whole_micros(stamp))
    return known.withColumns({**nan_free, "extraction_timestamp": epoch_count_to_ntz(in_micros, "us")}).select(*names)


def migrate_legacy_raw(spark: SparkSession, legacy_path: str, target_path: str) -> WriteResult:
    """One job: read the whole legacy tree once, write it in the current layout (same days)."""
    legacy = read_legacy_tree(row_based_session(spark), legacy_path)
    rows = conform(legacy, RAW, keep=PARTITION_COLUMNS).withColumn("_day", partition_date())
    return write_daily(rows.drop(*PARTITION_COLUMNS), target_path, date_col="_day", drop_date_col=True)
