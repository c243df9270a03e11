"""Landed pages from a file stream, through the batch extract.

The stream only stages: new landing files are read as they arrive, parsed,
and appended to a staging table of pages (the file sink's log makes that
exactly-once).  The raw day is then written from *all* staged pages by the
extract job's own plan, so page selection, page 1's header, the cut at
``totalPages`` and the replacement of the day are the same as in a batch run
over the same landing, and the batch tree holds nothing but that job's files.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StringType, StructField, StructType

from folioflow.options import JobOptions
from folioflow.plans.jobs import ExtractReport, extract_pages
from folioflow.schemas import landed_page
from folioflow.sources.pages import JSON_OPTIONS, normalise_pages


def stage_pages(
    spark: SparkSession,
    landing: str,
    staging: str,
    checkpoint: str,
    *,
    multi_line: bool = True,
    index: str | None = None,
    max_files_per_trigger: int = 10_000,
    available_now: bool = True,
    extra: tuple[str, ...] = (),
) -> StreamingQuery:
    """Append the pages of new landing files to ``staging`` (see :func:`~folioflow.sources.pages.read_pages`)."""
    schema = StructType(landed_page(extra).fields + [StructField("index", StringType())])
    bodies = (
        spark.readStream.schema(schema)
        .options(**JSON_OPTIONS)
        .option("multiLine", multi_line)
        .option("maxFilesPerTrigger", max_files_per_trigger)
        .json(landing)
    )
    file_col = F.col("_metadata.file_name") if multi_line else F.lit(None).cast("string")
    bodies = bodies.withColumns({"_source_file": file_col, "_landed_at": F.col("_metadata.file_modification_time")})
    pages = normalise_pages(
        bodies, index_col=F.coalesce(F.col("index"), F.lit(index).cast("string")), file_col=F.col("_source_file")
    )
    writer = pages.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start(staging)


def staged_pages(spark: SparkSession, staging: str) -> DataFrame:
    """Everything staged so far."""
    return spark.read.parquet(staging)


def landing_stream(
    spark: SparkSession,
    landing: str,
    opts: JobOptions,
    *,
    multi_line: bool = True,
    partition_day: dt.date | str | None = None,
    staging: str | None = None,
    checkpoint: str | None = None,
) -> ExtractReport:
    """Stage what has landed since the last call, then write the day from all staged pages."""
    staging = staging or f"{opts.root.rstrip('/')}/_staging/pages"
    query = stage_pages(
        spark, landing, staging, checkpoint or f"{opts.root.rstrip('/')}/_staging/checkpoint", multi_line=multi_line, index=opts.index,
        extra=opts.extra_columns,
    )
    query.awaitTermination()
    if query.exception() is not None:
        raise RuntimeError(f"staging failed: {query.exception()}")
    return extract_pages(spark, staged_pages(spark, staging), opts, partition_day=partition_day)
