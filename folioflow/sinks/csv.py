"""K6: CSV with a header line and no index column."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType


OPTIONS = {
    "header": "true",
    "quote": '"',
    "escape": '"',
    "nullValue": "",
    "emptyValue": '""',
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
    "lineSep": "\n",
}


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Distributed CSV write (one part file per task, header in each).

    Text is written as it is: quotes are doubled, padding and line ends are
    kept, an empty text is ``""`` and a NULL is nothing.
    """
    df.write.mode(mode).options(**OPTIONS).csv(path)


# What an empty text (``""``) is read as before it becomes empty again: the
# reader would take it for the NULL that an unquoted nothing stands for.
_EMPTY = "\x01empty\x01"


def read_csv(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Read back with a declared schema (no inference pass)."""
    options = OPTIONS | {"emptyValue": _EMPTY, "multiLine": "true", "mode": "FAILFAST"}
    df = spark.read.schema(schema).options(**options).csv(path)
    texts = [f.name for f in schema.fields if isinstance(f.dataType, StringType)]
    return df.withColumns({c: F.when(F.col(c) == _EMPTY, F.lit("")).otherwise(F.col(c)) for c in texts})
