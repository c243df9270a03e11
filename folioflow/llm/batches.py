"""Arrow batch helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ARROW_TYPES = {
    "long": pa.int64(),
    "int": pa.int32(),
    "double": pa.float64(),
    "string": pa.string(),
    "boolean": pa.bool_(),
    "binary": pa.binary(),
    "array<long>": pa.list_(pa.int64()),
}

# Texts are handed to an operator in groups of about this many characters,
# which bounds what one Python worker holds besides the Arrow batch itself.
GROUP_CHARS = 2_000_000


def pick(df: DataFrame, **columns: str) -> DataFrame:
    """Select ``name=type`` columns by exact name, whatever else ``df`` holds.

    Other columns may carry any name, equal up to case or even equal to one
    of these: the first column of exactly that name is taken.
    """
    names = df.columns
    plain = df.toDF(*[f"c{i}" for i in range(len(names))])
    return plain.select(*[F.col(f"c{names.index(n)}").cast(t).alias(n) for n, t in columns.items()])


def groups(texts: list[str], limit: int = GROUP_CHARS) -> Iterator[tuple[int, int]]:
    """Ranges of consecutive texts of about ``limit`` characters (one text at least)."""
    lo, held = 0, 0
    for i, t in enumerate(texts):
        if held and held + len(t) > limit:
            yield lo, i
            lo, held = i, 0
        held += len(t)
    if lo < len(texts):
        yield lo, len(texts)


# Rows of an Arrow batch that are turned into Python objects at a time.
SLICE_ROWS = 1_000


def slices(batches: Iterator[pa.RecordBatch], rows: int = SLICE_ROWS) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of at most ``rows`` rows (no copy)."""
    for batch in batches:
        for lo in range(0, batch.num_rows, rows):
            yield batch.slice(lo, rows)


def map_columns(df: DataFrame, schema: dict[str, str], start: Callable) -> DataFrame:
    """``mapInArrow`` by column lists.

    ``start()`` runs once per task and returns a function from the input's
    columns (a dict of Python lists) to the output's columns.
    """
    ddl = ", ".join(f"`{n}` {t}" for n, t in schema.items())
    out = pa.schema([(n, ARROW_TYPES[t]) for n, t in schema.items()])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = start()
        for batch in slices(batches):
            got = work({n: batch.column(i).to_pylist() for i, n in enumerate(batch.schema.names)})
            yield pa.RecordBatch.from_arrays([pa.array(got[f.name], type=f.type) for f in out], schema=out)

    return df.mapInArrow(run, ddl)


def filter_rows(df: DataFrame, column: str, start: Callable) -> DataFrame:
    """Rows of ``df``, all columns kept, whose ``column`` passes.

    ``start()`` runs once per task and returns a function from the column's
    values (a list) to a list of booleans.
    """
    at = df.columns.index(column)
    names = df.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = start()
        for batch in slices(batches):
            yield batch.filter(pa.array(work(batch.column(at).to_pylist()), type=pa.bool_()))

    plain = df.toDF(*[f"c{i}" for i in range(len(names))])
    return plain.mapInArrow(run, plain.schema).toDF(*names)


def replace_rows(df: DataFrame, column: str, changed: dict[str, str], start: Callable) -> DataFrame:
    """``df`` with the columns ``changed`` (name to type) rewritten from ``column``.

    ``start()`` runs once per task and returns a function from the column's
    values to a dict of lists, one per name in ``changed``.
    """
    names = df.columns
    at = names.index(column)
    plain = df.toDF(*[f"c{i}" for i in range(len(names))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = start()
        for batch in slices(batches):
            got = work(batch.column(at).to_pylist())
            arrays = list(batch.columns)
            for n in changed:
                if n in names:
                    i = names.index(n)
                    arrays[i] = pa.array(got[n]).cast(batch.schema.field(i).type)
            yield pa.RecordBatch.from_arrays(arrays, names=batch.schema.names)

    return plain.mapInArrow(run, plain.schema).toDF(*names)
