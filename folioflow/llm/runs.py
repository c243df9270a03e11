"""Runs: bounded stretches of a task's rows that several steps come back to.

A run's key is the task that made it and a number within the task.  What a run
holds is bounded by its own size, so its rows may be brought together in one
task again, and a value that very many rows have is held once by each run.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

OUT_ROWS = 4_000


def by_run(rows: DataFrame, keys: list[str], order: list[str], work: Callable[[pa.Table], pa.Table], schema: str) -> DataFrame:
    """``work`` on the rows of each run, sorted by ``order``; ``keys`` are long columns."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            columns = [batch.column(batch.schema.get_field_index(k)).to_numpy() for k in keys]
            edge = np.zeros(batch.num_rows, dtype=bool)
            for c in columns:
                edge[1:] |= c[1:] != c[:-1]
            if held:
                last = held[-1]
                edge[0] = any(last.column(last.schema.get_field_index(k))[-1].as_py() != c[0] for k, c in zip(keys, columns))
            starts = np.flatnonzero(edge).tolist()
            lo = 0
            for at in starts:
                if at > lo:
                    held.append(batch.slice(lo, at - lo))
                if held:
                    yield from work(pa.Table.from_batches(held)).to_batches(OUT_ROWS)
                held, lo = [], at
            held.append(batch.slice(lo))
        if held:
            yield from work(pa.Table.from_batches(held)).to_batches(OUT_ROWS)

    dealt = rows.repartition(*keys).sortWithinPartitions(*keys, *order)
    return dealt.mapInArrow(run, schema)
