"""Presentation (L1–L3): order by the group key, first rows."""

from __future__ import annotations

from pyspark.sql import DataFrame


def ordered(df: DataFrame, *keys: str) -> DataFrame:
    """L1: the sort happens only here, at presentation (default key ``acao``)."""
    return df.orderBy(*(keys or ("acao",)))


def top_rows(df: DataFrame, n: int = 3, *keys: str) -> DataFrame:
    """L2/L3: first ``n`` rows of a deterministic order.

    ``orderBy`` + ``limit`` plans as TakeOrderedAndProject: each task keeps
    its own top ``n``, the driver merges ``n`` × tasks rows.
    """
    return ordered(df, *keys).limit(n)
