"""Text cleaning as native Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StringType

# Every character Python's ``str.strip()`` removes (``str.isspace``): ASCII
# whitespace, the information separators U+001C..U+001F, NEL, NBSP and the
# Unicode space separators.  Spark's plain ``trim`` removes only U+0020.
# Built from the rule, not listed by hand; the highest such code point is U+3000.
WHITESPACE = "".join(ch for ch in map(chr, range(0x3001)) if ch.isspace())

# Fixed value: the literal text the feed uses for a missing string.
NONE_TEXT = "None"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_text(c: Column | str) -> Column:
    """Unicode-wide trim (tab, newline, NBSP...), codegen'd, no regex engine."""
    return F.trim(_col(c), F.lit(WHITESPACE))


def clean_text(c: Column | str, source_type: DataType | None = None) -> Column:
    """Trim, then the text ``'None'`` (after trimming) becomes NULL.

    ``'none'``, ``''`` and ``'nan'`` are kept as they are.  Non-text columns
    are cast to text first.
    """
    c = _col(c)
    if source_type is not None and not isinstance(source_type, StringType):
        c = c.cast("string")
    return F.nullif(strip_text(c), F.lit(NONE_TEXT))
