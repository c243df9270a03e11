"""Locale-formatted number text → numbers, as native Column expressions.

Three parsers:

* :func:`parse_number_enus` reads English notation (``,`` groups, ``.`` marks
  decimals), for responses requested in that language.
* :func:`parse_number_ptbr` (pipeline default) reads Brazilian notation the
  way the feed writes it: ``.`` groups thousands, ``,`` marks decimals.
* :func:`parse_number_compat` keeps the historical behaviour bit for bit:
  drop every character except digits, ``,``, ``.`` and ``-``, turn ``,``
  into ``.`` and read a double; anything unreadable is NULL.  That turns
  ``"476.976.044"`` into NULL and ``"976.044"`` into 976.044, which is why it
  is not the default.

All return NULL, never NaN, for unreadable text, and only apply to text: numeric columns pass through unchanged (see :func:`to_number`).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DoubleType, NumericType, StringType

from folioflow.schemas import NUMBER

# Fixed value (must equal the original cleaning): every character outside
# this class is deleted before parsing.  In Java regular expressions \d is
# the ASCII digits 0-9 and a trailing "-" in a class is literal.
NON_NUMERIC_PATTERN = r"[^\d,.-]"

# pt-BR grammar on the stripped text: three shapes.  A value without a dot
# can only be the comma form; with dots, grouped is tried before dot-decimal.
_GROUPED = r"^-?[0-9]{1,3}(\.[0-9]{3})+(,[0-9]+)?$"  # 1.234.567,89 - dots group
_COMMA_DECIMAL = r"^-?[0-9]+(,[0-9]+)?$"  # 1234,5 or 1234 - comma is the decimal mark
_DOT_DECIMAL = r"^-?([0-9]+\.[0-9]*|\.[0-9]+)$"  # 12.5, 5., .5 - a lone dot is decimal


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_non_numeric(c: Column | str) -> Column:
    """Remove everything except digits, ``,``, ``.`` and ``-`` (``"R$ 3,10"`` → ``"3,10"``)."""
    return F.regexp_replace(_col(c).cast("string"), NON_NUMERIC_PATTERN, "")


def parse_number_compat(c: Column | str) -> Column:
    """Historical parse: strip, ``,`` → ``.``, lenient double (bad → NULL)."""
    return F.translate(strip_non_numeric(c), ",", ".").try_cast("double")


def parse_number_ptbr(c: Column | str, dtype: DataType = NUMBER) -> Column:
    """pt-BR parse to an exact decimal: ``"476.976.044"`` → 476976044, ``"1.234,56"`` → 1234.56.

    ``"976.044"`` is read as grouped (976044): a single three-digit group
    after a dot is how the feed writes thousands.  Text that fits none of
    the three shapes, or does not fit ``dtype``, is NULL.
    """
    s = strip_non_numeric(c)
    # The comma form has no dot; the grouped and dot forms have one or more.
    # A plain substring test picks the shape to try, so each value runs at
    # most two patterns (grouped before dot: "976.044" fits both).
    has_dot = s.contains(".")
    grouped = F.translate(F.translate(s, ".", ""), ",", ".")  # drop the dots, comma → decimal point
    comma_decimal = F.translate(s, ",", ".")
    normalised = (
        F.when(~has_dot & s.rlike(_COMMA_DECIMAL), comma_decimal)
        .when(has_dot & s.rlike(_GROUPED), grouped)
        .when(has_dot & s.rlike(_DOT_DECIMAL), s)
    )
    return normalised.try_cast(dtype)


_ENGLISH = r"^-?([0-9]{1,3}(,[0-9]{3})+|[0-9]+)?(\.[0-9]*)?$"  # 1,234,567.89 or 1234.5


def parse_number_enus(c: Column | str, dtype: DataType = NUMBER) -> Column:
    """English parse: ``"476,976,044"`` → 476976044, ``"0.490"`` → 0.49; other shapes are NULL."""
    s = strip_non_numeric(c)
    return F.when(s.rlike(_ENGLISH) & s.rlike("[0-9]"), F.translate(s, ",", "")).try_cast(dtype)


def parse_number(c: Column | str, mode: str = "ptbr") -> Column:
    """Text → double.  No value is rounded to fixed decimals or dropped for its size."""
    if mode == "ptbr":
        return parse_number_ptbr(c, DoubleType())
    if mode == "enus":
        return parse_number_enus(c, DoubleType())
    if mode == "compat":
        return parse_number_compat(c)
    raise ValueError(f"unknown number mode {mode!r}")


def to_number(c: Column | str, source_type: DataType, mode: str = "ptbr") -> Column:
    """Parse text columns; pass numeric columns through (NaN → NULL).

    Output is DOUBLE, the raw table's type for ``part``/``theoricalQty``.
    """
    if isinstance(source_type, NumericType):
        d = _col(c).cast("double")
        return F.nanvl(d, F.lit(None).cast("double"))
    if not isinstance(source_type, StringType):
        c = _col(c).cast("string")
    return parse_number(c, mode).cast("double")


def _exact(c: Column) -> Column:
    """The decimal that equals a number, NULL where there is none of at most 18 decimals and 18 digits before them."""
    d = c.try_cast(NUMBER)
    return F.when(d.cast("double") == c.cast("double"), d)


def sums(c: Column | str) -> Column:
    """Aggregate: both parts of a sum that rounds and drops nothing.

    Values that a ``NUMBER`` holds exactly add up exactly (whatever the order
    of rows); any other value (very large, or with more decimals) is added
    as a double.  Use :func:`sum_double` or :func:`sum_long` on the result.
    """
    v = _col(c)
    d = _exact(v)
    whole = F.floor(d).cast("decimal(18,0)")
    return F.struct(
        F.sum(whole.cast("decimal(38,0)")).alias("whole"),
        F.sum((d - whole).cast("decimal(18,18)")).alias("part"),
        F.sum(F.when(d.isNull(), v.cast("double"))).alias("rest"),
    )


def add_sums(c: Column | str) -> Column:
    """Aggregate: the total of several :func:`sums`."""
    v = _col(c)
    return F.struct(F.sum(v["whole"]).alias("whole"), F.sum(v["part"]).alias("part"), F.sum(v["rest"]).alias("rest"))


def sum_double(s: Column) -> Column:
    """A :func:`sums` result as a double; 0 when there was nothing to add.

    The decimal total is rounded once, so it is the double nearest to the
    exact sum (beyond 19 digits the whole part alone is).
    """
    part = F.coalesce(s["part"], F.lit(0)).cast("decimal(28,18)")
    whole = F.coalesce(s["whole"], F.lit(0)).cast("decimal(38,0)") + F.floor(part).cast("decimal(38,0)")
    behind = (part - F.floor(part)).cast("decimal(18,18)")
    together = F.coalesce((whole.try_cast("decimal(19,0)") + behind).cast("double"), whole.cast("double"))
    return together + F.coalesce(s["rest"], F.lit(0.0))


def sum_long(s: Column) -> Column:
    """A :func:`sums` result rounded half up to a long; a total that no long holds raises."""
    part = F.round(F.coalesce(s["part"], F.lit(0)), 0).cast("decimal(38,0)")
    whole = (F.coalesce(s["whole"], F.lit(0)) + part).cast("bigint")
    return whole + F.round(F.coalesce(s["rest"], F.lit(0.0)), 0).cast("bigint")


def group_thousands(c: Column | str) -> Column:
    """Integer → pt-BR grouped text: ``6842346`` → ``"6.842.346"``."""
    return F.translate(F.format_number(_col(c).cast("bigint"), 0), ",", ".")

