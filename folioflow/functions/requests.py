"""Request parameters → URL token (compact JSON, UTF-8, base64)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


# Fixed values (the API's request parameters, in this order): pageNumber,
# pageSize, language, index.
REQUEST_FIELDS = ("pageNumber", "pageSize", "language", "index")


def request_json(page_number: Column, page_size: Column, language: Column, index: Column) -> Column:
    """Compact JSON of the request, fields in the API's order."""
    values = (page_number.cast("long"), page_size.cast("long"), language, index)
    return F.to_json(F.struct(*[v.alias(name) for v, name in zip(values, REQUEST_FIELDS)]))


def base64_text(c: Column) -> Column:
    """Standard base64 of the UTF-8 bytes, on one line.

    Spark's ``base64`` follows MIME and breaks lines every 76 characters;
    the URL token must not contain those breaks.
    """
    return F.regexp_replace(F.base64(c.cast("binary")), r"[\r\n]", "")


def request_token(page_number: Column, page_size: Column, language: Column, index: Column) -> Column:
    return base64_text(request_json(page_number, page_size, language, index))


def request_url(base_url: str | Column, token: Column) -> Column:
    base = F.lit(base_url.rstrip("/")) if isinstance(base_url, str) else base_url
    return F.concat(base, F.lit("/"), token)
