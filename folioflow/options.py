"""Job parameters (one frozen value object instead of module-level globals)."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field

# Fixed values of the feed's request API (documented defaults).
DEFAULT_PAGE_SIZE = 1200
MAX_PAGE_SIZE = 1200
DEFAULT_INDEX = "IBOV"
DEFAULT_LANGUAGE = "pt-br"
SCHEMA_VERSION = "1.0"

# Layout names (configurable; the request endpoint is always passed in).
RAW_PREFIX = "portfolio-raw"
TRANSFORMED_PREFIX = "portfolio-transformed"
RAW_SOURCE = "portfolio-feed"
TRANSFORMED_SOURCE = "portfolio-feed-transformed"

# "auto": by the language of the responses.
NUMBER_MODES = ("auto", "ptbr", "enus", "compat")
LANGUAGE_NUMBERS = {"pt": "ptbr", "en": "enus"}

# Where the index name goes: nowhere (one index per root, as the original
# layout), a data column (several indices per day, grouped per index), or
# a leading ``index=`` directory level (one directory per index and day).
INDEX_MODES = ("none", "column", "partition")


@dataclass(frozen=True)
class JobOptions:
    """Everything a run needs; bound once so every column sees one clock read.

    ``root`` is a URI (``file:/...``, ``s3a://bucket``...): Spark's file
    system layer handles local and object storage alike, so there is no
    storage switch beyond it.
    """

    root: str
    page_size: int = DEFAULT_PAGE_SIZE
    index: str = DEFAULT_INDEX
    language: str = DEFAULT_LANGUAGE
    all_pages: bool = False
    number_mode: str = "auto"
    run_timestamp: dt.datetime = field(default_factory=lambda: dt.datetime.now().replace(microsecond=0))
    raw_prefix: str = RAW_PREFIX
    transformed_prefix: str = TRANSFORMED_PREFIX
    index_mode: str = "none"
    # keys of the records outside the fixed schema that the raw table keeps as text columns
    extra_columns: tuple[str, ...] = ()

    def __post_init__(self) -> None:
        if self.number_mode not in NUMBER_MODES:
            raise ValueError(f"number_mode must be one of {NUMBER_MODES}, got {self.number_mode!r}")
        if self.number_mode == "auto":
            prefix = self.language.lower()[:2]
            if prefix not in LANGUAGE_NUMBERS:
                raise ValueError(f"no number grammar for language {self.language!r}; set number_mode")
            object.__setattr__(self, "number_mode", LANGUAGE_NUMBERS[prefix])
        if self.index_mode not in INDEX_MODES:
            raise ValueError(f"index_mode must be one of {INDEX_MODES}, got {self.index_mode!r}")
        object.__setattr__(self, "extra_columns", tuple(self.extra_columns))
        from folioflow.sources.records import can_be_column

        clashing = [c for c in self.extra_columns if not can_be_column(c)]
        if clashing or len({c.lower() for c in self.extra_columns}) < len(self.extra_columns):
            raise ValueError(f"extra_columns must be new, distinct column names, got {self.extra_columns!r}")
        if not 1 <= int(self.page_size) <= MAX_PAGE_SIZE:
            raise ValueError(f"page_size must be within 1..{MAX_PAGE_SIZE}, got {self.page_size}")

    @property
    def run_date(self) -> dt.date:
        return self.run_timestamp.date()

    @property
    def raw_path(self) -> str:
        return f"{self.root.rstrip('/')}/{self.raw_prefix}"

    @property
    def transformed_path(self) -> str:
        return f"{self.root.rstrip('/')}/{self.transformed_prefix}"

    @property
    def audit_path(self) -> str:
        return f"{self.root.rstrip('/')}/_audit"

    @property
    def keeps_index(self) -> bool:
        return self.index_mode != "none"

    @property
    def group_keys(self) -> tuple[str, ...]:
        """Keys the portfolio is grouped by ahead of the asset."""
        return ("index",) if self.keeps_index else ()

    @property
    def leading_partitions(self) -> tuple[str, ...]:
        return ("index",) if self.index_mode == "partition" else ()

    @property
    def raw_schema(self):
        from folioflow.schemas import RAW, with_extra, with_index

        return with_extra(with_index(RAW) if self.index_mode == "column" else RAW, self.extra_columns)

    @property
    def portfolio_schema(self):
        from folioflow.schemas import PORTFOLIO, with_index

        return with_index(PORTFOLIO) if self.index_mode == "column" else PORTFOLIO
