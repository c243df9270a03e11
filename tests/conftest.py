from __future__ import annotations

import json
import os
import sys
from pathlib import Path

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from folioflow.session import build_session, local_path, scratch_path  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"
SF_MEDIUM = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    session = build_session("local[*]", "folioflow-tests", **{"spark.sql.shuffle.partitions": "8", "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64KB"})
    yield session
    session.stop()


@pytest.fixture()
def scratch(spark):
    """A fresh folder under the session's checkpoint dir, as a plain local path."""

    def make(label: str = "t") -> str:
        uri = scratch_path(spark, label)
        path = local_path(uri)
        Path(path).mkdir(parents=True, exist_ok=True)
        return path

    return make


# ---------------------------------------------------------------- page fixtures


def record(i: int, **over) -> dict:
    rec = {
        "segment": None,
        "cod": f"C{i:03d}",
        "asset": f"ASSET {i // 2}",
        "type": "ON  ED  NM",
        "part": "0,490",
        "partAcum": None,
        "theoricalQty": "476.976.044",
    }
    rec.update(over)
    return rec


def page_body(page_number: int, total_pages: int | None, records: list[dict], page_size: int = 50, header=True) -> dict:
    body: dict = {"page": {"pageNumber": page_number, "pageSize": page_size, "totalRecords": 134}}
    if total_pages is not None:
        body["page"]["totalPages"] = total_pages
    if header:
        body["header"] = {"date": f"2{page_number}/07/25", "theoricalQty": "95.000.000.000", "reductor": "1.234,5"}
    if records is not None:
        body["results"] = records
    return body


def land(folder: str, name: str, body) -> str:
    path = Path(folder) / name
    path.parent.mkdir(parents=True, exist_ok=True)
    text = body if isinstance(body, str) else json.dumps(body, indent=2, ensure_ascii=False)
    path.write_text(text, encoding="utf-8")
    return str(path)


def three_pages() -> list[tuple[int, list[dict]]]:
    """134 records over pages of 50 + 50 + 34."""
    recs = [record(i) for i in range(134)]
    return [(1, recs[:50]), (2, recs[50:100]), (3, recs[100:])]
