"""Exact groups against a dictionary of whole texts."""

from __future__ import annotations

import hashlib
import random
from collections import Counter, defaultdict

import pytest

from folioflow.llm import block_naming
from folioflow.llm.block_naming import ASCII_LOWER, exact_groups, identities, keep_largest
from tests.llm.conftest import EDGE


def normal(text):
    return (text or "").encode().translate(ASCII_LOWER)


def brute_force(rows):
    """Multiset of results; of equal rows (id and text) one is kept."""
    members = defaultdict(list)
    for i, t in rows:
        members[normal(t)].append(i)
    out, kept = [], set()
    for i, t in rows:
        ids = members[normal(t)]
        keep = max((x for x in ids if x is not None), default=None)
        stays = i == keep and normal(t) not in kept
        if stays:
            kept.add(normal(t))
        out.append((i, keep, len(ids), stays, hashlib.sha256(normal(t)).hexdigest()))
    return Counter(out)


def check(df, rows):
    got = df.collect()
    assert Counter(map(tuple, got)) == brute_force(rows)
    return got


def test_documents(frame, documents):
    rows = [(i, t) for i, t, _ in documents]
    got = check(exact_groups(frame(rows).repartition(4)), rows)
    assert got[0].__fields__ == ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    assert any(r["group_size"] > 1 for r in got)


def test_edges(frame):
    check(exact_groups(frame(EDGE).repartition(2)), EDGE)
    assert exact_groups(frame([])).collect() == []
    only = [(None, None), (None, ""), (3, None), (3, "")]
    check(exact_groups(frame(only)), only)


@pytest.mark.parametrize("block, run", [(1, 40), (3, 300), (4, 10**9)])
def test_small_blocks_over_many_runs(spark, frame, monkeypatch, block, run):
    """Long and short sequences of equal blocks, prefixes of each other, copies in every run."""
    rng = random.Random(block)
    texts = ["".join(rng.choice("aAbÉ") for _ in range(rng.randrange(0, 40))) for _ in range(60)]
    texts += ["a" * n for n in range(20)] + ["ab" * n for n in range(12)] + ["é" * n for n in range(9)] + ["É" * n for n in range(9)]
    rows = [(i, t) for i, t in enumerate(texts + [t.upper() for t in texts] + texts[::3])]
    rows += [(i % 7, "hot copy of a text") for i in range(80)]
    monkeypatch.setattr(block_naming, "BLOCK", block)
    monkeypatch.setattr(block_naming, "RUN_BYTES", run)
    monkeypatch.setattr(block_naming, "RUN_ROW", 1)
    blocks = [block_naming._cut(spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)).where("kind = 1").select("t").distinct().count()]
    assert blocks[0] > 1 or run == 10**9
    check(exact_groups(frame(rows).repartition(3)), rows)


def test_identities_are_the_texts(spark, documents):
    rows = [(i, t) for i, t, _ in documents]
    got = identities(spark.createDataFrame(rows, "doc_id long, text string").repartition(5)).collect()
    texts = dict(rows)
    assert len(got) == len(rows) == len({(r["t"], r["at"]) for r in got})
    assert len({r["identity"] for r in got}) == len({normal(t) for t in texts.values()}) == len({(r["identity"], normal(texts[r["doc_id"]])) for r in got})


def test_keep_largest_keeps_columns_and_one_row_of_each_text(frame):
    rows = EDGE + [(20, "Same"), (21, "sAME"), (21, "same"), (None, "same")]
    df = frame(rows)
    got = keep_largest(df)
    assert got.columns == df.columns
    got = got.collect()
    assert Counter((r["doc_id"], normal(r["text"])) for r in got) == Counter((i, normal(t)) for (i, t), (_, _, _, kept, _) in _flags(rows) if kept)


def _flags(rows):
    return [((r[0], None if r[4] is None else _text(rows, r)), r) for r in brute_force(rows).elements()]


def _text(rows, r):
    return next(t for i, t in rows if i == r[0] and hashlib.sha256(normal(t)).hexdigest() == r[4])
