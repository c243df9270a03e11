"""Exact duplicates by deterministic block naming.

Texts are lower-cased (A-Z only) and cut into blocks of BLOCK bytes, the last
one as long as what is left.

1. *Local names.*  Each run of texts (about RUN_BYTES bytes of one task)
   numbers its distinct blocks by their bytes, so a block is shuffled once for
   each run that has it, however many texts share it.
2. *Integer names.*  Blocks are dealt by their bytes and sorted; equal blocks
   become neighbours and get one integer: the partition and the place in its
   order.  Bytes are compared with bytes, nothing is left to a hash.
3. *Pairs.*  The names go back to their runs, where each text becomes its
   sequence of names, and adjacent ones become pairs, named in the same way (a
   single last one is paired with nothing).  Every round halves the sequences;
   a text of one name is done.  The round is part of the name, so names of
   different lengths never meet.
4. Texts of one identity are counted through the runs: a group of copies is
   one row for each run that has it.

Each round is written once to the shared folder, so names stay as they were
when an executor is lost.

Defined results: NULL counts as empty, and empty texts are equal (the
identity of no blocks).  Of equal texts, one row with the largest ``doc_id``
stays; of repeated rows of that id, exactly one; a NULL id is smaller than
any other, and a group of NULL ids keeps one row with a NULL ``keep_id``.  An
empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioflow.llm.batches import pick, slices
from folioflow.llm.runs import by_run
from folioflow.session import scratch_path

BLOCK = 4096
RUN_BYTES = 32_000_000
RUN_ROW = 256  # bytes that a text counts for at least
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
ASCII_LOWER = bytes.maketrans(UPPER.encode(), LOWER.encode())
PART_BITS, RANK_BITS = 20, 37  # a name: round, partition, place in it

# kind NAME: what a run calls ``at`` (its bytes, or a pair of names); kind TEXT:
# a text, ``at`` its place in the run, ``seq`` its sequence in local names, ``identity`` when it is done
SCHEMA = "t long, kind int, at int, block binary, a long, b long, doc_id long, sha binary, seq binary, identity long"
ARROW = pa.schema(
    [("t", pa.int64()), ("kind", pa.int32()), ("at", pa.int32()), ("block", pa.binary()), ("a", pa.int64()), ("b", pa.int64()),
     ("doc_id", pa.int64()), ("sha", pa.binary()), ("seq", pa.binary()), ("identity", pa.int64())]
)
NAME, TEXT = range(2)
NOTHING = 0  # identity of an empty text, and the partner of a single last name


def _rows(kind: int, t: int, n: int, **columns: list) -> pa.RecordBatch:
    given = {"t": [t] * n, "kind": [kind] * n} | columns
    return pa.RecordBatch.from_arrays([pa.array(given[f.name], f.type) if f.name in given else pa.nulls(n, f.type) for f in ARROW], schema=ARROW)


def _cut(docs: DataFrame) -> DataFrame:
    """Runs of texts as sequences of locally named blocks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = TaskContext.get().partitionId() << 32
        names: dict[bytes, int] = {}
        held, place = 0, 0

        def named() -> Iterator[pa.RecordBatch]:
            blocks = list(names)
            for lo in range(0, len(blocks), 1_000):
                part = blocks[lo : lo + 1_000]
                yield _rows(NAME, t, len(part), at=list(range(lo, lo + len(part))), block=part)

        for batch in slices(batches):
            ids, shas, seqs, places = [], [], [], []

            def texts() -> pa.RecordBatch:
                done = [None if s else NOTHING for s in seqs]
                return _rows(TEXT, t, len(ids), at=places, doc_id=ids, sha=shas, seq=seqs, identity=done)

            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                raw = text.as_buffer().to_pybytes().translate(ASCII_LOWER) if text.is_valid else b""
                cut = [names.setdefault(raw[i : i + BLOCK], len(names)) for i in range(0, len(raw), BLOCK)]
                ids.append(doc_id)
                shas.append(hashlib.sha256(raw).digest())
                seqs.append(np.array(cut, dtype="<i4").tobytes())
                places.append(place)
                place += 1
                held += max(RUN_ROW, len(raw))
                if held > RUN_BYTES:
                    yield texts()
                    yield from named()
                    t, names, held, place = t + 1, {}, 0, 0
                    ids, shas, seqs, places = [], [], [], []
            if ids:
                yield texts()
        yield from named()

    return docs.mapInArrow(run, SCHEMA)


def _named(state: DataFrame, by: list[str], level: int) -> DataFrame:
    """(t, at, name): one integer for each distinct value of ``by`` (the blocks, or pairs of names)."""
    out = pa.schema([("t", pa.int64()), ("at", pa.int32()), ("name", pa.int64())])
    width = len(by)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name = (level << (PART_BITS + RANK_BITS)) + (TaskContext.get().partitionId() << RANK_BITS)
        last: list[pa.Scalar] | None = None
        for batch in batches:
            if not batch.num_rows:
                continue
            new = np.zeros(batch.num_rows, dtype=bool)
            for i in range(width):
                c = batch.column(i)
                new[1:] |= pc.not_equal(c.slice(1), c.slice(0, len(c) - 1)).to_numpy(zero_copy_only=False)
            new[0] = last is None or any(batch.column(i)[0] != last[i] for i in range(width))
            names = name + np.cumsum(new)
            name = int(names[-1])
            last = [pa.scalar(batch.column(i)[-1].as_py(), batch.column(i).type) for i in range(width)]
            yield pa.RecordBatch.from_arrays([batch.column(width), batch.column(width + 1), pa.array(names)], schema=out)

    dealt = state.where(F.col("kind") == NAME).select(*by, "t", "at").repartition(*by).sortWithinPartitions(*by)
    return dealt.mapInArrow(run, "t long, at int, name long")


def _halved(run: pa.Table) -> pa.Table:
    """The texts of one run with their blocks or pairs named, and the run's new distinct pairs."""
    t = run.column("t")[0].as_py()
    kind = run.column("kind").to_numpy()
    names = run.filter(pa.array(kind == NAME)).column("name").to_numpy()
    texts = run.filter(pa.array(kind == TEXT))
    local = np.frombuffer(b"".join(texts.column("seq").to_pylist()), dtype="<i4")
    lengths = pc.binary_length(texts.column("seq")).to_numpy().astype(np.int64) // 4
    halves = (lengths + 1) // 2
    single = lengths == 1
    flat = names[local]
    # each sequence gets an even length, a single last name beside nothing
    starts = np.cumsum(lengths) - lengths
    padded = np.full(int(2 * halves.sum()), NOTHING, dtype=np.int64)
    at = np.arange(len(flat)) + np.repeat(np.cumsum(2 * halves) - 2 * halves - starts, lengths)
    padded[at] = flat
    pairs = padded.reshape(-1, 2)
    keep = np.repeat(~single, halves)
    distinct, number = np.unique(pairs[keep], axis=0, return_inverse=True)
    left = halves[~single]
    raw, ends = np.asarray(number, dtype="<i4").ravel().tobytes(), 4 * np.cumsum(left)
    new = iter([raw[e - 4 * n : e] for e, n in zip(ends.tolist(), left.tolist())])
    seqs = [b"" if one else next(new) for one in single.tolist()]
    done = np.where(single, flat[np.minimum(starts, max(0, len(flat) - 1))] if len(flat) else 0, 0)
    n = len(lengths)
    out = _rows(
        TEXT, t, n, at=texts.column("at").to_pylist(), doc_id=texts.column("doc_id").to_pylist(), sha=texts.column("sha").to_pylist(), seq=seqs,
        identity=[v if one else None for v, one in zip(done.tolist(), single.tolist())],
    )
    m = len(distinct)
    return pa.Table.from_batches([out, _rows(NAME, t, m, at=list(range(m)), a=distinct[:, 0].tolist(), b=distinct[:, 1].tolist())])


def identities(docs: DataFrame) -> DataFrame:
    """(``t``, ``at``: the row; ``doc_id``, ``sha``, ``identity``) for each row of ``docs`` (``doc_id``, ``text``)."""
    spark = docs.sparkSession

    def stored(df: DataFrame, label: str) -> DataFrame:
        path = scratch_path(spark, f"naming-{label}")
        df.write.parquet(path)
        return spark.read.schema(SCHEMA).parquet(path)

    state = stored(_cut(pick(docs, doc_id="long", text="string")), "blocks")
    done, by, level = [], ["block"], 1
    while True:
        texts = state.where(F.col("kind") == TEXT)
        done.append(texts.where("identity is not null").select("t", "at", "doc_id", "sha", "identity"))
        going = texts.where("identity is null").select("t", "kind", "at", "doc_id", "sha", "seq")
        if going.isEmpty():
            break
        names = _named(state, by, level).withColumn("kind", F.lit(NAME))
        state = stored(by_run(names.unionByName(going, allowMissingColumns=True), ["t"], ["kind", "at"], _halved, SCHEMA), f"round-{level}")
        by, level = ["a", "b"], level + 1
    result = done[0]
    for more in done[1:]:
        result = result.union(more)
    return result


def exact_groups(docs: DataFrame) -> DataFrame:
    """A row for each row of ``docs``: the row of its group that stays, the group's size, and the digest of its normalised text."""
    rows = identities(docs)
    best = F.max(F.struct("doc_id", "t", "at")).alias("best")  # a NULL id is the smallest
    by_text = rows.groupBy("identity", "t").agg(best, F.count(F.lit(1)).alias("n"))
    groups = by_text.groupBy("identity").agg(F.max("best").alias("best"), F.sum("n").alias("group_size"))
    known = by_text.select("identity", "t").join(groups, "identity")  # a row for each run that has the text
    joined = rows.join(known, ["identity", "t"])
    return joined.select(
        "doc_id",
        F.col("best.doc_id").alias("keep_id"),
        "group_size",
        ((F.col("t") == F.col("best.t")) & (F.col("at") == F.col("best.at"))).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"),
    )


def keep_largest(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, all columns kept; of repeated rows of one id and text, one."""
    names = docs.columns
    plain = docs.toDF(*[f"c{i}" for i in range(len(names))])
    text, own = F.col(f"c{names.index('text')}"), F.col(f"c{names.index('doc_id')}")
    stay = exact_groups(docs).where("kept").select(F.col("doc_id").alias("stay_id"), F.col("text_sha256").alias("stay_sha"))
    sha = F.sha2(F.translate(F.coalesce(text.cast("string"), F.lit("")), UPPER, LOWER), 256)
    keyed = plain.withColumn("own_id", own.cast("long")).withColumn("own_sha", sha)
    kept = keyed.join(stay, F.col("own_id").eqNullSafe(F.col("stay_id")) & (F.col("own_sha") == F.col("stay_sha")), "left_semi")
    return kept.dropDuplicates(["own_id", "own_sha"]).select(plain.columns).toDF(*names)
