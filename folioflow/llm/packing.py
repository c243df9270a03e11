"""Packing documents into fixed windows by non-negative least squares.

A document's ids (with an end id) are cut into full windows and a tail.  Only
the histogram of tail lengths, at most ``window`` numbers, goes to the driver,
where the packing is planned for all documents of a length at once:

1. Pairs and triples of lengths that fill a window exactly are enumerated,
   and non-negative least squares (multiplicative updates) finds how often
   each should be used to meet the histogram; the counts are rounded and
   taken off it, largest first.
2. The residual lengths are packed greedily: the longest first, then the
   longest that still fits; a gap that nothing fits is filled by cutting a
   longer tail at a multiple of ``GRAIN`` ids, and the rest goes back.

The plan is a list of ranges: "the tails of length L with ranks lo .. hi - 1
put their ids s .. e - 1 at this offset of the sequences from q on".  Its size
is bounded by the window, not by the data.  Every tail then finds its pieces
by its length and its rank among the tails of that length.  Ranks come from
counting in two levels, (length, bucket) and then the buckets of a length, so
that a length shared by a third of all documents is still spread out.

Checksums of the pieces follow from running checksums kept at every multiple
of GRAIN; that of a piece that starts inside a tail is derived from two of them.

Defined results: NULL text counts as empty and has the end id alone; repeated
rows are packed each; an empty table gives no pieces.  Every id is in exactly
one piece, and the padding of a sequence without a full fit is under GRAIN
ids, but for the last few.
"""

from __future__ import annotations

import bisect
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from folioflow.llm.batches import ARROW_TYPES, pick, slices
from folioflow.llm.word_tokens import WordTokenizer, tokenizer_path
from folioflow.session import scratch_path

WINDOW = 2048
GRAIN = 64
END_ID = 1
MIDDLE_STEP = 32
MAX_COMBINATIONS = 8192
CRC_POLYNOMIAL = 0xEDB88320


# -- the plan ---------------------------------------------------------------


def combinations(lengths: np.ndarray, window: int = WINDOW) -> np.ndarray:
    """Pairs and triples of the given lengths that fill ``window`` (0: no third).

    A triple's middle length is a multiple of MIDDLE_STEP, which keeps the
    number of unknowns near that of the lengths.
    """
    have = np.zeros(window + 1, dtype=bool)
    have[lengths] = True
    long = np.arange((window + 1) // 2, window)
    pairs = np.stack([long, window - long, np.zeros_like(long)], axis=1)
    middle = np.arange(MIDDLE_STEP, window // 2 + 1, MIDDLE_STEP)
    a, b = np.meshgrid(np.arange(1, window), middle, indexing="ij")
    c = window - a - b
    ok = (a >= b) & (b >= c) & (c > 0)
    triples = np.stack([a[ok], b[ok], c[ok]], axis=1)
    every = np.concatenate([pairs, triples])
    return every[np.all(have[every] | (every == 0), axis=1)]


def solve(columns: np.ndarray, histogram: np.ndarray, steps: int = 400) -> np.ndarray:
    """Non-negative counts x of the columns that minimise the squared misfit of the histogram."""
    if not len(columns):
        return np.zeros(0)
    target = histogram.astype(float).copy()
    target[0] = 0.0
    weight = (columns > 0).astype(float)
    toward = (target[columns] * weight).sum(axis=1)
    x = np.full(len(columns), max(target.sum() / (3.0 * len(columns)), 1e-9))
    for _ in range(steps):
        fitted = np.bincount(columns.ravel(), weights=(x[:, None] * weight).ravel(), minlength=len(target))
        fitted[0] = 0.0
        x *= toward / np.maximum((fitted[columns] * weight).sum(axis=1), 1e-12)
    return x


class Plan:
    """Ranges of tails and where their pieces go; see the module's text."""

    def __init__(self, histogram: np.ndarray, window: int = WINDOW) -> None:
        self.window = window
        self.records: list[tuple[int, int, int, int, int, int, int]] = []  # length, lo, hi, s, e, sequence, offset
        self.sequences = 0
        self._stock: dict[int, list[list[int]]] = {}  # remaining length -> [tail length, lo, hi, s]
        self._lengths: list[int] = []
        left = histogram.astype(np.int64).copy()
        used = np.zeros_like(left)
        columns = combinations(np.flatnonzero(left[1:]) + 1, window)
        counts = solve(columns, left)
        for k in np.argsort(-counts, kind="stable")[:MAX_COMBINATIONS].tolist():
            lengths = [n for n in columns[k].tolist() if n]
            times = min([round(float(counts[k])), *(int(left[n]) // lengths.count(n) for n in lengths)])
            if times < 1:
                continue
            at = 0
            for n in lengths:
                self.records.append((n, int(used[n]), int(used[n]) + times, 0, n, self.sequences, at))
                used[n] += times
                left[n] -= times
                at += n
            self.sequences += times
        for n in np.flatnonzero(left[1:]) + 1:
            self._put(int(n), [int(n), int(used[n]), int(used[n] + left[n]), 0])
        self._greedy()

    def _put(self, length: int, item: list[int]) -> None:
        if length not in self._stock:
            bisect.insort(self._lengths, length)
            self._stock[length] = []
        self._stock[length].append(item)

    def _greedy(self) -> None:
        while self._lengths:
            gap, times = self.window, None
            slots: list[tuple[int, list[int], int]] = []  # remaining length, item, ids taken
            while gap:
                found = self._fitting(gap, slots)
                if found is None:
                    break
                length, item, take = found
                slots.append((length, item, take))
                uses = sum(s[1] is item for s in slots)
                share = (item[2] - item[1]) // uses
                times = share if times is None else min(times, share)
                gap -= take
            at = 0
            for length, item, take in slots:
                tail, lo, _, s = item
                self.records.append((tail, lo, lo + times, s, s + take, self.sequences, at))
                item[1] += times
                at += take
                if take < length:
                    self._put(length - take, [tail, lo, lo + times, s + take])
            for length, item, _ in slots:
                stock = self._stock.get(length, [])
                if item[1] == item[2] and any(x is item for x in stock):
                    self._stock[length] = [x for x in stock if x is not item]
                    if not self._stock[length]:
                        del self._stock[length]
                        self._lengths.remove(length)
            self.sequences += times

    def _fitting(self, gap: int, slots: list) -> tuple[int, list[int], int] | None:
        """The longest stock that fits the gap, else a longer one cut to fit it."""

        def free(length: int) -> list[int] | None:
            for item in reversed(self._stock[length]):
                if item[2] - item[1] > sum(s[1] is item for s in slots):
                    return item
            return None

        at = bisect.bisect_right(self._lengths, gap)
        for k in range(at - 1, -1, -1):
            item = free(self._lengths[k])
            if item is not None:
                return self._lengths[k], item, self._lengths[k]
        cut = gap // GRAIN * GRAIN
        for k in range(at, len(self._lengths)) if cut else ():
            item = free(self._lengths[k])
            if item is not None and not any(s[1] is item for s in slots):
                return self._lengths[k], item, cut
        return None


# -- checksums --------------------------------------------------------------


def _times_x(v: np.ndarray) -> np.ndarray:
    return (v >> np.uint64(1)) ^ np.where(v & np.uint64(1), np.uint64(CRC_POLYNOMIAL), np.uint64(0))


def _shifts(ids: int) -> np.ndarray:
    """x ** (32 * k) modulo the checksum's polynomial, for k ids behind."""
    out = np.empty(ids + 1, dtype=np.uint64)
    v = np.array([1 << 31], dtype=np.uint64)
    for k in range(ids + 1):
        out[k] = v[0]
        for _ in range(32):
            v = _times_x(v)
    return out


def checksum_between(upto_end: np.ndarray, upto_start: np.ndarray, ids: np.ndarray, shifts: np.ndarray) -> np.ndarray:
    """CRC-32 of the last ``ids`` ids, from the checksums up to their end and up to their start."""
    a, b = shifts[ids], upto_start.astype(np.uint64)
    product = np.zeros(len(a), dtype=np.uint64)
    for bit in range(31, -1, -1):
        product ^= np.where(a >> np.uint64(bit) & np.uint64(1), b, np.uint64(0))
        b = _times_x(b)
    return upto_end.astype(np.uint64) ^ product


def _cut(raw: bytes, window: int) -> tuple[list[int], list[int]]:
    """Checksums of the full windows, and of the tail up to every multiple of GRAIN and its end."""
    size = 4 * window
    full = [zlib.crc32(raw[i : i + size]) for i in range(0, len(raw) - size + 1, size)]
    marks, crc = [], 0
    for i in range(len(full) * size, len(raw), 4 * GRAIN):
        crc = zlib.crc32(raw[i : i + 4 * GRAIN], crc)
        marks.append(crc)
    return full, marks


# -- the job ----------------------------------------------------------------

SCHEMA = {
    "doc_id": "long",
    "start": "long",
    "length": "long",
    "ids_crc32": "long",
    "doc_tokens": "long",
    "sequence_id": "long",
    "offset": "long",
}


def _tokens(docs: DataFrame, tokenizer: str, window: int) -> DataFrame:
    """(doc_id, doc_tokens, tail, full, marks) of each document."""
    out = pa.schema(
        [("doc_id", pa.int64()), ("doc_tokens", pa.int64()), ("tail", pa.int32()), ("full", pa.list_(pa.int32())), ("marks", pa.list_(pa.int32()))]
    )
    end = np.array([END_ID], dtype="<u4").tobytes()
    signed = lambda crcs: np.array(crcs, dtype=np.uint32).view(np.int32).tolist()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = WordTokenizer.open(tokenizer)
        for batch in slices(batches):
            counts, tails, fulls, marks = [], [], [], []
            for text in batch.column(1).to_pylist():
                raw = words.ids(text or "") + end
                full, mark = _cut(raw, window)
                counts.append(len(raw) // 4)
                tails.append(len(raw) // 4 % window)
                fulls.append(signed(full))
                marks.append(signed(mark))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, type=out.field(i + 1).type) for i, c in enumerate((counts, tails, fulls, marks)))], schema=out
            )

    rows = pick(docs, doc_id="long", text="string")
    return rows.mapInArrow(run, "doc_id long, doc_tokens long, tail int, full array<int>, marks array<int>")


def pack(docs: DataFrame, tokenizer: str | None = None, window: int = WINDOW) -> DataFrame:
    """One row for each piece of each row of ``docs`` (``doc_id``, ``text``)."""
    spark = docs.sparkSession
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    path = scratch_path(spark, "packing")
    _tokens(docs, tokenizer or tokenizer_path(), window).write.parquet(path)
    bucket = F.pmod(F.xxhash64("doc_id", "doc_tokens", "marks"), F.lit(buckets)).cast("int")
    tokens = spark.read.parquet(path).withColumn("bucket", bucket)

    counts = tokens.groupBy("tail", "bucket").agg(F.count(F.lit(1)).alias("n"), F.sum(F.size("full")).alias("windows"))
    totals = {r["tail"]: (r["n"], r["windows"]) for r in counts.groupBy("tail").agg(F.sum("n").alias("n"), F.sum("windows").alias("windows")).collect()}
    histogram = np.zeros(window + 1, dtype=np.int64)
    for tail, (n, _) in totals.items():
        histogram[tail] = n
    histogram[0] = 0
    plan = Plan(histogram, window)
    places: dict[int, list[tuple]] = {tail: [] for tail in totals}
    for tail, *record in plan.records:
        places[tail].append(tuple(record))
    first, windows_before = [], plan.sequences
    for tail in sorted(totals):  # full windows follow the planned sequences
        first.append((tail, windows_before, places[tail]))
        windows_before += totals[tail][1]
    record = "struct<lo:long,hi:long,s:int,e:int,sequence:long,at:int>"
    planned = spark.createDataFrame(first, f"tail int, base long, places array<{record}>")

    # how many tails of a length, and full windows, stand in the buckets before
    before = Window.partitionBy("tail").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        F.col("tail").alias("t"),
        F.col("bucket").alias("b"),
        F.coalesce(F.sum("n").over(before), F.lit(0)).alias("n_before"),
        F.coalesce(F.sum("windows").over(before), F.lit(0)).alias("windows_before"),
    )
    own = Window.partitionBy("tail", "bucket").orderBy("doc_id", "doc_tokens", "marks", "full")
    ranked = tokens.withColumn("own_rank", F.row_number().over(own) - 1).withColumn(
        "own_windows", F.sum(F.size("full")).over(own.rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.size("full")
    )
    rows = ranked.join(offsets, (F.col("tail") == F.col("t")) & (F.col("bucket") == F.col("b"))).join(F.broadcast(planned), "tail")
    rank = F.col("own_rank") + F.col("n_before")
    window_id = F.col("base") + F.col("windows_before") + F.col("own_windows")
    whole = F.transform(
        "full",
        lambda crc, i: F.struct(
            (i * window).cast("long").alias("start"), F.lit(window).cast("long").alias("length"), crc.alias("upto_end"),
            F.lit(0).alias("upto_start"), F.lit(0).alias("s"), (window_id + i).alias("sequence_id"), F.lit(0).cast("long").alias("offset"),
        ),
    )
    mark = lambda upto: F.element_at("marks", F.ceil(upto / GRAIN).cast("int"))
    pieces = F.transform(
        F.filter("places", lambda p: (p["lo"] <= rank) & (rank < p["hi"])),
        lambda p: F.struct(
            (F.size("full") * window + p["s"]).cast("long").alias("start"), (p["e"] - p["s"]).cast("long").alias("length"), mark(p["e"]).alias("upto_end"),
            F.when(p["s"] > 0, mark(F.greatest(p["s"], F.lit(1)))).otherwise(0).alias("upto_start"), p["s"].alias("s"),
            (p["sequence"] + rank - p["lo"]).alias("sequence_id"), p["at"].cast("long").alias("offset"),
        ),
    )
    exploded = rows.select("doc_id", "doc_tokens", F.explode(F.concat(whole, pieces)).alias("p")).select("doc_id", "doc_tokens", "p.*")
    return _checksums(exploded, window)


def _checksums(pieces: DataFrame, window: int) -> DataFrame:
    out = pa.schema([(n, ARROW_TYPES[t]) for n, t in SCHEMA.items()])
    inside = F.col("s") > 0
    unsigned = lambda c: F.col(c).cast("long").bitwiseAND(F.lit(0xFFFFFFFF))
    rows = pieces.select(
        "doc_id", "start", "length", F.when(inside, unsigned("upto_start")).alias("upto_start"), unsigned("upto_end").alias("upto_end"),
        "doc_tokens", "sequence_id", "offset",
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shifts = None
        for batch in batches:
            crc = batch.column(4).to_numpy(zero_copy_only=False).astype(np.uint64)
            starts = batch.column(3)
            if starts.null_count < len(starts):
                shifts = _shifts(window) if shifts is None else shifts
                at = np.flatnonzero(starts.is_valid().to_numpy(zero_copy_only=False))
                ids = batch.column(2).to_numpy(zero_copy_only=False)[at]
                crc = crc.copy()
                crc[at] = checksum_between(crc[at], starts.take(pa.array(at)).to_numpy(zero_copy_only=False), ids, shifts)
            columns = [batch.column(0), batch.column(1), batch.column(2), pa.array(crc.astype(np.int64)), *(batch.column(i) for i in (5, 6, 7))]
            yield pa.RecordBatch.from_arrays(columns, schema=out)

    return rows.mapInArrow(run, ", ".join(f"`{n}` {t}" for n, t in SCHEMA.items()))
