"""Document fingerprints from prefix polynomial hashes.

``PrefixHash`` keeps, for two primes, the modular prefix sums
``P[i] = sum(c[j] * B**j for j < i)`` of a text's code points.  A span's hash
follows from two entries, so any two spans compare in constant time, and the
longest common extension of two places is found by binary search.

A fingerprint is a short string made of such span hashes:

``<length>:<whole text>:<step>:<prefix hashes>:<suffix hashes>:<sketch>``

* the hash of the whole text under both primes;
* hashes of the prefixes (and of the suffixes) whose lengths are multiples of
  a power-of-two step, at most 32 of each, cut to 16 bits;
* the smallest hashes among all spans of ``WINDOW`` code points, which any
  edit leaves mostly alone.

Two fingerprints are compared without their texts: binary search over the
prefix and suffix hashes bounds the longest common prefix and suffix, and the
sketch estimates the shared spans; their likeness is the larger of the two.
Equal texts have equal fingerprints and likeness 1.

Defined results: NULL text counts as empty; two empty texts have likeness 1,
an empty and another text 0.  A NULL ``doc_id`` sorts before all others; rows
of one ``doc_id`` follow each other by text.  Texts are read whole.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioflow.llm.batches import ARROW_TYPES, pick, slices

PRIMES = (2_147_483_647, 2_147_483_629)
BASES = (911_382_323, 972_663_749)
WINDOW = 24
GRID = 32
SKETCH = 16
MIX = np.uint64(0x9E3779B97F4A7C15)


class Powers:
    """Powers of each base and of its inverse, grown by doubling."""

    def __init__(self) -> None:
        self.up = [np.ones(1, dtype=np.int64) for _ in PRIMES]
        self.down = [np.ones(1, dtype=np.int64) for _ in PRIMES]

    def reach(self, n: int) -> None:
        while len(self.up[0]) <= n:
            for tables, bases in ((self.up, BASES), (self.down, [pow(b, -1, p) for b, p in zip(BASES, PRIMES)])):
                for k, (p, b) in enumerate(zip(PRIMES, bases)):
                    t = tables[k]
                    tables[k] = np.concatenate([t, t * pow(b, len(t), p) % p])


POWERS = Powers()


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le"), dtype=np.uint32).astype(np.int64) + 1


class PrefixHash:
    """Modular prefix arrays of a text (an array of code points)."""

    def __init__(self, points: np.ndarray, shared: PrefixHash | None = None, keep: int = 0) -> None:
        """``shared``: another text's arrays whose first ``keep`` code points are the same."""
        POWERS.reach(len(points) + 1)
        self.n = len(points)
        self.sums = []
        for k, p in enumerate(PRIMES):
            terms = points[keep:] * POWERS.up[k][keep : self.n] % p
            start = shared.sums[k][: keep + 1] if shared is not None else np.zeros(1, dtype=np.int64)
            # the running sum of fewer than 2**32 terms below 2**31 fits in 63 bits
            self.sums.append(np.concatenate([start, (np.cumsum(terms) + start[-1]) % p]))

    def span(self, lo: np.ndarray | int, hi: np.ndarray | int, k: int = 0) -> np.ndarray | int:
        """Hash of the code points ``lo .. hi - 1``, whatever stands before them."""
        p = PRIMES[k]
        return (self.sums[k][hi] - self.sums[k][lo]) % p * POWERS.down[k][lo] % p

    def equal(self, lo: int, other: PrefixHash, lo2: int, length: int) -> bool:
        return all(self.span(lo, lo + length, k) == other.span(lo2, lo2 + length, k) for k in range(len(PRIMES)))

    def extension(self, lo: int, other: PrefixHash, lo2: int) -> int:
        """Length of the longest common extension of two places, by binary search."""
        least, most = 0, min(self.n - lo, other.n - lo2)
        while least < most:
            middle = (least + most + 1) // 2
            if self.equal(lo, other, lo2, middle):
                least = middle
            else:
                most = middle - 1
        return least

    def fingerprint(self) -> str:
        n = self.n
        step = 1
        while n // step > GRID:
            step *= 2
        lengths = np.arange(step, n + 1, step)
        low = lambda x: "".join(f"{v & 0xFFFF:04x}" for v in np.atleast_1d(x).tolist())
        whole = "".join(f"{int(self.span(0, n, k)):08x}" for k in range(len(PRIMES))) if n else "0" * 16
        prefixes = low(self.span(np.zeros_like(lengths), lengths)) if n else ""
        suffixes = low(self.span(n - lengths, np.full_like(lengths, n))) if n else ""
        return f"{n}:{whole}:{step}:{prefixes}:{suffixes}:{''.join(f'{v:08x}' for v in self.sketch())}"

    def sketch(self) -> list[int]:
        """The smallest mixed hashes among all spans of WINDOW code points (of the whole text if shorter)."""
        if not self.n:
            return []
        width = min(WINDOW, self.n)
        lo = np.arange(self.n - width + 1)
        hashes = self.span(lo, lo + width).astype(np.uint64) * MIX >> np.uint64(32)
        if len(hashes) > 64 * SKETCH:  # the smallest are among those under a bound, if enough are
            under = np.unique(hashes[hashes < np.uint64(2**32 * 4 * SKETCH // len(hashes))])
            if len(under) >= SKETCH:
                return under[:SKETCH].tolist()
        return np.unique(hashes)[:SKETCH].tolist()


def _common(a: str, b: str, step_a: int, step_b: int, most: int) -> int:
    """Longest common length on the two grids, by binary search over hashes of 4 hex digits."""
    step = max(step_a, step_b)
    at = lambda s, own, i: s[4 * (i * step // own - 1) : 4 * (i * step // own)]
    least, top = 0, most // step
    while least < top:
        middle = (least + top + 1) // 2
        if at(a, step_a, middle) == at(b, step_b, middle):
            least = middle
        else:
            top = middle - 1
    return least * step


def likeness(a: str, b: str) -> float:
    """Likeness of two fingerprints, 0 to 1."""
    if a == b:
        return 1.0
    n_a, _, step_a, pre_a, suf_a, sk_a = a.split(":")
    n_b, _, step_b, pre_b, suf_b, sk_b = b.split(":")
    n_a, n_b, step_a, step_b = int(n_a), int(n_b), int(step_a), int(step_b)
    if not n_a or not n_b:
        return 0.0
    least = min(n_a, n_b)
    head = _common(pre_a, pre_b, step_a, step_b, least)
    tail = _common(suf_a, suf_b, step_a, step_b, least)
    extension = min(head + tail, least) / max(n_a, n_b)
    own = {sk_a[i : i + 8] for i in range(0, len(sk_a), 8)}
    other = {sk_b[i : i + 8] for i in range(0, len(sk_b), 8)}
    smallest = sorted(own | other)[: max(len(own), len(other))]
    shared = sum(v in own and v in other for v in smallest) / max(1, len(smallest))
    return float(min(1.0, max(extension, shared)))


SCHEMA = {
    "doc_id": "long",
    "n_chars": "long",
    "edited_sha256": "string",
    "fingerprint": "string",
    "edited_fingerprint": "string",
    "near_edited": "double",
    "near_next": "double",
    "edited_extension": "long",
}

LEAST_ID = -(2**63)


def with_next(docs: DataFrame, parts: int | None = None) -> DataFrame:
    """Documents dealt to partitions by ranges of ``doc_id``, each followed by a guard.

    The bounds are doc_ids of the table itself (one for each partition), so
    the first document of a range is known by its id alone and is also sent,
    as a guard, to the range before; the first of all goes to the last range
    as well.  Each text is shuffled once.
    """
    parts = parts or int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keyed = pick(docs, doc_id="long", text="string").select(
        F.coalesce("doc_id", F.lit(LEAST_ID)).alias("place"), "doc_id", F.coalesce("text", F.lit("")).alias("text")
    )
    shares = [F.lit(i / parts) for i in range(1, parts)]
    found = keyed.agg(
        F.min("place").alias("first"), F.percentile_approx("place", F.array(*shares), 10_000).alias("rest") if shares else F.array().alias("rest")
    ).first()  # one number for each partition
    bounds = sorted({found["first"], *(found["rest"] or [])}) if found["first"] is not None else [LEAST_ID]
    # the last bound up to a place, found in two steps of about the square root of their number
    stride = max(1, round(len(bounds) ** 0.5))
    at, coarse = F.array(*[F.lit(b) for b in bounds]), F.array(*[F.lit(b) for b in bounds[::stride]])
    upto = lambda some: F.size(F.filter(some, lambda b: b <= F.col("place")))
    before = (upto(coarse) - 1) * stride
    home = before + upto(F.slice(at, before + 1, F.lit(stride))) - 1
    last = len(bounds) - 1
    guard_of = F.when(F.element_at(at, home + 1) == F.col("place"), F.when(home == 0, F.lit(last)).otherwise(home - 1))
    copies = F.when(
        guard_of.isNotNull(),
        F.array(F.struct(home.alias("part"), F.lit(False).alias("guard")), F.struct(guard_of.alias("part"), F.lit(True).alias("guard"))),
    ).otherwise(F.array(F.struct(home.alias("part"), F.lit(False).alias("guard"))))
    dealt = keyed.withColumn("to", F.explode(copies)).select("to.part", "to.guard", "place", "doc_id", "text")
    return dealt.repartitionById(len(bounds), F.col("part")).sortWithinPartitions("part", "guard", "place", "text")


def fingerprints(docs: DataFrame, parts: int | None = None) -> DataFrame:
    """Fingerprint every text and its edited form, and compare with the next document.

    The edited text replaces the last ``floor(n / 4)`` code points by the
    first as many (or all) of the next document in ascending ``doc_id``.
    """
    out = pa.schema([(n, ARROW_TYPES[t]) for n, t in SCHEMA.items()])

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for batch in slices(batches):
            yield from zip(*(batch.column(i).to_pylist() for i in range(batch.num_columns)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # (part, doc_id, text, points, hashes, fingerprint) of the row before
        done: list[tuple] = []
        for part, guard, _, doc_id, text in rows(batches):
            if guard and (held is None or held[0] != part):
                continue  # the row that this guard was for has had one
            points = code_points(text)
            hashes = PrefixHash(points)
            mark = hashes.fingerprint()
            if held is not None and held[0] == part:
                done.append(compare(held, text, points, mark))
            held = None if guard else (part, doc_id, text, points, hashes, mark)
            if len(done) >= 500:
                yield pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(zip(*done), out)], schema=out)
                done = []
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(zip(*done), out)], schema=out)

    def compare(row: tuple, next_text: str, next_points: np.ndarray, next_mark: str) -> tuple:
        _, doc_id, text, points, hashes, mark = row
        cut = len(points) // 4
        keep = len(points) - cut
        edited = text[:keep] + next_text[:cut]
        other = PrefixHash(np.concatenate([points[:keep], next_points[:cut]]), hashes, keep)
        edited_mark = other.fingerprint()
        return (
            doc_id,
            len(points),
            hashlib.sha256(edited.encode("utf-8")).hexdigest(),
            mark,
            edited_mark,
            likeness(mark, edited_mark),
            likeness(mark, next_mark),
            hashes.extension(0, other, 0),
        )

    return with_next(docs, parts).mapInArrow(run, ", ".join(f"{n} {t}" for n, t in SCHEMA.items()))
