"""Cross-entropy difference of matched n-gram models.

Two bigram models of the same form and over one vocabulary (the ids of a
public tokenizer) are counted: the *target* from a set of chosen documents,
the *background* from all documents.  A document's score is its per-token
cross entropy under the target less that under the background; the lower,
the more it is like the target.  Both models smooth a bigram with the unigram:
``P(v | u) = (c(u v) + MU * P(v)) / (c(u) + MU)``, ``P(v) = (c(v) + 1) / (N + V)``.

All counts are exact and cover every document:

1. Texts become chunks of token ids, stored once.
2. Token counts (at most one row for each id of the vocabulary) are collected.
3. Bigrams whose two ids are both among the ``TOP`` most frequent ids are
   counted in a table of TOP * TOP numbers, which bounds what is collected and
   sent to the workers; these, the hot ones, are scored where the tokens are.
4. All other bigrams go to a bucket by a hash of the bigram, one compressed
   block for each chunk and bucket, entries summed by document.  A bucket adds
   up its bigrams' counts over all documents, scores its entries, and returns
   partial sums, which are added up for each document.
5. A bucket far beyond its size holds a *heavy* bigram.  The bigrams of such
   buckets are counted in Spark first (summed where they are, so no bigram is
   a hot key), and the heavy ones, at most HEAVY_MOST, are scored like the hot
   ones, where the tokens are.

A target document is scored by a target model without it: its own counts of
bigrams, contexts and tokens are taken off first.  The background keeps every
document.

Defined results: NULL or empty text, or one without tokens, has 0 tokens and
scores 0; repeated rows are scored (and counted) each, and each is taken off
once; without any (other) target document the model is uniform.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioflow.llm.batches import groups, pick, slices
from folioflow.llm.word_tokens import WordTokenizer, tokenizer_path
from folioflow.session import scratch_path

TOP = 1024
MU = 10.0
BUCKET_TOKENS = 8_000_000
HEAVY_MOST = 1 << 20  # heavy bigrams (24 bytes each) at most
BROADCAST_IDS = 500_000
CHUNK_DOCS = 50_000
CHUNK_CHARS = 1_000_000
SIZE = 49_408  # ids of the default tokenizer; one more stands for the start of a text


class Bigrams:
    """Costs of bigrams under the two models, from token counts."""

    def __init__(self, tokens: np.ndarray, contexts: np.ndarray) -> None:
        """``tokens``, ``contexts``: counts for each id and model (0 background, 1 target)."""
        size = len(tokens) - 1
        self.size = size
        self.prior = MU * (tokens[:size] + 1.0) / (tokens[:size].sum(axis=0) + size)
        self.below = np.log2(contexts + MU)
        self.tokens, self.contexts = tokens[:size, 1], contexts[:, 1]  # of the target
        self.all_tokens = float(self.tokens.sum())
        self.grand_total, self.bucket_tokens = float(tokens[:size, 0].sum()), BUCKET_TOKENS
        self.top = TOP
        order = np.argsort(-tokens[:size, 0], kind="stable")[: self.top - 1]
        self.rank = np.full(size + 1, self.top, dtype=np.int64)
        self.rank[order] = np.arange(len(order))
        self.rank[size] = self.top - 1  # the start of a text is always among the hot

    def costs(self, u: np.ndarray, v: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Bits of v after u in each model, from the bigrams' counts in each."""
        return self.below[u] - np.log2(counts + self.prior[v])

    def own_costs(self, u: np.ndarray, v: np.ndarray, counts: np.ndarray, own: np.ndarray) -> np.ndarray:
        """Bits of v after u in the target model without a document of its own counts (bigram, context, token, all)."""
        prior = MU * (self.tokens[v] - own[2] + 1.0) / (self.all_tokens - own[3] + self.size)
        return np.log2(self.contexts[u] - own[1] + MU) - np.log2(counts - own[0] + prior)

    def pairs(self, u: np.ndarray, v: np.ndarray) -> np.ndarray:
        return (u * (self.size + 1) + v).astype(np.uint64)  # under 2 ** 32


def _chunks(docs: DataFrame, tokenizer: str) -> DataFrame:
    """(chunk, doc_ids, target, lengths, ids): token ids of consecutive documents."""
    out = pa.schema(
        [("chunk", pa.int64()), ("doc_ids", pa.list_(pa.int64())), ("target", pa.binary()), ("lengths", pa.binary()), ("ids", pa.binary())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = WordTokenizer.open(tokenizer)
        number = TaskContext.get().partitionId() << 20
        for batch in slices(batches):
            doc_ids, texts, target = batch.column(0).to_pylist(), [t or "" for t in batch.column(1).to_pylist()], batch.column(2).to_pylist()
            for first, last in groups(texts, CHUNK_CHARS):
                for lo in range(first, last, CHUNK_DOCS):
                    hi = min(last, lo + CHUNK_DOCS)
                    raw = [words.ids(t) for t in texts[lo:hi]]
                    ids = np.frombuffer(b"".join(raw), dtype="<u4").astype("<u2")
                    lengths = np.array([len(r) // 4 for r in raw], dtype="<u4")
                    flags = np.array([bool(x) for x in target[lo:hi]], dtype=np.uint8)
                    yield pa.RecordBatch.from_pylist(
                        [{"chunk": number, "doc_ids": doc_ids[lo:hi], "target": flags.tobytes(), "lengths": lengths.tobytes(), "ids": ids.tobytes()}], schema=out
                    )
                    number += 1

    return docs.mapInArrow(run, "chunk long, doc_ids array<long>, target binary, lengths binary, ids binary")


def _read(row: dict, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(u, v, document number, target flag of each document) of a chunk's bigrams."""
    lengths = np.frombuffer(row["lengths"], dtype="<u4").astype(np.int64)
    v = np.frombuffer(row["ids"], dtype="<u2").astype(np.int64)
    doc = np.repeat(np.arange(len(lengths), dtype=np.int32), lengths)
    u = np.empty_like(v)
    u[1:] = v[:-1]
    starts = np.cumsum(lengths) - lengths
    u[starts[lengths > 0]] = size
    return u, v, doc, np.frombuffer(row["target"], dtype=np.uint8).astype(np.int64)


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for i in range(batch.num_rows):
            yield batch.slice(i, 1).to_pylist()[0]


def _entries(row: dict, model: Bigrams) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(bigram, u, v, document number, n, own counts) of each bigram of each document of a chunk, once.

    Own counts (bigram, context, token, all) are those of a target document, else 0.
    """
    u, v, doc, target = _read(row, model.size)
    entry, n = np.unique(model.pairs(u, v) << np.uint64(16) | doc.astype(np.uint64), return_counts=True)
    pair, d = entry >> np.uint64(16), (entry & np.uint64(0xFFFF)).astype(np.int64)
    eu, ev = np.divmod(pair.astype(np.int64), model.size + 1)
    own = np.zeros((4, len(entry)), dtype=np.int64)
    chosen = target[d] > 0
    if chosen.any():
        lengths = np.bincount(doc, minlength=len(target))
        for k, (seen, asked) in enumerate(((u, eu), (v, ev)), 1):
            keys, counts = np.unique(seen << 16 | doc, return_counts=True)
            own[k, chosen] = counts[np.searchsorted(keys, (asked << 16 | d)[chosen])]
        own[0, chosen], own[3, chosen] = n[chosen], lengths[d[chosen]]
    return pair, eu, ev, d, n, own


def _buckets(pair: np.ndarray, buckets: int) -> np.ndarray:
    return (pair * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(40)) % np.uint64(buckets)


def _token_counts(chunks: DataFrame, size: int) -> tuple[np.ndarray, np.ndarray]:
    out = pa.schema([("id", pa.int32()), *((n, pa.int64()) for n in ("b", "t", "cb", "ct"))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros((4, size + 1), dtype=np.int64)
        for row in _rows(batches):
            u, v, doc, target = _read(row, size)
            chosen = target[doc] > 0
            held += np.stack([np.bincount(x, minlength=size + 1) for x in (v, v[chosen], u, u[chosen])])
        at = np.flatnonzero(held.any(axis=0))
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), *(pa.array(h[at]) for h in held)], schema=out)

    names = ("b", "t", "cb", "ct")
    rows = chunks.select("target", "lengths", "ids").mapInArrow(run, "id int, b long, t long, cb long, ct long")
    found = rows.groupBy("id").agg(*[F.sum(n).alias(n) for n in names]).collect()  # a row for each id at most
    counts = np.zeros((4, size + 1))
    for r in found:
        counts[:, r["id"]] = [r[n] for n in names]
    return counts[:2].T, counts[2:].T


def _hot_counts(chunks: DataFrame, model: Bigrams) -> np.ndarray:
    out = pa.schema([("pair", pa.int32()), ("b", pa.int64()), ("t", pa.int64())])
    rank, size, top = model.rank, model.size, model.top

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros((2, top * top), dtype=np.int64)
        for row in _rows(batches):
            u, v, doc, target = _read(row, size)
            hot = (rank[u] < model.top) & (rank[v] < model.top)
            pair = rank[u[hot]] * model.top + rank[v[hot]]
            held[0] += np.bincount(pair, minlength=model.top * model.top)
            held[1] += np.bincount(pair[target[doc[hot]] > 0], minlength=model.top * model.top)
        at = np.flatnonzero(held[0])
        for lo in range(0, max(1, len(at)), 100_000):
            part = at[lo : lo + 100_000]
            yield pa.RecordBatch.from_arrays([pa.array(part, pa.int32()), pa.array(held[0][part]), pa.array(held[1][part])], schema=out)

    rows = chunks.select("target", "lengths", "ids").mapInArrow(run, "pair int, b long, t long")
    found = rows.groupBy("pair").agg(F.sum("b").alias("b"), F.sum("t").alias("t")).toArrow()  # top * top rows at most
    counts = np.zeros((model.top * model.top, 2))
    at = found.column("pair").to_numpy()
    counts[at, 0] = found.column("b").to_numpy()
    counts[at, 1] = found.column("t").to_numpy()
    return counts


SUMS = "row long, doc_id long, n_tokens long, b double, t double"


def _heavy(chunks: DataFrame, model: Bigrams, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted bigrams of oversized buckets that hold much of them, and their counts in each model."""
    rank = model.rank
    total = model.grand_total

    def cold_of(row: dict) -> tuple[np.ndarray, np.ndarray]:
        u, v, doc, target = _read(row, model.size)
        cold = (rank[u] >= model.top) | (rank[v] >= model.top)
        return model.pairs(u[cold], v[cold]), target[doc[cold]]

    def sizes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros(buckets, dtype=np.int64)
        for row in _rows(batches):
            held += np.bincount(_buckets(cold_of(row)[0], buckets).astype(np.int64), minlength=buckets)
        at = np.flatnonzero(held)
        yield pa.RecordBatch.from_pydict({"bucket": pa.array(at, pa.int32()), "n": pa.array(held[at])})

    rows = chunks.select("target", "lengths", "ids")
    found = rows.mapInArrow(sizes, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n")).where(F.col("n") > 2 * model.bucket_tokens)
    large = np.array(sorted(r["bucket"] for r in found.collect()), dtype=np.uint64)  # under one for each bucket
    if not len(large):
        return np.zeros(0, dtype=np.uint64), np.zeros((0, 2))
    least = max(model.bucket_tokens // 4, int(total // HEAVY_MOST) + 1)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            pair, flag = cold_of(row)
            inside = np.isin(_buckets(pair, buckets), large)
            pair, place = np.unique(pair[inside], return_inverse=True)
            n, t = np.bincount(place, minlength=len(pair)), np.bincount(place, weights=flag[inside], minlength=len(pair))
            yield pa.RecordBatch.from_pydict({"pair": pa.array(pair.astype(np.int64)), "b": pa.array(n.astype(np.int64)), "t": pa.array(t.astype(np.int64))})

    counted = rows.mapInArrow(count, "pair long, b long, t long").groupBy("pair").agg(F.sum("b").alias("b"), F.sum("t").alias("t"))
    table = counted.where(F.col("b") >= least).toArrow().sort_by("pair")  # total / least rows at most
    return table.column("pair").to_numpy().astype(np.uint64), np.stack([table.column(c).to_numpy().astype(np.float64) for c in ("b", "t")], axis=1)


def _near_sums(chunks: DataFrame, model: Bigrams, counts: np.ndarray, heavy: tuple[np.ndarray, np.ndarray]) -> DataFrame:
    """For each document: its number of tokens, and the cost of its hot and heavy bigrams."""
    out = pa.schema([("row", pa.int64()), ("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("b", pa.float64()), ("t", pa.float64())])
    rank, (names, held) = model.rank, heavy

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            pair, u, v, d, n, own = _entries(row, model)
            hot = (rank[u] < model.top) & (rank[v] < model.top)
            here = np.zeros((len(pair), 2))
            here[hot] = counts[rank[u[hot]] * model.top + rank[v[hot]]]
            if len(names):
                place = np.minimum(np.searchsorted(names, pair), len(names) - 1)
                is_heavy = (names[place] == pair) & ~hot
                here[is_heavy] = held[place[is_heavy]]
                hot |= is_heavy
            docs = len(row["doc_ids"])
            lengths = np.frombuffer(row["lengths"], dtype="<u4").astype(np.int64)
            cost = _costs(model, u[hot], v[hot], here[hot], own[:, hot])
            sums = [np.bincount(d[hot], weights=n[hot] * cost[k], minlength=docs) for k in range(2)]
            yield pa.RecordBatch.from_arrays(
                [pa.array((row["chunk"] << 16) + np.arange(docs)), pa.array(row["doc_ids"], pa.int64()), pa.array(lengths), *map(pa.array, sums)], schema=out
            )

    return chunks.mapInArrow(run, SUMS)


def _costs(model: Bigrams, u: np.ndarray, v: np.ndarray, counts: np.ndarray, own: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bits in the background, and in the target without the document itself."""
    both = model.costs(u, v, counts)
    background, target = both[:, 0], both[:, 1].copy()
    mine = own[3] > 0
    if mine.any():
        target[mine] = model.own_costs(u[mine], v[mine], counts[mine, 1], own[:, mine])
    return background, target


def _cold_sums(chunks: DataFrame, model: Bigrams, buckets: int, heavy: np.ndarray) -> DataFrame:
    """For each document and bucket: the cost of its other bigrams."""
    rank, size = model.rank, model.size
    blocks = pa.schema([("bucket", pa.int32()), ("chunk", pa.int64()), ("block", pa.binary())])
    out = pa.schema([("row", pa.int64()), ("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("b", pa.float64()), ("t", pa.float64())])

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = zstandard.ZstdCompressor(level=3)
        for row in _rows(batches):
            pair, u, v, d, n, own = _entries(row, model)
            cold = ((rank[u] >= model.top) | (rank[v] >= model.top)) & ~np.isin(pair, heavy)
            pair, d, n, own = pair[cold], d[cold], n[cold], own[:, cold]
            bucket = _buckets(pair, buckets)
            order = np.argsort(bucket, kind="stable")
            pair, d, n, own, bucket = pair[order], d[order], n[order], own[:, order], bucket[order]
            ends = np.searchsorted(bucket, np.arange(buckets), side="right").tolist()
            numbers, packed = [], []
            for k, (lo, hi) in enumerate(zip([0, *ends], ends)):
                if lo == hi:
                    continue
                names, mine = pair[lo:hi].astype("<u4"), own[3, lo:hi] > 0
                raw = struct.pack("<I", hi - lo) + np.diff(names, prepend=np.uint32(0)).astype("<u4").tobytes() + d[lo:hi].astype("<u2").tobytes()
                raw += n[lo:hi].astype("<u4").tobytes() + mine.astype(np.uint8).tobytes() + own[1:, lo:hi][:, mine].astype("<u4").tobytes()
                numbers.append(k)
                packed.append(packer.compress(raw))
            yield pa.RecordBatch.from_arrays(
                [pa.array(numbers, pa.int32()), pa.array([row["chunk"]] * len(numbers), pa.int64()), pa.array(packed, pa.binary())], schema=blocks
            )

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpacker = zstandard.ZstdDecompressor()
        pairs, rows, ns, flags, owns = [], [], [], [], []
        for batch in batches:
            for chunk, block in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                raw = unpacker.decompress(block)
                (k,) = struct.unpack_from("<I", raw)
                pairs.append(np.cumsum(np.frombuffer(raw, "<u4", k, 4), dtype=np.uint32))
                rows.append((chunk << 16) + np.frombuffer(raw, "<u2", k, 4 + 4 * k).astype(np.int64))
                ns.append(np.frombuffer(raw, "<u4", k, 4 + 6 * k))
                flags.append(np.frombuffer(raw, np.uint8, k, 4 + 10 * k))
                owns.append(np.frombuffer(raw, "<u4", -1, 4 + 11 * k).reshape(3, -1))
        if not pairs:
            return
        n, mine = np.concatenate(ns).astype(np.float64), np.concatenate(flags) > 0
        values, inverse = np.unique(np.concatenate(pairs), return_inverse=True)
        counts = np.stack([np.bincount(inverse, weights=n), np.bincount(inverse, weights=n * mine)], axis=1)
        u, v = np.divmod(values.astype(np.int64), size + 1)
        both = model.costs(u, v, counts)
        cost = [both[inverse, 0], both[inverse, 1]]
        at = inverse[mine]
        own = np.concatenate([n[mine][None, :], np.concatenate(owns, axis=1)])
        cost[1][mine] = model.own_costs(u[at], v[at], counts[at, 1], own)
        keys, place = np.unique(np.concatenate(rows), return_inverse=True)
        sums = [np.bincount(place, weights=n * cost[k]) for k in range(2)]
        for lo in range(0, len(keys), 100_000):
            part = slice(lo, lo + 100_000)
            m = len(keys[part])
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys[part]), pa.nulls(m, pa.int64()), pa.nulls(m, pa.int64()), pa.array(sums[0][part]), pa.array(sums[1][part])], schema=out
            )

    sent = chunks.select("chunk", "target", "lengths", "ids").mapInArrow(send, "bucket int, chunk long, block binary")
    return sent.repartitionById(buckets, F.col("bucket")).mapInArrow(score, SUMS)


def score_documents(docs: DataFrame, target: DataFrame, tokenizer: str | None = None, size: int = SIZE) -> DataFrame:
    """Cross entropies of each row of ``docs`` (``doc_id``, ``text``); ``target``: the ``doc_id`` of the target documents.

    ``size``: the number of ids of the tokenizer (under 65,535).
    """
    spark = docs.sparkSession
    chosen = pick(target, doc_id="long").where("doc_id is not null").distinct().withColumn("chosen", F.lit(True)).checkpoint()
    chosen = F.broadcast(chosen) if chosen.count() <= BROADCAST_IDS else chosen
    flagged = pick(docs, doc_id="long", text="string").join(chosen, "doc_id", "left").select("doc_id", "text", F.coalesce("chosen", F.lit(False)).alias("target"))
    path = scratch_path(spark, "lm-chunks")
    _chunks(flagged, tokenizer or tokenizer_path()).write.parquet(path)
    chunks = spark.read.parquet(path)

    tokens, contexts = _token_counts(chunks, size)
    model = Bigrams(tokens, contexts)
    hot = _hot_counts(chunks, model)
    buckets = max(16, int(np.ceil(model.grand_total / model.bucket_tokens)))
    heavy = _heavy(chunks, model, buckets)
    sums = _near_sums(chunks, model, hot, heavy).union(_cold_sums(chunks, model, buckets, heavy[0]))
    totals = sums.groupBy("row").agg(F.max("doc_id").alias("doc_id"), F.sum("n_tokens").alias("n"), F.sum("b").alias("b"), F.sum("t").alias("t"))
    mean = lambda c: F.round(F.when(F.col("n") > 0, F.col(c) / F.col("n")).otherwise(0.0), 6)
    return totals.select(
        "doc_id",
        F.col("n").alias("n_tokens"),
        mean("t").alias("target_bits"),
        mean("b").alias("background_bits"),
        F.round(F.when(F.col("n") > 0, (F.col("t") - F.col("b")) / F.col("n")).otherwise(0.0), 6).alias("difference"),
    )
