"""Language identification by prediction by partial matching.

Each language has a byte context tree of variable order (up to ``ORDER``
bytes of context) with escape probabilities (method C): a byte seen after the
longest context costs ``-log2(n(byte) / (n + d))``, where the context has
been followed ``n`` times by ``d`` different bytes; an unseen byte costs the
escape ``-log2(d / (n + d))`` and is then coded in the next shorter context,
at last at 8 bits.  The statistics are frozen after training, so the code
length of a text is an exact sum of table entries.  All languages share one
numbering of byte strings; a few array lookups for each byte give the longest
known string that ends there, with its cost in every language at once.

Training reads a bounded sample of labelled rows: about ``sample_docs`` rows
for each language (at most twice that; fewer if there are so many languages
that this would pass ``SAMPLE_ROWS`` rows), chosen by a hash of the row, whole
texts of at most ``sample_chars`` characters; where a language has too few of
those, the first ``sample_chars`` characters of longer ones as well.
Prediction reads whole texts.

Defined results: ``und`` with score 0 for a NULL text, a text without a
letter, or when there is no labelled row to learn from; equal code lengths go
to the language first in alphabetical order; repeated rows are alike.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folioflow.llm.batches import filter_rows, map_columns, pick

ORDER = 3
FOLDS = 5
SAMPLE_ROWS = 10_000
GROUP_BYTES = 400_000  # of texts whose code lengths are taken together: about 100 bytes each in a worker


class ContextTrees:
    """Byte context trees of several languages over one numbering of byte strings.

    Strings of length L have numbers ``offset[L] + 1 ..``; 0 means unknown.
    ``cost[g, l]``: bits for the last byte of string g after the bytes before
    it, in language l.  ``escapes[g, l]``: bits of all escapes from context g
    down to the empty context.
    """

    def __init__(self, samples: dict[str, list[bytes]], order: int = ORDER) -> None:
        self.languages = sorted(samples)
        self.order = order
        chunks, owners = [], []
        for k, lang in enumerate(self.languages):
            for raw in samples[lang]:
                part = np.frombuffer(raw, dtype=np.uint8).astype(np.int64) + 1
                chunks += [part, np.zeros(order + 1, dtype=np.int64)]
                owners += [np.full(len(part) + order + 1, k, dtype=np.int64)]
        seq = np.concatenate(chunks) if chunks else np.zeros(0, dtype=np.int64)
        owner = np.concatenate(owners) if owners else np.zeros(0, dtype=np.int64)
        known = np.unique(seq[seq > 0])
        self.symbol = np.zeros(257, dtype=np.int64)
        self.symbol[known] = np.arange(1, len(known) + 1)
        self.width = len(known) + 1
        sym = self.symbol[seq]
        n_lang = len(self.languages)

        level = sym  # number of the string of the current length that ends at each place
        self.keys: list[np.ndarray] = []  # for lengths 2 .. order + 1: parent * width + symbol, ascending
        count = self._counts(level, owner, len(known), n_lang)
        counts, parents, suffixes = [count], [np.zeros(len(known), dtype=np.int64)], [np.zeros(len(known), dtype=np.int64)]
        for _ in range(order):
            before = np.concatenate([[0], level[:-1]])
            key = np.where((before > 0) & (sym > 0), before * self.width + sym, 0)
            keys = np.unique(key)
            keys = keys[keys > 0]
            longer = np.where(key > 0, np.searchsorted(keys, key) + 1, 0)
            self.keys.append(keys)
            counts.append(self._counts(longer, owner, len(keys), n_lang))
            parents.append(keys // self.width)
            suffix = np.zeros(len(keys) + 1, dtype=np.int64)
            suffix[longer] = level
            suffixes.append(suffix[1:])
            level = longer
        self._price(counts, parents, suffixes)

    @staticmethod
    def _counts(level: np.ndarray, owner: np.ndarray, n: int, n_lang: int) -> np.ndarray:
        hit = level > 0
        flat = np.bincount((level[hit] - 1) * n_lang + owner[hit], minlength=n * n_lang)
        return flat.reshape(n, n_lang)

    def _price(self, counts: list, parents: list, suffixes: list) -> None:
        n_lang = len(self.languages)
        sizes = [len(c) for c in counts]
        self.offset = [0, *np.cumsum(sizes).tolist()]
        cost = np.zeros((1 + sum(sizes), n_lang))
        escapes = np.zeros((1 + sum(sizes), n_lang))
        cost[0] = 8.0  # a byte unknown everywhere, after all escapes
        for length, count in enumerate(counts, start=1):
            contexts = sizes[length - 2] + 1 if length > 1 else 1
            total = np.zeros((contexts, n_lang))
            kinds = np.zeros((contexts, n_lang))
            np.add.at(total, parents[length - 1], count)
            np.add.at(kinds, parents[length - 1], count > 0)
            every = np.maximum(total + kinds, 1)
            escape = np.where(kinds > 0, -np.log2(np.maximum(kinds, 1) / every), 0.0)
            if length == 1:
                escapes[0] = escape[0]
                shorter = np.full((len(count), n_lang), 8.0)
            else:
                lo = self.offset[length - 2]
                escapes[lo + 1 : lo + contexts] = escape[1:]
                shorter = cost[self._global(suffixes[length - 1], length - 1)]
            own = parents[length - 1]
            seen = -np.log2(np.maximum(count, 1) / every[own])
            lo = self.offset[length - 1]
            cost[lo + 1 : lo + 1 + len(count)] = np.where(count > 0, seen, escape[own] + shorter)
        for length in range(1, self.order + 1):  # sums of escapes, shorter contexts first
            lo, n = self.offset[length - 1], sizes[length - 1]
            below = self._global(suffixes[length - 1], length - 1) if length > 1 else np.zeros(n, dtype=np.int64)
            escapes[lo + 1 : lo + 1 + n] += escapes[below]
        self.cost = cost.astype(np.float32)
        self.escapes = escapes.astype(np.float32)

    def _global(self, numbers: np.ndarray, length: int) -> np.ndarray:
        return np.where(numbers > 0, numbers + self.offset[length - 1], 0)

    def tables(self) -> list[np.ndarray]:
        """For each length from 2: number of (string, next symbol), 0 if unknown."""
        if not hasattr(self, "_tables"):
            n = self.width - 1
            self._tables = []
            for keys in self.keys:
                table = np.zeros((n + 1) * self.width, dtype=np.int32)
                table[keys] = np.arange(1, len(keys) + 1)
                self._tables.append(table)
                n = len(keys)
        return self._tables

    def __getstate__(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if k != "_tables"}

    def code_lengths(self, texts: list[bytes]) -> np.ndarray:
        """Bits of each text in each language."""
        out = np.zeros((len(texts), len(self.languages)))
        lo = 0
        while lo < len(texts):
            hi, held = lo + 1, len(texts[lo])
            while hi < len(texts) and held + len(texts[hi]) <= GROUP_BYTES:
                held += len(texts[hi])
                hi += 1
            out[lo:hi] = self._lengths(texts[lo:hi])
            lo = hi
        return out

    def _lengths(self, texts: list[bytes]) -> np.ndarray:
        tables = self.tables()
        start = np.cumsum([0, *[len(t) for t in texts]])
        raw = np.frombuffer(b"".join(texts), dtype=np.uint8)
        out = np.zeros((len(texts), len(self.languages)))
        if not len(raw):
            return out
        # bytes since the text's start: a context never reaches into the text before
        since = np.full(len(raw), self.order, dtype=np.int8)
        for d in range(self.order):
            at = start[:-1] + d
            since[at[(at < start[1:])]] = d
        sym = self.symbol[raw.astype(np.int64) + 1]
        levels = [sym]
        for k, table in enumerate(tables):
            before = np.concatenate([[0], levels[-1][:-1]])
            before = np.where(since > k, before, 0)
            longer = table[before * self.width + sym].astype(np.int64)
            levels.append(longer)
        best = self._global(levels[0], 1)
        context = np.zeros(len(raw), dtype=np.int64)  # context of the longest known string
        deepest = np.zeros(len(raw), dtype=np.int64)  # longest known context
        for k in range(1, len(levels)):
            before = np.where(since >= k, np.concatenate([[0], levels[k - 1][:-1]]), 0)
            before = self._global(before, k)
            deepest = np.where(before > 0, before, deepest)
            hit = levels[k] > 0
            best = np.where(hit, self._global(levels[k], k + 1), best)
            context = np.where(hit, before, context)
        bits = self.cost[best]
        more = np.flatnonzero(deepest != context)
        bits[more] += self.escapes[deepest[more]] - self.escapes[context[more]]
        unknown = np.flatnonzero(best == 0)
        bits[unknown] += self.escapes[0]
        full = np.flatnonzero(start[1:] > start[:-1])
        out[full] = np.add.reduceat(bits, start[:-1][full], axis=0, dtype=np.float64)
        return out

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        """Language and posterior (uniform prior) of each text."""
        good = [bool(self.languages) and t is not None and any(map(str.isalpha, t)) for t in texts]
        raw = [t.encode("utf-8") if ok else b"" for t, ok in zip(texts, good)]
        bits = self.code_lengths(raw) if self.languages else np.zeros((len(texts), 0))
        langs, scores = [], []
        for ok, row in zip(good, bits):
            if not ok:
                langs.append("und")
                scores.append(0.0)
                continue
            k = int(np.argmin(row))
            langs.append(self.languages[k])
            scores.append(1.0 / float(np.sum(np.exp2(np.maximum(row[k] - row, -1000.0)))))
        return langs, scores


def held_out(doc_id: Column) -> Column:
    """Whether a document's labels are kept from training."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % FOLDS == 0, F.lit(False))


def train(docs: DataFrame, sample_docs: int = 200, sample_chars: int = 20_000, order: int = ORDER) -> ContextTrees:
    """Context trees from a bounded sample of the labelled rows that are not held out."""
    rows = pick(docs, doc_id="long", text="string", lang="string").where(
        F.col("lang").isNotNull() & ~held_out(F.col("doc_id")) & F.col("text").isNotNull()
    )
    # texts over the bound are needed only where a language has too few under it, and then their first characters
    short = F.length("text") <= sample_chars
    rows = rows.where(F.length("text") > 0)
    place = F.pmod(F.xxhash64("doc_id", "text"), F.lit(2**30)) / F.lit(float(2**30))
    different = lambda some: F.approx_count_distinct(F.when(some, place), 0.02)  # noqa: E731 - equal rows have one place
    found = rows.groupBy("lang").agg(different(short).alias("n"), different(~short).alias("longer")).collect()
    counts = {r["lang"]: r["n"] for r in found}
    longer = {r["lang"]: r["longer"] for r in found}
    sample_docs = max(1, min(sample_docs, SAMPLE_ROWS // max(1, len(counts))))
    # one condition for each language: a share of the hash range that holds about sample_docs rows
    chosen = F.lit(False)
    for lang, n in counts.items():
        own = short & (place < F.lit(min(1.0, sample_docs / max(1, n))))
        if n < sample_docs and longer[lang]:
            own = own | (~short & (place < F.lit(min(1.0, (sample_docs - n) / longer[lang]))))
        chosen = chosen | ((F.col("lang") == lang) & own)
    samples: dict[str, list[bytes]] = {lang: [] for lang in counts}
    if counts:
        # rows that are alike count once, and each language has its own least places: the same rows in every run
        alike = rows.where(chosen).groupBy("lang", place.alias("place")).agg(F.min(F.substring("text", 1, sample_chars)).alias("text"))
        first = F.row_number().over(Window.partitionBy("lang").orderBy("place"))
        picked = alike.withColumn("first", first).where(F.col("first") <= 2 * sample_docs).collect()
        for row in sorted(picked, key=lambda r: (r["lang"], r["text"])):
            samples[row["lang"]].append(row["text"].encode("utf-8"))
    return ContextTrees({k: v for k, v in samples.items() if v}, order)


SCHEMA = {"doc_id": "long", "held_out": "boolean", "lang_pred": "string", "score": "double"}


def identify_language(docs: DataFrame, model: ContextTrees | None = None) -> DataFrame:
    """The predicted language of each row of ``docs`` (``doc_id``, ``text``; ``lang`` for training)."""
    trees = model or train(docs)
    rows = pick(docs, doc_id="long", text="string").select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "text")

    def start():
        def work(cols):
            langs, scores = trees.predict(cols["text"])
            return {"doc_id": cols["doc_id"], "held_out": cols["held_out"], "lang_pred": langs, "score": scores}

        return work

    return map_columns(rows, SCHEMA, start)


def keep_identified(docs: DataFrame, least_score: float = 0.5, model: ContextTrees | None = None) -> DataFrame:
    """The rows of ``docs`` with a predicted language of at least ``least_score``, all columns kept."""
    trees = model or train(docs)

    def start():
        def work(texts):
            langs, scores = trees.predict(texts)
            return [lang != "und" and score >= least_score for lang, score in zip(langs, scores)]

        return work

    return filter_rows(docs, "text", start)
