"""Alignment of two tokenizers' ids over the same bytes, by white-space anchors.

A text is given to both tokenizers whole.  Token ends are byte offsets; where
both have an end and the next token of either starts with a space, the text is
cut (an anchor), after the joined bytes of both are found equal to the text's.
Between two anchors lies a window: the ids of either side.  Equal windows align
alike, so each run of texts (about RUN_CHARS characters of one task) keeps a
memo from the tuple of ids to the window's groups and links, and the new
windows of some texts are aligned together in numpy; windows without a space
mark inside them may be long (scripts without spaces) and are not kept in the
memo.

The corpus counts go through the runs as well:

1. a task writes, for each run, its distinct linked id pairs with their counts,
   the pairs of each window, and for each text the numbers of its windows;
2. counts are added up by id pair and the highest of each B id is marked.  A
   run holds a pair once, however often its texts have it, so no pair is a hot
   key;
3. each run's counts come back to it, and the sums of its texts are taken from
   windows and pairs in numpy.

Everything between the steps is bounded by a run; the runs are written once to
the shared folder, so a lost executor repeats no tokenisation.  Nothing of the
vocabulary's square is broadcast.

Defined results: a text that is NULL or empty, or whose tokens' joined bytes
differ from a space and the text, has no tokens (zeros and empty strings);
repeated rows and NULL ids come out one by one and all count; a very long text
is a run of its own, tokenised in parts cut between two letters and a single
space, where neither tokenizer joins.  An empty table gives an empty result.
"""

from __future__ import annotations

import base64
import hashlib
import os
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioflow.llm.batches import pick, slices
from folioflow.llm.runs import by_run
from folioflow.llm.word_tokens import byte_letters, tokenizer_path
from folioflow.session import scratch_path

RUN_CHARS = 8_000_000  # characters of the texts of a run
RUN_TEXT = 200  # characters that a text counts for at least
PART_CHARS = 200_000  # longer texts are tokenised in parts
MEMO_IDS = 64  # ids of the longest window that is kept in the memo
SPACE_MARK = "▁"

RUN_SCHEMA = (
    "t long, kind int, at int, a int, b int, n long, doc_id long, n_a long, n_b long, n_groups long, n_links long,"
    " groups_sha256 string, groups string, windows binary, lengths binary"
)
PAIR, WINDOWS, TEXT = range(3)


class Tokens:
    """The bytes of one tokenizer's tokens, all in one array."""

    def __init__(self, tokens: list[bytes]) -> None:
        self.flat = np.frombuffer(b"".join(tokens), dtype=np.uint8)
        self.length = np.array([len(t) for t in tokens], dtype=np.int64)
        self.start = np.cumsum(self.length) - self.length
        self.marked = np.array([t[:1] == b" " for t in tokens])

    def joined(self, ids: np.ndarray) -> bytes:
        """The bytes of ``ids``, one after another."""
        length = self.length[ids]
        behind = np.cumsum(length)
        at = np.arange(behind[-1] if len(behind) else 0) + np.repeat(self.start[ids] - (behind - length), length)
        return self.flat[at].tobytes()


class Aligner:
    """Both tokenizers with the bytes of their tokens, and the alignment of windows."""

    _open: dict[tuple[str, str], Aligner] = {}

    @classmethod
    def open(cls, a_path: str, b_path: str) -> Aligner:
        if (a_path, b_path) not in cls._open:
            cls._open[a_path, b_path] = cls(a_path, b_path)
        return cls._open[a_path, b_path]

    def __init__(self, a_path: str, b_path: str) -> None:
        import sentencepiece

        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        a_tokens, self.a = _byte_level(a_path)
        b_tokens = [self._piece(i) for i in range(self.b.get_piece_size())]
        self.a_tokens, self.b_tokens = Tokens(a_tokens), Tokens(b_tokens)
        self.names = [str(i) for i in range(max(len(a_tokens), len(b_tokens)))]

    def _piece(self, i: int) -> bytes:
        if self.b.is_byte(i):
            return bytes([int(self.b.id_to_piece(i)[3:5], 16)])
        return self.b.id_to_piece(i).replace(SPACE_MARK, " ").encode("utf-8")

    def encode(self, texts: list[str]) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """Ids of either side for each text."""
        cut = [_parts(t) for t in texts]
        ends = np.cumsum([len(ps) for ps in cut]).tolist()
        parts = list(chain.from_iterable(cut))
        a = self.a([" " + p for p in parts])
        b = self.b.encode(parts, num_threads=1) if parts else []
        return tuple([np.array(list(chain.from_iterable(x[e - len(ps) : e])), dtype=np.uint32) for ps, e in zip(cut, ends)] for x in (a, b))

    def tokens(self, texts: list[str]) -> tuple[list[bool], np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Which texts both sides join to, and their ids: (whole, ids of A, number in each text, ids of B, number in each text)."""
        a, b = self.encode(texts)
        sides = []
        for ids, tokens in ((a, self.a_tokens), (b, self.b_tokens)):
            flat = np.concatenate([*ids, np.zeros(0, dtype=np.uint32)])
            ends = np.concatenate([[0], np.cumsum(tokens.length[flat])])[np.cumsum([len(i) for i in ids])].tolist() if ids else []
            sides.append((memoryview(tokens.joined(flat)), ends))
        whole = []
        for k, text in enumerate(texts):
            raw = (" " + text).encode("utf-8")
            whole.append(bool(text) and all(joined[(ends[k - 1] if k else 0) : ends[k]] == raw for joined, ends in sides))
        kept = [[i for i, ok in zip(ids, whole) if ok] for ids in (a, b)]
        flat = [np.concatenate([*ids, np.zeros(0, dtype=np.uint32)]) for ids in kept]
        numbers = [np.array([len(i) for i in ids], dtype=np.int64) for ids in kept]
        return whole, flat[0], numbers[0], flat[1], numbers[1]

    def anchors(self, a: np.ndarray, a_n: np.ndarray, b: np.ndarray, b_n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places in ``a`` and ``b`` where a window starts: an end that both share before space-marked tokens, and every text's start."""
        a_at, b_at = (np.concatenate([[0], np.cumsum(t.length[i])[:-1]]) for i, t in ((a, self.a_tokens), (b, self.b_tokens)))
        a_cut, b_cut = self.a_tokens.marked[a], self.b_tokens.marked[b]
        a_cut[np.cumsum(a_n) - a_n] = True
        b_cut[np.cumsum(b_n) - b_n] = True
        place = np.full(int(a_at[-1]) + 1, -1, dtype=np.int64)
        a_cut = np.flatnonzero(a_cut)
        place[a_at[a_cut]] = a_cut
        b_cut = np.flatnonzero(b_cut)
        b_cut = b_cut[b_at[b_cut] < len(place)]
        partner = place[b_at[b_cut]]
        return partner[partner >= 0], b_cut[partner >= 0]

    def align(self, windows: list[tuple[bytes, bytes]]) -> tuple[list[str], np.ndarray, np.ndarray, np.ndarray]:
        """Groups as text and their number for each window, links of each window, and all links (A id above B id)."""
        a, b = (np.frombuffer(b"".join(w[k] for w in windows), dtype="<u4").astype(np.int64) for k in (0, 1))
        a_last, b_last = (np.cumsum([len(w[k]) // 4 for w in windows]) for k in (0, 1))
        a_ends, b_ends = np.cumsum(self.a_tokens.length[a]), np.cumsum(self.b_tokens.length[b])
        a_starts, b_starts = a_ends - self.a_tokens.length[a], b_ends - self.b_tokens.length[b]
        # the B tokens that overlap each A token: windows share both ends, so none crosses a window
        first, last = np.searchsorted(b_ends, a_starts, side="right"), np.searchsorted(b_starts, a_ends, side="left")
        n = last - first
        which = np.repeat(first - (np.cumsum(n) - n), n) + np.arange(n.sum())
        links = np.repeat(a, n) << 32 | b[which]
        n_links = np.diff(np.concatenate([[0], np.cumsum(n)])[np.concatenate([[0], a_last])])
        shared = np.searchsorted(b_ends, a_ends)
        closes = np.flatnonzero(b_ends[np.minimum(shared, len(b_ends) - 1)] == a_ends)
        n_groups = np.diff(np.searchsorted(closes, np.concatenate([[0], a_last])))
        a_to, b_to = (closes + 1).tolist(), (shared[closes] + 1).tolist()
        a_names, b_names = ([self.names[i] for i in x.tolist()] for x in (a, b))
        groups = [
            (a_names[p] if q - p == 1 else ",".join(a_names[p:q])) + "|" + (b_names[r] if s - r == 1 else ",".join(b_names[r:s]))
            for p, q, r, s in zip([0, *a_to], a_to, [0, *b_to], b_to)
        ]
        ends = np.cumsum(n_groups).tolist()
        texts = [groups[p] if q - p == 1 else ";".join(groups[p:q]) for p, q in zip([0, *ends], ends)]
        return texts, n_groups, n_links, links


def _byte_level(path: str):
    """Token bytes of a byte-level tokenizer's file, and its encoder of whole texts.

    A vocabulary of ranks beside the file (``.tiktoken``) gives the same ids,
    several times faster; it is used if its tokens are those of the file.
    """
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True
    back = {c: i for i, c in enumerate(byte_letters())}
    names = [tokenizer.id_to_token(i) or "" for i in range(tokenizer.get_vocab_size())]
    tokens = [bytes(back[c] for c in t) if all(c in back for c in t) else b"" for t in names]
    special = set(tokenizer.get_added_tokens_decoder())
    tokens = [b"" if i in special else t for i, t in enumerate(tokens)]
    ranked = re.sub(r"\.json$", ".tiktoken", path)
    if os.path.isfile(ranked):
        import public_tokenizers
        import tiktoken

        with open(ranked, "rb") as f:
            ranks = {base64.b64decode(t): int(i) for t, i in map(bytes.split, f)}
        if ranks == {t: i for i, t in enumerate(tokens) if t}:
            fast = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
            return tokens, lambda texts: [fast.encode_ordinary(t) for t in texts]
    return tokens, lambda texts: [e.ids for e in tokenizer.encode_batch(texts, add_special_tokens=False)] if texts else []


BETWEEN_WORDS = re.compile(r"(?<=[a-z]) (?=[a-z])")


def _parts(text: str) -> list[str]:
    """A text in parts of about PART_CHARS characters, each without the space before it, which both tokenizers get back."""
    parts, lo = [], 0
    while len(text) - lo > PART_CHARS:
        found = BETWEEN_WORDS.search(text, lo + PART_CHARS)
        if found is None:
            break
        parts.append(text[lo : found.start()])
        lo = found.end()
    return [*parts, text[lo:]] if text else []


class _Run:
    """What a run of texts has met: its windows, by their id tuples where they are short, with their alignments."""

    def __init__(self, t: int) -> None:
        self.t, self.chars = t, 0
        self.memo: dict[tuple[bytes, bytes], int] = {}
        self.texts: list[str] = []  # groups of each window
        self.n_groups: list[np.ndarray] = []
        self.n_links: list[np.ndarray] = []
        self.links: list[np.ndarray] = []
        self.counts: list[np.ndarray] = []  # windows of the texts so far, as numbers

    def numbers(self, aligner: Aligner, keys: list[tuple[bytes, bytes]]) -> np.ndarray:
        """The numbers of windows; those not met yet are aligned together."""
        known = list(map(self.memo.get, keys))
        new: dict[tuple[bytes, bytes], int] = {}
        size = len(self.texts)
        for k, number in enumerate(known):
            if number is None:
                known[k] = new.setdefault(keys[k], size + len(new))
        if new:
            texts, n_groups, n_links, links = aligner.align(list(new))
            self.texts += texts
            self.n_groups.append(n_groups)
            self.n_links.append(n_links)
            self.links.append(links)
            self.memo.update({w: i for w, i in new.items() if len(w[0]) + len(w[1]) <= 4 * MEMO_IDS})
        return np.array(known, dtype=np.int64)

    def rows_of(self, aligner: Aligner, texts: list[str]) -> dict[str, list]:
        """Columns of the run's texts."""
        whole, a, a_n, b, b_n = aligner.tokens(texts)
        self.chars += sum(max(RUN_TEXT, len(t)) for t in texts)
        out: dict[str, list] = {}
        values = {"n_a": a_n, "n_b": b_n, "n_groups": a_n, "n_links": a_n}
        groups, windows = [], []
        if any(whole):
            p, r = aligner.anchors(a, a_n, b, b_n)
            a_raw, b_raw = a.astype("<u4").tobytes(), b.astype("<u4").tobytes()
            p4, r4 = (4 * p).tolist(), (4 * r).tolist()
            keys = [(a_raw[i:j], b_raw[k:m]) for i, j, k, m in zip(p4, [*p4[1:], len(a_raw)], r4, [*r4[1:], len(b_raw)])]
            numbers = self.numbers(aligner, keys)
            self.counts.append(numbers)
            first = np.searchsorted(p, np.cumsum(a_n) - a_n)
            self.n_groups, self.n_links = [np.concatenate(self.n_groups)], [np.concatenate(self.n_links)]
            values |= {"n_groups": np.add.reduceat(self.n_groups[0][numbers], first), "n_links": np.add.reduceat(self.n_links[0][numbers], first)}
            named = list(map(self.texts.__getitem__, numbers.tolist()))
            raw = numbers.astype("<u4").tobytes()
            for lo, hi in zip(first.tolist(), [*first.tolist()[1:], len(named)]):
                groups.append(";".join(named[lo:hi]))
                windows.append(raw[4 * lo : 4 * hi])
        place = iter(range(len(groups)))
        at = [next(place) if ok else None for ok in whole]
        for n, v in values.items():
            v = v.tolist()
            out[n] = [0 if k is None else v[k] for k in at]
        out["groups"] = ["" if k is None else groups[k] for k in at]
        out["windows"] = [b"" if k is None else windows[k] for k in at]
        return out

    def rows(self, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
        """The run's pairs with their counts, and the pairs of its windows."""
        none = np.zeros(0, dtype=np.int64)
        links, lengths = np.concatenate([none, *self.links]), np.concatenate([none, *self.n_links])
        seen = np.bincount(np.concatenate([none, *self.counts]), minlength=len(lengths))
        pairs, flat = np.unique(links, return_inverse=True)
        counts = np.bincount(flat, weights=np.repeat(seen, lengths), minlength=len(pairs)).astype(np.int64)
        a, b, at = (pairs >> 32).astype(np.int32), (pairs & 0xFFFFFFFF).astype(np.int32), np.arange(len(pairs), dtype=np.int32)
        yield _batch(schema, len(pairs), t=self.t, kind=PAIR, at=at, a=a, b=b, n=counts)
        yield _batch(schema, 1, t=self.t, kind=WINDOWS, at=0, windows=[flat.astype("<u4").tobytes()], lengths=[lengths.astype("<u4").tobytes()])


def _batch(schema: pa.Schema, rows: int, **columns) -> pa.RecordBatch:
    """A batch of ``rows`` rows; a scalar fills its column, a column not given is NULL."""
    arrays = []
    for f in schema:
        v = columns.get(f.name)
        if v is None:
            arrays.append(pa.nulls(rows, f.type))
        elif isinstance(v, (int, str)):
            arrays.append(pa.repeat(pa.scalar(v, f.type), rows))
        else:
            arrays.append(pa.array(v, type=f.type))
    return pa.RecordBatch.from_arrays(arrays, schema=schema)


ARROW = pa.schema(
    [("t", pa.int64()), *[(c, pa.int32()) for c in ("kind", "at", "a", "b")], *[(c, pa.int64()) for c in ("n", "doc_id", "n_a", "n_b", "n_groups", "n_links")],
     ("groups_sha256", pa.string()), ("groups", pa.string()), ("windows", pa.binary()), ("lengths", pa.binary())]
)


def _aligned_runs(docs: DataFrame, a_path: str, b_path: str, keep_groups: bool) -> DataFrame:
    """All texts tokenised and cut into windows, run by run."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = Aligner.open(a_path, b_path)
        first = TaskContext.get().partitionId() << 32
        current, runs = _Run(first), 0
        for batch in slices(batches, 128):
            ids, texts = batch.column(0).to_pylist(), [t or "" for t in batch.column(1).to_pylist()]
            got = current.rows_of(aligner, texts)
            shas = [hashlib.sha256(g.encode()).hexdigest() if g else "" for g in got["groups"]]
            if not keep_groups:
                del got["groups"]
            yield _batch(ARROW, len(ids), t=current.t, kind=TEXT, at=0, doc_id=ids, groups_sha256=shas, **got)
            if current.chars > RUN_CHARS:
                yield from current.rows(ARROW)
                runs += 1
                current = _Run(first + runs)
        yield from current.rows(ARROW)

    return docs.mapInArrow(run, RUN_SCHEMA)


def _scored(run: pa.Table) -> pa.Table:
    """The texts of one run with their sums; ``run`` holds its pairs in order, its windows and its texts."""
    kind = run.column("kind").to_numpy()
    pairs, texts = run.filter(pa.array(kind == PAIR)), run.filter(pa.array(kind == TEXT))
    held = run.filter(pa.array(kind == WINDOWS))
    count = pairs.column("n").to_numpy()
    best = pairs.column("best").to_numpy(zero_copy_only=False).astype(np.int64)
    flat = np.frombuffer(held.column("windows")[0].as_py(), dtype="<u4")
    starts = np.concatenate([[0], np.cumsum(np.frombuffer(held.column("lengths")[0].as_py(), dtype="<u4"))]).astype(np.int64)
    by_window = [np.diff(np.concatenate([[0], np.cumsum(v[flat])])[starts]) for v in (best, count)]
    n_best, count_sum = [], []
    for raw in texts.column("windows"):
        numbers = np.frombuffer(raw.as_buffer(), dtype="<u4")
        n_best.append(int(by_window[0][numbers].sum()))
        count_sum.append(int(by_window[1][numbers].sum()))
    names = ["doc_id", "n_a", "n_b", "n_groups", "n_links"]
    out = {n: texts.column(n) for n in names} | {"n_best": pa.array(n_best, pa.int64()), "count_sum": pa.array(count_sum, pa.int64())}
    return pa.table(out | {n: texts.column(n) for n in ("groups_sha256", "groups")})


def pair_counts(runs: DataFrame) -> DataFrame:
    """(a, b, count, best): links of each id pair in the whole corpus, and whether no pair of this B id has more."""
    counts = runs.where(F.col("kind") == PAIR).groupBy("a", "b").agg(F.sum("n").alias("count"))
    highest = counts.groupBy("b").agg(F.max("count").alias("highest"))
    return counts.join(highest, "b").select("a", "b", "count", (F.col("count") == F.col("highest")).alias("best"))


def align_tokens(docs: DataFrame, a_path: str | None = None, b_path: str | None = None, keep_groups: bool = False) -> DataFrame:
    """A row for each row of ``docs`` (``doc_id``, ``text``): counts, digest and, if asked for, the groups themselves."""
    spark = docs.sparkSession
    a_path, b_path = a_path or tokenizer_path("byte_bpe_50k.json"), b_path or tokenizer_path("piece_bpe_32k.model")
    path = scratch_path(spark, "alignment-runs")
    _aligned_runs(pick(docs, doc_id="long", text="string"), a_path, b_path, keep_groups).write.parquet(path)
    runs = spark.read.schema(RUN_SCHEMA).parquet(path)
    counts = pair_counts(runs)
    pairs = runs.where(F.col("kind") == PAIR).select("t", "kind", "at", "a", "b").join(counts, ["a", "b"])
    texts = runs.where(F.col("kind") != PAIR)
    carried = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "groups", "windows", "lengths"]
    both = pairs.select("t", "kind", "at", F.col("count").alias("n"), "best").unionByName(
        texts.select("t", "kind", "at", *carried), allowMissingColumns=True
    )
    schema = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string, groups string"
    result = by_run(both, ["t"], ["kind", "at"], _scored, schema)
    return result if keep_groups else result.drop("groups")
