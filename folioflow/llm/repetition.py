"""Quality rules by repetition coverage.

Rolling hashes of several n-gram lengths over the words of a text tell which
windows of words occur twice or more; the verdict measures the characters
inside such windows and inside repeated lines against all characters in
words.  The windows of every text of a group are hashed and sorted together
in numpy, so the cost is a few array passes for each word.

Defined results: a NULL or empty text has no words, fails the base rule
(too few words) and is not kept; repeated rows are judged alike, each on its
own text alone; a text of any length is read whole.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import xxhash
from pyspark.sql import DataFrame

from folioflow.llm.batches import filter_rows, groups, map_columns, pick

SYMBOLS = re.compile(r"[#*$%&|<>]")
SPACES = "\x20\x09\x0a\x0b\x0c\x0d"
ROLL = np.uint64(0x9E3779B97F4A7C15)


@dataclass(frozen=True)
class RepetitionRules:
    """Limits of the verdict, as shares of the characters in words.

    ``ngram_limits``: for each window length in words, the largest share of
    characters inside windows found twice or more.  ``line_limit``: the
    largest share inside lines equal to an earlier line.
    """

    min_words: int = 20
    base_window: int = 8
    base_percent: int = 30
    ngram_limits: tuple[tuple[int, float], ...] = ((5, 0.35), (6, 0.34), (7, 0.33), (8, 0.32), (9, 0.31), (10, 0.30))
    line_limit: float = 0.30


SCHEMA = {
    "doc_id": "long",
    "n_words": "long",
    "word_chars": "long",
    "n_symbols": "long",
    "n_dup_lines": "long",
    "n_repeat_words": "long",
    "base_failed": "boolean",
    "kept": "boolean",
    "ngram_share": "double",
    "line_share": "double",
}


def _covered(hashes: np.ndarray, doc: np.ndarray, lengths: list[int]) -> dict[int, np.ndarray]:
    """For each window length: which words lie in a window found twice in their own text.

    A window found twice holds only shorter windows found twice, so each
    length looks only at the places that the one before left over.
    """
    n = len(hashes)
    out: dict[int, np.ndarray] = {}
    places: np.ndarray | None = None
    salt = (doc.astype(np.uint64) + np.uint64(1)) * np.uint64(0xD6E8FEB86659FD93)
    rolling, width = hashes.copy(), 1
    for length in lengths:
        while width < length:  # rolling[i] covers words i .. i + width - 1
            rolling = rolling[: max(0, n - width)] * ROLL + hashes[width:]
            width += 1
        marks = np.zeros(n + 1, dtype=np.int64)
        if n >= length:
            at = np.arange(n - length + 1) if places is None else places[places <= n - length]
            at = at[doc[at] == doc[at + length - 1]]
            key = rolling[at] ^ salt[at]
            order = np.argsort(key, kind="stable")
            key = key[order]
            same = key[1:] == key[:-1]
            twice = np.zeros(len(key), dtype=bool)
            twice[1:] |= same
            twice[:-1] |= same
            places = np.sort(at[order[twice]])
            marks[places] += 1
            marks[places + length] -= 1
        out[length] = np.cumsum(marks[:n]) > 0
    return out


def measure(texts: list[str], rules: RepetitionRules) -> dict[str, list]:
    """The measures and verdict of each text."""
    out: dict[str, list] = {k: [] for k in SCHEMA if k != "doc_id"}
    lengths = sorted({rules.base_window, *(n for n, _ in rules.ngram_limits)})
    for lo, hi in groups(texts):
        hashes: list[int] = []
        chars: list[int] = []
        counts: list[int] = []
        lines: list[tuple[int, int]] = []
        for text in texts[lo:hi]:
            raw = text.encode("utf-8")
            words = raw.split()  # on \x20 and \x09-\x0d
            counts.append(len(words))
            hashes.extend(map(xxhash.xxh3_64_intdigest, words))
            chars.extend(map(len, words) if text.isascii() else [len(w.decode("utf-8")) for w in words])
            seen: set[str] = set()
            repeats = repeat_chars = 0
            for line in text.split("\n"):
                if line in seen:
                    repeats += 1
                    repeat_chars += len(line) - sum(map(line.count, SPACES))
                elif line.strip(SPACES):
                    seen.add(line)
            lines.append((repeats, repeat_chars))
        counts_a = np.array(counts, dtype=np.int64)
        doc = np.repeat(np.arange(hi - lo), counts_a)
        chars_a = np.array(chars, dtype=np.int64)
        covered = _covered(np.array(hashes, dtype=np.uint64), doc, lengths)
        total = np.bincount(doc, weights=chars_a, minlength=hi - lo).astype(np.int64)
        words_in = np.bincount(doc[covered[rules.base_window]], minlength=hi - lo)
        excess = np.full(hi - lo, 0.0)
        over = np.zeros(hi - lo, dtype=bool)
        for length, limit in rules.ngram_limits:
            inside = np.bincount(doc, weights=chars_a * covered[length], minlength=hi - lo)
            share = inside / np.maximum(total, 1)
            excess = np.maximum(excess, share)
            over |= share > limit
        for i, text in enumerate(texts[lo:hi]):
            n, repeat = int(counts_a[i]), int(words_in[i])
            failed = n < rules.min_words or 100 * repeat > rules.base_percent * n
            line_share = lines[i][1] / max(1, int(total[i]))
            out["n_words"].append(n)
            out["word_chars"].append(int(total[i]))
            out["n_symbols"].append(len(SYMBOLS.findall(text)))
            out["n_dup_lines"].append(lines[i][0])
            out["n_repeat_words"].append(repeat)
            out["base_failed"].append(failed)
            out["kept"].append(not failed and not bool(over[i]) and line_share <= rules.line_limit)
            out["ngram_share"].append(float(excess[i]))
            out["line_share"].append(line_share)
    return out


def repetition_quality(docs: DataFrame, rules: RepetitionRules = RepetitionRules()) -> DataFrame:
    """One row of measures and verdict for each row of ``docs`` (``doc_id``, ``text``)."""

    def start():
        return lambda cols: {"doc_id": cols["doc_id"], **measure([t or "" for t in cols["text"]], rules)}

    return map_columns(pick(docs, doc_id="long", text="string"), SCHEMA, start)


def keep_quality(docs: DataFrame, rules: RepetitionRules = RepetitionRules()) -> DataFrame:
    """The rows of ``docs`` that the verdict keeps, with all their columns."""

    def start():
        return lambda texts: measure([t or "" for t in texts], rules)["kept"]

    return filter_rows(docs, "text", start)
