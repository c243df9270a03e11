"""Alignment of two tokenizers against plain loops over bytes."""

from __future__ import annotations

import hashlib
from collections import Counter, defaultdict

import numpy as np
import sentencepiece
from tokenizers import Tokenizer

from folioflow.llm import token_alignment
from folioflow.llm.token_alignment import Aligner, align_tokens
from folioflow.llm.word_tokens import byte_letters, tokenizer_path
from tests.llm.conftest import EDGE

A_PATH, B_PATH = tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model")
HARD = [
    "<|endoftext|> a <s> </s> <unk> b", "a▁b", "x  y   z ", " lead", "tab\tand\nline\r\n", "日本語のテキスト。", "don't I'LL 12345 3.14!!", "\u0000\u0001 é é \U0001f600",
    "ＡＢＣ ﬁ ½", "word " * 30, "\n\n\n", "▁", "a" * 300, "<0x41> <0x0A>", "naïve Straße — öäü",
]


def brute_force(rows):
    """The contract by its words: every token's byte range, all pairs that overlap."""
    a, b = Tokenizer.from_file(A_PATH), sentencepiece.SentencePieceProcessor(model_file=B_PATH)
    a.encode_special_tokens = True
    back = {c: i for i, c in enumerate(byte_letters())}
    aligned, counts = [], Counter()
    for _, text in rows:
        aligned.append(None)
        if not text:
            continue
        whole = (" " + text).encode()
        x, y = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
        xs = [bytes(back[c] for c in a.id_to_token(i)) for i in x]
        ys = [bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode() for i, p in ((i, b.id_to_piece(i)) for i in y)]
        if b"".join(xs) != whole or b"".join(ys) != whole:
            continue
        spans = []
        for parts in (xs, ys):
            at, out = 0, []
            for p in parts:
                out.append((at, at + len(p)))
                at += len(p)
            spans.append(out)
        first = 0
        links = []
        for i, (s, e) in zip(x, spans[0]):
            while spans[1][first][1] <= s:
                first += 1
            k = first
            while k < len(y) and spans[1][k][0] < e:
                links.append((i, y[k]))
                k += 1
        ends = sorted({e for _, e in spans[0]} & {e for _, e in spans[1]})
        groups, lo = [], 0
        ia = ib = 0
        for e in ends:
            ga, gb = [], []
            while ia < len(x) and spans[0][ia][1] <= e:
                ga.append(x[ia])
                ia += 1
            while ib < len(y) and spans[1][ib][1] <= e:
                gb.append(y[ib])
                ib += 1
            groups.append(",".join(map(str, ga)) + "|" + ",".join(map(str, gb)))
            lo = e
        assert lo == len(whole)
        counts.update(links)
        aligned[-1] = (len(x), len(y), groups, links)
    top = defaultdict(int)
    for (_, j), n in counts.items():
        top[j] = max(top[j], n)
    out = []
    for (doc_id, _), got in zip(rows, aligned):
        if got is None:
            out.append((doc_id, 0, 0, 0, 0, 0, 0, ""))
            continue
        n_a, n_b, groups, links = got
        n_best, total = sum(counts[p] == top[p[1]] for p in links), sum(counts[p] for p in links)
        out.append((doc_id, n_a, n_b, len(groups), len(links), n_best, total, hashlib.sha256(";".join(groups).encode()).hexdigest()))
    return out


def key(row):
    return row[0] is None, row[0] or 0, row[1:]


def check(got, rows):
    assert sorted(map(tuple, got), key=key) == sorted(brute_force(rows), key=key)


def test_documents_and_hard_texts(frame, documents):
    rows = [(i, t) for i, t, _ in documents] + [(10_000 + i, t) for i, t in enumerate(HARD)]
    got = align_tokens(frame(rows).repartition(3)).collect()
    assert got[0].__fields__ == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    check(got, rows)


def test_groups_themselves(frame):
    rows = [(i, t) for i, t in enumerate(HARD)]
    got = align_tokens(frame(rows), keep_groups=True).collect()
    assert all(r["groups_sha256"] == (hashlib.sha256(r["groups"].encode()).hexdigest() if r["groups"] else "") for r in got)
    assert all(r["n_groups"] == (r["groups"].count(";") + 1 if r["groups"] else 0) for r in got) and any(r["groups"] for r in got)


def test_edges_in_small_runs_and_parts(frame, monkeypatch):
    check(align_tokens(frame(EDGE).repartition(2)).collect(), EDGE)
    assert align_tokens(frame([])).collect() == []
    only = [(1, None), (None, "")]
    check(align_tokens(frame(only)).collect(), only)


def test_parts_tokenise_as_a_whole(documents):
    aligner = Aligner.open(A_PATH, B_PATH)
    texts = ["\n".join(t for _, t, _ in documents if t), "word and  word " * 200, "日本 " * 300]
    whole = aligner.encode(texts)
    before = token_alignment.PART_CHARS
    try:
        token_alignment.PART_CHARS = 50
        parts = aligner.encode(texts)
    finally:
        token_alignment.PART_CHARS = before
    assert all((x == y).all() for side in (0, 1) for x, y in zip(whole[side], parts[side], strict=True))


def test_windows_start_at_verified_shared_ends():
    aligner = Aligner.open(A_PATH, B_PATH)
    whole, a, a_n, b, b_n = aligner.tokens(HARD)
    assert whole.count(False) == 2 and not whole[HARD.index("a▁b")] and len(a_n) == whole.count(True)
    p, r = aligner.anchors(a, a_n, b, b_n)
    for x, y in zip(np.split(a, p[1:]), np.split(b, r[1:])):
        assert aligner.a_tokens.joined(x) == aligner.b_tokens.joined(y)
    assert set(np.cumsum(a_n) - a_n) <= set(p) and len(p) > 2 * len(HARD)


def test_ids_of_every_code_point_are_the_tokenizers():
    """The encoder by ranks gives the ids of the tokenizer's own file."""
    aligner, tokenizer = Aligner.open(A_PATH, B_PATH), Tokenizer.from_file(A_PATH)
    tokenizer.encode_special_tokens = True
    chars = [c for c in map(chr, range(0x110000)) if not 0xD800 <= ord(c) < 0xE000]
    texts = ["".join(f"a{c} {c}1" for c in chars[lo : lo + 100]) for lo in range(0, len(chars), 100)]
    assert aligner.a(texts) == [e.ids for e in tokenizer.encode_batch(texts, add_special_tokens=False)]
