"""Packing, pieces and language-model scores, against the libraries and brute force."""

from __future__ import annotations

import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import sentencepiece
from tokenizers import Tokenizer

from folioflow.llm import lm_difference, sentence_pieces, word_tokens
from folioflow.llm.lm_difference import MU, score_documents
from folioflow.llm.packing import GRAIN, WINDOW, Plan, checksum_between, combinations, pack, solve, _shifts
from folioflow.llm.sentence_pieces import PieceModel, decode_pieces, encode_pieces, model_path
from folioflow.llm.word_tokens import WordTokenizer, tokenizer_path
from tests.llm.conftest import EDGE

HARD = [
    "", " ", "<|endoftext|> a b\x0bc  É é x ﬁ 1234 don't I'LL \U0001f600!! ΣΑΣ İstanbul ǅ ªº éa STRAẞE naïve, ñ. co-op a_b x\xa0y ½ ²",
    "a.b,c d!e", "l'eau c'est", "rock'n'roll it's.", " x \x85", "  a b  c ", "日本 \n\tx", "ａｂｃ fi ﬁ", "a" * 300, "\n\n\na\n", "\x00 b", "aaaa bbbb " * 40, " " * 70 + "x",
]


def test_word_ids_are_the_tokenizers(documents):
    ours, theirs = WordTokenizer(tokenizer_path()), Tokenizer.from_file(tokenizer_path())
    for t in HARD + [t for _, t, _ in documents[:80]]:
        assert np.frombuffer(ours.ids(t), "<u4").tolist() == theirs.encode(t, add_special_tokens=False).ids


@pytest.mark.parametrize("sign", ["|"])
def test_word_ids_of_every_letter_and_digit_beside_a_sign(sign):
    """Some letters become a letter and a mark when normalised, and the mark joins the sign."""
    ours, theirs = WordTokenizer(tokenizer_path()), Tokenizer.from_file(tokenizer_path())
    chars = [c for c in map(chr, range(0x110000)) if c.isalnum() and not 0x3500 < ord(c) < 0x9F00 and not 0xAD00 < ord(c) < 0xD700 and not 0x17100 < ord(c) < 0x18C00]
    for lo in range(0, len(chars), 4000):
        text = " ".join(f"a{c}{sign} {c}a{sign} a{c}b" for c in chars[lo : lo + 4000])
        assert np.frombuffer(ours.ids(text), "<u4").tolist() == theirs.encode(text, add_special_tokens=False).ids
    for t in ("TEŞEKKÜRLERİ.", "\u0958.", "\u09dc,", "\u09dd!"):
        assert np.frombuffer(ours.ids(t), "<u4").tolist() == theirs.encode(t, add_special_tokens=False).ids


def test_caches_are_bounded_by_bytes_on_text_without_spaces(monkeypatch):
    words = WordTokenizer(tokenizer_path())
    pieces = PieceModel(model_path())
    monkeypatch.setattr(sentence_pieces, "CACHE_BYTES", 400_000)
    monkeypatch.setattr(word_tokens, "CACHE_BYTES", 400_000)
    rng = random.Random(5)
    for i in range(40):
        text = "".join(chr(rng.randrange(0x4E00, 0x9000)) for _ in range(3000))
        words.ids(text + " " + " ".join(text[k : k + 20] for k in range(0, 3000, 20)))
        pieces.encode([text])
    assert words.held <= 450_000 and all(len(w) <= word_tokens.LONGEST for w in [*words, *words.older])
    assert sum(map(len, pieces.met.names)) <= 40_000 and sum(map(len, pieces.older.names)) <= 40_000


def test_checksums_between():
    raw = np.arange(300, dtype="<u4").tobytes()
    shifts = _shifts(300)
    for lo, hi in ((0, 1), (1, 300), (64, 128), (150, 151)):
        a, b = zlib.crc32(raw[: 4 * hi]), zlib.crc32(raw[: 4 * lo])
        got = checksum_between(np.array([a], np.uint64), np.array([b], np.uint64), np.array([hi - lo]), shifts)
        assert int(got[0]) == zlib.crc32(raw[4 * lo : 4 * hi])


def test_plan_places_every_tail_once_with_little_padding():
    rng = np.random.default_rng(1)
    for n in (0, 1, 40, 20_000, 10**7):
        p = np.exp(-np.arange(1, WINDOW) / 500)
        h = np.zeros(WINDOW + 1, dtype=np.int64)
        h[1:WINDOW] = rng.multinomial(n, p / p.sum())
        plan = Plan(h)
        covered = defaultdict(int)
        filled = defaultdict(int)
        for length, lo, hi, s, e, _, _ in plan.records:
            assert 0 <= lo < hi <= h[length] and 0 <= s < e <= length and s % GRAIN == 0
            covered[length] += (hi - lo) * (e - s)
        assert all(covered[k] == k * h[k] for k in range(1, WINDOW))
        if n == 40:  # by sequence: no overlap, no gap
            for length, lo, hi, s, e, q, at in plan.records:
                for k in range(hi - lo):
                    filled[q + k] += e - s
            assert max(filled.values()) <= WINDOW
        if n >= 20_000:
            assert 1 - (h * np.arange(WINDOW + 1)).sum() / (plan.sequences * WINDOW) < 0.002
    every = combinations(np.arange(1, WINDOW))
    assert (every.sum(axis=1) == WINDOW).all()
    counts = solve(every, h)
    assert (counts >= 0).all()


def test_packing_round_trip(frame, documents):
    rows = [(i, t) for i, t, _ in documents] + [(10_000 + k, t) for k, t in enumerate(HARD)] + [(99_999, "the " * 9000)]
    theirs = Tokenizer.from_file(tokenizer_path())
    ids = {i: np.array(theirs.encode(t, add_special_tokens=False).ids + [1], dtype="<u4") for i, t in rows}
    got = pack(frame(rows)).collect()
    place = defaultdict(int)
    at = defaultdict(int)
    for r in sorted(got, key=lambda r: (r.doc_id, r.start)):
        own = ids[r.doc_id]
        assert r.doc_tokens == len(own) and r.start == at[r.doc_id]
        assert r.ids_crc32 == zlib.crc32(own[r.start : r.start + r.length].tobytes())
        at[r.doc_id] += r.length
    assert all(at[i] == len(own) for i, own in ids.items())
    for r in sorted(got, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == place[r.sequence_id]
        place[r.sequence_id] += r.length
    assert max(place.values()) <= WINDOW


def test_packing_edges(frame):
    got = pack(frame(EDGE)).collect()
    assert sum(r.length for r in got if r.doc_id in (1, 2, 3)) == 3
    assert len([r for r in got if r.doc_id == 4]) == 2
    assert pack(frame([])).count() == 0


def test_pieces_are_the_librarys(documents):
    sp = sentencepiece.SentencePieceProcessor(model_file=model_path())
    model = PieceModel(model_path())
    texts = HARD + [t for _, t, _ in documents[:60]]
    for t, (best, own) in zip(texts, model.encode(texts)):
        assert np.frombuffer(own, "<u4").tolist() == sp.encode(t), t[:60]
        assert model.decode(own) == model.decode(best) == t


def test_viterbi_is_the_best_path():
    model = PieceModel(model_path())
    model.encode(["the theoretical misunderstanding of words like antidisestablishmentarianism qqxzj"])
    for word, n in model.met.items():
        best = [0.0] + [-math.inf] * len(word)
        for e in range(1, len(word) + 1):
            for s in range(max(0, e - model.longest), e):
                i = model.id_of.get(word[s:e])
                price = model.price[i] if i is not None else model.unknown_price if e - s == 1 else -math.inf
                best[e] = max(best[e], best[s] + price)
        ids = np.frombuffer(model.met.best[n], "<u4").tolist()
        if not set(ids) & set(model.byte_ids.tolist()):
            assert abs(sum(model.price[i] for i in ids) - best[-1]) < 1e-9


def test_pieces_round_trip_in_spark(frame):
    rows = encode_pieces(frame(EDGE), ids=True)
    got = rows.collect()
    assert len(got) == len(EDGE) and all(r.round_trip and r.viterbi_round_trip for r in got)
    back = decode_pieces(rows.select("doc_id", "ids")).collect()
    assert sorted((r.doc_id or 0, r.text) for r in back) == sorted((i or 0, t or "") for i, t in EDGE)
    assert encode_pieces(frame([])).count() == 0


def test_scores(frame, spark, documents):
    rows = [(i, t) for i, t, _ in documents[:60]] + [(901, None), (902, ""), (903, "  ")]
    target = [i for i, _ in rows[:20]]
    got = {r.doc_id: r for r in score_documents(frame(rows), spark.createDataFrame([(i,) for i in target], "doc_id long")).collect()}
    theirs = Tokenizer.from_file(tokenizer_path())
    ids = {i: theirs.encode(t or "", add_special_tokens=False).ids for i, t in rows}
    size = 49_408

    def model(chosen):
        one, before, two = Counter(), Counter(), Counter()
        for i in chosen:
            u = size
            for v in ids[i]:
                one[v] += 1
                before[u] += 1
                two[u, v] += 1
                u = v
        return one, before, two, sum(one.values())

    def bits(m, x):
        one, before, two, n = m
        u, total = size, 0.0
        for v in x:
            total -= math.log2((two[u, v] + MU * (one[v] + 1) / (n + size)) / (before[u] + MU))
            u = v
        return total / len(x) if x else 0.0

    all_docs, chosen = model(ids), model(target)
    for i, x in ids.items():
        like = model([j for j in target if j != i]) if i in target else chosen  # without the document itself
        assert got[i].n_tokens == len(x)
        assert abs(got[i].background_bits - bits(all_docs, x)) < 1e-5
        assert abs(got[i].target_bits - bits(like, x)) < 1e-5
        assert abs(got[i].difference - (bits(like, x) - bits(all_docs, x))) < 1e-5


def test_a_heavy_bigram_is_scored_where_the_tokens_are(frame, spark, documents, monkeypatch):
    """A rare pair of words that fills its bucket: the same scores as in a bucket of its own."""
    rows = [(i, t) for i, t, _ in documents[:40]] + [(900 + k, "zyzzyva quokka " * 400) for k in range(6)]
    target = spark.createDataFrame([(i,) for i, _ in rows[::3]], "doc_id long")
    plain = {r.doc_id: tuple(r) for r in score_documents(frame(rows), target).collect()}
    monkeypatch.setattr(lm_difference, "BUCKET_TOKENS", 500)
    monkeypatch.setattr(lm_difference, "TOP", 4)  # next to nothing is hot
    seen = []
    heavy = lm_difference._heavy
    monkeypatch.setattr(lm_difference, "_heavy", lambda *a: seen.append(heavy(*a)) or seen[-1])
    got = {r.doc_id: tuple(r) for r in score_documents(frame(rows), target).collect()}
    assert got == plain and len(seen[0][0])


def test_score_edges(frame, spark):
    none = spark.createDataFrame([], "doc_id long")
    assert score_documents(frame(EDGE), none).count() == len(EDGE)
    assert score_documents(frame([]), none).count() == 0
