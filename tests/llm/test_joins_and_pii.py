"""Near-duplicate components and personal data, against brute force."""

from __future__ import annotations

import hashlib
import random
import re
import tracemalloc
from collections import Counter

import numpy as np
import pytest

from folioflow.llm import jaccard_join as J
from folioflow.llm.components import components
from folioflow.llm.jaccard_join import CountTree, fold, jaccard_components, keep_one, overlap_needed, point, shingle_sets, tokens
from folioflow.llm.personal_data import KINDS, find_personal_data
from tests.llm.conftest import EDGE

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + 5]) for i in range(len(words) - 4)) if len(words) >= 5 else frozenset([tuple(words)])


def brute(rows):
    """(set size, smallest id reachable) of each row, by an inverted index and union-find."""
    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    holders = {}
    for k, s in enumerate(sets):
        for g in s:
            holders.setdefault(g, []).append(k)
    for k, s in enumerate(sets):
        for j, n in Counter(j for g in s for j in holders[g] if j < k).items():
            if 100 * n >= 80 * (len(s) + len(sets[j]) - n):
                parent[find(k)] = find(j)
    least = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            least[find(k)] = min(least.get(find(k), i), i)
    return [(len(s), least.get(find(k))) for k, s in enumerate(sets)]


def corpus(documents):
    random.seed(5)
    words = [f"w{i}" for i in range(400)]
    pick = lambda n: [random.choice(words) for _ in range(n)]
    texts = [t for _, t, _ in documents]
    for size in (12, 60, 300, 1500):  # near copies of several sizes
        start = pick(size)
        for _ in range(25):
            w = list(start)
            for _ in range(random.choice([0, 1, 1, 2, size // 40])):
                w[random.randrange(size)] = random.choice(words)
            texts.append(" ".join(w[: size - random.choice([0, 0, size // 20])]))
    w = pick(80)
    for k in range(25):  # a chain: each like the next alone
        w = list(w)
        w[random.randrange(80)] = f"z{k}"
        texts.append(" ".join(w))
    shared = " ".join(pick(40))  # a passage in many documents
    texts += [shared + " " + " ".join(pick(random.choice([3, 8, 12, 30, 60]))) for _ in range(80)]
    texts += [None, "", "  \n", "a b", "A  b", "a b c d", "a b c d e", "É b c d e", "é b c d e", "a b c d e f", "x " * 500]
    return [(i * 3 + 7, t) for i, t in enumerate(texts)]


def test_components_are_exact(frame, documents):
    rows = corpus(documents)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_components(frame(rows)).collect()}
    want = brute(rows)
    assert [got[i] for i, _ in rows] == want
    kept = keep_one(frame(rows + rows[:4]))
    assert sorted(r.doc_id for r in kept.collect()) == sorted({c for _, c in want})
    assert kept.columns == frame(rows).columns


@pytest.mark.parametrize("block", [2, 5])
def test_large_cells_in_blocks_give_the_same(frame, documents, monkeypatch, block):
    monkeypatch.setattr(J, "BLOCK", block)
    monkeypatch.setattr(J, "BROADCAST_IDS", 0)
    rows = corpus(documents)[-160:]
    got = {r.doc_id: r.component_id for r in jaccard_components(frame(rows)).collect()}
    assert [got[i] for i, _ in rows] == [c for _, c in brute(rows)]


def test_all_pairs_are_tested_after_an_empty_spanning_pass(frame, monkeypatch):
    pairs = J._tree_pairs
    # the cells in which pairs were left out are still named
    monkeypatch.setattr(J, "_tree_pairs", lambda cells, spanning: pairs(cells, spanning).where("token is not null" if spanning else "true"))
    centre = [f"w{i}" for i in range(80)]
    rows = []
    for i in range(121):  # any two differ in two of three words, so are no link, and share each word with others
        w = list(centre)
        w[20], w[40], w[60] = f"a{i // 11}", f"b{i % 11}", f"c{(i // 11 + i % 11) % 11}"
        rows.append((2 * i, " ".join(w)))
        if i % 4 == 0:  # a link
            w[5] = f"d{i}"
            rows.append((2 * i + 1, " ".join(w)))
    got = {r.doc_id: r.component_id for r in jaccard_components(frame(rows)).collect()}
    assert [got[i] for i, _ in rows] == [c for _, c in brute(rows)]


def test_links_share_a_routing_token():
    rng = np.random.default_rng(3)
    for n in [*range(4, 140, 3), 250, 260, 1020, 1030, 2047, 2049, 5000]:
        a = np.unique(rng.integers(0, 2**63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1))
        for _ in range(4):
            k = int(rng.integers(0, len(a) // 9 + 1))  # k out and k in: at the threshold or above
            b = np.unique(np.concatenate([rng.permutation(a)[k:], rng.integers(0, 2**63, k, dtype=np.uint64)]))
            c = rng.permutation(a)[len(a) // 5 :]
            for other in (b, np.sort(c)):
                shared = len(np.intersect1d(a, other))
                if 100 * shared >= 80 * (len(a) + len(other) - shared) and len(other) != shared + len(a) - shared + 1:
                    if not np.array_equal(a, other):
                        assert len(np.intersect1d(tokens(a), tokens(other))), (n, k)


def test_tree_finds_all_pairs_within_the_bound():
    rng = np.random.default_rng(4)
    sizes = rng.integers(40, 70, 300)
    points = np.stack([np.bincount(rng.integers(0, 16, s), minlength=16) for s in sizes])
    points[150:] = points[:150]  # with neighbours
    points[150:, 3] += 1
    sizes[150:] = sizes[:150] + 1
    found = {(int(q), int(m)) for qs, ms in CountTree(sizes, points).search(sizes, points) for q, m in zip(qs, ms)}
    bound = np.minimum(points[:, None, :], points[None, :, :]).sum(axis=2)
    fits = 100 * np.minimum.outer(sizes, sizes) >= 80 * np.maximum.outer(sizes, sizes)
    want = np.argwhere(fits & (bound >= overlap_needed(sizes[:, None], sizes[None, :])))
    assert found == {tuple(p) for p in want.tolist()}


def test_points_bound_the_overlap():
    a, b = list(shingle_sets([" ".join(f"w{i}" for i in range(700)), " ".join(f"w{i}" for i in range(100, 900))]))
    p, q = point(a), point(b)
    groups = min(len(p), len(q))
    bound = np.minimum(fold(p[None, :], groups), fold(q[None, :], groups)).sum()
    assert len(np.intersect1d(a, b)) <= bound <= min(len(a), len(b))


def test_join_edges(frame):
    rows = jaccard_components(frame(EDGE)).collect()
    assert len(rows) == len(EDGE)
    by = {r.doc_id: r for r in rows if r.doc_id is not None}
    assert by[8].component_id == 7 and by[1].n_shingles == 0 and by[1].component_id == 1 and by[4].n_shingles == 1
    assert jaccard_components(frame([])).count() == 0
    kept = [r.doc_id for r in keep_one(frame(EDGE)).collect()]
    assert kept.count(4) == 1 and kept.count(7) == 1 and 8 not in kept and kept.count(None) == 2


def test_one_row_of_each_component_with_repeated_ids(frame):
    rng = random.Random(6)
    base = {k: [f"{k}{rng.randrange(10**6)}" for _ in range(60)] for k in "abc"}
    copy = lambda k, i: " ".join([*base[k][:-1], f"z{i}"])
    rows = [(1, copy("a", 1)), (5, copy("a", 5)), (5, copy("b", 5)), (7, copy("b", 7)), (8, copy("b", 8))]
    rows += [(9, copy("c", 1)), (9, copy("c", 2)), (9, copy("c", 2).upper()), (9, "alone here"), (9, None), (9, ""), (9, ""), (7, "")]
    kept = [(r.doc_id, (r.text or "?")[:1].lower()) for r in keep_one(frame(rows)).collect()]
    assert sorted(kept) == [(1, "a"), (5, "b"), (7, "?"), (9, "?"), (9, "?"), (9, "a"), (9, "c")]


def test_connected_components(spark):
    links = [(i, i + 1) for i in range(60)] + [(100, 100), (5, None), (200, 150), (150, 120), (-3, 120)]
    got = dict(components(spark.createDataFrame(links, "a long, b long")).collect())
    assert {k: got[k] for k in (0, 60, 100, 200, -3)} == {0: 0, 60: 0, 100: 100, 200: -3, -3: -3} and len(got) == 66
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        v = int(c) * (1 + i % 2)
        total += v - 9 if v > 9 else v
    return total % 10 == 0


def base(text):
    out = []
    for kind in KINDS:
        for m in re.finditer(PATTERNS[kind], text or ""):
            d = re.sub("[^0-9]", "", m[0])
            if kind == "ip" and any(int(x) > 255 for x in m[0].split(".")):
                continue
            if kind == "card" and not (13 <= len(d) <= 19 and luhn(d)):
                continue
            if kind == "phone" and not 9 <= len(d) <= 15:
                continue
            out.append(f"{kind}:{m.start()}:{m.end()}")
    return ",".join(out)


HARD = [
    "a@b.c@d.e x", "a@b.c_x@d.e", " 😀 é x@y.zz 1.2.3.4 +49 (30) 1234-5678 4111 1111 1111 1111", "1.2.3.4.5.6.7.8",
    "999.1.1.1 001.002.003.004 0000.1.1.1 0000000255.1.1.1", "4111-1111-1111-1111 4111111111111111x", "+1.2 +12345678", "a" * 5000 + "@b.c",
    "1" * 3000 + ".1.1.1", "a.a@" + "b." * 4000 + "c", "@@a@b.c.@d", "+1 ((( 555 555 55 55 ))", "a@b.c.d-e.f@g.h", "4111 1111  1111 1111",
    "1 2 3 4 5 6 7 8 9 0 1 2 3 4 5 6 7 8 9 0", "-1-1.1.1.1-1 %+@a.b\x0b9@8.7 q@w.e",
]


def test_base_spans(frame, documents):
    rows = [(i, t) for i, t, _ in documents] + [(10_000 + k, t) for k, t in enumerate(HARD)]
    got = {r.doc_id: r for r in find_personal_data(frame(rows)).collect()}
    for i, t in rows:
        want = base(t)
        assert got[i].base_sha256 == hashlib.sha256(want.encode()).hexdigest(), (t[:80], want[:80], got[i].spans[:80])
        assert not want or set(want.split(",")) <= set(got[i].spans.split(","))
        assert [got[i][f"n_{k}"] for k in KINDS] == [sum(s.startswith(k + ":") for s in want.split(",")) for k in KINDS]


def test_contexts_find_what_no_base_pattern_matches(frame):
    rows = [(i, f"please write mail to user{i}@example.org before noon") for i in range(12)]
    rows += [(50, "please write mail to someone7#intranet before noon"), (51, "the sum of 7 apples and the number 12 too")]
    # found in the first round, and then a witness for the context of its other occurrence
    rows += [(60 + i, f"kindly ask user{i}@example.org tomorrow") for i in range(6)]
    got = {r.doc_id: r for r in find_personal_data(frame(rows)).collect()}
    assert got[50].spans == "email:21:38" and got[50].n_email == 0 and got[50].n_found == 1
    assert got[51].spans == "" and all(got[i].n_found == 0 for i in range(12))


def planted(rng):
    """Texts with seeds and with identifiers that no base pattern matches, in varied contexts; the spans of the latter."""
    words = [f"{a}{b}" for a in ("lor", "sit", "dol", "con", "ad", "pis", "ma", "gna") for b in ("em", "um", "or", "ec", "ing", "ere")]
    prose = lambda n: " ".join(rng.choice(words) for _ in range(n))
    cues = {
        "phone": ["call {}", "Phone: {}", "my number is {}", "reach me on ({})", "tel. {} (office)", "ring, if you can, {} please", "WhatsApp: {};"],
        "email": ["write to {}", "E-mail: {}", "contact {} for more", "mailto <{}>", "send it to {}, please", "reply at {}"],
    }
    seeds = {
        "phone": lambda: f"+1 ({rng.randrange(200, 999)}) 555-{rng.randrange(1000, 9999)}",
        "email": lambda: f"{rng.choice(words)}.{rng.randrange(10, 99)}@mail{rng.randrange(9)}.example.com",
    }
    unseen = {
        "phone": lambda: rng.choice(["({}) 555-{}", "{}-555-{}", "{}.555.{}"]).format(rng.randrange(200, 999), rng.randrange(1000, 9999)),
        "email": lambda: f"{rng.choice(words)}.{rng.randrange(10, 99)}@{rng.choice(words)}intranet",
    }
    rows, want = [], set()
    for i in range(900):
        kind = rng.choice(["phone", "email"])
        new = i % 5 == 0
        value = (unseen if new else seeds)[kind]()
        before, after = rng.choice(cues[kind]).split("{}")
        head = f"{prose(rng.randrange(3, 12))}. {before}"
        if new:
            want.add((i, kind, len(head), value))
        rows.append((i, head + value + after + " " + prose(rng.randrange(2, 9))))
    for i in range(300):  # numbers of other kinds, in contexts of their own
        rows.append((1000 + i, f"{prose(5)} {rng.choice(['costs', 'chapter', 'room', 'in the year', 'version'])} {rng.randrange(10, 99999)} {prose(4)}"))
    return rows, want


def test_recall_and_precision_of_unseen_identifiers(frame):
    rows, want = planted(random.Random(11))
    texts = dict(rows)
    got = find_personal_data(frame(rows)).collect()
    found = set()
    for r in got:
        spans = [s.split(":") for s in r.spans.split(",") if s]
        known = set(base(texts[r.doc_id]).split(","))
        found |= {(r.doc_id, kind, int(lo), int(hi)) for kind, lo, hi in spans if f"{kind}:{lo}:{hi}" not in known}
    hit = {(i, kind, at) for i, kind, at, value in want for d, k, lo, hi in found if d == i and k == kind and lo <= at + 1 and hi >= at + len(value) - 1}
    recall = len(hit) / len(want)
    precision = len(hit) / max(1, len(found))
    print(f"recall {recall:.3f}, precision {precision:.3f} of {len(want)} planted, {len(found)} found")
    assert recall >= 0.9 and precision >= 0.9


def test_very_many_matches_in_one_text(frame):
    """Chunks of matches are placed one after the other; the time does not grow with the square of their number."""
    text = " ".join(f"word {i} a{i}@b.cc 10.0.{i % 256}.1" for i in range(12_000))
    row = find_personal_data(frame([(1, text)])).collect()[0]
    want = base(text)
    assert row.base_sha256 == hashlib.sha256(want.encode()).hexdigest() and row.n_email == 12_000 and row.n_ip == 12_000


def test_personal_data_edges(frame):
    rows = find_personal_data(frame(EDGE)).collect()
    assert len(rows) == len(EDGE) and all(r.spans == "" and r.n_email == 0 for r in rows)
    assert find_personal_data(frame([])).count() == 0


def test_personal_data_is_native(frame):
    plan = find_personal_data(frame(EDGE))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_search_of_a_large_tree_holds_few_coordinates():
    rng = np.random.default_rng(0)
    base = rng.poisson(0.6, 512)
    points = (base + (rng.random((1_000, 512)) < 0.05)).astype(np.uint8)
    sizes = points.sum(axis=1).astype(np.int32)
    tree = CountTree(sizes, points)
    tracemalloc.start()
    try:
        found = sum(len(q) for q, _ in tree.search(sizes, points))
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    n = sizes.astype(np.int64)
    want = 0
    for i in range(len(n)):
        bound = np.minimum(points[i], points).sum(axis=1, dtype=np.int64)
        fits = 100 * np.minimum(n, n[i]) >= 80 * np.maximum(n, n[i])
        want += int((fits & (bound >= overlap_needed(n, n[i]))).sum())
    assert found == want > 100_000
    assert peak < 60_000_000
