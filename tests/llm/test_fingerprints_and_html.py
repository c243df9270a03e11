"""Prefix hashes and page text, against brute force."""

from __future__ import annotations

import hashlib
import random
import re
from html import unescape

import duckdb
import pytest

from folioflow.llm.html_text import extract, extract_text
from folioflow.llm.prefix_hash import PrefixHash, code_points, fingerprints, likeness
from tests.llm.conftest import EDGE, SF


def test_spans_and_extensions():
    random.seed(2)
    for _ in range(60):
        a = "".join(random.choice("ab😀") for _ in range(random.randrange(0, 60)))
        b = a[: random.randrange(0, len(a) + 1)] + "".join(random.choice("ab") for _ in range(random.randrange(0, 30)))
        x, y = PrefixHash(code_points(a)), PrefixHash(code_points(b))
        i, j = random.randrange(0, len(a) + 1), random.randrange(0, len(b) + 1)
        want = 0
        while i + want < len(a) and j + want < len(b) and a[i + want] == b[j + want]:
            want += 1
        assert x.extension(i, y, j) == want
        n = random.randrange(0, min(len(a) - i, len(b) - j) + 1)
        assert x.equal(i, y, j, n) == (a[i : i + n] == b[j : j + n])


def test_likeness():
    mark = lambda t: PrefixHash(code_points(t)).fingerprint()
    text = " ".join(f"word{i}" for i in range(500))
    assert likeness(mark(text), mark(text)) == 1.0 and likeness(mark(""), mark("")) == 1.0 and likeness(mark(""), mark("a")) == 0.0
    assert likeness(mark(text), mark(text[:2000] + "X" + text[2000:])) > 0.8  # an insertion
    assert likeness(mark(text), mark(text[::-1])) < 0.2
    tail = " ".join(f"other{i}" for i in range(500))[: len(text) // 4]
    assert 0.6 < likeness(mark(text), mark(text[: len(text) * 3 // 4] + tail)) < 0.9


def test_fingerprints_over_partitions(frame, documents):
    rows = [(i, t) for i, t, _ in documents]
    texts = dict(rows)
    order = sorted(texts)
    for parts in (1, 7):
        got = {r.doc_id: r for r in fingerprints(frame(rows), parts).collect()}
        assert sorted(got) == order
        for k, i in enumerate(order):
            t, after = texts[i], texts[order[(k + 1) % len(order)]]
            cut = len(t) // 4
            edited = t[: len(t) - cut] + after[:cut]
            mark = PrefixHash(code_points(t)).fingerprint()
            other = PrefixHash(code_points(edited)).fingerprint()
            r = got[i]
            assert (r.n_chars, r.fingerprint, r.edited_fingerprint) == (len(t), mark, other)
            assert r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
            assert r.near_edited == likeness(mark, other) and r.near_next == likeness(mark, PrefixHash(code_points(after)).fingerprint())


def test_fingerprint_edges(frame):
    rows = fingerprints(frame(EDGE), 3).collect()
    assert len(rows) == len(EDGE)
    assert {r.n_chars for r in rows if r.doc_id in (1, 2)} == {0}
    assert len({r.fingerprint for r in rows if r.doc_id == 4}) == 1
    assert fingerprints(frame([]), 3).count() == 0
    alone = fingerprints(frame([(5, "abcdefgh")]), 3).first()
    assert alone.near_next == 1.0 and alone.edited_sha256 == hashlib.sha256(b"abcdefab").hexdigest()


def naive(html):
    m = re.search(r"<article>(.*?)(</article>|$)", html, re.S)
    out = [" ".join(unescape(re.sub(r"<[^>]*>?", " ", b)).split()) for b in re.split(r"</?(?:p|h1)>", m[1])]
    return "\n".join(x for x in out if x)


def test_pages(spark):
    rows = duckdb.sql(f"SELECT page_id, url, html FROM '{SF}/pages.parquet'").fetchall()
    got = {r.page_id: r for r in extract_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    for i, url, html in rows:
        assert (got[i].url, got[i].text) == (url, naive(html)) and got[i].n_chars == len(naive(html))


def test_page_kinds():
    blog = (
        '<body class="has-sidebar"><div id=nav><a href=x>Home</a></div><header>Site</header><div class="post-content"><h2>T &lt; x</h2>Text, direct.'
        '<p>para one, with&nbsp;nbsp <a href=y>link</a></p><ul><li>one<li>two</ul></div><div class="cookie-notice">We use cookies</div>'
        '<div class="comments"><p>nice, post, yes, indeed, very, very nice</p></div></body>'
    )
    assert extract(blog) == "T < x\nText, direct.\npara one, with nbsp link\none\ntwo"
    assert extract("<article><header><h1>T</h1></header><div><p>x</p></div><footer>f</footer></article>") == "T\nx"
    assert extract("<p>a few words of the page, more of them<form><input><p>in a form</form>") == "a few words of the page, more of them"
    assert extract('<p title="a>b">q<br>r</p><p>z') == "q r\nz"
    assert extract("text < 3 & more &copy;") == "text < 3 & more ©"
    assert extract("<script>var a='<p>x</p>'</script><p>y<!-- <p>z -->") == "y"


def test_layout_words_do_not_drop_the_text():
    story = [f"Paragraph {i} of the story, with some words, more of them, and an end." for i in range(6)]
    text, paragraphs = "\n".join(story), "".join(f"<p>{x}</p>" for x in story)
    around = '<div id="nav"><a href=x>Home</a> <a href=y>More</a></div>%s<div class="sidebar-inner"><p>Short words at the side.</p></div>'
    for kind in ('div class="elementor-widget-text-editor"', 'div class="layout-sidebar-right"', 'div class="site comments-open"', 'section id="discussion"'):
        page = f"<{kind}>{paragraphs}</{kind.split()[0]}>"
        assert extract(page) == text
        assert extract("<body>" + around % page + "</body>").startswith(text)
        assert extract(f"<body><{kind}><article>{paragraphs}</article></{kind.split()[0]}></body>") == text
    parts = "".join(f'<div class="elementor-widget elementor-widget-text"><p>{x}</p></div>' for x in story)
    assert extract("<body>" + around % parts + "</body>") == text
    many = "".join(f"<p>Nice story, number {i}, really, very nice, thanks, all.</p>" for i in range(40))
    assert extract(f'<body><article>{paragraphs}</article><div id="comments">{many}</div></body>') == text
    assert extract(f'<body><div>{paragraphs}</div><div class="comments">{many}</div></body>') == text
    assert extract(f'<body><div>{paragraphs}</div><div class="related-posts"><p>Other story, one.</p></div></body>') == text
    assert extract(f'<p>{story[0]} <span class="share-link">Share</span></p>') == story[0]


def test_page_edges(spark):
    deep = "<div>" * 20_000 + "<p>deep, text</p>" + "<b>" * 5_000
    rows = [(1, "u", None), (2, None, ""), (None, "u", "<p>a"), (4, "u", "<p"), (5, "u", deep), (5, "u", deep)]
    df = spark.createDataFrame([(*r, "extra") for r in rows], "page_id long, url string, html string, text string")
    got = extract_text(df).collect()
    assert sorted(r.text for r in got) == ["", "", "", "a", "deep, text", "deep, text"]
    assert extract_text(df.limit(0)).count() == 0


TALE = "The harbour town had been quiet for years, and nobody, not even the mayor, expected the fair to return."


@pytest.mark.parametrize(
    "html, want",
    [
        (f"<p>{TALE}</p><p title='the hidden truth'>{TALE}</p>", f"{TALE}\n{TALE}"),
        (f"<div data-title='a hidden gem'><p>{TALE}</p><p>{TALE}</p></div>", f"{TALE}\n{TALE}"),
        (f"<p>{TALE}</p><div class='md:block hidden lg:flex'><p>{TALE}</p></div>", f"{TALE}\n{TALE}"),
        (f"<p>At the <a class='side-note'>old harbour</a> in <span class='search-term'>Lisbon</span>, {TALE}</p>", f"At the old harbour in Lisbon, {TALE}"),
        (f"<p>{TALE}</p><pre>x = 1 <span class='token comment'># set</span> y</pre>", f"{TALE}\nx = 1 # set y"),
        (f"<div class='widget'><p>{TALE}</p><p>{TALE}</p></div>", f"{TALE}\n{TALE}"),
        (f"<p>We <button>Share</button>met <script>var a = '<p>';</script>there, {TALE}</p>", f"We met there, {TALE}"),
        (f"<p>{TALE}</p><p hidden>gone</p><p hidden=''>{TALE} gone</p><p class=x aria-hidden=true>gone</p>", TALE),
        (f"<div class='comments'><p>{TALE}</p></div><p>{TALE}</p><p>{TALE}</p>", f"{TALE}\n{TALE}"),
        (f"<p>{TALE}</p><p>{TALE}</p><div class=sidebar><p>{TALE}</p><p>{TALE}</p><p>{TALE}</p></div>", f"{TALE}\n{TALE}"),
    ],
)
def test_only_attributes_of_the_name_hide_and_inline_words_keep_the_line(html, want):
    assert extract(f"<html><body>{html}</body></html>") == want
