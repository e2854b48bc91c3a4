"""Licences, pages, BPE and token files against plain versions."""

import hashlib
import io
import os
import random
import re
from html.parser import HTMLParser

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from deliverylens.llm import bpe, licenses, pages, queries, tokenstore

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
DOCS = "doc_id long, text string, lang string, source string, n_chars long"
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")


def docs(spark, texts, ids=None):
    ids = range(len(texts)) if ids is None else ids
    return spark.createDataFrame([(i, t, None, None, None) for i, t in zip(ids, texts)], DOCS)


def clashing(df):
    """Columns named like those that operators make."""
    names = ("blob", "spans", "score", "ids", "e", "fp", "found", "n_words", "component_id", "id", "start")
    return df.select("*", *(F.lit(-1).alias(n) for n in names if n not in df.columns))


# --- licences ---

PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}


def plain_licences(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", lowered)
    places, labels = [], set()
    for phrase, label in PHRASES.items():
        own = phrase.split()
        for k in range(len(words) - len(own) + 1):
            if words[k : k + len(own)] == own:
                places.append(k)
                labels.add(label)
    return len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels))


LICENCE_TEXTS = [
    None,
    "",
    "CC BY cc-by CC\nBY cc by by, all rights reserved. All Rights Reservedé",
    "GNU General Public License, version 3 general public licenses",
    "ccby cc byé É cc by",
    "word " * 50_000 + "cc by",
    "cc by cc by cc by",
]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from(["cc", "by", "CC BY", "all", "rights", "reserved", "é", "general public", "license", "-", "1"])))
def test_base_phrases_like_a_plain_count(parts):
    text = " ".join(parts)
    assert licenses.scan_text(text)[:5] == plain_licences(text)


def test_licence_rows(spark):
    table = docs(spark, [*LICENCE_TEXTS, LICENCE_TEXTS[2]], [0, 1, 2, 3, 4, 5, 6, None])
    rows = licenses.scan_licenses(clashing(table)).collect()
    assert len(rows) == 8
    for row in rows:
        text = LICENCE_TEXTS[2 if row.doc_id is None else row.doc_id]
        assert (row.n_words, row.n_base, row.first_word, row.last_word, row.base_labels) == plain_licences(text)
        assert 0 <= row.score <= 1 and (row.score > 0) == bool(row.labels)
        assert set(filter(None, row.base_labels.split(","))) <= set(row.labels.split(","))
    assert licenses.scan_licenses(table.limit(0)).count() == 0


@pytest.mark.parametrize(
    ("text", "names", "sure"),
    [
        ("MIT", ["mit"], 1.0),
        ("MIT OR Unknown-1.0", ["mit", "unknown-1.0"], 1.0),
        ("MIT AND Unknown-1.0", ["mit", "unknown-1.0"], 0.5),
        # and binds closer than or
        ("MIT OR Unknown-1.0 AND Unknown-2.0", ["mit", "unknown-1.0", "unknown-2.0"], 1.0),
        ("(MIT OR Unknown-1.0) AND Unknown-2.0", ["mit", "unknown-1.0", "unknown-2.0"], 0.5),
        ("GPL-2.0-only WITH Classpath-exception-2.0", ["gpl-2.0-only", "classpath-exception-2.0"], 1.0),
        ("GPL-2.0-only with MIT", ["gpl-2.0-only", "mit"], 0.5),
        ("GPL-2.0+ */ more", ["gpl-2.0+"], 1.0),
        ("((MIT))", ["mit"], 1.0),
        ("MIT)", ["mit"], 1.0),
        ("(MIT", [], 0.0),
        ("MIT AND", [], 0.0),
        ("OR MIT", [], 0.0),
        ("", [], 0.0),
    ],
)
def test_licence_expressions(text, names, sure):
    assert licenses.evaluate_expression(text) == (names, sure)


def test_tags_and_notices():
    found = licenses.scan_text("// SPDX-License-Identifier: MIT OR Apache-2.0\nReleased under the MIT License.")
    assert found[5:] == ("apache-2.0,mit", 1.0)
    assert licenses.scan_text("Licensed under the Apache License, Version 2.0.")[5:] == ("apache-2.0", 0.8)


# --- pages ---

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head><body>
<header><h2>Site</h2></header><nav><ul><li><a href="/a">A</a></li></ul></nav><!-- ad --><div class="ad">Buy this now.</div>
<article><h1>Tom &amp; Jerry</h1><p><b>One  two<br>three<p>A&nbsp;last
line &lt;b&gt;</p><aside>Aside</aside><form><input><p>Sign up</p></form><p>End.</p>
<section id="comments"><p>First!</p></section></article>
<div class='sidebar'>More</div><div role=alert>Cookies?</div><footer>&copy; x</footer></body></html>"""


def test_main_text():
    assert pages.main_text(PAGE) == "Tom & Jerry\nOne two three\nA last line <b>\nEnd."
    assert pages.main_text(PAGE[: PAGE.index("<aside>")]) == "Tom & Jerry\nOne two three\nA last line <b>"
    assert pages.main_text("<p>" + "word " * 50_000 + "</p>") == ("word " * 50_000).strip()
    for nothing in (None, "", "   ", "<nav>x</nav>", "<script>x", "<!-- x", "<"):
        assert pages.main_text(nothing) == ("<" if nothing == "<" else "")


def test_main_text_without_article():
    long = "A sentence that goes on for quite a while, as those of articles do. " * 3
    page = (
        "<body><div><a href=1>Home</a></div><div><a href=2>News</a></div>" + "<div></div>" * 5
        + f"<div>{long}</div><div>{long}</div>" + "<div></div>" * 5 + "<div>Short.</div></body>"
    )
    assert pages.main_text(page) == f"{long.strip()}\n{long.strip()}"


@pytest.mark.parametrize(
    "page",
    [
        # an end tag of head may be left out
        "<html><head><title>t</title><body><article><p>Main.</p></article></body></html>",
        "<head><meta charset=utf-8><title>t<article><p>Main.</p></article>",
        "<title>t</title><link rel=x><style>p{}</style><article><p>Main.</p></article>",
        # what is not shown ends with its end tag, and is empty without one
        '<article><svg width="1"/><p>Main.</p></article>',
        "<article><svg><svg/><text>x</text></svg><p>Main.</p></article>",
        "<article><svg><svg><text>x</text></svg><text>x</text></svg><p>Main.</p></article>",
        "<article><svg width=1><p>Main.</p><svg><text>x</text></svg></article>",
        "<article><iframe src=a><p>Main.</p><iframe src=b>x</iframe></article>",
        '<article><script src="a"/><p>Main.</p><script>x</script></article>',
        '<article><script src="a"/>x</script><p>Main.</p></article>',
        "<article><object data=a><textarea><noscript><template><p>Main.</p></article>",
        "<article><object>x<object>x</object>x</object><p>Main.</p></article>",
        "<article><!--><p>Main.</p><!-- x --></article>",
        # marks and forms around an article
        '<div class="content with-sidebar"><article><p>Main.</p></article></div>',
        '<div class="no-comments"><p>Main.</p></div>',
        '<main><div class="sidebar-right"><article><p>Main.</p></article></div></main>',
        '<main><p>Main.</p><section id="comments"><article>x</article></section></main>',
        '<div id="search-page"><div class="widget"><main><p>Main.</p></main></div></div>',
        '<form id="page"><fieldset><article><p>Main.</p></article></fieldset></form>',
        '<form><nav>x</nav><article><p>Main.</p><div id=reply><article>x</article></div></article></form>',
        '<article><p>Main.</p></article><section id="comments"><article>x</article></section><aside><article>x</article></aside>',
    ],
)
def test_main_text_of_odd_markup(page):
    assert pages.main_text(page) == "Main."


def test_main_text_of_marked_articles():
    posts = '<div class="post widget-box"><article>One.</article></div><div class="newsletter"><article>Two.</article></div>'
    assert pages.main_text(posts) == "One.\nTwo."


def test_short_texts_within_an_article_without_name():
    long = "A sentence that goes on for quite a while, as those of articles do. " * 3
    nested = lambda text: f"<div><div><p>{text}</p></div></div>"
    page = "<body><div>Site</div><h2><a href=1>Home</a></h2><div><h1>Title</h1></div>" + "<div></div>" * 5 + "".join(
        nested(text) for text in (long, "Short.", "<a href=2>All links.</a>", "<b>Two</b>", long)
    ) + "<div></div>" * 5 + "<div>Short.</div></body>"
    assert pages.main_text(page).split("\n") == ["Title", long.strip(), "Short.", "All links.", "Two", long.strip()]


@pytest.mark.parametrize(
    "inside",
    [
        "<p class='share-price'>Main.</p>",
        "<p id='ad-hoc'>Main.</p>",
        "<p class='notice-period'>Main.</p>",
        "<p class='search-results'>Main.</p>",
        "<table class='menu-prices'><tr><td>Main.</table>",
        "<div class='login-tutorial'>Main.</div>",
        "<header><h1>Main.</h1><p>By someone</p><nav>x</nav></header>",
        "<p>Main.</p><div class='ad-container top'>x</div><ul class=social-share-buttons><li>x</ul><div id='comments-list'>x</div>",
    ],
)
def test_marks_are_whole_names(inside):
    assert pages.main_text(f"<article>{inside}</article>") == "Main."
    assert pages.main_text(f"<div id='login-tutorial'>{inside}</div>") == ("" if "header" in inside else "Main.")


def test_marks_yield_to_the_text():
    prose = "A sentence that goes on for quite a while, as those of articles do, and then on. " * 2
    # a paragraph of prose stays, whatever it is called; a short one called so goes
    assert pages.main_text(f"<article><p class=notice>{prose}</p><p class=ad>Buy.</p></article>") == prose.strip()
    # most of a page is not its menu, but comments may be most of a page
    assert pages.main_text(f"<div class=menu><div>{prose}</div></div><div>x</div>") == f"{prose.strip()}\nx"
    assert pages.main_text(f"<div>Main.</div><div class=comments><div>{prose * 3}</div></div>") == "Main."


def test_sums_over_windows_choose_the_article():
    """Teasers and the article carry the same names: only how much text stands together tells
    them apart. Without sums, with the least threshold, the teasers come along."""
    prose = "A sentence that goes on for quite a while, as those of articles do. " * 3
    teasers = "".join(f"<article><h2>{k}</h2></article>" + "<div></div>" * 4 for k in range(5))
    page = f"<body><div>{teasers}</div><div><article><h1>Title</h1><p>{prose}</p><p>Short.</p></article></div></body>"
    assert pages.main_text(page).split("\n") == ["Title", prose.strip(), "Short."]
    assert pages.main_text(page, surge=0).split("\n") == ["0", "1", "2", "3", "4", "Title", prose.strip(), "Short."]
    # lines that weigh little each make a text together
    lines = "".join(f"<div>line {k} of a text</div>" for k in range(12))
    page = f"<body><div>Site name</div>{'<div></div>' * 5}{lines}{'<div></div>' * 5}<div>{'x' * 20}</div></body>"
    assert pages.main_text(page).split("\n")[0] == "line 0 of a text"
    assert len(pages.main_text(page, window=5).split("\n")) == 12 != len(pages.main_text(page, window=1).split("\n"))


class PlainPage(HTMLParser):
    """The article of a page as the given tables have them, by a parser of its own."""

    SKIPPED = ("script", "style", "title", "nav", "footer", "header", "aside", "form")

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.lines, self.parts, self.skipped, self.depth = [], [], [], 0

    def line(self):
        text = " ".join("".join(self.parts).split())
        self.parts = []
        if text:
            self.lines.append(text)

    def handle_starttag(self, tag, attrs):
        if tag == "br":
            self.parts.append(" ")
        elif tag not in ("b", "i", "a", "em", "strong", "span", "meta"):
            self.line()
        if tag in self.SKIPPED or (tag == "div" and dict(attrs).get("class") in ("ad", "comments", "sidebar", "cookie")):
            self.skipped.append(tag)
        if tag == "article":
            self.depth += 1

    def handle_endtag(self, tag):
        if tag not in ("b", "i", "a", "em", "strong", "span"):
            self.line()
        if self.skipped and self.skipped[-1] == tag:
            self.skipped.pop()
        if tag == "article":
            self.depth -= 1

    def handle_data(self, data):
        if self.depth and not self.skipped:
            self.parts.append(data)


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="sample tables not present")
def test_pages_query_matches_a_plain_parser(spark):
    found = {r.page_id: r.text for r in queries.op5_main_text(spark, SF_DIR).collect()}
    given = spark.read.parquet(f"{SF_DIR}/pages.parquet").collect()
    assert len(found) == len(given)
    for row in given:
        plain = PlainPage()
        plain.feed(row.html or "")
        plain.close()
        plain.line()
        assert found[row.page_id] == "\n".join(plain.lines)


def test_page_rows(spark):
    table = spark.createDataFrame(
        [(1, "u", PAGE, "x"), (1, "u", PAGE, "x"), (None, None, None, "x"), (2, "v", "", "x")],
        "page_id long, url string, html string, text string",
    )
    rows = pages.extract_pages(table).collect()
    assert sorted(r.n_chars for r in rows) == sorted([len(pages.main_text(PAGE))] * 2 + [0, 0])
    assert all(r.n_chars == len(r.text) for r in rows)
    assert pages.extract_pages(table.limit(0)).count() == 0


# --- encodings ---

ODD = [
    None, "", " ", "a<|endoftext|>b  c", "<|startoftext|><|x", "don't we'll I'M '", " \n\t x", "0123 4½ ²", "ΑΣ ΣΑΣ İstanbul",
    "日本語 é ​ a b", "ﬁ Å \x85 y x\x1fy", "x   ", "\n\n a \n b", "naïve—dash“quote”", "word " * 5_000, "a" * 400,
]


def fuzz(n, seed=0):
    rng = random.Random(seed)
    return ["".join(rng.choice("abcdethin' é.\n\t Ż0-\x1d ") for _ in range(rng.randint(1, 40))) for _ in range(n)]


def test_trie_encoding_like_the_library():
    encoder = bpe.TrieEncoder(WORD_BPE)
    library = Tokenizer.from_file(WORD_BPE)
    texts = [t for t in ODD + fuzz(3000)]
    for text, ids in zip(texts, encoder.encode(texts)):
        expected = library.encode(text or "", add_special_tokens=False).ids
        assert ids.tolist() == expected, text
        assert encoder.decode(ids.tolist()) == library.decode(expected, skip_special_tokens=False)


def test_bpe_rows(spark):
    library = Tokenizer.from_file(WORD_BPE)
    table = clashing(docs(spark, [*ODD, "again", "again"], [*range(len(ODD)), None, None]))
    rows = bpe.digest_encoded(bpe.encode_documents(table, WORD_BPE)).collect()
    assert len(rows) == len(ODD) + 2
    for row in rows:
        text = "again" if row.doc_id is None else ODD[row.doc_id] or ""
        ids = library.encode(text, add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        assert row.n_tokens == len(ids)
        assert row.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert row.decoded_sha256 == hashlib.sha256(decoded.encode()).hexdigest()
    assert bpe.encode_documents(table.limit(0), WORD_BPE).count() == 0


def test_piece_encoding_like_the_library():
    encoder = tokenstore.PieceEncoder(BYTE_BPE)
    library = Tokenizer.from_file(BYTE_BPE)
    texts = [*ODD, *fuzz(3000)]
    for text, ids in zip(texts, encoder.encode([t or "" for t in texts])):
        assert ids.tolist() == library.encode(text or "", add_special_tokens=False).ids, text


@settings(max_examples=60, deadline=None)
@given(
    st.lists(st.lists(st.integers(0, 2**32 - 1), max_size=40), max_size=12),
    st.sampled_from(["bit", "byte"]),
    st.integers(1, 50),
)
def test_planes_round_trip(texts, unit, block):
    sink = io.BytesIO()
    writer = tokenstore.PlaneWriter(sink, unit, block)
    for k, ids in enumerate(texts):
        writer.add(k, np.array(ids, np.uint32))
    writer.close()
    back = list(tokenstore.read_documents(sink, len(sink.getvalue())))
    assert [(k, ids.tolist()) for k, _, ids in back] == list(enumerate(texts))
    assert [s for _, s, _ in back] == [sum(map(len, texts[:k])) for k in range(len(texts))]
    index = tokenstore.read_index(sink, len(sink.getvalue()))
    assert all(n == block for n, _ in index["chunks"][:-1])


@pytest.mark.parametrize("unit", ["bit", "byte"])
def test_token_files(spark, unit):
    library = Tokenizer.from_file(BYTE_BPE)
    ids = [*range(len(ODD))][::-1]
    table = clashing(docs(spark, [*ODD, "same", "same", "lost"], [*ids, 3, 3, None])).repartition(5)
    rows = tokenstore.token_digest(tokenstore.round_trip(table, BYTE_BPE, 2, unit)).collect()
    texts = sorted(
        [(i, t or "") for i, t in zip(ids, ODD)] + [(3, "same"), (3, "same"), (-1, "lost")], key=lambda x: x[0]
    )
    expected = [[*library.encode(t, add_special_tokens=False).ids, 2] for _, t in texts]
    assert [r.start for r in sorted(rows, key=lambda r: r.start)][0] == 0
    assert sorted((-1 if r.doc_id is None else r.doc_id, r.n_tokens, r.ids_crc32) for r in rows) == sorted(
        (i, len(e), tokenstore.crc32_of(e)) for (i, _), e in zip(texts, expected)
    )
    at = 0
    last = -1
    for r in sorted(rows, key=lambda r: r.start):
        assert r.start == at and (r.doc_id or 0 if r.doc_id is not None else -1) >= last
        at += r.n_tokens
        last = -1 if r.doc_id is None else r.doc_id
    assert tokenstore.round_trip(table.limit(0), BYTE_BPE, 2).count() == 0
