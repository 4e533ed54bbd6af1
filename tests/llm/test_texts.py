"""Fingerprints, license scan and main text of pages."""

from __future__ import annotations

import hashlib
import time

from clickloom.llm.fingerprints import PrefixHash, codes_of, fingerprints
from clickloom.llm.licenses import TEMPLATES, scan
from clickloom.llm.site_tree import extract, low_branches, main_text, tokens

from .samples import sentences, varied

PAGES = "page_id long, url string, html string"


def page(number, title, *paragraphs):
    body = "".join(f"<p>{p}</p>" for p in paragraphs)
    return (
        number,
        f"https://site.example/{number}",
        "<html><head><title>x</title><style>p{}</style></head><body><header><a href='/'>Site name</a></header>"
        "<nav><ul><li><a href='/a'>Home</a></li><li><a href='/b'>News</a></li></ul></nav>"
        f"<article><h1>{title}</h1>{body}</article><script>var a = 1;</script>"
        "<footer>All rights reserved by the site</footer></body></html>",
    )


def test_edited_texts_and_fingerprints(spark, documents):
    texts = varied(4, 10)
    got = {r.doc_id: r for r in fingerprints(documents(*texts)).collect()}
    for doc, text in enumerate(texts, 1):
        text = text or ""
        following = texts[doc - 2] or ""
        cut = len(text) // 3
        edited = text[: len(text) - cut] + following[:cut]
        assert got[doc].n_chars == len(text)
        assert got[doc].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert 0 <= got[doc].near_edited <= 1 and 0 <= got[doc].near_next <= 1
        if edited == text:
            assert got[doc].near_edited == 1.0
    marks = {}
    for doc, text in enumerate(texts, 1):
        assert marks.setdefault(text or "", got[doc].fingerprint) == got[doc].fingerprint


def test_fingerprints_of_nothing(spark, documents):
    assert fingerprints(documents("x").limit(0)).collect() == []


def test_prefix_hashes_compare_spans():
    a, b = "the quick brown fox jumps", "a quick brown fox sleeps"
    one, two = PrefixHash(codes_of(a)), PrefixHash(codes_of(b))
    assert one.equal(4, two, 2, 16) and not one.equal(0, two, 0, 3)
    assert one.common(4, two, 2) == len("quick brown fox ")
    assert one.common(0, one, 0) == len(a) and one.common(0, two, 0) == 0


def test_licenses_are_named_and_clean_texts_left_alone(spark, documents):
    names = ["ISC", "MPL-2.0", "BSD-3-Clause"]
    texts = [f"{sentences(n, 40)}\n{TEMPLATES[n][-1]}\n{sentences(-1, 30)}" for n in names]
    got = scan(documents(*texts, sentences(9, 80), None, "", "his license plate was blue")).collect()
    found = {(r.doc_id, r.license) for r in got if r.confirmed}
    assert found == {(i, n) for i, n in enumerate(names, 1)}
    assert scan(documents("x").limit(0)).collect() == []


def test_main_text_without_site_furniture(spark):
    rows = [page(i, f"Title {i}", f"Text {i}  of &amp; about\n topic {sentences(i, 30)}.", f"More {i}.") for i in range(1, 9)]
    rows += [(20, None, None), (21, "https://site.example/e", ""), (22, "no url", "plain <b>words</b>")]
    got = {r.page_id: r for r in extract(spark.createDataFrame(rows, PAGES)).collect()}
    assert len(got) == len(rows)
    for i in range(1, 9):
        lines = got[i].text.split("\n")
        assert lines == [f"Title {i}", f"Text {i} of & about topic {sentences(i, 30)}.", f"More {i}."]
        assert got[i].n_chars == len(got[i].text)
    assert (got[20].text, got[20].n_chars, got[21].text) == ("", 0, "")
    assert extract(spark.createDataFrame([], PAGES)).collect() == []


def unnamed(number, host="plain.example", body=None):
    """A page whose furniture no name or tag tells."""
    return (
        number,
        f"https://{host}/{number}",
        "<html><body><div class='x1'>Plain site <a href='/'>home</a> of all things</div>"
        f"<div class='x2'><h1>Head {number}</h1><p>{body or sentences(number, 40)}</p>"
        "<div class='x3'>Read on in our printed volumes</div></div>"
        "<div class='x4'><p>All words are free</p></div></body></html>",
    )


def test_tree_removes_unnamed_furniture(spark):
    rows = [unnamed(i) for i in range(1, 25)]
    # One article at many places is not furniture, and neither is anything on a host of one page.
    rows += [unnamed(i, "copies.example", "the same words") for i in range(100, 120)]
    rows += [(i, u, h.replace(f"Head {i}", "Head")) for i, u, h in [unnamed(i, "same.example", "one text") for i in range(200, 220)]]
    rows += [unnamed(300, "alone.example"), unnamed(1)]
    got = sorted((r.page_id, r.text) for r in extract(spark.createDataFrame(rows, PAGES)).collect())
    texts = dict(got)
    for i in range(1, 25):
        assert texts[i] == f"Head {i}\n{sentences(i, 40)}"
    assert [t for i, t in got if i == 1] == [texts[1]] * 2
    for i in range(100, 120):
        assert texts[i] == f"Head {i}\nthe same words"
    for i in range(200, 220):
        assert "Head\none text" in texts[i]
    assert "All words are free" in texts[300]


def test_low_branches_are_those_that_never_change(spark):
    rows = [("h", unnamed(i, body="a b" if i % 3 else None)[2]) for i in range(1, 20)]
    rows += [("g", unnamed(1)[2]), ("g", unnamed(2)[2])]
    low = {r.host: set(r.low) for r in low_branches(spark.createDataFrame(rows, "host string, html string")).collect()}
    assert set(low) == {"h"}
    assert {p.rsplit(">", 1)[1] for p in low["h"]} == {"div.x1.#", "div.x3.#", "div.x4.#"}


def test_attributes_and_broken_markup():
    none = frozenset()
    assert main_text("<p title='the hidden valley'>one</p><a href='/hidden/valley'>two</a><div data-id=\"footer\">three</div>", none) == "one\ntwo\nthree"
    assert main_text("<a title=it's>x</a> 2 < 3 <br/>y", none) == "x 2 < 3 y"
    assert main_text("<div class=footer>x</div><p hidden>y</p>z &lt;b&gt; <!-- c --><p>cut <a hre", none) == "z <b>\ncut"
    assert list(tokens("a<script>if (a<b) </SCRIPT >c")) == [
        ("text", "a", {}, False), ("start", "script", {}, False), ("text", "c", {}, False)
    ]


def test_hostile_markup_takes_linear_time():
    for part in ("<a", '<a x="', "<a<p>", "<script></script", "<!", "<!--", "<div>", "<p a "):
        start = time.perf_counter()
        list(tokens(part * (1_000_000 // len(part))))
        assert time.perf_counter() - start < 5
    main_text("<div>" * 20_000, frozenset())
