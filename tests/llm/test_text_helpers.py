"""Word hashes, HTML grammar, forms and nesting."""

import time

import pytest

from merchpulse.llm import decontam, htmltext, licenses, neardup
from merchpulse.llm.textbytes import NONSPACE, split_words


def thue_morse(n, flip=False):
    return "".join("ab"[(bin(i).count("1") + flip) % 2] for i in range(n))


@pytest.mark.parametrize("n", [8, 64, 128, 1024, 4096])
def test_words_of_equal_polynomials_differ(n):
    words = split_words([f"{thue_morse(n)} {thue_morse(n, True)} {thue_morse(n)} {thue_morse(n)}a x xy".encode()], NONSPACE)
    h = words.hashes().tolist()
    assert h[0] == h[2] and len(set(h)) == 5


def test_such_words_link_no_documents(spark):
    rows = [(1, thue_morse(1024)), (2, thue_morse(1024, True)), (3, thue_morse(1024))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in neardup.near_duplicates(docs, 4).collect()}
    assert got == {1: 1, 2: 2, 3: 1}
    bench = spark.createDataFrame([(9, thue_morse(1024, True))], "item_id long, text string")
    assert {r.doc_id: r.n_hit for r in decontam.contamination(docs, bench).collect()} == {1: 0, 2: 1, 3: 0}
    phrase = licenses.Template("t", "t", f"a {thue_morse(1024)}", True)
    other = spark.createDataFrame([(1, f"a {thue_morse(1024, True)}"), (2, f"a {thue_morse(1024)}")], "doc_id long, text string")
    assert {r.doc_id: r.n_base for r in licenses.licenses(other, [phrase]).collect()} == {1: 0, 2: 1}


BODY = "<p>" + "The first paragraph of the article, long enough to be kept, with commas, and words. " * 3 + "</p>"


@pytest.mark.parametrize("markup, kept, gone", [
    ("<article><p data-x=it's>First, it is here.</p><p>It isn't lost.</p>" + BODY + "</article>", ["First, it is here.", "It isn't lost."], ["data-x"]),
    ("<article>" + BODY + '<p>See <a href="x>linked</a> text here.</p></article>', ["linked"], ["href", "<a"]),
    ("<body><form action=/x><input name=a>" + BODY * 3 + "<button>Send</button></form></body>", ["The first paragraph"], ["Send"]),
    ("<body>" + BODY * 3 + "<form><p>Your mail</p><input></form></body>", ["The first paragraph"], ["Your mail"]),
    ("<article>" + BODY + '<p class="alert">Mind the step, please.</p><p>A <span class="side">word</span> inside.</p></article>', ["Mind the step, please.", "A word inside."], []),
    ("<article>" + BODY + '<div class="ad">Buy now</div></article>', ["The first paragraph"], ["Buy now"]),
])
def test_markup(markup, kept, gone):
    text = htmltext.extract(f"<html>{markup}</html>")
    assert all(k in text for k in kept) and not any(g in text for g in gone), text


@pytest.mark.parametrize("page", [
    "<blockquote>" * 8000 + "deep, deep text" + "</blockquote>" * 8000,
    "<div>" * 4000 + "text</b></i></u></q>" * 4000,
    "<span>" * 4000 + "<p>text, here" * 4000 + "<li>x" * 4000,
])
def test_time_is_linear_in_nesting(page):
    import sys

    held = sys.getrecursionlimit()
    sys.setrecursionlimit(1_000_000)
    try:
        begin = time.process_time()
        assert "text" in htmltext.extract(page)
        assert time.process_time() - begin < 3
    finally:
        sys.setrecursionlimit(held)


def test_pages_with_other_columns_and_none(spark):
    rows = [(1, "u", "<p>Some text, here.</p>", "x", 1), (None, None, None, None, None), (1, "u", "", "x", 1)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string, n_chars int")
    got = sorted((r.page_id or 0, r.text, r.n_chars) for r in htmltext.extract_pages(pages).collect())
    assert got == [(0, "", 0), (1, "", 0), (1, "Some text, here.", 16)]
    assert htmltext.extract_pages(pages.limit(0)).count() == 0
