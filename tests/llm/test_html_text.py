"""Main text: pages left open, boxes inside lines, names that only hint, density inside articles, and a plain second reading of the given pages."""

import re
import time
from html import unescape

import pytest

from recordloom.llm import html_text

PROSE = "It is one of the things that they have in the house of the man, and it was there for a long time."
text = lambda html: html_text.main_text(html)[0]


@pytest.mark.parametrize("piece", ['<a href="', "<a href='x", "<textarea>", "</textarea ", "<!--", "<!x", "<p <b ", '<a ="\'', "<a =\"'\"", "<script", "<", "</", "&", "<iframe><a ='", "<p class=\"a b\" x"])
def test_unclosed_markup_takes_linear_time(piece):
    began = time.perf_counter()
    text(piece * (900_000 // len(piece)))
    text("<article><p>" + PROSE + piece * (300_000 // len(piece)) + '">')
    assert time.perf_counter() - began < 8


def test_raw_elements_without_an_end():
    assert text("<article><p>One.<textarea>two</p><textarea>three").startswith("One.")
    assert text("<article><p>One.</p><textarea>x</textarea ><p>Two.</p>") == "One.\nTwo."
    assert text("<article><p>a<script>no</p>") == "a"


def test_boxes_inside_a_line_cut_their_own_text():
    assert text("<article><p>One <svg><text>icon</text></svg> two.</p></article>") == "One two."
    assert text('<article><p>One <span class="ad">buy <b>now</b></span> two <button>go</button>.</p></article>') == "One two ."
    assert text("<article><p>One <label>named</label> two <math>x</math>.</p></article>") == "One named two x."
    assert text("<article><p>One <button><div>go</div></button> two.</p></article>") == "One\ntwo."


def test_names_that_hint_need_prose():
    short, long = "Follow us on the net", PROSE * 2
    page = '<article><p>{0}</p><div class="social-history"><p>{0}</p></div><div class="social-history"><p>{1}</p></div><div class="social"><p>{0}</p></div><div class="share-buttons box2"><p>{0}</p></div></article>'
    assert text(page.format(long, short)) == f"{long}\n{long}"
    assert text(f'<article><p>{PROSE}</p><div class="user-feedback"><p>{PROSE} Me too.</p></div></article>') == PROSE


def test_density_decides_inside_articles():
    words = " | ".join(f"Catchword{k}" for k in range(20))
    links = " ".join(f"<a href=x>The page of it {k}</a>" for k in range(10))
    assert text(f"<article><p>{PROSE}</p><div>{words}</div><div>{links}</div><p>{PROSE}</p></article>") == f"{PROSE}\n{PROSE}"
    # A paragraph stays whatever is in it, and so does a table or a list among good blocks, or an article in another language.
    assert text(f"<article><p>{PROSE}</p><p>{words}</p><ul><li>Steel, 12 mm</li></ul><p>{PROSE}</p></article>") == f"{PROSE}\n{words}\nSteel, 12 mm\n{PROSE}"
    other = "Nagyon szép történet volt ez, amelyet mindenki szívesen olvasott és sokáig megjegyzett magának akkor."
    assert text(f"<article><p>{other}</p><div>{other}</div></article>") == f"{other}\n{other}"


LABELLED = [
    (True, "<h1>The house of the man</h1>"), (True, f"<p>{PROSE}</p>"), (True, "<p>Short one.</p>"), (False, "<nav><a href=/>Home</a></nav>"), (True, f"<blockquote>{PROSE}</blockquote>"), (False, f'<div class="advert"><p>{PROSE}</p></div>'),
    (True, "<pre>x = 1</pre>"), (False, f"<aside>{PROSE}</aside>"), (True, "<ul><li>One of them</li></ul>"), (False, f"<form><p>{PROSE}</p></form>"), (False, "<p><a href=1>More on this</a> <a href=2>And on that</a></p>"), (True, "<h2>What they have</h2>"),
    (True, f"<table><tr><td>{PROSE}</td></tr></table>"), (False, f'<div class="cookie-notice">{PROSE}</div>'), (False, f'<div id="comments">{PROSE}</div>'), (True, f"<div>{PROSE}</div>"), (False, f"<p hidden>{PROSE}</p>"), (False, f'<p style="display:none">{PROSE}</p>'),
    (True, f"<p>{PROSE} <a href=x>See it</a></p>"), (False, f'<div role="navigation">{PROSE}</div>'), (False, f'<div class="related">{PROSE}</div>'), (True, "<figure><figcaption>The man in the house</figcaption></figure>"),
    (False, f'<section class="newsletter signup">{PROSE}</section>'), (True, f'<section class="chapter">{PROSE}</section>'), (False, f"<footer>{PROSE}</footer>"), (True, f'<div class="notice-of-the-king">{PROSE}</div>'), (False, "<select><option>One of it</option></select>"),
    (True, f"<p>{PROSE}<br>{PROSE}</p>"), (False, f'<div class="breadcrumb">{PROSE}</div>'), (False, f'<div class="guestbook">{PROSE}</div>'), (True, f"<details><summary>More of it</summary><p>{PROSE}</p></details>"), (False, f"<dialog>{PROSE}</dialog>"),
]


def test_blocks_labelled_by_hand():
    """Each block alone between two paragraphs of an article."""
    for good, block in LABELLED:
        got = text(f"<article><p>Begin. {PROSE}</p>{block}<p>End. {PROSE}</p></article>")
        assert (got.count("\n") > 1) == good, block


def test_given_pages_by_a_second_reading(spark):
    """The given pages mark their articles and close what they open; there, plain patterns find the same text."""
    for (html,) in spark.read.parquet("/root/testdata/sf0.01/pages.parquet").select("html").collect():
        inside = "\n".join(re.findall(r"<article>(.*?)</article>", html, re.S))
        parts = re.split(r"</?(?:p|h1|article|div|ul|li)\b[^>]*>", inside)
        lines = [" ".join(unescape(re.sub(r"<[^>]*>", lambda m: " " if m[0].startswith("<br") else "", part)).split()) for part in parts]
        assert text(html) == "\n".join(x for x in lines if x)
