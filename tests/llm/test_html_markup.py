"""Broken markup: nothing of the article is lost, and time grows with the page's length."""

import time

import pytest

from tidemark.llm import html_crf

ARTICLE = "<article><p>First words, of the text.</p><p>And more of it here.</p></article>"
TEXTS = ["First words, of the text.", "And more of it here."]


@pytest.mark.parametrize(
    "head",
    [
        '<header><svg viewBox="0"/></header>',
        "<header><svg><path d='1'></header>",
        "<header><button>Menu</header>",
        "<button>Menu",
        "<div><object data='x'></div>",
        "<iframe src='x'>",
        "<select><option>a<option>b</div>",
        "<noscript>",
        "<template>",
        '<img alt="unclosed>',
        "<div class='a b>",
        "a < b and c > d <3",
        "<!doctype html><?xml?>",
    ],
)
def test_article_stays(head):
    found = [b.text for b in html_crf.leaf_blocks(f"<html><body>{head}{ARTICLE}</body></html>")]
    assert [t for t in found if t in TEXTS] == TEXTS


def test_left_out_elements_are_left_out():
    page = (
        "<p>Keep <button>Click <b>me</b></button> this <select><option>one<option>two</select>too.</p>"
        "<noscript><div>No</div><p>script</p></noscript><svg><title>x</title><text>No</text></svg>"
        "<script>if (a < b) { '<p>no</p>' }</script><style>p > a {}</style><template><p>No</p></template>"
        "<object><p>No</p></object><textarea>No <p></textarea><p>End &amp; out.</p>"
    )
    assert [b.text for b in html_crf.leaf_blocks(page)] == ["Keep this too.", "End & out."]


def test_quotes_hide_what_they_should():
    page = "<p title=\"a > b\" class='c \"d\"'>One</p><a href=x>two</a><p data-x='<p>'>Three</p>"
    assert [b.text for b in html_crf.leaf_blocks(page)] == ["One", "two", "Three"]


@pytest.mark.parametrize("piece", ['<div x="', "<a '", '<a ">" ', "<b \"<b>\" '", "<", "<!--", "<button>", "<p><svg>", "</p", "<a b='c\" "])
def test_a_megabyte_of_broken_markup(piece):
    page = piece * (1_000_000 // len(piece)) + ARTICLE
    start = time.process_time()
    html_crf.leaf_blocks(page)
    assert time.process_time() - start < 6


def test_training_takes_distinct_pages(spark):
    rows = [(i % 5, f"u{i % 5}", f"<body><nav>menu {i % 5}</nav>{ARTICLE}</body>") for i in range(50)] + [(9, "n", None)]
    field = html_crf.train(spark.createDataFrame(rows, "page_id long, url string, html string"))
    assert html_crf.main_text(rows[0][2], field) == "\n\n".join(TEXTS)
