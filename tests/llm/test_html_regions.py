"""Main text: regions by ratio, line breaks, broken pages in linear time."""

import time

import pytest
from pagewright.llm.fixtures import MAIN_TEXT
from pagewright.llm.html_text import main_text


@pytest.mark.parametrize("html, text", MAIN_TEXT)
def test_fixtures(html, text):
    assert main_text(html) == text


def test_line_breaks_stay_in_their_paragraph():
    assert main_text("<article><p>one<br>two <b>thr</b>ee</p><p>four<hr>five</article>") == "one two three four five"


@pytest.mark.parametrize("part", ["</b>", "<b>", "<div><p>x", "</p><p>", "<table><td><b>x</b></table>", "<p><table><td><div>"])
def test_broken_pages_take_linear_time(part):
    long = "<article><p>Words of the article. " + "<div>" * 500 + part * 30_000
    began = time.time()
    assert main_text(long).startswith("Words of the article.")
    assert time.time() - began < 20
