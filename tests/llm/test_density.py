"""op4: the density, not the class names, selects the text."""

import re

import pyarrow.parquet as pq
import pytest

from tessera.llm import htmltext

PAGES = [p for p in pq.read_table("/root/testdata/sf0.01/pages.parquet").column("html").to_pylist() if p]


def renamed(page: str) -> str:
    return page.replace('<div class="ad">', '<div class="x1">')


def without_names(page: str) -> str:
    """The same page of plain blocks only."""
    for tag in ("article", "nav", "footer"):
        page = re.sub(rf"<{tag}(?=[\s>])", "<div", page).replace(f"</{tag}>", "</div>")
    return renamed(page)


def test_articles_are_found_among_neutral_class_names():
    assert any('class="ad"' in p for p in PAGES)
    for page in PAGES:
        assert htmltext.main_text(renamed(page)) == htmltext.main_text(page)


def test_most_articles_are_found_without_any_telling_name():
    # Articles about as short as the advert and the footer beside them cannot be told from these.
    same = [htmltext.main_text(without_names(p)) == htmltext.main_text(p) for p in PAGES]
    assert sum(same) > 0.8 * len(PAGES)
    long = [s for s, p in zip(same, PAGES, strict=True) if len(htmltext.main_text(p)) > 1500]
    assert sum(long) > 0.9 * len(long)


@pytest.mark.parametrize("page,text", [
    ("<div class=x1>aaa bbb ccc ddd</div><article><h1>T</h1><p>short one</p></article><div class=x2>eee fff ggg</div>", "T short one"),
    ("<article><h2>T</h2><p>tease</p></article><div>" + "a" * 400 + "</div>", "T tease " + "a" * 400),
    ("<article>x</article><article>" + "<p>" + "a" * 50 + "</p>" * 3 + "</article>", "a" * 50),
])
def test_the_densest_article_is_chosen(page, text):
    assert htmltext.main_text(page) == text


def test_no_pages(spark):
    empty = spark.createDataFrame([], "page_id BIGINT, url STRING, html STRING")
    assert htmltext.extract_text(empty).count() == 0
