"""Pages whose head has no end tag, and self-closed svg and math."""

from __future__ import annotations

import pytest

from paralith.llm import html_text


def shown(page):
    return " ".join(n.text.strip() for n in html_text.parse(page) if n.tag == "#text" and n.text.strip())


@pytest.mark.parametrize("page, text", [
    ("<head><title>T</title><body><p>one</p><p>two</p>", "one two"),
    ("<html><head><meta charset=utf-8><title>T</title><style>p{}</style><p>one", "one"),
    ("<head><title>T</title>\n one <b>two</b>", "one two"),
    ("<head>\n<bgsound src=x><script>var a = '<p>no</p>'</script><div>one</div>", "one"),
    ("<head><title>T</title></head><body><p>one", "one"),
    ("<head><template><p>no</p></template><noscript><p>no</p></noscript></head><p>one", "one"),
    ("<div><svg/>one</div><p>two", "one two"),
    ("<div><svg class='x' /><math/>one</div><p>two", "one two"),
    ("<div><svg><title/><path d='M0'/></svg>one</div><p>two", "one two"),
    ("<div><svg width=10/>no</svg>one</div><p>two", "one two"),
    ("<div/>one</div><p>two", "one two"),
])
def test_texts_shown(page, text):
    assert shown(page) == text


def test_main_text_without_end_of_head(spark):
    body = "<body><article><h1>Title</h1><p>" + "A long sentence of plain words stands here. " * 8 + "</p></article></body>"
    pages = [(1, f"<html><head><title>T</title></head>{body}</html>"), (2, f"<html><head><title>T</title>{body}</html>"), (3, f"<html><head><title>T</title></head><svg/>{body}</html>")]
    got = {r["page_id"]: r["text"] for r in html_text.extract_main_text(spark.createDataFrame([(i, "", h) for i, h in pages], "page_id bigint, url string, html string")).collect()}
    assert got[1] and got[1] == got[2] == got[3]
