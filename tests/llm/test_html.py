"""What density decides, what marks may cut, and pages that must not take long."""

import re
import time

import pytest

from gridloom.llm import html_text


def p(letter, *sizes):
    return "".join(f"<p>{letter * n}</p>" for n in sizes)


def found(page):
    return html_text.main_text(page).split()


MAIN = p("x", 300, 300, 300)


@pytest.mark.parametrize("notice", [
    "<div>Copyright 2024 Example Ltd. Terms apply.</div>", "<p>Please log in to read more.</p>",
    "<div><p>Read our new story about the sea.</p></div>", "loose words here", "<span>visitor number 5</span>"])
@pytest.mark.parametrize("frame", ["<body>{n}<article>{m}</article>{n}</body>", "<body>{n}<div>{m}</div>{n}</body>",
                                   "<body><div>{n}<div><article>{m}</article></div></div></body>"])
def test_unmarked_notices_beside_the_article_go(notice, frame):
    assert found(frame.format(n=notice, m=MAIN)) == ["x" * 300] * 3


def test_a_long_remark_beside_an_article_goes():
    remark = f"<div><p>{'remark ' * 20}</p></div>"
    assert found(f"<body><article>{p('x', *[400] * 8)}</article>{remark}</body>") == ["x" * 400] * 8


def test_marks_in_a_part_of_a_word_are_hints():
    dense = f"<div class='social-science'>{p('y', 300, 300)}</div>"
    assert found(f"<article>{MAIN}{dense}</article>") == ["x" * 300] * 3 + ["y" * 300] * 2
    assert found(f"<body><div>{MAIN}{dense}</div></body>") == ["x" * 300] * 3 + ["y" * 300] * 2
    thin = "<div class='share-this-now'><a href=/>one</a> <a href=/>two</a></div>"
    assert found(f"<article>{MAIN}{thin}</article>") == ["x" * 300] * 3
    for strong in ("comments", "cookie-notice", "ad-box-2", "reader comments"):
        assert found(f"<article>{MAIN}<div class='{strong}'>{p('y', 300, 300)}</div></article>") == ["x" * 300] * 3


def test_density_decides(monkeypatch):
    page = f"<body><div>{p('s', 30)}<ul><li><a href=/>a</a><li><a href=/>b</a></ul></div><div>{MAIN}</div></body>"
    assert found(page) == ["x" * 300] * 3
    monkeypatch.setattr(html_text, "text_density", lambda *_: 1.0)
    assert found(page) != ["x" * 300] * 3


def test_headings_and_sections_without_an_article():
    title = "<h1>the title</h1>"
    assert found(f"<body>{title}<div>{MAIN}</div></body>") == ["the", "title", *["x" * 300] * 3]
    assert found(f"<body><div>{title}</div><div>{MAIN}</div></body>") == ["the", "title", *["x" * 300] * 3]
    assert found(f"<body>{title}{MAIN}<ul><li><a href=/>a</a><li><a href=/>b</a></ul></body>") == [
        "the", "title", *["x" * 300] * 3]


def test_pages_of_the_table_give_their_article(spark):
    """A page's article by a plain cut of its markup; nothing around it is text."""
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet").collect()
    same = 0
    for r in pages:
        inner = re.search(r"<article>(.*?)</article>", r.html or "", re.S)
        if inner:
            plain = re.sub(r"<!--.*?-->|<(script|style)\b.*?</\1>", "", inner[1], flags=re.S)
            import html as h
            want = h.unescape(re.sub(r"</?(?:b|i|em|strong|a|span)\b[^>]*>", "", plain).replace("<", " <"))
            want = " ".join(re.sub(r"<[^>]*>", " ", want).split())
            same += html_text.main_text(r.html) == want
    assert same >= 0.9 * len(pages)


@pytest.mark.parametrize("page", [
    "<a " * 300000, "<! " * 300000, "<a \"" * 200000 + ">", "<b>" * 100000 + "</i>" * 100000, "<div>" * 100000 + "deep",
    "<div>" * 50000 + "<li>x" * 50000, "<td>" + "<b>" * 50000 + "<hr>" * 50000, "<p><td>" + "<b>" * 50000 + "<hr>" * 50000,
    "<!--" * 250000, "<script>" * 120000, "&" * 1000000, " " * 1000000 + "x", "<p class='" + "a " * 400000 + "'>x",
    "<table>" + "<tr><td>x" * 60000, "x" * 1000000, "<dl>" + "<dt>a<dd>b" * 50000], ids=range(16))
def test_long_odd_pages_take_little_time(page):
    before = time.process_time()
    assert isinstance(html_text.main_text(page), str)
    assert time.process_time() - before < 5


def test_odd_markup():
    assert found("a < b <p>c <!-- x") == ["a", "<", "b", "c"]
    assert found("one <a href='>'>two</a> <b") == ["one", "two", "<b"]
    assert found("<ul><li>a<li>b<ul><li>c</ul><li>d</ul>") == ["a", "b", "c", "d"]
    assert found("<title>t</title><p>x</i></b>y") == ["xy"]
