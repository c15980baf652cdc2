from __future__ import annotations

import random

import pytest

from martsmith.llm.htmltext import extract, op7_html_text, visible_text

from .conftest import SF

CASES = {
    "a<p>b<p>c": "a\n\nb\n\nc",
    "<p>a\n  b <b>c</b><i> d</i>e</p>": "a b c de",
    "<p>x<br>y<br/>z": "x\ny\nz",
    "<div>a</div><div>b</div>": "a\nb",
    "<ul><li>a<li>b<ul><li>c</ul><li>d</ul>": "- a\n- b\n  - c\n- d",
    "<ol start=9><li>a<li>b<p>c</ol>": "9. a\n10. b\n\n    c",
    "<dl><dt>t<dd>d<dt>u<dd>e</dl>": "t\n  d\nu\n  e",
    "<table><tr><th>Name<th>Qty<tr><td>apple<td>10<tr><td>fig<td>3</table>": "Name   Qty\napple  10\nfig    3",
    "<table><td>a<td>b</table>": "a  b",
    "<table><tr><td colspan=2>wide cell<td>z<tr><td>1<td>2<td>3</table>": "wide cell  z\n1  2       3",
    "<table><tr><td>a<br>b<td>c</table>": "a  c\nb",
    "<table><tr><td><table><tr><td>1<td>2</table><td>x</table>": "1  2  x",
    "<pre>  a\n\tb  </pre>": "  a\n\tb",
    "<script>if (a</b>) '</p>'</script>x<style>p{}</style>": "x",
    "<head><title>t</title></head><body>x": "x",
    "<head><title>t</title><p>x": "x",
    "<div hidden>a</div><span style='Display : NONE'>b</span><p style='color:red'>c": "c",
    "<details><summary>s</summary>no</details><details open><summary>t</summary>yes</details>": "s\nt\nyes",
    "<!-- <p>a --> b &amp; &eacute; &lt;": "b & é <",
    "1 < 2 <3 a>b": "1 < 2 <3 a>b",
    "<p>a<!-- open": "a",
    "<a title='x>y' href=\"q'>\">l</a>": "l",
    "</p></td></x>a</b>": "a",
    "<template>t</template><noscript>n</noscript><svg><text>s</text></svg>v": "v",
    "<textarea>a\n b</textarea>": "a\n b",
    "<input type=submit value=Go><input type=hidden value=h>": "Go",
    "<blockquote><p>q</blockquote>r": "  q\n\nr",
    "": "", "   ": "",
}


@pytest.mark.parametrize("html", CASES)
def test_rendering(html):
    assert visible_text(html) == CASES[html]


def test_deep_and_broken_pages_take_linear_time():
    assert visible_text("<div>" * 50_000 + "x") == "x"
    assert visible_text("<b>" * 50_000 + "x" + "</b>" * 50_000) == "x"
    assert visible_text("<table><tr><td>" * 300 + "x") == "x"
    assert visible_text("<" * 50_000).count("<") == 50_000
    visible_text('<a "' * 20_000)
    visible_text("<p " * 20_000)


def test_every_visible_word_is_there(spark):
    import re

    pages = {r.page_id: r.html for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    got = {r.page_id: r for r in op7_html_text(spark, SF).collect()}
    assert got.keys() == pages.keys()
    from html import unescape

    for i, html in pages.items():
        plain = re.sub(r"(?s)<head>.*?</head>|<!--.*?-->|<(script|style)\b.*?</\1>", " ", html)
        words = unescape(re.sub(r"(?s)<!?/?[a-zA-Z][^>]*>", " ", plain)).split()
        assert [w for w in got[i].text.split() if w != "-"] == [w for w in words if w != "-"]
        assert got[i].n_chars == len(got[i].text)


def test_edge_cases(spark):
    rows = [(1, None, 0), (2, "", 0), (1, None, 0), (None, "<p>a", 0), (3, "<p>" + "w " * 200_000, 0)]
    pages = spark.createDataFrame(rows, "page_id long, html string, html_in int")
    got = sorted(((str(r.page_id), r.text) for r in extract(pages, keep=["page_id", "html_in"]).collect()), key=str)
    assert got == sorted([("1", None), ("2", ""), ("1", None), ("None", "a"), ("3", ("w " * 200_000).strip())], key=str)
    assert extract(pages.limit(0), keep=["page_id"]).count() == 0


@pytest.mark.parametrize("html,text", [
    ('<a href="x"">link</a><p class="a">Hello</p><p class="b">World</p>', "link\n\nHello\n\nWorld"),
    ("<p class=it's>Hello world. It's great</p>", "Hello world. It's great"),
    ("<p it's>Hello <b \">there</b> \"you\"", 'Hello there "you"'),
    ('<a x=y="z>l</a> "r"', 'l "r"'),
    ("<a title = 'x>y' b= \"q'>\"c>l</a>", "l"),
    ('<p title="open>text', "text"),
    ("<div class=a/b hidden>no</div><input value=it's><input value=\"a'b\"><input value=''>", "it'sa'b"),
])
def test_quotes_delimit_values_only_after_equals(html, text):
    assert visible_text(html) == text


def test_stray_quotes_take_linear_time():
    for part in ('<a x="', "<a x='", '<a x=" \'', "<a ='", '<p "a=\'>', "<a b =\n", "<a x" + " " * 50):
        visible_text(part * 20_000)
    visible_text("<a x" + " " * 200_000 + "y" + "/" * 200_000)


@pytest.mark.parametrize(("html", "want"), [
    ("<table><tr><td rowspan=2>a<td>b<tr><td>c<tr><td>d<td>e</table>", "a  b\n   c\nd  e"),
    ("<table><tr><td>x<td rowspan=0>y<td>z<tr><td>1<td>2</table>", "x  y  z\n1     2"),
    ("<div style='visibility:hidden'>no <b style='visibility: visible'>yes</b> no</div>", "yes"),
    ("<style>.x{display:none} #y,p.z { visibility : hidden }</style><p class='a x'>no<p id=y>no<p class=z>no<div class=z>yes</div>", "yes"),
    ("<style>/* .a */ p{display:none} p.b{display:block}</style><p>no<p class=b>yes", "yes"),
    ("<style>.n{display:none}</style><p class=n style='display:block'>yes", "yes"),
    ("<style>.n{display:none!important}</style><p class=n style='display:block'>no", ""),
    ("<style>@media print{p{display:none}} @media screen{i{display:none}} div p{display:none}</style><p>yes<i>no</i>", "yes"),
    ("<style media=print>p{display:none}</style><p>yes", "yes"),
    ("<div style='white-space:pre'>a  b\n  c</div>", "a  b\n  c"), ("<p>a <span style='white-space: pre-wrap'>b  c</span>  d", "a b  c d"),
    ("<ol reversed><li>a<li>b<li>c</ol>", "3. a\n2. b\n1. c"), ("<ol start=5><li>a<li value=9>b<li>c</ol>", "5. a\n9. b\n10. c"),
    ("<ol reversed start=9><li>a<li>b</ol>", "9. a\n8. b"), ("<p hidden>no<p>yes", "yes"), ("<style>p{}</style><p>yes", "yes"), ("<style>{x:y}}p{display:none", ""),
])
def test_spans_styles_and_numbers(html, want):
    assert visible_text(html) == want


def canvas(rows):
    """A table drawn cell by cell on a grid of owners, then on a sheet of characters."""
    owner, size = {}, {}
    for y, row in enumerate(rows):
        x = 0
        for n, (columns, down, text) in enumerate(row):
            while (y, x) in owner:
                x += 1
            for dy in range(down):
                for dx in range(columns):
                    owner.setdefault((y + dy, x + dx), (y, n))
            size[y, n] = (x, columns, text)
    width = [0] * (1 + max((x + c - 1 for x, c, _ in size.values()), default=0))
    for x, columns, text in size.values():
        if columns == 1:
            width[x] = max(width[x], len(text))
    for _, (x, columns, text) in sorted(size.items()):
        if columns > 1:
            width[x + columns - 1] += max(0, len(text) - sum(width[x:x + columns]) - 2 * (columns - 1))
    lines = []
    for y, row in enumerate(rows):
        sheet = [" "] * (sum(width) + 2 * len(width))
        for n in range(len(row)):
            x, _, text = size[y, n]
            left = sum(width[:x]) + 2 * x
            sheet[left:left + len(text)] = text
        if any(t for *_, t in row):
            lines.append("".join(sheet).rstrip())
    return lines


def test_tables_equal_a_drawing():
    r = random.Random(8)
    for _ in range(300):
        rows = [[(r.choice([1, 1, 1, 2, 3]), r.choice([1, 1, 1, 2, 4]), "x" * r.randint(1, 9)) for _ in range(r.randint(1, 5))] for _ in range(r.randint(1, 6))]
        html = "<table>" + "".join("<tr>" + "".join(f"<td colspan={c} rowspan={d}>{t}" for c, d, t in row) for row in rows) + "</table>"
        assert visible_text(html).split("\n") == canvas(rows)
