"""Pages as browsers read them: implied ends, broken markup, and time in proportion to the page."""

from __future__ import annotations

import time

import pytest

from quarrystone.functions import markup
from quarrystone.operators.site import parse_page


def shown(html):
    p = markup.read(html)
    return [(x.tag, p.text(x, " ")) for x in p.elements if x.tag not in ("html", "body")]


@pytest.mark.parametrize(
    ("html", "want"),
    [
        ("<ul><li>a<li>b</ul>c", [("ul", "a b"), ("li", "a"), ("li", "b")]),
        ("<ul><li>a<ul><li>b</ul>c<li>d</ul>", [("ul", "a b c d"), ("li", "a b c"), ("ul", "b"), ("li", "b"), ("li", "d")]),
        ("<p>x<p>y<div>z</div>w", [("p", "x"), ("p", "y"), ("div", "z")]),
        ("<p>x<b>y</p>z", [("p", "x y"), ("b", "y")]),
        ("<dl><dt>a<dd>b<dt>c</dl>", [("dl", "a b c"), ("dt", "a"), ("dd", "b"), ("dt", "c")]),
        ("<table><tr><td>1<td>2<tr><td>3</table>4", [("table", "1 2 3"), ("tr", "1 2"), ("td", "1"), ("td", "2"), ("tr", "3"), ("td", "3")]),
        ("<table><tr><td><table><tr><td>1</table>2<td>3</table>", [("table", "1 2 3"), ("tr", "1 2 3"), ("td", "1 2"), ("table", "1"), ("tr", "1"), ("td", "1"), ("td", "3")]),
        ("<select><option>1<option>2</select>", [("select", "1 2"), ("option", "1"), ("option", "2")]),
        ("<h1>a<h2>b</h1>c", [("h1", "a"), ("h2", "b")]),
        ("<a href=x>1<a href=y>2</a>3", [("a", "1"), ("a", "2")]),
        ("<div><span>a</div>b</span>", [("div", "a"), ("span", "a")]),
        ("<span><div>a</span>b</div>", [("span", "a b"), ("div", "a b")]),
        ("<div/>x", [("div", "x")]),
        ("<svg><title>no</title><path/></svg>x<svg><p>y", [("p", "y")]),
        ("<script>if (a</b>) '<p>'</script ><p>x", [("p", "x")]),
        ("<title>a <b> &amp; c</title>x", [("title", "a <b> & c")]),
        ("<noscript><a href=n>n</a></noscript><template><p>t</template><p>x", [("p", "x")]),
    ],
)
def test_tree(html, want):
    assert shown(html) == want


def test_text():
    body = lambda html: parse_page(html)["body_text"]
    assert body("a < b <3 </> <!x> <![CDATA[y]]> <?z?> &amp;&copy &lt;p><!-- c --!>d<!-->e") == "a < b <3 &© <p> d e"
    assert body("<title>t</title>x") == "x" and body("<head><title>t</title></head><body>x</body>y") == "x y" and body(None) == ""
    assert body("x <a href='unclosed>y") == "x" and body("x <!-- open") == "x" and body("x<") == "x<"


def test_attributes():
    get = lambda html: markup.read(html).elements[-1].attrs
    assert get("<a HREF = '1&amp;2' b=x/y c d=\"&copy=3&lt\" href=2>") == {"href": "1&2", "b": "x/y", "c": "", "d": "&copy=3<"}
    assert get("<a href=x/>") == {"href": "x/"} and get("<a/b/c>") == {"b": "", "c": ""}


def test_parts_of_a_page():
    p = parse_page('<meta property="og:description" content="og"><meta name=description content=" D "><footer>F<address>A</footer><div class="x footer">G</div><a href="//[x">h</a><li>one<li>two', "https://x.no/")
    assert (p["description"], p["identity_excerpt"], p["links"]) == ("D", "F A A G", ["//[x"])
    assert [b["text"] for b in p["blocks"]] == ["one", "two"] and p["anchors"][0]["url"] is None


@pytest.mark.parametrize("unit", ["<font>", "<div>", "<li>a", "<ul><li>", "<p>x<b>", "<a ", "<", "<a b='", "<table><tr><td>", "<script>", "<!--", "</a ", "<article>", "&amp", "<div class=footer>", "</div>", "<svg>", "<h1>", "<option>", "<a href=x>"])
def test_deep_and_broken_pages_take_time_in_proportion(unit):
    began = time.time()
    parse_page(unit * 100_000 + "</span>" * 1000 + "x")
    assert time.time() - began < 40


def test_pages_that_are_not_html():
    for x in ("\x00\x01", "{}", "<" * 9, "<![if x]>y<![endif]>", "<!DOCTYPE", "&#xD800;&#0;&#99999999;", "<a href='http://[::1'>x</a>", '<script type="application/ld+json">' + "[" * 100_000 + "</script>"):
        assert parse_page(x, "https://x.no")["nodes"] == []
