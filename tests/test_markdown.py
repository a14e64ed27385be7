"""Page conversion: fixed cases, every visible word of the test pages, random trees, and long broken markup."""

import random
import re
import time
from html.parser import HTMLParser

import duckdb
import pytest

from claimloom.operators import markdown as D

CASES = {
    "": "", "   ": "", "plain": "plain", "<p>a<p>b": "a\n\nb", "<p>a</p>b<p>c": "a\n\nb\n\nc", "a<br>b": "a\nb", "<h2>A &amp; <b>b</b></h2>x": "## A & **b**\n\nx", "<b> a </b>b": "**a** b", "<b></b>x<i> </i>": "x",
    "<a href='/x?a=1&amp;b=2'>l <em>k</em></a><a>no</a><a href=y></a>": "[l *k*](/x?a=1&b=2)no", "<ul><li>one<li>two<ol><li>x</li><li><p>y</p><p>z</p></ol></ul>": "- one\n- two\n  1. x\n  2. y\n    z",
    "<table><tr><th>h|1<th>h2</tr><tr><td>a<td><b>x</b><p>q</p><table><tr><td>in</td></tr></table></table>": "| h\\|1 | h2 |\n| --- | --- |\n| a | **x** q in |", "<table><tr><td></table>": "", "<table><td>a</table>": "| a |\n| --- |", "<table><tr><td>a</td></tr><tr><td>b<td>c</table>t": "| a |  |\n| --- | --- |\n| b | c |\n\nt",
    "<pre>\n a\n  b\n</pre>": "```\n a\n  b\n```", "<blockquote>q<br>r</blockquote>": "> q\n> r", "a<hr>b": "a\n\n---\n\nb", "<img alt='p q' src=s.png>": "![p q](s.png)", "a < b > c <1": "a < b > c <1", "</p></table></li>x": "x", "<li>alone": "alone", "<!-- never ends <p>x": "", "x<script>var a = '</p>';</script >y": "xy", "x<script>no end": "x",
    "x<a href=\"no end>y": "xy", "<title>t</title><head><meta name=x>q</head>b": "b", "<P CLASS=x>A</P><DIV>B": "A\n\nB", "&nbsp;&lt;b&gt;&#8217;&bogus;": "<b>’&bogus;", "<p><b>t<p>u": "**t**\n\nu", "<custom-x>a</custom-x>b": "ab", "<div><div>a</div>b</div>c": "a\n\nb\n\nc",
}


@pytest.mark.parametrize("html", sorted(CASES))
def test_cases(html):
    assert D.pages_of(html) == [CASES[html]]


def test_page_breaks():
    assert D.pages_of("a<p style='color:red; PAGE-BREAK-BEFORE: always'>b<div style='break-before:page'>c</div>d") == ["a", "b", "c\n\nd"]
    assert D.pages_of(None) == [""]


class Words(HTMLParser):
    """The visible words, by another parser."""

    def __init__(self):
        super().__init__()
        self.out, self.hidden = [], 0

    def handle_starttag(self, tag, attrs):
        self.hidden += tag in ("script", "style", "title")
        if tag in ("p", "br", "li", "div", "h1", "article", "nav", "footer", "ul"):
            self.out.append(" ")

    def handle_endtag(self, tag):
        self.hidden -= tag in ("script", "style", "title")
        if tag in ("p", "li", "div", "h1", "article", "nav", "footer", "ul"):
            self.out.append(" ")

    def handle_data(self, data):
        if not self.hidden:
            self.out.append(data)


def test_every_visible_word_of_all_pages():
    for (html,) in duckdb.sql("select html from '/root/testdata/sf0.01/pages.parquet'").fetchall():
        parser = Words()
        parser.feed(html or "")
        text = re.sub(r"\]\([^)]*\)|[\[*]|(?m:^(?:# |- ))", "", "\n\n".join(D.pages_of(html)))
        assert text.split() == re.sub(r"[\[*]", "", "".join(parser.out)).split()


def tree(rng, depth):
    """(html, markdown blocks) of a random well-formed block."""
    word = lambda: rng.choice(["alpha", "beta", "gamma", "d&amp;e"])

    def inline(n):
        html, text = [], []
        for _ in range(n):
            w, k = word(), rng.randrange(6)
            plain = w.replace("&amp;", "&")
            html.append([w, f"<b>{w}</b>", f"<i>{w}</i>", f'<a href="/{w}">{w}</a>', f"<span>{w}</span>", f"{w}\n\t"][k])
            text.append([plain, f"**{plain}**", f"*{plain}*", f"[{plain}](/{plain})", plain, plain][k])
        return " ".join(html), " ".join(text)

    kind = rng.randrange(6 if depth else 4)
    html, text = inline(rng.randrange(1, 5))
    if kind == 0:
        return f"<p>{html}</p>", [text]
    if kind == 1:
        n = rng.randrange(1, 7)
        return f"<h{n}>{html}</h{n}>", ["#" * n + " " + text]
    if kind == 2:
        rows = [inline(2) for _ in range(rng.randrange(1, 4))]
        return f"<{(t := rng.choice(['ul', 'ol']))}>" + "".join(f"<li>{h}</li>" for h, _ in rows) + f"</{t}>", ["\n".join(("- " if t == "ul" else f"{i}. ") + x for i, (_, x) in enumerate(rows, 1))]
    if kind == 3:
        wide = rng.randrange(1, 4)
        rows = [[inline(1) for _ in range(wide)] for _ in range(rng.randrange(1, 4))]
        lines = ["| " + " | ".join(x for _, x in r) + " |" for r in rows]
        return "<table>" + "".join("<tr>" + "".join(f"<td>{h}</td>" for h, _ in r) + "</tr>" for r in rows) + "</table>", ["\n".join([lines[0], "|" + " --- |" * wide, *lines[1:]])]
    parts = [tree(rng, depth - 1) for _ in range(rng.randrange(1, 4))]
    return f"<div>{''.join(h for h, _ in parts)}</div>", [b for _, bs in parts for b in bs]


@pytest.mark.parametrize("seed", range(4))
def test_random_trees(seed):
    rng = random.Random(seed)
    for _ in range(150):
        parts = [tree(rng, 3) for _ in range(rng.randrange(1, 6))]
        blocks = [b for _, bs in parts for b in bs]
        text, lists = "", re.compile(r"- |[0-9]+\. ")
        for i, b in enumerate(blocks):
            both = i and lists.match(b) and lists.match(blocks[i - 1])
            text += ("" if not i else "\n" if both else "\n\n") + b
        assert D.pages_of("".join(h for h, _ in parts)) == [text]


@pytest.mark.parametrize("piece", ["<div>", "<a href=\"", "<!--", "<b><p>", "<li>x", "<td>", "<", "</p>", "<ul><li>", "<table><tr><td>", "&amp;", "<i>x", "<a '", "<script>x</script>"])
def test_broken_markup_is_linear(piece):
    took = []
    for size in (40_000, 400_000):
        start = time.process_time()
        D.pages_of(piece * (size // len(piece)))
        took.append(time.process_time() - start)
    assert took[1] < 40 * max(took[0], 0.05)


def test_columns(spark):
    df = spark.createDataFrame([(1, "<p>a<p style='break-before:page'>b"), (2, None), (3, "")], "k int, html string")
    rows = {r["k"]: (r["pages"], r["markdown"]) for r in D.converted(df).collect()}
    assert rows == {1: (["a", "b"], "\n<!-- PAGE 1 -->\na\n<!-- PAGE 2 -->\nb"), 2: ([""], "\n<!-- PAGE 1 -->\n"), 3: ([""], "\n<!-- PAGE 1 -->\n")}
