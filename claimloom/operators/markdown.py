"""Pages of HTML to markdown: a tokenizer and a stack of open elements over batches of pages.

Headings, paragraphs, lists, tables as rows of pipes, emphasis, links, images, preformatted text and rules are kept;
scripts, styles, comments and what stands in the head are left out. Elements with a page break in their style begin
a new page.

Broken markup has one defined result. An end tag without its start is ignored; a start tag ends what it can't stand
in (a paragraph, item, row or cell of its own kind), and the end of the text ends all. Emphasis and links end with their
block. A comment, tag or script that never ends takes the rest of the text with it; a lone `<` is text. An inner table's
cells are words of the outer one's cell. Markdown's own signs in text are not escaped, but for pipes in cells.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from html import unescape

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HIDDEN = {"script", "style", "template", "noscript", "title", "textarea", "iframe", "svg"}  # up to their end tag nothing is read
VOID = {"br", "hr", "img", "input", "meta", "link", "area", "base", "col", "embed", "source", "wbr"}
INLINE = {"b": "**", "strong": "**", "i": "*", "em": "*", "code": "`"}
HEADINGS = [f"h{n}" for n in range(1, 7)]
BLOCKS = {
    *"address article aside blockquote body center dd details div dl dt fieldset figcaption figure footer form head header hgroup html li main nav ol p pre section summary table tbody td tfoot th thead tr ul".split(),
    *HEADINGS,
}
#: What a start tag ends, and the elements beyond which it doesn't look.
ENDS = {"li": ({"li"}, {"ul", "ol"}), "tr": ({"tr"}, {"table"}), "td": ({"td", "th"}, {"table", "tr"}), "th": ({"td", "th"}, {"table", "tr"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), **{t: ({t}, {"table"}) for t in ("thead", "tbody", "tfoot")}}
TAG = re.compile(r"[a-zA-Z][^\s/>]*")
ATTRIBUTE = re.compile(r"""([a-zA-Z_:][^\s=/>"']*)\s*(?:=\s*(?:"([^"]*)"|'([^']*)'|([^\s>"']+)))?""")
NEW_PAGE = re.compile(r"(?:page-break-before|break-before)\s*:\s*(?:always|page)", re.IGNORECASE)
SPACE = re.compile(r"[ \t\n\r\f\v ]+")


def tokens(html: str) -> Iterator[tuple[str, str, str]]:
    """('text', characters, ''), ('start', name, attributes) and ('end', name, ''); every character is looked at a bounded number of times."""
    at, n, open_quotes = 0, len(html), {'"': True, "'": True}
    while at < n:
        lt = html.find("<", at)
        if lt < 0:
            yield "text", html[at:], ""
            return
        if lt > at:
            yield "text", html[at:lt], ""
        if html.startswith("<!--", lt):
            end = html.find("-->", lt + 4)
            at = end + 3 if end >= 0 else n
        elif html[lt + 1 : lt + 2] in ("!", "?"):
            end = html.find(">", lt)
            at = end + 1 if end >= 0 else n
        elif name := TAG.match(html, lt + 1 + html.startswith("/", lt + 1)):
            k = name.end()
            while k < n and html[k] != ">":
                c = html[k]
                if c in open_quotes and open_quotes[c]:
                    end = html.find(c, k + 1)
                    open_quotes[c] = end >= 0  # without another one, it is a character like any other
                    k = end if end >= 0 else k
                k += 1
            if k >= n:
                return
            closing, tag = html[lt + 1] == "/", name[0].lower()
            yield ("end", tag, "") if closing else ("start", tag, html[name.end() : k])
            at = k + 1
            if tag in HIDDEN and not closing:
                m = re.compile(f"</{tag}(?=[\\s/>])", re.IGNORECASE).search(html, at)
                if m is None:
                    return
                at = m.start()
        else:
            yield "text", "<", ""
            at = lt + 1


class Writer:
    """Pages of finished blocks, the words of the open block, and the stack of open elements."""

    def __init__(self) -> None:
        self.pages: list[list[tuple[str, str]]] = [[]]
        self.words: list[str] = []
        self.stack: list[tuple[str, int, str]] = []  # (element, its first word, the link's address); inline ones only above the last block
        self.open: Counter[str] = Counter()  # the elements on the stack
        self.lists: list[list] = []  # [kind, items so far, whether the item's sign is still due]
        self.rows: list[list[str]] | None = None  # of the outermost open table
        self.tables = 0

    def within(self, *names: str) -> bool:
        return any(self.open[t] for t in names)

    def push(self, tag: str, href: str) -> None:
        self.stack.append((tag, len(self.words), href))
        self.open[tag] += 1

    def pop(self) -> tuple[str, int, str]:
        self.open[self.stack[-1][0]] -= 1
        return self.stack.pop()

    def text(self, raw: str) -> None:
        if self.within("head"):
            return
        raw = unescape(raw)
        self.words.append(raw if self.within("pre") else SPACE.sub(" ", raw))

    def block(self) -> None:
        """Ends the open block: of inline elements too, which are no longer open."""
        while self.stack and self.stack[-1][0] not in BLOCKS:
            self.close_inline(*self.pop())
        if self.tables:
            self.words.append(" ")  # a cell goes on
            return
        whole, self.words = "".join(self.words), []
        if self.within("pre"):
            whole = whole.strip("\n")
            if whole.strip():
                self.pages[-1].append(("block", f"```\n{whole}\n```"))
            return
        whole = "\n".join(x for line in whole.split("\n") if (x := SPACE.sub(" ", line).strip()))
        if not whole:
            return
        if self.within(*HEADINGS):
            heading = next(t for t, _, _ in reversed(self.stack) if t in HEADINGS)
            self.pages[-1].append(("block", "#" * int(heading[1]) + " " + whole.replace("\n", " ")))
        elif self.lists and self.within("li"):
            kind, items, due = self.lists[-1]
            sign = (f"{items}. " if kind == "ol" else "- ") if due else "  "
            self.lists[-1][2] = False
            self.pages[-1].append(("item", "  " * (len(self.lists) - 1) + sign + whole.replace("\n", " ")))
        else:
            self.pages[-1].append(("block", "\n".join(("> " if self.within("blockquote") else "") + x for x in whole.split("\n"))))

    def close_inline(self, tag: str, first: int, href: str) -> None:
        inner = "".join(self.words[first:])
        bare = inner.strip()
        if bare and (tag in INLINE or tag == "a" and href):
            lead, tail = inner[: len(inner) - len(inner.lstrip())], inner[len(inner.rstrip()) :]
            marked = f"[{bare}]({href})" if tag == "a" else f"{INLINE[tag]}{bare}{INLINE[tag]}"
            self.words[first:] = [lead + marked + tail]

    def start(self, tag: str, attributes: str) -> None:
        own = {m[1].lower(): unescape(next((v for v in m.groups()[1:] if v is not None), "")) for m in ATTRIBUTE.finditer(attributes)}
        if NEW_PAGE.search(own.get("style", "")) and not self.tables:
            self.block()
            self.pages.append([])
        if tag == "br":
            self.words.append(" " if self.tables else "\n")
        elif tag == "hr":
            self.block()
            if not self.tables:
                self.pages[-1].append(("block", "---"))
        elif tag == "img":
            if own.get("alt", "").strip() and not self.within("head"):
                self.words.append(f"![{own['alt'].strip()}]({own.get('src', '')})")
        if tag in VOID or tag in HIDDEN:
            return
        if tag in BLOCKS:
            if self.within("p"):
                self.end("p")
            if tag in ENDS and self.within(*ENDS[tag][0]):
                mine, scope = ENDS[tag]
                for t, _, _ in reversed(self.stack):
                    if t in scope:
                        break
                    if t in mine:
                        self.end(t)
                        break
            self.block()
            self.open_block(tag)
        self.push(tag, own.get("href", ""))

    def open_block(self, tag: str) -> None:
        if tag in ("ul", "ol"):
            self.lists.append([tag, 0, False])
        elif tag == "li" and self.lists:
            self.lists[-1][1] += 1
            self.lists[-1][2] = True
        elif tag == "table":
            self.tables += 1
            if self.tables == 1:
                self.rows, self.words = [], []
        elif self.tables == 1 and tag == "tr":
            self.rows.append([])
        if self.tables == 1 and tag in ("td", "th", "tr"):
            self.words = []

    def end(self, tag: str) -> None:
        if not self.within(tag):
            return
        while True:
            if self.stack[-1][0] in BLOCKS:
                self.block()
                self.close_block(self.stack[-1][0])
                t = self.pop()[0]
            else:
                t, first, href = self.pop()
                self.close_inline(t, first, href)
            if t == tag:
                return

    def close_block(self, tag: str) -> None:
        if tag in ("ul", "ol"):
            self.lists.pop()
        elif tag in ("td", "th") and self.tables == 1:
            if not self.rows:
                self.rows = [[]]
            self.rows[-1].append(SPACE.sub(" ", "".join(self.words)).strip().replace("|", "\\|"))
            self.words = []
        elif tag == "table":
            self.tables -= 1
            if not self.tables:
                rows = [r for r in self.rows if any(r)]
                wide = max(map(len, rows), default=0)
                lines = ["| " + " | ".join(r + [""] * (wide - len(r))) + " |" for r in rows]
                if lines:
                    self.pages[-1].append(("block", "\n".join([lines[0], "|" + " --- |" * wide, *lines[1:]])))
                self.rows, self.words = None, []

    def finish(self) -> list[str]:
        while self.stack:
            self.end(self.stack[-1][0])
        self.block()
        out = []
        for page in self.pages:
            parts = []
            for i, (kind, block) in enumerate(page):
                parts.append(("" if not i else "\n" if kind == page[i - 1][0] == "item" else "\n\n") + block)
            out.append("".join(parts))
        return out


def pages_of(html: str | None) -> list[str]:
    """The pages of a document as markdown: one that is empty for null, empty or hidden text."""
    writer = Writer()
    for kind, value, attributes in tokens(html or ""):
        if kind == "text":
            writer.text(value)
        elif kind == "start":
            writer.start(value, attributes)
        else:
            writer.end(value)
    return writer.finish()


def markdown_pages(html: Column) -> Column:
    """An array of a document's pages as markdown."""

    @F.pandas_udf("array<string>")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series([pages_of(x) for x in batch])

    return run(html)


def converted(documents: DataFrame, html_col: str = "html") -> DataFrame:
    """documents with `pages`, an array of markdown, and `markdown`, all of them behind numbered markers as a filing's text has them."""
    marked = F.transform("pages", lambda p, i: F.concat(F.lit("\n<!-- PAGE "), (i + 1).cast("string"), F.lit(" -->\n"), p))
    return documents.withColumn("pages", markdown_pages(F.col(html_col))).withColumn("markdown", F.array_join(marked, ""))
