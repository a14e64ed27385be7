"""All text mining in one pass: an automaton finds where the patterns of operators.mining can match at all.

Every pattern has a literal core: a noun, a verb, an ending of organizations, an ampersand. An Aho-Corasick automaton
over all cores reads a text once; only around its hits are the patterns tried, in windows that hold every match
with that core. Patterns with a gap (a head, anything but a full stop or a new line, a tail) are put together of their
two ends by bisection, so a text without full stops is as fast as any. Results are those of the patterns tried
on the whole text, and the time is linear in its length.
"""

from __future__ import annotations

import functools
import re
from bisect import bisect_left
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from claimloom.operators import mining as M

NUM = rf"\b(?P<count>{M.NUMBER})\s+"
NOUNS = "financial buyers|financial participants|financial bidders|financial sponsors|strategic parties|strategic buyers|strategic bidders|strategic acquirers|potential participants|potential bidders|parties|bidders"
# Counts by priority: (pattern that ends with a core, its core, words before the core), or the two ends around a gap with what it must not hold.
WHOLE = {
    0: (NUM + r"of the\s+potentially interested parties\s+submitted indications of interest\b", "submitted indications of interest", 6),
    2: (rf"\b(?:all\s+)?(?P<count>{M.NUMBER})\s+(?:of the\s+)?(?:financial buyers|strategic buyers)\s+entered into confidentiality agreements\b", "entered into confidentiality agreements", 6),
    4: (rf"\bcontacted a total of\s+(?P<count>{M.NUMBER})\s+parties\b", "parties", 5),
    6: (NUM + rf"(?:potentially interested\s+)?(?:potential\s+)?(?:{NOUNS})\b", ("participants", "sponsors", "acquirers", "buyers", "parties", "bidders"), 5),
}
GAPPED = {
    1: ((NUM + r"bidders\s+that had indicated\b", "that had indicated", 2), (r"\bfinal round\b", "final round", 0), "\n"),
    3: ((NUM + r"potential bidders\b", "potential bidders", 1), (r"\bentered into confidentiality agreements\b", "entered into confidentiality agreements", 0), "."),
    5: ((r"\bcontacted\b", "contacted", 0), (NUM + r"(?:parties|potential participants|potential buyers)\b", ("parties", "potential participants", "potential buyers"), 1), "."),
}
BREAK = re.compile(r"[^\w\s'’&.-]|(?<![\w'’-])[a-z]")  # where no name goes on


@functools.cache
def _compiled(pattern: str, flags: int = 0) -> re.Pattern:
    return re.compile(pattern, flags)


@functools.cache
def automaton():
    """The cores of all patterns, in small letters, and what each is."""
    import ahocorasick

    cores: dict[str, list[str]] = {}
    ends = [e for ends in (*WHOLE.values(), *(end for head, tail, _ in GAPPED.values() for end in (head, tail))) for e in ((ends[1],) if isinstance(ends[1], str) else ends[1])]
    handles = ["party ", "bidder ", "buyer group", "industry participant", "sponsor ", "company ", "merger sub", "parent"]
    names = ["&", *(e.lower() for e in M.ORG_ENDINGS)]
    for kind, words in (("count", ends), ("bid", ["per share", "$"]), ("event", ["on "]), ("handle", handles), ("name", names), ("near", M.CONTEXT_WORDS.split("|"))):
        for w in words:
            cores.setdefault(w, []).append(kind)
    out = ahocorasick.Automaton()
    for w, kinds in cores.items():
        out.add_word(w, (w, tuple(dict.fromkeys(kinds))))
    out.make_automaton()
    return out


def hits(text: str) -> dict[str, dict[str, list[int]]]:
    """For each kind and core the places at which it begins, in order."""
    out: dict[str, dict[str, list[int]]] = {}
    for end, (core, kinds) in automaton().iter(text.translate(M.FOLDED)):
        for kind in kinds:
            out.setdefault(kind, {}).setdefault(core, []).append(end - len(core) + 1)
    return out


def back(text: str, at: int, words: int) -> int:
    """Where the `words`-th word before `at` begins; a word over 64 characters that is no number ends the search."""
    for _ in range(words + 1):  # one more, for the word that `at` may stand in
        while at and text[at - 1].isspace():
            at -= 1
        end = at
        while at and not text[at - 1].isspace() and (end - at < 64 or text[at - 1].isdigit()):
            at -= 1
        if end - at >= 64 and not text[at:end].isdigit():
            break
    return at


def ending(text: str, pattern: str, cores: str | tuple[str, ...], words: int, found: dict[str, list[int]]) -> list[re.Match]:
    """The matches of a pattern that ends with one of the cores, as finditer gives them for the whole text."""
    out, done = [], 0
    p = _compiled(pattern, re.IGNORECASE)
    for at, core in sorted((at, core) for core in ((cores,) if isinstance(cores, str) else cores) for at in found.get(core, ())):
        end = at + len(core)
        if end < done:
            continue
        for m in p.finditer(text, max(done, back(text, at, words)), min(len(text), end + 1)):
            if m.end() <= end:
                out.append(m)
                done = m.end()
    return out


def gapped(text: str, heads: list[re.Match], tails: list[re.Match], stop: str) -> list[tuple[int, int, str]]:
    """(start, end, count) of each head and the first tail after it without `stop` between, left to right."""
    out, done = [], 0
    starts = [t.start() for t in tails]
    stops = [m.start() for m in re.finditer(re.escape(stop), text)] if heads and tails else []
    for head in heads:
        if head.start() < done:
            continue
        k = bisect_left(starts, head.end())
        if k < len(tails):
            s = bisect_left(stops, head.end())
            if s == len(stops) or stops[s] >= starts[k]:
                out.append((head.start(), tails[k].end(), {**head.groupdict(), **tails[k].groupdict()}["count"]))
                done = tails[k].end()
    return out


def counts(text: str, found: dict[str, list[int]]) -> list[M.Match]:
    owner, out = bytearray(len(text)), []
    for k in range(len(M.COUNT_PATTERNS)):
        if k in WHOLE:
            rows = [(*m.span(), m["count"]) for m in ending(text, *WHOLE[k], found)]
        else:
            head, tail, stop = GAPPED[k]
            rows = gapped(text, ending(text, *head, found), ending(text, *tail, found), stop)
        for start, end, word in rows:
            if not any(owner[start:end]):
                owner[start:end] = b"\1" * (end - start)
                out.append((text[start:end], M.number(word), start, end))
    return sorted(out, key=lambda m: m[2])


def bids(text: str, found: dict[str, list[int]]) -> list[M.Match]:
    """Every amount ends with its core; it begins at the last dollar sign before it, a range at the last but one."""
    dollars, spans, done = found.get("$", []), [], 0
    ends = [at + len("per share") for at in found.get("per share", ())]
    before = [bisect_left(dollars, end) for end in ends]
    for end, k in zip(ends, before):
        if k > 1 and dollars[k - 2] >= done and (m := _compiled(M.AMOUNT_RANGE).fullmatch(text, dollars[k - 2], end)):
            spans.append(m)
            done = end
    ranges = [m.end() for m in spans]
    for end, k in zip(ends, before):
        if k and (m := _compiled(M.AMOUNT_SINGLE).fullmatch(text, dollars[k - 1], end)):
            i = bisect_left(ranges, m.start() + 1)
            if i == len(ranges) or spans[i].start() >= end:  # outside of every range
                spans.append(m)
    return [(m.group(), "-".join(str(float(v)) for v in m.groups()), *m.span()) for m in sorted(spans, key=re.Match.start)]


def begun(text: str, pattern: str, found: dict[str, list[int]], flags: int = 0) -> list[re.Match]:
    """The matches of a pattern that begins with one of the cores found."""
    out, done, p = [], 0, _compiled(pattern, flags)
    for at in sorted({at for places in found.values() for at in places}):
        if at >= done and (m := p.match(text, at)):
            out.append(m)
            done = m.end()
    return out


def names(text: str, found: dict[str, list[int]]) -> list[re.Match]:
    """The names that hold a core, cut as in the whole text: each search begins behind the last character before the core that no name holds."""
    out, done, p = [], 0, _compiled(M.NAME)
    spelled = {"&", *M.ORG_ENDINGS}
    for at, core in sorted((at, core) for core, places in found.items() for at in places):
        if at < done or text[at : at + len(core)] not in spelled:
            continue
        start, step = done, 256
        while True:
            low = max(done, at - step)
            last = None
            for last in BREAK.finditer(text, low, at):
                pass
            if last is not None or low == done:
                start = last.end() if last is not None else done
                break
            step *= 4
        for m in p.finditer(text, start):
            if m.start() > at:
                break
            out.append(m)
            done = m.end()
        done = max(done, at)
    return out


def mine(text: str | None) -> dict[str, list[M.Match]]:
    """Bids, counts, dated events and actors of a whole text, as the functions of operators.mining give them; null has none."""
    found = hits(text) if text else {}
    near = [m.span() for m in begun(text, M.CONTEXT, found.get("near", {}), re.IGNORECASE)] if found else []
    return {
        "bid": bids(text, found["bid"]) if "bid" in found else [],
        "count": counts(text, found["count"]) if "count" in found else [],
        "event": M.dated(text, begun(text, M.DATED, found["event"])) if "event" in found else [],
        "actor": M.acting(begun(text, M.HANDLE, found.get("handle", {})), names(text, found.get("name", {})) if near else [], near) if found else [],
    }


KINDS = ("bid", "count", "event", "actor")


def scanned(text: Column) -> Column:
    """A struct of the four arrays of matches of a text, made in one pass over it."""

    @F.pandas_udf("struct<" + ", ".join(f"{k}: {M.FOUND}" for k in KINDS) + ">")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            found = [mine(t) for t in texts]
            yield pd.DataFrame({k: [[dict(zip(("raw_value", "normalized_value", "start", "end"), m)) for m in f[k]] for f in found] for k in KINDS})

    return run(text)
