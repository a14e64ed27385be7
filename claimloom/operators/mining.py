"""Text mining with match offsets, for which there is no built-in: batches of texts in Arrow, patterns in Python.

Each function gives a list of (raw_value, normalized_value, start, end), half-open code point offsets, in the order
of the text.
"""

from __future__ import annotations

import contextlib
import datetime as dt
import re
import unicodedata
from bisect import bisect_left
from collections.abc import Callable, Iterable, Iterator
from itertools import pairwise

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from claimloom.functions.vocabulary import NUMBER_WORDS

FIELDS = "raw_value string, normalized_value string, start int, end int"
FOUND = "array<struct<raw_value: string, normalized_value: string, start: int, end: int>>"
BATCH = 5000
Match = tuple[str, str, int, int]

# The patterns of amounts, participation counts, dated events and actors.
AMOUNT = r"\$(\d+(?:\.\d+)?)"
AMOUNT_RANGE = rf"{AMOUNT}\s*(?:per share\s*)?(?:-|–|—|to|and)\s*{AMOUNT}\s*per share"
AMOUNT_SINGLE = rf"{AMOUNT} per share"
NUMBER = r"\d+|" + "|".join(sorted(map(re.escape, NUMBER_WORDS), key=len, reverse=True))
COUNT_PATTERNS = [
    rf"\b(?P<count>{NUMBER})\s+of the\s+potentially interested parties\s+submitted indications of interest\b",
    rf"\b(?P<count>{NUMBER})\s+bidders\s+that had indicated\b.*?\bfinal round\b",
    rf"\b(?:all\s+)?(?P<count>{NUMBER})\s+(?:of the\s+)?(?:financial buyers|strategic buyers)\s+entered into confidentiality agreements\b",
    rf"\b(?P<count>{NUMBER})\s+potential bidders\b[^.]*?\bentered into confidentiality agreements\b",
    rf"\bcontacted a total of\s+(?P<count>{NUMBER})\s+parties\b",
    rf"\bcontacted\b[^.]*?\b(?P<count>{NUMBER})\s+(?:parties|potential participants|potential buyers)\b",
    rf"\b(?P<count>{NUMBER})\s+(?:potentially interested\s+)?(?:potential\s+)?(?:financial buyers|financial participants|financial bidders|financial sponsors|strategic parties|strategic buyers|strategic bidders|strategic acquirers|potential participants|potential bidders|parties|bidders)\b",
]
COUNTED = ("parties", "bidders", "buyers", "participants", "sponsors", "acquirers")  # each of the patterns holds one of them
DATED = r"\bOn ([A-Z][a-z]+ \d{1,2}, \d{4}),"
ABBREVIATIONS = ("J.P.", "U.S.", "Mr.", "Ms.", "Dr.", "Inc.", "Co.", "Ltd.", "L.P.", "L.L.C.", "LLC.")
HANDLE = r"\b(?:Party [A-Z]|Bidder \d+|Buyer Group|Industry Participant|Sponsor [A-Z]|Company [A-Z]|Merger Sub|Parent)\b"
NAME_TOKEN = r"(?:[A-Z](?:&[A-Z])+|(?:Inc|Corp|L\.P|LLC|Ltd)\.|[A-Z][A-Za-z0-9'’À-ſ-]+)"
NAME = rf"\b{NAME_TOKEN}(?:\s+{NAME_TOKEN}){{0,5}}\b"
CONTEXT_WORDS = "submitted|proposal|proposals|offer|offers|loi|bid|bids|bidders|buyer|buyers|acquir|remained active|continued interest|merger agreement|confidentiality agreement|non-disclosure agreement|exclusivity"
CONTEXT = rf"\b({CONTEXT_WORDS})\b"
ORG_ENDINGS = {"Bay", "Capital", "Corp.", "Corporation", "Group", "Holdings", "Inc.", "Investments", "LLC", "Limited", "LP", "L.P.", "Ltd.", "Management", "Partners", "Railway"}
NO_ACTORS = {"Board", "Company", "Table of Contents", "Transaction Committee"}
CONTEXT_CHARS = 120


# A full stop that ends a sentence: after no abbreviation and no initial, and not between digits.
STOP = re.compile("".join(f"(?<!{re.escape(a[:-1])})" for a in ABBREVIATIONS) + r"(?<!\b[A-Z])(?:(?<!\d)\.|\.(?!\d))")
# A name between what may surround it: signs, an article, a possessive.
CORE = re.compile(r"[ ,.;:]*(?:The )?[ ,.;:]*(?P<name>.*?)[ ,.;:]*(?:['’]s)?[ ,.;:]*", re.DOTALL)


def claimed(text: str, *patterns: str, flags: int = 0) -> list[re.Match]:
    """Matches in the order of the text; a character belongs to one match at most, earlier patterns first."""
    owner, found = bytearray(len(text)), []
    for pattern in patterns:
        for m in re.finditer(pattern, text, flags):
            here = slice(*m.span())
            if not any(owner[here]):
                owner[here] = b"\1" * len(m.group())
                found.append(m)
    return sorted(found, key=re.Match.start)


def bids(text: str) -> list[Match]:
    """Ranges of amounts a share, and single amounts outside of them; values as floats."""
    if "per share" not in text:
        return []
    return [(m.group(), "-".join(str(float(v)) for v in m.groups()), *m.span()) for m in claimed(text, AMOUNT_RANGE, AMOUNT_SINGLE)]


#: What IGNORECASE takes for an ASCII letter, as that letter; each is one character, so offsets stay.
FOLDED = {**{k: chr(k + 32) for k in range(65, 91)}, 0x17F: "s", 0x212A: "k", 0x130: "i", 0x131: "i"}


def number(word: str) -> str:
    """A number word's or a run of digits' value in plain digits, however many."""
    small = word.translate(FOLDED)
    return str(NUMBER_WORDS[small]) if small in NUMBER_WORDS else "".join(str(unicodedata.digit(c)) for c in word).lstrip("0") or "0"


def counts(text: str) -> list[Match]:
    """Numbers of participants: patterns in the order of their priority, each where no earlier one matched."""
    folded = text.lower() if text.isascii() else text.translate(FOLDED)
    if not any(w in folded for w in COUNTED):
        return []
    return [(m.group(), number(m["count"]), *m.span()) for m in claimed(text, *COUNT_PATTERNS, flags=re.IGNORECASE)]


def dated_events(text: str) -> list[Match]:
    """Sentences that begin with a date, cut where the next one begins. A date that no calendar has is left out."""
    return dated(text, re.finditer(DATED, text)) if "On " in text else []


def dated(text: str, dates: Iterable[re.Match]) -> list[Match]:
    found = []
    for m, after in pairwise([*dates, None]):
        with contextlib.suppress(ValueError):
            day = dt.datetime.strptime(m[1], "%B %d, %Y").date()
            limit = after.start() if after else len(text)
            stop = STOP.search(text, m.start(), min(limit + 1, len(text)))  # one more, to see whether a digit follows
            raw = text[m.start() : stop.end() if stop and stop.end() <= limit else limit].rstrip()
            found.append((raw, day.isoformat(), m.start(), m.start() + len(raw)))
    return found


def actors(text: str) -> list[Match]:
    """Handles, and names of organizations near words of a sale; each label once, at its first place."""
    return acting(re.finditer(HANDLE, text), re.finditer(NAME, text), [m.span() for m in re.finditer(CONTEXT, text, re.IGNORECASE)])


def acting(handles: Iterable[re.Match], names: Iterable[re.Match], near: list[tuple[int, int]]) -> list[Match]:
    """Of handles and names, those that actors() gives; `near` has the places of words of a sale, in order."""
    spots = {m.span(): m.group() for m in handles}
    starts = [a for a, _ in near]
    for m in names:
        core = CORE.fullmatch(m.group())
        label, last = core["name"], core["name"].rpartition(" ")
        if label in NO_ACTORS or not ("&" in label or last[0] and last[2] in ORG_ENDINGS):
            continue
        k = bisect_left(starts, m.start() - CONTEXT_CHARS)
        if k < len(near) and near[k][1] <= m.end() + CONTEXT_CHARS:
            spots.setdefault((m.start() + core.start("name"), m.start() + core.end("name")), label)
    labels: dict[str, tuple[int, int]] = {}
    for span in sorted(spots):
        labels.setdefault(spots[span], span)
    return [(label, label, *span) for label, span in labels.items()]


def mined(functions: dict[str, Callable[[str], list[Match]]], rows: DataFrame, text: str = "text") -> DataFrame:
    """rows without their text, one for each match of any of the functions above, with its kind and fields; null texts have none.

    One pass in Arrow for all functions: each would have a worker process of its own if it were a column. A match is written as it is
    found, and a batch goes out once it holds BATCH of them, so memory grows neither with the table nor with the number of functions.
    """
    kept = [f for f in rows.schema if f.name != text]
    schema = T.StructType([*kept, T.StructField("kind", T.StringType()), *T.StructType.fromDDL(FIELDS)])
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own, found, at = batch.drop_columns([text]), [], []

            def made() -> pa.RecordBatch:
                matches = [pa.array(v, f.type) for v, f in zip(zip(*found), list(arrow)[len(kept) :])]
                return pa.RecordBatch.from_arrays([*own.take(pa.array(at)).columns, *matches], schema=arrow)  # noqa: B023

            for i, t in enumerate(batch.column(text)):
                t = t.as_py()
                for kind, function in functions.items() if t else ():
                    for m in function(t):
                        found.append((kind, *m))
                        at.append(i)
                if len(found) >= BATCH:
                    yield made()
                    found, at = [], []
            if found:
                yield made()

    return rows.mapInArrow(run, schema)
