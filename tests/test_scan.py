"""The one-pass scan against the patterns tried on whole texts, and its time on long ones."""

import random
import time

import pytest
from pyspark.sql import functions as F

from claimloom.operators import mining as M
from claimloom.operators import scan as S

PIECES = [
    "$12.50 per share", "$7", " to ", " and ", "$9.1  per share", " - ", "–", "$3 per share to $4.5 per share", " per share", "$", "per share.", "$1to$2per share",
    "six of the potentially interested parties submitted indications of interest", "Two bidders that had indicated", " final round ", "final rounds", "all eleven of the strategic buyers entered into confidentiality agreements",
    "Twenty-four potential bidders", " entered into confidentiality agreements", "contacted", " contacted a total of 30 parties", "contacted-four parties", "12 potential participants", "five financial sponsors", "007 potentially interested potential buyers", "TEN PARTIES", "ten partieſ", "ſix bidders", "parties", "bidders",
    "On March 3, 2014,", "On June 31, 2014,", " On May 9, 2015, the board met", "Mr. A. Smith of J.P. Row bid $3.50 per share.", "He left.", "Once On", "On Xx 1, 20,",
    "Party A", "Bidder 12", "Buyer Group", "Parent", "Apparent", "Company Bay", "Merger Sub", "Sponsor X", "The Northern Capital Partners", "B&C", "A&B&C Corp.", "& Co", "Capital", "XCapital Group", "O’Neil Inc.", "Acme Holdings, Inc.", "Big Red Blue Green Black White Grey Group", "lower Capital", "Board", "Transaction Committee", "L.P.", "Éa Partners", "A-b LLC",
    "submitted", "a proposal", "exclusivity", "loi", "offers", " ", "\n", ". ", ".", ", ", "  ", "x", "the", "é", "İ", " ", "'s", "’s",
]


def plain(text):
    return {"bid": M.bids(text), "count": M.counts(text), "event": M.dated_events(text), "actor": M.actors(text)}


@pytest.mark.parametrize("seed", range(6))
def test_same_as_the_patterns_on_the_whole_text(seed):
    rng = random.Random(seed)
    for _ in range(700):
        glue = rng.choice(["", " ", " ", "\n"])
        text = glue.join(rng.choice(PIECES) for _ in range(rng.randrange(1, 40)))
        assert S.mine(text) == plain(text), text


def test_null_and_empty():
    assert S.mine(None) == S.mine("") == {k: [] for k in S.KINDS}


def test_numbers_of_any_length():
    text = "9" * 6000 + " parties and 00 bidders and ٣ bidders"
    assert [m[1] for m in S.mine(text)["count"]] == ["9" * 6000, "0", "3"] == [m[1] for m in M.counts(text)]


HARD = {
    "heads without tails or full stops": "contacted them and ten potential bidders or two bidders that had indicated ",
    "cores alone": "& & parties per share Capital bidders ",
    "capitals": "Capital Group Holdings Partners Bay ",
    "amounts": "$1 to $2 per share and $3 per share ",
    "one word": "partiesbiddersparties",
    "dates": "On March 3, 2014, it On March 4, 2014, bid ",
    "prose": "Nothing of the kind is in here, but words of all sorts. ",
}


@pytest.mark.parametrize("kind", sorted(HARD))
def test_time_is_linear(kind):
    took = []
    for size in (300_000, 3_000_000):
        text = HARD[kind] * (size // len(HARD[kind]))
        start = time.process_time()
        S.mine(text)
        took.append(time.process_time() - start)
    assert took[1] < 25 * max(took[0], 0.05)


def test_ten_megabytes():
    text = "".join(HARD.values()) * (10_000_000 // sum(map(len, HARD.values())))
    start = time.process_time()
    found = S.mine(text)
    assert time.process_time() - start < 240 and found["count"] and found["bid"] and found["event"]


def test_column(spark):
    df = spark.createDataFrame([(1, "Ten parties offered $3 per share"), (2, None), (3, "")], "k int, text string")
    rows = df.select("k", S.scanned(F.col("text")).alias("m")).select("k", "m.*").collect()
    assert [(r["k"], [tuple(x) for x in r["count"]], [tuple(x) for x in r["bid"]]) for r in rows] == [(1, [("Ten parties", "10", 0, 11)], [("$3 per share", "3.0", 20, 32)]), (2, [], []), (3, [], [])]
