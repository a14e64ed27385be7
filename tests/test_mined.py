"""Texts of a table are mined for all kinds in one pass, in batches of bounded size."""

import io
from contextlib import redirect_stdout

from claimloom.operators import mining as M
from claimloom.plans.page_queries import QUERIES

KINDS = {"bid": M.bids, "count": M.counts, "event": M.dated_events, "actor": M.actors}


def test_one_python_pass_for_all_kinds(spark):
    with redirect_stdout(io.StringIO()) as out:
        QUERIES["mined_matches"](spark, "/root/testdata/sf0.001").explain()
    assert out.getvalue().count("MapInArrow") + out.getvalue().count("ArrowEvalPython") == 1


def test_a_match_a_row_in_bounded_batches(spark):
    texts = ["$5 per share " * 3000, None, "", "Party A, two bidders; $7 per share", "nothing"] * 3
    rows = spark.createDataFrame(list(enumerate(texts)), "n long, text string").coalesce(1)
    got = [tuple(r) for r in M.mined(KINDS, rows).collect()]
    assert sorted(got) == sorted((n, k, *m) for n, t in enumerate(texts) if t for k, f in KINDS.items() for m in f(t))
