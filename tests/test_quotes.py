"""Quote binding against a search of every paragraph for every quote."""

import random
import re

from pyspark.sql import functions as F

from claimloom.operators import claims as C


def places(text, quote):
    return [i for i in range(len(text) - len(quote) + 1) if text[i : i + len(quote)] == quote]


def expected(claims, paragraphs):
    out = {}
    for key, window, quote in claims:
        hits = [(pid, start + i) for w, pid, start, text in paragraphs if w == window and w is not None and quote and text for i in places(text, quote)]
        per = sum(min(2, len(places(text, quote))) for w, _, _, text in paragraphs if w == window and w is not None and quote and text)
        one = per == 1
        out[key] = (per, hits[0][0] if one else None, hits[0][1] if one else None, hits[0][1] + len(quote) if one else None)
    return out


def bound(spark, claims, paragraphs):
    c = spark.createDataFrame(claims, "claim_key string, window_id string, quote_text string")
    p = spark.createDataFrame(paragraphs, "window_id string, paragraph_id string, char_start int, paragraph_text string")
    return C.bind_quotes(c, p)


def test_against_a_search_of_all(spark):
    rng = random.Random(11)
    words = ["a", "aa", "aaa", "b", "ab", "", "\n", "été", "😀x", "The", "board"]
    text = lambda n: " ".join(rng.choice(words) for _ in range(n))
    paragraphs = [(f"w{rng.randrange(3)}", f"p{i}", i * 1000, text(rng.randrange(1, 60))) for i in range(60)] + [("w1", "null", 5, None), (None, "lost", 5, "a aa aaa b ab"), ("w2", "empty", 7, "")]
    claims = []
    for i in range(250):
        w, _, _, t = rng.choice(paragraphs[:60])
        a = rng.randrange(len(t))
        quote = t[a : a + rng.randrange(1, 60)]
        claims.append((f"c{i}", w if i % 5 else f"w{rng.randrange(4)}", quote if i % 7 else quote + "z"))
    claims += [("empty", "w1", ""), ("null", "w1", None), ("lost", None, "a aa aaa b ab"), ("spaces", "w0", "    "), ("long", "w0", " ".join(p[3] for p in paragraphs[:9]))]
    found = {r["claim_key"]: tuple(r)[1:] for r in bound(spark, claims, paragraphs).collect()}
    assert found == expected(claims, paragraphs)
    assert {r[0] for r in found.values()} >= {0, 1, 2} and any(r[0] == 1 and len(q) > 30 for (k, _, q), r in zip(claims, found.values()) if q)


def test_overlapping_places_count(spark):
    rows = bound(spark, [("x", "w", "aba aba aba aba")], [("w", "p", 0, "aba aba aba aba aba"), ("w", "q", 0, "nothing here")])
    assert [tuple(r) for r in rows.collect()] == [("x", 2, None, None, None)]


def test_anchor_is_the_rarest_pair(spark):
    c = spark.createDataFrame([("k", "w", "x the board met rarely y"), ("none", "w", "x the board never met y")], "claim_key string, window_id string, quote_text string")
    p = spark.createDataFrame([("w", "the board met"), ("w", "then the board met rarely"), ("w", "the board and met")], "window_id string, paragraph_text string")
    rows = C.quote_anchors(c, p).select("claim_key", F.col("pair") == F.xxhash64(F.lit("met"), F.lit("rarely"))).collect()
    assert [tuple(r) for r in rows] == [("k", True)]


def test_no_pair_of_everything_with_everything(spark):
    plan = bound(spark, [("x", "w", "a b c d e")], [("w", "p", 0, "a b c d e")])._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_few_quotes_shuffle_no_texts(spark):
    plan = bound(spark, [("x", "w", "a b c d e"), ("y", "w", "b c")], [("w", "p", 0, "a b c d e"), ("w", "q", 0, "b c a b c d e f")])._jdf.queryExecution().executedPlan().toString()
    assert set(re.findall(r"hashpartitioning\((\w+?)#", plan)) == {"claim_key"}
