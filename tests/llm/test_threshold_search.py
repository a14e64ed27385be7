"""Ranked search against a plain scan of all documents, and what the threshold saves."""

import math
import random
import re
from collections import Counter

import numpy as np

from claimloom.llm import threshold_search
from claimloom.llm.threshold_search import Shard, impacts, search, top

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return ["".join(c.lower() if "A" <= c <= "Z" else c for c in w) for w in TERM.findall(text or "")]


def scanned(docs, queries, k):
    bags = [(i, Counter(terms(t))) for i, t in docs]
    bags = [(i, b) for i, b in bags if b]
    n, total = len(bags), sum(sum(b.values()) for _, b in bags)
    df = Counter(t for _, b in bags for t in b)
    asked = {}
    for i, t in queries:
        asked.setdefault(i, set()).update(terms(t))
    out = []
    for q, own in asked.items():
        scores = []
        for i, b in bags:
            m = 50 + (50 * sum(b.values()) * n) // total
            s = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * ((1_000_000_000 * b[t]) // (1000 * b[t] + 20 * m)) for t in own if t in b)
            scores.append((-s, i is None, i or 0, i))
        ranked = sorted(x for x in scores if x[0] < 0)[:k]
        out += [(q, rank, x[3], -x[0]) for rank, x in enumerate(ranked, 1)]
    return out


def ran(spark, docs, queries, **how):
    d = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    q = spark.createDataFrame(queries, "item_id long, text string")
    return [tuple(r) for r in search(d, q, **how).collect()]


key = lambda r: tuple((x is None, x or 0) for x in r)


def test_against_a_scan(spark):
    rng = random.Random(8)
    vocabulary = [f"t{i}" for i in range(60)] + ["Über", "über", "A1", "a1", "x_y"]
    text = lambda n: " ".join(rng.choices(vocabulary, [1 / (i + 1) for i in range(len(vocabulary))], k=n))
    docs = [(i, text(rng.randrange(1, 80))) for i in range(700)] + [(None, text(9)), (3, text(5)), (3, text(5)), (900, None), (901, ""), (902, "!! __")]
    docs += [(1000 + i, docs[0][1]) for i in range(150)]  # ties beyond k
    queries = [(i, text(rng.randrange(1, 12))) for i in range(25)] + [(None, "t1 t2"), (None, "t9"), (7, "t40 t41"), (50, None), (51, "nowhere"), (52, "-"), (53, docs[0][1])]
    expected = sorted(scanned(docs, queries, 20), key=key)
    for how in ({}, {"shard_postings": 50}, {"block_bytes": 40}):
        assert sorted(ran(spark, docs, queries, k=20, **how), key=key) == expected
    assert len({r[:2] for r in expected}) == len(expected)


def test_stops_early_and_never_too_early():
    rng = np.random.default_rng(4)
    n, v = 20_000, 40
    held = rng.random((n, v)) < 0.2
    held[:, 0] |= ~held.any(1)
    doc, term = np.nonzero(held)
    counts = rng.geometric(0.4, len(doc))
    impact = impacts(counts, 50 + rng.integers(0, 200, n)[doc])
    shard = Shard(np.arange(n), np.concatenate([[0], np.cumsum(held.sum(1))]), term.astype("i4"), impact, v)
    dense = np.zeros((n, v), "i8")
    dense[doc, term] = impact
    none = (np.zeros(0, "i8"), np.zeros(0, "i8"))
    for own, weights in ((np.array([3, 5]), np.array([900, 40])), (np.arange(20), rng.integers(0, 2000, 20)), (np.array([7]), np.array([0]))):
        (ids, scores), scored = shard.search(own, weights, none, 50)
        whole = dense[:, own] @ weights
        best = np.lexsort((np.arange(n), -whole))[:50]
        best = best[whole[best] > 0]
        assert ids.tolist() == best.tolist() and scores.tolist() == whole[best].tolist()
        if len(own) == 2:
            assert scored < n / 10
    assert not shard.seen.any() and not shard.weights.any()


def test_top_breaks_ties_by_id():
    ids, scores = top(np.arange(1000)[::-1].copy(), np.full(1000, 7), 50)
    assert ids.tolist() == list(range(50)) and set(scores.tolist()) == {7}


def test_hard_rows(spark, docs, empty):
    queries = docs.selectExpr("doc_id as item_id", "text", "1 as rank", "2 as score")
    found = [tuple(r) for r in search(docs.selectExpr("*", "'x' as n_terms", "1 as terms"), queries).collect()]
    assert sorted(found, key=key) == sorted(scanned([(r[0], r[1]) for r in docs.collect()], [(r[0], r[1]) for r in docs.collect()], 50), key=key)
    schema = ["item_id", "rank", "doc_id", "score"]
    for d, q in ((empty, queries), (docs, queries.limit(0))):
        out = search(d, q)
        assert out.columns == schema and out.count() == 0


def test_integers_beyond_64_bits_in_the_length_factor():
    assert threshold_search.length_factor(10**9, 10**12, 10**14) == 50 + 50 * 10**9 * 10**12 // 10**14
