"""Chunks and term contexts against plain loops."""

import random

import pytest

from claimloom.operators import sections as W


def folded(rows, most):
    """(key, chunk) -> its paragraphs, greedily."""
    out = {}
    for key in {r[0] for r in rows}:
        chunk, begin = 0, None
        for _, n, start, end in sorted((r for r in rows if r[0] == key), key=lambda r: r[2]):
            if begin is None or end - begin > most:
                chunk, begin = chunk + 1, start
            out.setdefault((key, chunk), []).append((n, start, end))
    return {k: (v[0][0], v[-1][0], v[0][1], v[-1][2], v[-1][2] - v[0][1] > most) for k, v in out.items()}


@pytest.mark.parametrize("most", [1, 40, 1000])
def test_every_paragraph_is_in_one_chunk(spark, most):
    rng, rows = random.Random(most), []
    for k in range(30):
        at = 0
        for n in range(1, rng.randrange(2, 60)):
            size = rng.choice([1, 5, 20, 39, 40, 41, 200])
            rows.append((f"k{k}", n, at, at + size))
            at += size + rng.randrange(4)
    df = spark.createDataFrame(rows, "deal_slug string, n int, char_start int, char_end int").repartition(5)
    found = {(r["deal_slug"], r["chunk"]): (r["n_first"], r["n_last"], r["char_start"], r["char_end"], r["over_long"]) for r in W.chunks(df, most).collect()}
    assert found == folded(rows, most)
    assert all(not v[4] or v[0] == v[1] for v in found.values())  # only a paragraph alone may be too long
    assert W.chunks(df.limit(0), most).count() == 0


def test_a_chunk_needs_room(spark):
    with pytest.raises(ValueError):
        W.chunks(spark.createDataFrame([], "deal_slug string, n int, char_start int, char_end int"), 0)


def test_sections_that_come_again(spark):
    rows = [("a", n, n * 10, n * 10 + 5, s) for n, s in enumerate("xxyyxzz", 1)] + [("b", 1, 0, 3, "x")]
    df = spark.createDataFrame(rows, "deal_slug string, n int, char_start int, char_end int, section string").repartition(3)
    found = sorted(tuple(r) for r in W.section_windows(df).select("deal_slug", "window", "section", "n_first", "n_last").collect())
    assert found == [("a", 1, "x", 1, 2), ("a", 2, "y", 3, 4), ("a", 3, "x", 5, 5), ("a", 4, "z", 6, 7), ("b", 1, "x", 1, 1)]


def around(text, terms, before, after):
    small = "".join(c.lower() if c.isascii() else c for c in text)
    spans = []
    for t in {x.lower() for x in terms}:
        at = small.find(t)
        while at >= 0:
            spans.append((max(0, at - before), min(len(text), at + len(t) + after), t))
            at = small.find(t, at + len(t))
    out = []
    for a, z, t in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(z, out[-1][1]), out[-1][2] + 1, out[-1][3] | {t})
        else:
            out.append((a, z, 1, {t}))
    return [(a, z, n, "|".join(sorted(ts))) for a, z, n, ts in out]


@pytest.mark.parametrize("before, after", [(0, 0), (3, 5), (100, 1)])
def test_contexts(spark, before, after):
    rng = random.Random(before)
    terms = ["ab", "B.c", "\\E(x", "é", "aa"]
    texts = [("".join(rng.choice(["a", "b", "B.C", ".", " ", "\\E(x", "é", "İ", "\n", "zzzz"]) for _ in range(rng.randrange(90)))) for _ in range(60)] + ["", "none", "aaaaa"]
    df = spark.createDataFrame([(f"d{i}", t) for i, t in enumerate(texts)] + [("null", None)], "deal_slug string, text string").repartition(4)
    found = {}
    for r in W.term_context(df, [*terms, ""], before, after).collect():
        found.setdefault(r["deal_slug"], []).append((r["char_start"], r["char_end"], r["hits"], r["terms"]))
    assert {k: sorted(v) for k, v in found.items()} == {f"d{i}": x for i, t in enumerate(texts) if (x := around(t, terms, before, after))}
