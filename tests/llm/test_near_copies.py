"""The pipeline's near copies against brute force."""

import random

import pytest

import corpus_pipeline
from claimloom.llm import near_copies as N
from tests.llm.test_copies import roots

SCHEMA = "doc_id long, text string"


def shingles(text):
    w = (text or "").lower().split()
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def jaccard(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


@pytest.mark.parametrize("tile_rows", [2048, 4])
def test_keep_one(spark, tile_rows):
    """Edited copies of texts of 3 to 900 words, on both sides of the threshold, some with a common passage."""
    rng = random.Random(tile_rows)
    common, texts = [f"c{i}" for i in range(12)], []
    for k in range(60):
        base = [f"w{rng.randrange(4000)}" for _ in range(rng.choice([3, 8, 15, 40, 90, 300, 900]))] + (common if k % 3 == 0 else [])
        texts.append(" ".join(base))
        for _ in range(3):
            copy = list(base)
            for _ in range(rng.randrange(1 + len(base) // 30 + 1)):
                copy[rng.randrange(len(copy))] = f"x{rng.randrange(10**6)}"
            texts.append(" ".join(copy))
    texts += ["", " \n", None]
    rng.shuffle(texts)
    sets = [shingles(t) for t in texts]
    pairs = [(i, j) for i in range(len(texts)) for j in range(i + 1, len(texts)) if jaccard(sets[i], sets[j]) >= 0.8]
    assert sum(jaccard(sets[i], sets[j]) < 1 for i, j in pairs) > 40
    want = sorted(set(roots(range(len(texts)), pairs).values()))
    docs = spark.createDataFrame(list(enumerate(texts)), SCHEMA)
    got = N.keep_one(docs, tile_rows=tile_rows)
    assert got.columns == docs.columns and sorted(r["doc_id"] for r in got.collect()) == want


def test_stage_takes_copies_apart_by_many_bits(spark):
    words = [f"w{i}" for i in range(200)]
    near = list(words)
    for i in (20, 90, 160):
        near[i] = "other"
    docs = spark.createDataFrame([(4, " ".join(near)), (1, " ".join(words)), (9, "some thing else that stands alone here")], SCHEMA)
    assert sorted(r["doc_id"] for r in corpus_pipeline.near_copies(spark, docs, "").collect()) == [1, 9]


def test_rows_of_one_id_or_none(spark):
    """Exact copies with a repeated or null id: one row of each group stays, whole."""
    a, b, c = (" ".join(f"{x}{i}" for i in range(30)) for x in "abc")
    rows = [(5, a, "x"), (5, a, "x"), (None, a, "x"), (None, b, "x"), (None, b, "x"), (None, b, "y"), (6, c, "x"), (6, a, "x"), (7, c, "x"), (None, None, "x"), (8, "", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    kept = corpus_pipeline.near_copies(spark, docs, "").collect()
    assert sorted((r["doc_id"] or 0, r["text"]) for r in kept) == sorted([(5, a), (0, b), (6, c), (8, "")])


@pytest.mark.parametrize("tile_rows", [2048, 4])
def test_open_pairs_come_once(spark, monkeypatch, tile_rows):
    """Texts near the threshold share many keys and stay apart after the first round: each of their pairs is given once."""
    rng, base = random.Random(3), [f"w{i}" for i in range(200)]
    texts = []
    for _ in range(40):
        copy = list(base)
        for _ in range(3):
            copy[rng.randrange(200)] = f"x{rng.randrange(10**6)}"
        texts.append(" ".join(copy))
    given, real = [], N.verified

    def watched(pairs, *rest):
        given.append((pairs.count(), pairs.distinct().count()))
        return real(pairs, *rest)

    monkeypatch.setattr(N, "verified", watched)
    N.keep_one(spark.createDataFrame(list(enumerate(texts)), SCHEMA), tile_rows=tile_rows)
    assert given[1][0] == given[1][1] > 40
