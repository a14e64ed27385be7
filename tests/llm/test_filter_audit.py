"""The filter audit against filters applied one after the other."""

import random
import re
from collections import Counter
from itertools import permutations

import numpy as np
import pytest

from claimloom.llm import filter_audit
from claimloom.llm.filter_audit import audit, before_after, cells, judged, text_failures


def plain_failures(text):
    text = text or ""
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", text) if w]
    return sum(1 << k for k, bad in enumerate([len(words) < 200, 100 * len(set(words)) < 50 * len(words), 100 * sum("A" <= c <= "Z" for c in text) > 2 * len(text), any(c in "#$%&*|" for c in text)]) if bad)


def applied(rows, names):
    """(part, order, step) -> counts, by brute force over (part, failures, good, toxic)."""
    out, n = {}, len(names)
    for part in {r[0] for r in rows}:
        mine = [r for r in rows if r[0] == part]
        shapley = Counter()
        for order in permutations(range(n)):
            left = mine
            for step, k in enumerate(order, 1):
                gone = [r for r in left if r[1] >> k & 1]
                after = [r for r in left if not r[1] >> k & 1]
                failing = [r for r in mine if r[1] >> k & 1]
                shapley[k] += len(gone)
                out[part, "".join(names[i] for i in order), step] = [k, len(after), len(gone), len(failing) - len(gone), sum(r[1] == 1 << k for r in mine), sum(r[2] for r in gone), sum(r[3] for r in gone)]
                left = after
        for key, v in out.items():
            if key[0] == part and len(v) == 7:
                v.append(shapley[v[0]])
    return {k: tuple(v[1:]) for k, v in out.items()}


def seen(df):
    return {(r["part"], r["filter_order"], r["step"]): (r["kept"], r["removed"], r["redundant"], r["unique_fails"], r["good_lost"], r["toxic_lost"], r["shapley"]) for r in df.collect()}


@pytest.mark.parametrize("names", ["ABCDE", "XY", "Z"])
def test_all_orders(spark, monkeypatch, names):
    monkeypatch.setattr(filter_audit, "BLOCK_ROWS", 100)
    rng = random.Random(len(names))
    rows = [(rng.choice(["", "a", "b", "ü"]) if i % 3 else "hot", rng.randrange(1 << len(names)), rng.random() < 0.5, rng.random() < 0.2) for i in range(900)] + [("clean", 0, False, False)]
    df = spark.createDataFrame(rows, "part string, failures int, good boolean, toxic boolean").repartition(5)
    assert seen(audit(df, ["good", "toxic"], names)) == applied(rows, names)


def test_bits_of_parts_of_all_sizes():
    rng = np.random.default_rng(2)
    codes = np.concatenate([np.zeros(64, int), np.ones(1, int), np.full(65, 2), np.full(200, 3)])
    rng.shuffle(codes)
    failures = rng.integers(0, 8, len(codes))
    label = rng.random(len(codes)) < 0.3
    found = cells(codes, failures, [label], 3)
    for part in range(4):
        for i, (before, k) in enumerate(before_after(3)):
            mine = codes == part
            hit = mine & (failures & before == 0) & (failures >> k & 1 == 1)
            alive = mine & (failures & before == 0)
            assert found[part, :, i].tolist() == [int((alive & ~hit).sum()), int(hit.sum()), int((mine & (failures >> k & 1 == 1)).sum() - hit.sum()), int((mine & (failures == 1 << k)).sum()), int((hit & label).sum())]


def test_text_failures():
    texts = [None, "", "a " * 199, "a " * 200, " ".join(f"w{i % 100}" for i in range(200)), " ".join(f"w{i % 99}" for i in range(200)), "Ab" + "é" * 48, "AB" + "é" * 98, "AB" + "é" * 97, "x#", "a|b", "\x1c".join("abc"), " " * 5, "\x0b\x0c \r" * 4]
    for t in texts:
        assert text_failures(t) == plain_failures(t), t


def test_hard_rows(spark, docs, empty):
    labels = spark.createDataFrame([(2, 1, 0), (2, 0, 1), (5, None, 1), (9, 1, 1), (None, 1, 1), (77, 1, 1)], "doc_id long, quality int, toxic int")
    rows = docs.collect()
    says = {2: (True, True), 5: (False, True), 9: (True, True)}
    expected = []
    for r in rows:
        smaller = any((o["text"] or "") == (r["text"] or "") and o["doc_id"] is not None and r["doc_id"] is not None and o["doc_id"] < r["doc_id"] for o in rows)
        expected.append((r["source"] or "", plain_failures(r["text"]) | smaller << 4, *says.get(r["doc_id"], (False, False))))
    found = judged(docs.selectExpr("*", "1 as failures", "'x' as part", "true as good", "text as digest"), labels)
    assert sorted(map(tuple, found.collect())) == sorted(expected)
    assert seen(audit(found, ["good", "toxic"])) == applied(expected, "ABCDE")
    assert audit(judged(empty, labels), ["good", "toxic"]).count() == 0
    assert seen(audit(judged(docs, labels.limit(0)), ["good", "toxic"])) == applied([(p, f, False, False) for p, f, _, _ in expected], "ABCDE")


def test_filters_have_a_bound(spark, empty):
    with pytest.raises(ValueError):
        audit(empty, [], "ABCDEFG")
