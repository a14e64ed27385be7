"""SimHash groups, line dedup and decontamination against brute force."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from claimloom.llm import decontamination as D
from claimloom.llm import line_dedup as L
from claimloom.llm import simhash as S


def slow_print(text, width=3):
    import xxhash

    words = [w for w in (text or "").encode().lower().replace(b"\x0b", b" ").replace(b"\x0c", b" ").split()]
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + width]) for i in range(len(words) - width + 1)] or [b" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def roots(nodes, pairs):
    up = {n: n for n in nodes}

    def find(n):
        while up[n] != n:
            n = up[n]
        return n

    for a, b in pairs:
        a, b = sorted((find(a), find(b)))
        up[b] = a
    return {n: find(n) for n in nodes}


def test_fingerprints(docs):
    for r in S.fingerprints(docs).collect():
        assert r["fp"] % (1 << 64) == slow_print(r["text"])
    text = " ".join(f"w{i}" for i in range(5000))
    assert S.fingerprint(text) == slow_print(text)


def test_close_pairs_skips_nothing():
    rng = np.random.default_rng(3)
    base = rng.integers(0, 1 << 63, 40, dtype="u8")
    fps = np.concatenate([base, base ^ np.uint64(1), base ^ np.uint64(5), rng.integers(0, 1 << 63, 900, dtype="u8")])
    fps = np.unique(fps)
    x, y = S.close_pairs(np.zeros(len(fps), "i8"), fps, 2, tile=2)
    want = {(i, j) for i in range(len(fps)) for j in range(i + 1, len(fps)) if int(fps[i] ^ fps[j]).bit_count() <= 2}
    assert {tuple(sorted(p)) for p in zip(x.tolist(), y.tolist())} == want and len(want) >= 100
    groups = np.sort(rng.integers(0, 90, len(fps)))  # many small groups, and a large one
    groups[:200] = 0
    x, y = S.close_pairs(groups, fps, 20)
    want = {(i, j) for i in range(len(fps)) for j in range(i + 1, len(fps)) if groups[i] == groups[j] and int(fps[i] ^ fps[j]).bit_count() <= 20}
    assert {tuple(sorted(p)) for p in zip(x.tolist(), y.tolist())} == want and len(want) == len(x)


@pytest.mark.parametrize("tile_rows", [2048, 8])
def test_links_and_components(spark, tile_rows):
    """A dense group around one fingerprint, chains of two-bit steps, and strangers; small tiles force the split of buckets."""
    rng = random.Random(tile_rows)
    fps = {rng.getrandbits(64) for _ in range(60)}
    centre = rng.getrandbits(64)
    fps |= {centre ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)) for _ in range(150)}
    step = rng.getrandbits(64)
    for i in range(0, 60, 2):
        step ^= 3 << i
        fps.add(step)
    signed = [int(np.uint64(f).astype("i8")) for f in fps]
    found = S.components(S.links(spark.createDataFrame([(f,) for f in signed], "fp long"), 2, tile_rows))
    pairs = [(a, b) for a in signed for b in signed if a < b and ((a ^ b) % (1 << 64)).bit_count() <= 2]
    want = {n: r for n, r in roots(signed, pairs).items() if any(n in p for p in pairs)}
    assert {r["node"]: r["root"] for r in found.collect()} == want


def test_near_duplicates(docs, empty):
    rows = S.near_duplicates(docs.withColumn("fp", F.lit(1))).collect()
    assert len(rows) == docs.count()
    by = {r["doc_id"]: r for r in rows if r["doc_id"] is not None}
    assert by[5]["component_id"] == 2 and by[1]["component_id"] == by[3]["component_id"] == by[11]["component_id"] == 1
    assert by[1]["fingerprint"] == "0" * 16 and by[12]["fingerprint"] == f"{slow_print('a'):016x}"
    assert sorted(r["component_id"] for r in rows if r["doc_id"] is None) == [1, 2]
    kept = S.keep_first(docs)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == [1, 2, 9, 9, 12, 13, 14, 15, 16]
    assert S.near_duplicates(empty).count() == 0


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def changed(rng, text, n):
    out = list(text)
    for _ in range(n):
        k = rng.randrange(len(out))
        rng.choice([lambda: out.insert(k, rng.choice("aé中")), lambda: out.pop(k), lambda: out.__setitem__(k, rng.choice("xyz"))])()
    return "".join(out)


@pytest.mark.parametrize("tile_rows", [1024, 4])
def test_line_dedup(spark, tile_rows):
    rng = random.Random(11)
    base = ["".join(rng.choice("abcdé ") for _ in range(rng.randrange(20, 60))) for _ in range(25)]
    lines = base + [changed(rng, rng.choice(base), rng.randrange(5)) for _ in range(120)] + ["short", "short", ""]
    rng.shuffle(lines)
    rows = [(i // 7 * 3, i) for i in range(len(lines))]
    texts = {}
    for (d, _), x in zip(rows, lines):
        texts.setdefault(d, []).append(x)
    docs = spark.createDataFrame([(d, "\n".join(t), 1) for d, t in texts.items()] + [(None, base[0], 1), (1000, None, 1)], "doc_id long, text string, n_lines int")
    order = [(d, k, x) for d in sorted(texts) for k, x in enumerate(texts[d]) if len(x) >= 20]
    distinct = sorted({x for _, _, x in order})
    links = [(a, b) for i, a in enumerate(distinct) for b in distinct[i + 1 :] if abs(len(a) - len(b)) <= 2 and distance(a, b) <= 2]
    assert len(links) > 30
    group, first = roots(distinct, links), {}
    for d, k, x in order:
        first.setdefault(group[x], (d, k))
    got = {r["doc_id"]: r for r in L.dedup_lines(docs, tile_rows=tile_rows).collect()}
    for d, t in texts.items():
        keep = [x for k, x in enumerate(t) if len(x) < 20 or first[group[x]] == (d, k)]
        assert got[d]["text"] == "\n".join(keep) and got[d]["n_dropped"] == len(t) - len(keep) and got[d]["n_lines"] == len(t)
    assert got[None]["text"] == base[0] and got[1000]["text"] is None
    kept = L.keep_fresh(docs.drop("n_lines"))
    assert kept.columns == ["doc_id", "text"]


def test_line_dedup_edges(docs, empty):
    rows = L.dedup_lines(docs).collect()
    assert len(rows) == docs.count()
    by = {}
    for r in rows:
        by.setdefault(r["doc_id"], []).append(r)
    assert by[5][0]["text"] == "" and by[2][0]["n_dropped"] == 0 and {r["text"] for r in by[9]} == {""}
    assert by[15][0]["text"] == "été où ça\nend"
    assert L.dedup_lines(empty).count() == 0
    assert {r["doc_id"] for r in L.keep_fresh(docs).collect()} == {None, 1, 2, 3, 11, 12, 13, 14, 16}


def weighted(a, b):
    keys = set(a) | set(b)
    return sum(min(a.count(k), b.count(k)) for k in keys) / max(1, sum(max(a.count(k), b.count(k)) for k in keys))


def test_decontamination(spark, docs, empty):
    rng = random.Random(4)
    vocabulary = [f"w{i}" for i in range(50)]
    items = [" ".join(rng.choice(vocabulary) for _ in range(rng.randrange(1, 40))) for _ in range(30)] + ["", None]
    texts = []
    for i in range(60):
        words = [rng.choice(vocabulary) for _ in range(rng.randrange(0, 80))]
        if i % 2:
            leak = rng.choice(items[:30]).split()
            if i % 4 == 1 and len(leak) > 8:
                leak[rng.randrange(len(leak))] = "edit"
            words[5:5] = leak
        texts.append(" ".join(words).upper() + "!")
    table = spark.createDataFrame([(i, t) for i, t in enumerate(texts)] + [(100, None), (101, "")], "doc_id long, text string")
    bench = spark.createDataFrame([(i, t) for i, t in enumerate(items)], "item_id long, text string")
    got = {r["doc_id"]: {m["item_id"]: m["similarity"] for m in r["leaks"]} for r in D.find_leaks(table, bench, radius=63).collect()}
    for i, text in enumerate(texts):
        own, want = D.words(text), {}
        for j, item in enumerate(items):
            w = D.words(item)
            if not w:
                continue
            k = min(5, len(w))
            cut = lambda x, k=k: [tuple(x[n : n + k]) for n in range(len(x) - k + 1)]
            mine, size = cut(w), len(w) - k + 1
            all_ = cut(own)
            best = max((weighted(mine, all_[s : s + size]) for s in range(max(1, len(all_) - size + 1))), default=0)
            if all_ and best >= 0.8:
                want[j] = best
        assert got[i] == pytest.approx(want), i
    assert got[100] == got[101] == {}
    same = {r["doc_id"]: sorted(m["item_id"] for m in r["leaks"]) for r in D.find_leaks(table, bench, block_bytes=50).collect()}
    exact = {i: sorted(j for j, v in got[i].items() if v == 1) for i in got}
    assert all(set(exact[i]) <= set(same[i]) <= set(got[i]) for i in got)
    assert D.find_leaks(empty, bench).count() == 0 and D.drop_leaks(docs, bench.limit(0)).count() == docs.count()


def test_multi_index_is_complete():
    rng = np.random.default_rng(2)
    items = [(i, rng.integers(0, 1 << 63, 12, dtype="u8")) for i in range(40)]
    group = D.Group(items, 15)
    prints = np.concatenate([group.prints ^ np.uint64(sum(1 << int(b) for b in rng.choice(64, n, replace=False))) for n in range(20)])
    w, i = group.candidates(prints)
    want = {(a, b) for a in range(len(prints)) for b in range(40) if int(prints[a] ^ group.prints[b]).bit_count() <= 15}
    assert set(zip(w.tolist(), i.tolist())) == want
