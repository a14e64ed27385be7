"""Progressive JPEG round trips, language identification, sharding and revisits."""

import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from claimloom.llm import language_id as G
from claimloom.llm import progressive_jpeg as J
from claimloom.llm import sharding as H
from claimloom.llm import warc as R
from claimloom.llm.common import kept


@pytest.mark.parametrize("blocks", [1, 2, 6, 7, 25, 60])
def test_payload_round_trip_both_ways(blocks):
    raw = random.Random(blocks).randbytes(64 * blocks)
    file = J.encode(raw)
    quick, slow = J.decode(file), J.decode(file, flat=False)
    assert J.payload(quick) == J.payload(slow) == raw
    assert all((a.coefficients == b.coefficients).all() for a, b in zip(quick.components, slow.components))


def test_inverse_transform_and_colour():
    c = J.Component(1, 1, 1, 0, 1, 1, 1, 1, np.zeros((1, 64), "i4"))
    c.coefficients[0, :3] = 40, 8, -16
    got = J.planes(J.Image(8, 8, [c], {0: np.ones(64, "f4")}, None))[0]
    k = lambda u: np.sqrt(0.125) if u == 0 else 0.5
    want = [[128 + sum(v * k(a) * k(b) * np.cos((2 * y + 1) * a * np.pi / 16) * np.cos((2 * x + 1) * b * np.pi / 16) for v, (a, b) in zip((40, 8, -16), ((0, 0), (0, 1), (1, 0)))) for x in range(8)] for y in range(8)]
    assert abs(got.astype(float) - np.array(want)).max() <= 0.51
    image = J.decode(J.encode(bytes(64 * 6)))
    y, cb, cr = J.planes(image)
    rgb = J.rgb(image)
    assert rgb.shape == (16, 16, 3) and y.shape == (16, 16) and cb.shape == (8, 8)
    red = y[3, 5] + 1.402 * (int(cr[1, 2]) - 128)
    assert abs(rgb[3, 5, 0] - min(255, max(0, red))) <= 1


def test_other_progressive_files():
    """A file as other encoders write it: interleaved DC, runs of zeros, end-of-band runs, new coefficients in a refining scan, restarts."""
    bits = ""
    dc = {0: "00", 1: "01", 2: "10"}  # code lengths of two bits for sizes 0, 1, 2
    ac = {0x00: "00", 0x01: "01", 0x31: "10", 0x10: "110"}
    dht = lambda cls, ident, lengths, symbols: J._segment(0xC4, bytes([cls << 4 | ident, *lengths, *symbols]))
    pack = lambda s: J._stuffed(bytes(int((s + "1" * (-len(s) % 8))[i : i + 8], 2) for i in range(0, len(s), 8)))
    head = b"\xff\xd8" + J._segment(0xDB, bytes([0] + [1] * 64)) + J._segment(0xC2, bytes([8, 0, 8, 0, 16, 1, 1, 0x11, 0]))
    head += dht(0, 0, [0, 3] + [0] * 14, [0, 1, 2]) + dht(1, 0, [0, 3, 1] + [0] * 13, [0x00, 0x01, 0x31, 0x10])
    bits = dc[2] + "11" + dc[1] + "0"  # 3, then 3 - 1
    file = head + J._scan(1, 0, 0, 0, 0, 0, pack(bits))
    file += J._scan(1, 0, 1, 63, 0, 1, pack(ac[0x01] + "1" + ac[0x31] + "0" + ac[0x10] + "0"))  # 1 << 1, three zeros, -1 << 1, then a run of two bands
    file += J._scan(1, 0, 1, 63, 1, 0, pack(ac[0x31] + "1" + "1" + ac[0x00] + "0" + ac[0x01] + "1" + ac[0x00])) + b"\xff\xd9"
    c = J.decode(file).components[0].coefficients
    assert c[:, 0].tolist() == [3, 2]
    assert c[0, 1:7].tolist() == [3, 0, 0, 0, -2, 1] and c[1, 1:4].tolist() == [1, 0, 0]
    with pytest.raises(ValueError):
        J.decode(b"no picture")
    with pytest.raises(ValueError):
        J.decode(b"\xff\xd8" + J._segment(0xC0, bytes([8, 0, 8, 0, 8, 1, 1, 0x11, 0])))


def test_media_columns(docs, empty):
    media = kept(J.encode_media(docs), "media")
    rows = J.digest_media(media).collect()
    assert len(rows) == docs.count()
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    for r in rows:
        if r["doc_id"] is not None:
            p = J.padded(texts[r["doc_id"]])
            assert (r["n_bytes"], r["payload_bytes"], r["tail_crc32"]) == (len((texts[r["doc_id"]] or "").encode()), len(p), zlib.crc32(p[-64:]))
    same = [r for r in rows if r["doc_id"] in (2, 5)]
    assert same[0]["feature"] == same[1]["feature"] and same[0]["media_sha256"] == same[1]["media_sha256"]
    back = J.decode_media(media.where("doc_id = 12").unionByName(media.where("doc_id = 1").withColumn("media", F.lit(b"x")))).collect()
    by = {r["doc_id"]: r for r in back}
    assert by[12]["payload"] == b"a" + bytes(63) and len(by[12]["tensor"]) == by[12]["width"] * by[12]["height"] * 3 and by[1]["tensor"] is None
    assert J.digest_media(J.encode_media(empty)).count() == 0


def test_language(spark, docs, empty):
    rng = random.Random(1)
    parts = {"aa": ["ka", "ki", "ko"], "bb": ["zut", "zet", "zot"], "cc": ["émo", "ému", "éma"]}
    text = lambda lang, n: " ".join("".join(rng.choice(parts[lang]) for _ in range(3)) for _ in range(n))
    rows = [(i, text(lang, rng.randrange(5, 200)), lang) for i, lang in enumerate(rng.choice(list(parts)) for _ in range(400))]
    table = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = G.learned(table)
    got = G.predict(table.withColumn("held", G.held_out()), model).collect()
    assert all(r["held"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in got)
    assert np.mean([r["lang"] == r["lang_pred"] for r in got if r["held"]]) > 0.97
    assert all(0 <= r["score"] <= 1 for r in got)
    again = G.learned(table)
    assert all((a == b).all() for a, b in zip(model.conv, again.conv))
    odd = G.predict(docs.withColumn("score", F.lit("clash")), model).collect()
    assert {r["doc_id"] for r in odd if r["lang_pred"] == "und"} == {1, 3, 11, None} and len(odd) == docs.count()
    assert [r["lang_pred"] for r in G.predict(docs, None).select("lang_pred").distinct().collect()] == ["und"]
    assert G.learned(empty) is None and G.predict(empty, model).count() == 0
    assert G.keep_known(docs, model).columns == docs.columns


def test_joined_tables_score_as_the_plain_network():
    model = G.ByteCNN(["a", "b"], filters=4)
    x = np.random.default_rng(0).integers(0, 256, (50, G.WINDOW)).astype("u1")
    pooled, _ = model._pooled(x)
    want = G.softmax(np.maximum(pooled, 0) @ model.out + model.shift)
    assert np.allclose(model.scorer()(x, 16), want, atol=1e-5)


@pytest.mark.parametrize("dims, bits", [(2, 4), (3, 3), (4, 2)])
def test_hilbert_is_a_path_of_unit_steps(dims, bits):
    grid = np.stack(np.meshgrid(*[np.arange(1 << bits)] * dims, indexing="ij"), -1).reshape(-1, dims)
    index = H.hilbert_index(grid, bits)
    assert sorted(index) == list(range(len(grid)))
    assert (np.abs(np.diff(grid[np.argsort(index)], axis=0)).sum(1) == 1).all()


def test_shards(spark, docs, empty, tmp_path):
    rng = random.Random(9)
    rows = [(i, rng.choice([None, "en", "de", "fr"]), "hot" if i % 3 == 0 else f"s{i % 7}", rng.randrange(1, 1000)) for i in range(500)] + [(7, "en", "hot", 5)] * 40 + [(None, None, None, 3)]
    table = spark.createDataFrame(rows, "doc_id long, lang string, source string, size long")
    out = H.assign_shards(table, ["lang", "source", "size"])
    found = out.collect()
    assert len(found) == len(rows) and sorted((str(r["doc_id"]), r["size"]) for r in found) == sorted((str(r[0]), r[3]) for r in rows)
    total = sum(r[3] for r in rows)
    for s in range(8):
        own = [r for r in found if r["shard"] == s]
        assert sorted(r["slot"] for r in own) == list(range(len(own)))
        assert abs(sum(r["size"] for r in own) - total / 8) <= 1000
    curve = [r["curve"] for r in sorted(found, key=lambda r: (r["shard"], r["slot"]))]
    assert curve == sorted(curve)
    spans = H.shard_ranges(out, ["lang", "source"]).collect()
    assert sum(r["rows"] for r in spans) == len(rows)
    pairs = {(r["lang"], r["source"]) for r in found}
    assert sum(len({(r["lang"], r["source"]) for r in found if r["shard"] == s}) for s in range(8)) < 3 * len(pairs)  # of 8 times as many if spread
    assert H.assign_shards(table.limit(0), ["lang"]).count() == 0


def test_canonical_urls(spark):
    urls = ["HTTP://u@WWW.Ex.com:80/a/?b=2&utm_x=1&a=1#f", "https://ex.com/a?a=1&b=2", "ex.com", None, "", "https://ex.com:8080/A/"]
    got = [r[0] for r in spark.createDataFrame([(u,) for u in urls], "u string").coalesce(1).select(R.canonical_url(F.col("u"))).collect()]
    assert got == ["ex.com/a?a=1&b=2", "ex.com/a?a=1&b=2", "ex.com", None, "", "ex.com:8080/A"]


def test_revisits(spark):
    """Against a scan in order, with one URL that has a third of all rows, ties in time, repeats and nulls."""
    rng = random.Random(5)
    rows = []
    for i in range(300):
        full = rng.random() < 0.2
        tag = rng.choice(["x", "y", None])
        rows.append((i, rng.choice(["http://hot.example/", f"http://h{i % 9}.example/p", None if i % 50 == 0 else "http://HOT.example"]), None if i % 41 == 0 else rng.randrange(60), "response" if full else rng.choice(["revisit", None]), tag and ("W/" if rng.random() < 0.3 else "") + tag, rng.choice([None, "m"]), {"Date": str(i), "Content-Type": "t", "ETag": "e"} if full else {"date": str(i), "Content-Length": "0"}, f"body{i}" if full else None))
    rows += rows[10:12]
    df = spark.createDataFrame(rows, "record_id long, url string, ts long, kind string, etag string, last_modified string, headers map<string,string>, body string")
    got = {}
    for r in R.resolve_revisits(df.withColumn("extra", F.lit(1))).collect():
        got.setdefault(r["record_id"], []).append(r)
    assert sum(map(len, got.values())) == len(rows)
    key = lambda u: u and u.lower().split("://")[1].rstrip("/")
    plain = lambda t: t and t.removeprefix("W/")
    order = sorted((r for r in rows if r[2] is not None and r[1]), key=lambda r: (r[2], r[3] != "response", r[0]))
    last, want = {}, {}
    for r in order:
        if r[3] == "response":
            last[key(r[1])] = r
        else:
            want[r[0]] = last.get(key(r[1]))
    for r in rows:
        g = got[r[0]][0]
        if r[3] == "response":
            assert (g["outcome"], g["body"]) == ("response", r[7])
            continue
        base = want.get(r[0])
        if base is None:
            assert (g["outcome"], g["base_id"], g["body"]) == ("no_base", None, None)
            continue
        ok = plain(r[4]) == plain(base[4]) if r[4] else (r[5] == base[5] if r[5] else None)
        assert (g["outcome"], g["base_id"]) == ({None: "unchecked", True: "resolved", False: "mismatch"}[ok], base[0])
        assert g["body"] == (base[7] if ok is not False else None)
        if ok is not False:
            assert g["headers"] == {"date": str(r[0]), "content-type": "t", "etag": "e"}
    assert R.resolve_revisits(df.limit(0)).count() == 0
