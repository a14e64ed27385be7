"""Hot keys, repeated and null ids, broken files and clashing names; and the queries on the smallest tables against brute force."""

import glob
import hashlib
import random
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from claimloom.llm import decontamination as D
from claimloom.llm import language_id as G
from claimloom.llm import line_dedup as L
from claimloom.llm import progressive_jpeg as J
from claimloom.llm import queries
from claimloom.llm import sharding as H
from claimloom.llm import token_output
from claimloom.llm import warc as R
from claimloom.llm.common import new_path
from claimloom.llm.pieces import vocabulary
from tests.llm.test_copies import slow_print, weighted

SF = "/root/testdata/sf0.001"


def test_lines_of_rows_with_one_id(spark):
    """A row loses a line only where it stands itself."""
    line = "a line that is long enough to be compared with others"
    rows = [(1, line), (2, line + "\nfresh line of the first row of this id"), (2, "an entirely different unique line of text here")]
    got = L.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(r["text"] for r in got) == sorted([line, "fresh line of the first row of this id", rows[2][1]])


def test_rows_without_an_id_link_nothing(spark):
    a = "the quick brown fox jumps over the lazy dog"
    rows = [(1, a), (None, a + "XX"), (3, a + "XXYY")]
    got = {r["doc_id"]: r["text"] for r in L.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == dict(rows)


@pytest.mark.parametrize("rows", [1, 2, 3, 50])
def test_met_lines_are_streamed(rows):
    rng = np.random.default_rng(rows)
    sig, line = np.sort(rng.integers(0, 40, 200)), rng.integers(0, 9, 200) * 2
    sig[60:160] = sig[60]
    order = np.lexsort((line, np.sort(sig)))
    sig, line = np.sort(sig)[order], line[order] | rng.integers(0, 2, 200)
    batches = [pa.RecordBatch.from_arrays([pa.array(sig[i : i + rows]), pa.array(line[i : i + rows])], names=["sig", "line"]) for i in range(0, 200, rows)]
    got = [tuple(r.values()) for b in L._met(iter(batches)) for r in b.to_pylist()]
    want = {}
    for s, x in zip(sig.tolist(), line.tolist()):
        want.setdefault(s, {})[x & ~1] = want.get(s, {}).get(x & ~1, False) or bool(x & 1)
    assert sorted(got) == sorted((s, x, own) for s, lines in want.items() if len(lines) > 1 for x, own in lines.items())


def test_blocks_leave_no_seam():
    rng = random.Random(8)
    items = [(i, " ".join(f"w{rng.randrange(400)}" for _ in range(rng.randrange(8, 60)))) for i in range(40)]
    bench = D.Benchmark(items)
    for n in range(30):
        words = [f"w{rng.randrange(400)}" for _ in range(rng.randrange(10, 900))]
        for _ in range(3):
            at, leak = rng.randrange(len(words)), rng.choice(items)[1].split()
            words[at:at] = leak[: rng.randrange(len(leak) // 2, len(leak) + 1)]
        text = " ".join(words)
        for size in (7, 100, 300):
            assert bench.search(text, block_words=size) == bench.search(text), n


def test_recall_at_the_production_radius():
    """Edited items of benchmark-like length, against all windows by exact similarity."""
    rng, found, due = random.Random(6), 0, 0
    items = [(i, " ".join(f"w{rng.randrange(3000)}" for _ in range(rng.randrange(20, 80)))) for i in range(60)]
    near, all_ = D.Benchmark(items), D.Benchmark(items, radius=64)
    for _ in range(400):
        words, leak = [f"w{rng.randrange(3000)}" for _ in range(100)], rng.choice(items)[1].split()
        for _ in range(rng.randrange(3)):
            leak[rng.randrange(len(leak))] = "edit"
        words[40:40] = leak
        want = {m[0] for m in all_.search(" ".join(words))}
        got = {m[0] for m in near.search(" ".join(words))}
        assert got <= want
        found, due = found + len(got), due + len(want)
    assert due > 200 and found >= 0.99 * due


def test_header_case_and_missing_ids(spark):
    schema = "record_id long, url string, ts long, kind string, etag string, last_modified string, headers map<string,string>, body string"
    rows = [
        (None, "http://a/", 1, "response", "x", None, {"Set-Cookie": "1", "set-cookie": "2", "Date": "d"}, "first"), (None, "http://b/", 1, "response", "x", None, None, "second"),
        (7, "http://a/", 2, "revisit", "x", None, {"DATE": "e", "date": "f"}, None), (7, "http://b/", 2, "revisit", "x", None, {"Vary": "v"}, None), (None, "http://c/", 2, "revisit", "x", None, {"own": "1"}, None),
    ]
    got = sorted((r["url_key"], r["outcome"], r["body"], r["headers"]) for r in R.resolve_revisits(spark.createDataFrame(rows, schema)).collect() if r["outcome"] != "response")
    assert got == [("a", "resolved", "first", {"set-cookie": "2", "date": "f"}), ("b", "resolved", "second", {"vary": "v"}), ("c", "no_base", None, {"own": "1"})]


def test_broken_files_give_nulls(spark):
    """Truncations and flipped bits: an image or a ValueError, never more memory than the file's length allows."""
    raw, rng = J.encode(random.Random(1).randbytes(640)), random.Random(2)
    files = [raw[:n] for n in range(2, len(raw), 37)] + [bytes([*raw[:k], raw[k] ^ 1 << rng.randrange(8), *raw[k + 1 :]]) for k in range(2, len(raw), 3)]
    for f in files:
        try:
            image = J.decode(f)
        except ValueError:
            continue
        assert sum(len(c.coefficients) for c in image.components) <= 8 * len(f)
    rows = J.decode_media(spark.createDataFrame([(i, f) for i, f in enumerate(files[::5] + [None])], "doc_id long, media binary").coalesce(2)).collect()
    assert len(rows) == len(files[::5]) + 1 and any(r["tensor"] is None for r in rows)
    huge = raw.replace(raw[raw.index(b"\xff\xc2") + 5 : raw.index(b"\xff\xc2") + 9], b"\xff\xff\xff\xff", 1)
    with pytest.raises(ValueError):
        J.decode(huge)


def test_stored_tensors(spark, docs):
    media = J.write_media(docs.withColumn("media", F.lit(1)), new_path(spark, "media"))
    back = J.write_tensors(media.where("doc_id in (2, 14)"), new_path(spark, "tensors")).collect()
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    assert sorted(r["doc_id"] for r in back) == [2, 14]
    for r in back:
        assert r["payload"] == J.padded(texts[r["doc_id"]])
        assert np.array_equal(np.frombuffer(r["tensor"], "u1").reshape(r["height"], r["width"], 3), J.rgb(J.decode(J.encode(r["payload"]))))


def test_frequent_text_and_rare_language_are_learned(spark):
    one = "la misma frase en castellano una y otra vez, sin ningún cambio"
    other = [f"some english words number {i} that are all their own" for i in range(60)]
    rows = [(i, one, "es") for i in range(3000)] + [(5000 + i, t, "en") for i, t in enumerate(other)] + [(9000 + i, f"klingon {i}", f"l{i}") for i in range(250)]
    table = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(4)
    found = G.training_windows(table, per_language=20)
    assert len({lang for lang, _ in found}) == 252
    assert len({raw for lang, raw in found if lang == "es"}) == sum(lang == "es" for lang, _ in found) == 1
    assert found == G.training_windows(table.repartition(7), per_language=20)


def test_strings_are_ranked_whole(spark):
    table = spark.createDataFrame([(i, f"https://site.example/{i:04d}", 1) for i in range(640)], "doc_id long, url string, size long")
    rows = sorted(H.assign_shards(table, ["url"]).collect(), key=lambda r: r["doc_id"])
    assert len({r["curve"] for r in rows}) == 64 and [r["curve"] for r in rows] == sorted(r["curve"] for r in rows)


def test_names_of_shards_may_clash(spark):
    names = ["run", "place", "shard", "slot", "row", "before", "curve", "rows", "total", "size__", "r"]
    table = spark.createDataFrame([(i, "en", 5) for i in range(40)], "doc_id long, lang string, size long").withColumns({n: F.col("doc_id") * 2 for n in names})
    out = H.assign_shards(table, ["lang", "place"])
    assert sorted(out.columns) == sorted(["doc_id", "lang", "size", *names])
    assert all(r[n] == 2 * r["doc_id"] for r in out.collect() for n in set(names) - {"shard", "slot", "curve"})


def test_written_shards_hold_every_row_once(spark):
    rng = random.Random(3)
    rows = [(rng.choice([None, i, i, i]), rng.choice([None, "", "é" * rng.randrange(300)]), rng.choice(["en", "de", None]), f"s{rng.randrange(40)}", i) for i in range(600)] + [(5, "same", "en", "s1", 1)] * 30
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, shard int")
    H.write_shards(docs.repartition(5), {"lang": F.col("lang"), "source": F.col("source")}, out := new_path(spark, "shards"))
    found = H.read_shards(spark, out).collect()
    key = lambda r: tuple(str(x) for x in r)
    assert sorted(key(r["r"]) for r in found) == sorted(map(key, rows))
    size = lambda r: len((r["r"]["text"] or "").encode()) + 1
    for s in range(8):
        own = sorted((r for r in found if r["shard"] == s), key=lambda r: r["slot"])
        assert [r["slot"] for r in own] == list(range(len(own))) and [r["curve"] for r in own] == sorted(r["curve"] for r in own)
        assert abs(sum(map(size, own)) - sum(map(size, found)) / 8) <= 1200
    files = glob.glob(f"{out.removeprefix('file://')}/shard=*/*.parquet")
    spans = []
    for f in files:
        meta = pq.ParquetFile(f).metadata
        at = next(i for i in range(meta.num_columns) if meta.row_group(0).column(i).path_in_schema == "dim_source")
        stats = meta.row_group(0).column(at).statistics
        spans.append((stats.min, stats.max))
    assert len(spans) >= 8 and sum(a <= "s17" <= b for a, b in spans) <= 0.75 * len(spans)  # a reader skips the others by their footers


def test_orc_has_filters_and_indexes(spark, docs):
    token_output.write_token_ids(docs, out := new_path(spark, "orc"))
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    seen = 0
    for f in glob.glob(f"{out.removeprefix('file://')}/*.orc"):
        path = jvm.org.apache.hadoop.fs.Path(f)
        reader = jvm.org.apache.orc.OrcFile.createReader(path, jvm.org.apache.orc.OrcFile.readerOptions(conf))
        if not reader.getNumberOfRows():
            continue
        assert reader.getRowIndexStride() == 2000
        rows = reader.rows()
        footer = rows.readStripeFooter(reader.getStripes().get(0)) if hasattr(rows, "readStripeFooter") else None
        kinds = [str(footer.getStreams(i).getKind()) for i in range(footer.getStreamsCount())]
        assert "ROW_INDEX" in kinds and any(k.startswith("BLOOM_FILTER") for k in kinds)
        assert {str(footer.getColumns(i).getKind()) for i in range(footer.getColumnsCount())} <= {"DIRECT_V2", "DIRECT"}  # run lengths, version 2
        seen += 1
    assert seen


@pytest.fixture(scope="module")
def texts(spark):
    return {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}


def answer(spark, name):
    rows = queries.QUERIES[name](spark, SF).collect()
    by = {r["doc_id"]: r for r in rows}
    return rows, by


def test_op1(spark, texts):
    rows, by = answer(spark, "op1_simhash")
    assert len(rows) == len(texts)
    prints = {d: slow_print(t) for d, t in texts.items()}
    up = {d: d for d in texts}

    def root(d):
        while up[d] != d:
            d = up[d]
        return d

    ids = sorted(texts)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            if (prints[a] ^ prints[b]).bit_count() <= 2:
                low, high = sorted((root(a), root(b)))
                up[high] = low
    assert all((by[d]["fingerprint"], by[d]["component_id"]) == (f"{prints[d]:016x}", root(d)) for d in ids)


def test_op3_op4_op8(spark, texts):
    from tokenizers import Tokenizer

    byte, word = (Tokenizer.from_file(vocabulary(n)) for n in ("byte_bpe_50k.json", "word_bpe_49k.json"))
    ids = {d: byte.encode(t or "", add_special_tokens=False).ids for d, t in texts.items()}
    _, counts = answer(spark, "op3_token_counts")
    _, orc = answer(spark, "op4_token_ids")
    start = 0
    for d in sorted(texts):
        assert (counts[d]["n_bytes"], counts[d]["n_tokens"], counts[d]["over_limit"]) == (len((texts[d] or "").encode()), len(ids[d]), len(ids[d]) > 1024)
        raw = np.array([*ids[d], 2], "<u4").tobytes()
        assert (orc[d]["start"], orc[d]["n_tokens"], orc[d]["ids_crc32"]) == (start, len(raw) // 4, zlib.crc32(raw))
        start += len(raw) // 4
    pieces, _ = answer(spark, "op8_packing")
    whole = {d: [*word.encode(t or "", add_special_tokens=False).ids, 1] for d, t in texts.items()}
    at, used = {d: 0 for d in texts}, {}
    for p in sorted(pieces, key=lambda p: (p["doc_id"], p["start"])):
        cut = np.array(whole[p["doc_id"]][p["start"] : p["start"] + p["length"]], "<u4").tobytes()
        assert p["start"] == at[p["doc_id"]] and p["ids_crc32"] == zlib.crc32(cut) and p["doc_tokens"] == len(whole[p["doc_id"]])
        at[p["doc_id"]] += p["length"]
        used.setdefault(p["sequence_id"], []).append((p["offset"], p["length"]))
    assert at == {d: len(x) for d, x in whole.items()}
    for spans in used.values():
        assert [o for o, _ in sorted(spans)] == np.cumsum([0, *(n for _, n in sorted(spans))])[:-1].tolist() and sum(n for _, n in spans) <= 2048


def test_op5(spark, texts):
    bench = {r["item_id"]: r["text"] for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()}
    _, got = answer(spark, "op5_decontamination")
    cut = lambda w: [tuple(w[n : n + min(5, len(w))]) for n in range(len(w) - min(5, len(w)) + 1)]
    items = {i: cut(D.words(t)) for i, t in bench.items() if D.words(t)}
    for d, t in texts.items():
        own, want = cut(D.words(t)), []
        known = set(own)
        for i, mine in items.items():
            if not known & set(mine):
                continue
            if max((weighted(mine, own[s : s + len(mine)]) for s in range(max(1, len(own) - len(mine) + 1)) if own[s] in mine or own[min(s + len(mine), len(own)) - 1] in mine), default=0) >= 0.8:
                want.append(i)
        assert got[d]["item_ids"] == sorted(want) and got[d]["contaminated"] == bool(want), d


def test_op7(spark, texts):
    rows, _ = answer(spark, "op7_progressive_jpeg")
    assert len(rows) == len(texts)
    for r in rows:
        p = J.padded(texts[r["doc_id"]])
        file = J.encode(p)
        slow = J.decode(file, flat=False) if len(p) < 2000 else J.decode(file)
        tensor = J.rgb(slow)
        assert J.payload(slow) == p
        assert (r["payload_sha256"], r["media_bytes"], r["media_sha256"]) == (hashlib.sha256(p).hexdigest(), len(file), hashlib.sha256(file).hexdigest())
        assert r["feature"].startswith(f"{tensor.shape[1]}x{tensor.shape[0]}:") and r["feature"].endswith(f"{zlib.crc32(tensor):08x}")


def test_op9(spark, texts):
    _, got = answer(spark, "op9_language_id")
    lang = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    assert set(got) == set(texts)
    assert all(r["held_out"] == (zlib.crc32(str(d).encode()) % 4 == 2) and 0 <= r["score"] <= 1 for d, r in got.items())
    held = [d for d in texts if got[d]["held_out"] and lang[d] and texts[d] and any(c.isalpha() for c in texts[d])]
    assert np.mean([got[d]["lang_pred"] == lang[d] for d in held]) > 0.9
    assert all((r["lang_pred"] == "und") == (not texts[d] or not any(c.isalpha() for c in texts[d])) for d, r in got.items())


def test_op10(spark, texts):
    rows, by = answer(spark, "op10_sharding")
    assert len(rows) == len(texts)
    sizes = {d: len((t or "").encode()) + 1 for d, t in texts.items()}
    assert all((r["size"], r["text_crc32"], r["law"], r["grown_shard"]) == (sizes[d], zlib.crc32((texts[d] or "").encode()), "bytes", None) for d, r in by.items())
    for s in range(8):
        own = [r for r in rows if r["shard"] == s]
        assert sorted(r["slot"] for r in own) == list(range(len(own)))
        assert abs(sum(r["size"] for r in own) - sum(sizes.values()) / 8) <= max(sizes.values())
