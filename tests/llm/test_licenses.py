"""License scans against a plain search of the words."""

import random
import re

import pytest

from claimloom.llm import licenses
from claimloom.llm.licenses import BASE, NOTICES, Index, Template, scan_licenses

WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def small(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def base_places(text):
    words = WORDS.findall(small(text))
    out = []
    for t in BASE:
        own = t.text.split()
        out += [(i, t.label) for i in range(len(words)) if words[i : i + len(own)] == own]
    return len(words), sorted(out)


def found(spark, texts, **how):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return {r["doc_id"]: r for r in scan_licenses(df, **how).collect()}


def test_base_places_of_random_texts(spark):
    rng = random.Random(5)
    parts = ["cc", "CC", "by", "by-cc", "general", "General public", "public license", "license", "all", "rights", "reserved", "All rights reserved.", "x", "été", "\x7f", "ccé", "GENERAL PUBLIC LICENSE", "ÀLL", "\n"]
    texts = [" ".join(rng.choice(parts) for _ in range(rng.randrange(60))) for _ in range(300)] + ["", None, "cc by", "cc-by cc_by ccby cc by by cc by"]
    rows = found(spark, texts)
    for i, text in enumerate(texts):
        n, places = base_places(text)
        assert rows[i]["n_words"] == n
        assert sorted((x["first_word"], x["label"]) for x in rows[i]["licenses"] if x["base"]) == places


def test_every_notice_is_found_in_its_text_and_with_a_word_more(spark):
    rng = random.Random(1)
    filler = lambda: " ".join(rng.choice(["lorem", "ipsum", "dolor", "sit"]) for _ in range(50))
    texts = []
    for t in NOTICES:
        words = t.text.split()
        last = words[:-1] + ["truly"] + words[-1:]
        texts += [f"{filler()} {t.text.upper()} {filler()}", f"{filler()} {' '.join(last)} {filler()}"]
    rows = found(spark, texts)
    for k, t in enumerate(NOTICES):
        assert any(x["label"] == t.label and x["first_word"] == 50 and x["share"] == 1.0 for x in rows[2 * k]["licenses"]), t
        within_keys = t.keys and t.text.lower().rstrip(".").endswith(t.keys[-1].split()[-1]) and len(t.words) > 3
        if t.drift and not within_keys:
            assert any(x["label"] == t.label for x in rows[2 * k + 1]["licenses"]), t


def test_key_phrases_are_mandatory_and_most_of_the_weight_must_stand():
    template = Template("a", "one two three four five six seven eight nine ten", ("five six",))
    index = Index([template], 100, {w: 50 for w in template.words})
    assert index.scan("one two three four five six seven eight nine ten")[1] == [(0, 0, 1.0)]
    assert index.scan("one two three four six five seven eight nine ten")[1] == []
    assert index.scan("one two three x five six x x x x")[1] == []
    assert index.scan("z one two three four five six seven y y y")[1] == [(0, 1, 0.7)]
    assert index.scan("two three four five six seven eight nine ten")[1] == []  # without its rarest word, the first of equals


def test_rarest_words_anchor():
    template = Template("a", "the of rare the of")
    index = Index([template], 1000, {b"the": 900, b"of": 800, b"rare": 1})
    assert [index.words[0][q] for q in index.rare[0]] == [b"rare", b"of", b"of"]


def test_long_texts_in_blocks_lose_no_place(monkeypatch):
    index = Index([*BASE, *NOTICES], 10, {})
    rng = random.Random(3)
    words = []
    while len(words) < 300_000:
        words += ["w%d" % rng.randrange(9)] * rng.randrange(3000) + rng.choice([t.text for t in [*BASE, *NOTICES]]).split()
    text = " ".join(words)
    n, places = index.scan(text)
    expected_n, expected = base_places(text)
    assert n == expected_n and sorted((at, index.templates[t].label) for t, at, _ in places if index.templates[t].base) == expected
    assert len(places) == len({(t, at) for t, at, _ in places})
    monkeypatch.setattr(licenses, "BLOCK_WORDS", 1 << 30)
    assert sorted(index.scan(text)[1]) == sorted(places)


def test_hard_rows(spark, docs, empty):
    clash = docs.selectExpr("*", "'mine' as n_words", "1 as licenses", "text as label")
    out = scan_licenses(clash)
    assert out.count() == docs.count() and out.columns == ["doc_id", "text", "lang", "source", "n_chars", "label", "n_words", "licenses"]
    assert all(r["n_words"] == 0 and r["licenses"] == [] for r in out.where("text is null").collect())
    assert scan_licenses(empty).count() == 0


def test_query_on_hard_rows(spark, docs, tmp_path):
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    rows = licenses.op11_license_scan(spark, str(tmp_path)).collect()
    assert len(rows) == docs.count()
    null = [r for r in rows if r["n_words"] == 0]
    assert null and all((r["n_base"], r["first_word"], r["last_word"], r["base_labels"], r["labels"], r["score"]) == (0, None, None, "", "", 0.0) for r in null)


@pytest.mark.parametrize("text, labels", [("Licensed under CC BY-NC 4.0.", "cc-by,cc-by-nc"), ("This work is licensed under the GNU General Public License, version 3.", "gpl,gpl-3.0"), ("Released under the MIT License.", "mit"), ("Licensed under the Apache License, Version 2.0.\nAll rights reserved", "apache-2.0,reserved"), ("the licence of cc", "")])
def test_labels(spark, tmp_path, text, labels):
    spark.createDataFrame([(1, text)], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    assert [r["labels"] for r in licenses.op11_license_scan(spark, str(tmp_path)).collect()] == [labels]
