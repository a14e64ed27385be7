"""The language query's rows, each worked out again window by window in double precision."""

import zlib

import duckdb
import numpy as np
import pytest

from claimloom.llm import language_id as L

SF = "/root/testdata/sf0.001"


def one(model, text):
    """(label, score) of a text: every whole and last window by itself, weighted by its bytes; no batches, no joined tables."""
    raw = text.encode()
    total, weights = np.zeros(len(model.languages)), 0
    for at in range(0, len(raw), L.WINDOW):
        piece = raw[at : at + L.WINDOW]
        x = np.zeros(L.WINDOW, int)
        x[: len(piece)] = list(piece)
        best = []
        for w, table in zip(L.WIDTHS, model.conv):
            best.append(np.max([sum(table[j][x[s + j]].astype("f8") for j in range(w)) for s in range(L.WINDOW - w + 1)], axis=0))
        z = np.maximum(np.concatenate(best) + model.bias, 0) @ model.out.astype("f8") + model.shift
        p = np.exp(z - z.max())
        total += p / p.sum() * len(piece)
        weights += len(piece)
    return model.languages[int(total.argmax())], float(total.max() / weights), total / weights


def test_rows_of_the_query(spark):
    docs = {i: t for i, t in duckdb.sql(f"select doc_id, text from '{SF}/documents.parquet'").fetchall()}
    model = L.learned(spark.read.parquet(f"{SF}/documents.parquet"))
    found = {r["doc_id"]: r for r in L.op9_language_id(spark, SF).collect()}
    assert sorted(found) == sorted(docs)
    looked = 0
    for doc_id, text in docs.items():
        r = found[doc_id]
        assert r["held_out"] == (zlib.crc32(str(doc_id).encode()) % 4 == 2)
        if text is None or not any(c.isalpha() for c in text):
            assert (r["lang_pred"], r["score"]) == (L.UNKNOWN, 0.0)
        elif len(text) <= 3000:
            label, score, all_ = one(model, text)
            looked += 1
            assert r["score"] == pytest.approx(score, abs=2e-4)
            assert r["lang_pred"] == label or np.sort(all_)[-1] - np.sort(all_)[-2] < 1e-4
    assert looked > 100
