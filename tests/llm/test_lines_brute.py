"""The line query over all documents of the smallest table against pairwise edit distances."""

import hashlib
from collections import defaultdict

import duckdb
import numpy as np

from claimloom.llm.line_dedup import op2_line_dedup

SF = "/root/testdata/sf0.001"


def within_two(a, b):
    """Whether a and b are within two edits: the plain dynamic programme, kept to the diagonals that matter."""
    if abs(len(a) - len(b)) > 2:
        return False
    row = {j: j for j in range(min(len(b), 2) + 1)}
    for i, x in enumerate(a, 1):
        now = {}
        for j in range(max(0, i - 2), min(len(b), i + 2) + 1):
            now[j] = min(row.get(j, 9) + 1, now.get(j - 1, 9) + 1, row.get(j - 1, 9) + (j == 0 or x != b[j - 1])) if j else i
        row = now
    return row[len(b)] <= 2


def classes(lines):
    """line -> the least line of its class, by comparing all pairs whose characters allow it."""
    root = {x: x for x in lines}

    def find(x):
        while root[x] != x:
            x = root[x] = root[root[x]]
        return x

    by = defaultdict(list)
    for x in sorted(lines):
        by[len(x)].append(x)
    bags = {n: np.array([np.bincount([ord(c) % 64 for c in x], minlength=64) for x in group]) for n, group in by.items()}
    for n, group in by.items():
        for m in range(n, n + 3):
            for i, x in enumerate(group):
                others = by.get(m, [])
                if not others:
                    continue
                apart = bags[m] - bags[n][i]
                for j in np.flatnonzero((np.maximum(apart, 0).sum(1) <= 2) & (np.maximum(-apart, 0).sum(1) <= 2)).tolist():
                    y = others[j]
                    if x != y and find(x) != find(y) and within_two(x, y):
                        low, high = sorted((find(x), find(y)))
                        root[high] = low
    return {x: find(x) for x in lines}


def test_every_document_of_the_query(spark):
    docs = duckdb.sql(f"select doc_id, text from '{SF}/documents.parquet' order by doc_id").fetchall()
    long = {x for _, t in docs for x in (t or "").split("\n") if len(x) >= 20}
    of, seen, expected = classes(long), set(), {}
    for doc_id, text in docs:
        lines = (text or "").split("\n") if text is not None else []
        kept, dropped, compared, lost = [], 0, 0, 0
        for x in lines:
            if len(x) < 20 and not x.strip():
                kept.append(x)
                continue
            compared += len(x)
            key = of.get(x, x)
            if key in seen:
                dropped, lost = dropped + 1, lost + len(x)
            else:
                seen.add(key)
                kept.append(x)
        digest = hashlib.sha256("\n".join(kept).encode()).hexdigest() if text is not None else None
        expected[doc_id] = (len(lines), dropped, compared, lost, digest)
    found = {r["doc_id"]: tuple(r)[1:] for r in op2_line_dedup(spark, SF).collect()}
    assert found == expected and sum(v[1] for v in expected.values()) > 50
