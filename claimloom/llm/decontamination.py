"""Benchmark decontamination by SimHash windows.

Each benchmark item is a multiset of word shingles with a 64-bit fingerprint. Every stretch of a document with as
many shingles as an item is a window of that item's size. A multi-index over Hamming blocks gives all items of a
window's size whose fingerprints are within the radius, without loss: if two fingerprints differ in at most
`radius` of 64 bits, one of eight blocks differs in at most radius // 8. Candidates are then verified exactly: the
weighted Jaccard similarity of the two shingle multisets.

Windows that can't reach the similarity are never fingerprinted: the places of an item's shingles in the text vote
for the windows that cover them, and only a window with as many places as the similarity needs is compared with that item.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import combinations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimloom.llm.common import add_columns, set_aside, table
from claimloom.llm.simhash import shingle_hashes

WIDTH, SIMILARITY, RADIUS, BLOCKS = 5, 0.8, 23, 8
#: ASCII signs become spaces; letters were made small before.
SIGNS = bytes(32 if b < 48 or 57 < b < 97 or 122 < b < 128 else b for b in range(256))


def words(text: str | None) -> list[bytes]:
    """A text's words: small letters and digits; ASCII signs and spaces part them."""
    return (text or "").lower().encode().translate(SIGNS).split()


def fingerprints(hashes: np.ndarray, starts: np.ndarray, size: int) -> np.ndarray:
    """The fingerprint of each window hashes[s : s + size], by running sums of bits."""
    bits = np.unpackbits(hashes.view("u1").reshape(-1, 8), axis=1, bitorder="little")
    sums = np.zeros((len(hashes) + 1, 64), "i4")
    np.cumsum(bits, axis=0, dtype="i4", out=sums[1:])
    return np.packbits((sums[starts + size] - sums[starts]) * 2 > size, axis=1, bitorder="little").view("<u8")[:, 0]


class Group:
    """The items of one shingle width and size, with their multi-index."""

    def __init__(self, items: list[tuple[int, np.ndarray]], radius: int):
        self.ids = [i for i, _ in items]
        self.size = len(items[0][1])
        self.bags = [dict(zip(*(v.tolist() for v in np.unique(h, return_counts=True)))) for _, h in items]
        self.prints = np.array([fingerprints(h, np.zeros(1, "i8"), self.size)[0] for _, h in items], "u8")
        self.radius = radius
        unique = [np.unique(h) for _, h in items]
        held, holders = np.concatenate(unique), np.repeat(np.arange(len(items)), list(map(len, unique)))
        order = np.argsort(held, kind="stable")
        self.held, self.holders = held[order], holders[order]  # each item's shingles, in order, and whose they are
        steps = [0] + [sum(1 << b for b in c) for n in range(1, radius // BLOCKS + 1) for c in combinations(range(8), n)]
        self.near = np.zeros((BLOCKS, 256, len(items)), bool)
        for b, row in enumerate(self.prints.view("u1").reshape(-1, 8).T):
            for step in steps:
                self.near[b, row ^ step, np.arange(len(items))] = True

    def candidates(self, prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All (window, item) within the radius."""
        w, i = (x.ravel() for x in np.meshgrid(np.arange(len(prints)), np.arange(len(self.ids)), indexing="ij"))
        keep = self.within(prints, w, i)
        return w[keep], i[keep]

    def within(self, prints: np.ndarray, windows: np.ndarray, items: np.ndarray) -> np.ndarray:
        """Whether each window's fingerprint is within the radius of its item's: by the index of blocks first, then by all bits."""
        bytes_ = prints.view("u1").reshape(-1, 8)
        hit = np.zeros(len(windows), bool)
        for b in range(BLOCKS):
            hit |= self.near[b, bytes_[windows, b], items]
        at = np.flatnonzero(hit)
        hit[at] = np.bitwise_count(prints[windows[at]] ^ self.prints[items[at]]) <= self.radius
        return hit

    def voted(self, h: np.ndarray, anchors: np.ndarray, similarity: float, most: int = 1 << 20) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(starts, items) of the windows of h that hold enough places of an item's shingles, some items at a time.

        anchors are the places of shingles of any item. A window of `size` needs t (size + item's size) / (1 + t) shared
        shingles for the similarity t, and shares no more than it has places; so from the first to the last of that many
        places in a row there must be less than a window.
        """
        size = min(self.size, len(h))
        need = max(1, math.ceil(similarity * (size + self.size) / (1 + similarity) - 1e-9))
        places = anchors[np.argsort(h[anchors], kind="stable")]
        keys, first, counts = np.unique(h[places], return_index=True, return_counts=True)
        low = np.searchsorted(self.held, keys)
        n = np.searchsorted(self.held, keys, side="right") - low
        key = np.repeat(np.arange(len(keys)), n)
        item = self.holders[np.arange(int(n.sum())) + np.repeat(low - (np.cumsum(n) - n), n)]
        votes = np.bincount(item, weights=counts[key], minlength=len(self.ids))
        keep = np.flatnonzero(votes[item] >= need)
        keep = keep[np.argsort(item[keep], kind="stable")]
        item, key = item[keep], key[keep]
        if not len(item):
            return
        bounds = np.concatenate([[0], np.flatnonzero(np.diff(item)) + 1, [len(item)]])
        ahead = np.concatenate([[0], np.cumsum(counts[key])])[bounds]
        at = 0
        while at < len(bounds) - 1:
            to = max(at + 1, int(np.searchsorted(ahead, ahead[at] + most, side="right")) - 1)
            some, at = slice(bounds[at], bounds[to]), to
            c = counts[key[some]]
            whose = np.repeat(item[some], c)
            place = places[np.arange(int(c.sum())) + np.repeat(first[key[some]] - (np.cumsum(c) - c), c)]
            order = np.lexsort((place, whose))
            whose, place = whose[order], place[order]
            i = np.arange(max(0, len(place) - need + 1))
            j = i + need - 1
            close = (whose[i] == whose[j]) & (place[j] - place[i] < size)
            i, j = i[close], j[close]
            begin, end = np.maximum(place[j] - size + 1, 0), np.minimum(place[i], len(h) - size)
            m = np.maximum(end - begin + 1, 0)
            starts = np.arange(int(m.sum())) + np.repeat(begin - (np.cumsum(m) - m), m)
            pair = np.unique(starts * len(self.ids) + np.repeat(whose[i], m))
            yield pair // len(self.ids), pair % len(self.ids)


class Benchmark:
    """Some items of the benchmark, ready to search documents."""

    def __init__(self, items: list[tuple[int | None, str]], width: int = WIDTH, radius: int = RADIUS, similarity: float = SIMILARITY):
        self.similarity = similarity
        by: dict[tuple[int, int], list[tuple[int, np.ndarray]]] = {}
        for ident, text in items:
            w = words(text)
            if w:  # an item without words can't be found
                k = min(width, len(w))
                h = shingle_hashes(w, k)
                by.setdefault((k, len(h)), []).append((ident, h))
        self.groups = {key: Group(found, radius) for key, found in by.items()}
        self.shingles = {k: np.unique(np.concatenate([h for (w, _), found in by.items() if w == k for _, h in found])) for k in {k for k, _ in by}}
        self.sizes: dict[tuple[int, int], set[int]] = {}
        for (k, size), found in by.items():
            for _, h in found:
                for x in h.tolist():
                    self.sizes.setdefault((k, x), set()).add(size)

    def search(self, text: str | None, block_words: int = 1 << 18) -> list[tuple[int | None, float, int, int]]:
        """(item, similarity, first word, words) of the best window of each item found in a whole text."""
        all_words, best = words(text), {}
        for k, known in self.shingles.items():
            over = max(size for kk, size in self.groups if kk == k) + k  # blocks overlap by the longest window
            for at in range(0, max(1, len(all_words)), block_words):
                if at and at + over > len(all_words):  # the block before has reached the end
                    break
                part = all_words[at : at + block_words + over]
                if len(part) < k:
                    continue
                h = shingle_hashes(part, k)
                place = np.searchsorted(known, h)
                anchors = np.flatnonzero(known[np.minimum(place, len(known) - 1)] == h)
                if not len(anchors):
                    continue
                wanted: dict[int, list[int]] = {}
                for a, x in zip(anchors.tolist(), h[anchors].tolist()):
                    for size in self.sizes[k, x]:
                        wanted.setdefault(size, []).append(a)
                for size, anchored in wanted.items():
                    self._windows(self.groups[k, size], h, np.array(anchored), at, k, best)
        return sorted(((i, s, start, n) for i, (s, start, n) in best.items()), key=lambda m: (m[0] is None, m[0] or 0))

    def _windows(self, group: Group, h: np.ndarray, anchors: np.ndarray, at: int, k: int, best: dict) -> None:
        size = min(group.size, len(h))
        for starts, items in group.voted(h, anchors, self.similarity):
            for i in range(0, len(starts), 1 << 14):
                some, mine = starts[i : i + (1 << 14)], items[i : i + (1 << 14)]
                own_starts, window = np.unique(some, return_inverse=True)
                low = int(own_starts[0])
                prints = fingerprints(h[low : int(own_starts[-1]) + size], own_starts - low, size)
                near = group.within(prints, window, mine)
                for start, item in zip(some[near].tolist(), mine[near].tolist()):
                    bag = group.bags[item]
                    own: dict[int, int] = {}
                    for x in h[start : start + size].tolist():
                        own[x] = own.get(x, 0) + 1
                    shared = sum(min(n, bag.get(x, 0)) for x, n in own.items())
                    score = shared / (size + group.size - shared)
                    ident = group.ids[item]
                    if score >= self.similarity and (ident not in best or (score, -start - at) > (best[ident][0], -best[ident][1])):
                        best[ident] = (score, start + at, size + k - 1)


def blocks_of(benchmark: DataFrame, id_col: str, text_col: str, block_bytes: int) -> Iterator[list[tuple[int | None, str]]]:
    """The query set in blocks of bounded size, one at a time on the driver; null texts are left out."""
    held, size = [], 0
    for r in benchmark.where(F.col(text_col).isNotNull()).select(F.col(id_col).cast("long"), text_col).toLocalIterator():
        held.append((r[0], r[1]))
        size += len(r[1])
        if size >= block_bytes:
            yield held
            held, size = [], 0
    if held:
        yield held


MATCH = "array<struct<item_id: bigint, similarity: double, first_word: int, words: int>>"


def find_leaks(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", block_bytes: int = 4 << 20, **how) -> DataFrame:
    """docs with `leaks`: each item found, its best window's similarity, first word and number of words.

    An item is found if a window of its size (the whole text, if that is shorter) has a fingerprint within the
    radius and a weighted similarity of 0.8 or more over shingles of five words. Items of fewer words are one
    shingle and must be there word for word. Null and empty texts, and items without words, give nothing. Items
    of one id count as one, and so do items of a null id: they are searched too and reported with a null item_id. Of equal windows the first is reported. No row of docs moves or is lost; other columns
    pass through, one named leaks is replaced. Benchmarks above block_bytes are searched in as many passes.
    """
    found = docs.withColumn("leaks", F.array().cast(MATCH))
    for items in blocks_of(benchmark, item_col, item_text_col, block_bytes):

        def start(items=items):
            index = Benchmark(items, **how)

            def made(texts):
                return [[[dict(zip(("item_id", "similarity", "first_word", "words"), m)) for m in index.search(t)] for t in texts]]

            return made

        found = add_columns(found, [text_col], f"leaks_here__ {MATCH}", start).withColumn("leaks", F.concat("leaks", "leaks_here__")).drop("leaks_here__")
    return found


def drop_leaks(docs: DataFrame, benchmark: DataFrame, **how) -> DataFrame:
    """docs without those in which an item was found; columns as they are, whatever their names."""
    moved, back = set_aside(docs, ["leaks", "leaks_here__"])
    return back(find_leaks(moved, benchmark, **how).where(F.size("leaks") == 0))


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark items in every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = find_leaks(docs, table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", (F.size("leaks") > 0).alias("contaminated"), F.array_sort(F.transform("leaks", lambda m: m["item_id"])).alias("item_ids"), F.round(F.array_max(F.transform("leaks", lambda m: m["similarity"])), 6).alias("best_similarity"))
