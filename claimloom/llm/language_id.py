"""Language identification by a byte convolutional network.

One-hot convolutions of several widths over UTF-8 bytes, max pooling over a fixed-length window, and a softmax,
trained in numpy. A whole text is cut into windows; its probabilities are the windows' means, weighted by bytes.
Convolutions over one-hot bytes are sums of table rows, and for inference the tables of neighbouring bytes are
joined into tables of byte pairs.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from claimloom.llm.common import add_columns, map_arrow, set_aside, table

WINDOW, BATCH = 128, 2048  # bytes of a window, windows of a batch
WIDTHS = (2, 3, 4)
UNKNOWN = "und"
WORD_LIKE = re.compile(r"[^\W\d_]")


class ByteCNN:
    """Weights and the two passes. Windows are uint8 arrays (rows, WINDOW)."""

    def __init__(self, languages: list[str], filters: int = 16, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.languages, self.filters = languages, filters
        self.conv = [rng.normal(0, 0.1, (w, 256, filters)).astype("f4") for w in WIDTHS]
        self.bias = np.zeros(len(WIDTHS) * filters, "f4")
        self.out = rng.normal(0, 0.1, (len(WIDTHS) * filters, len(languages))).astype("f4")
        self.shift = np.zeros(len(languages), "f4")

    def _pooled(self, x: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
        best, where = [], []
        for w, table_ in zip(WIDTHS, self.conv):
            n = x.shape[1] - w + 1
            s = table_[0][x[:, :n]]
            for j in range(1, w):
                s += table_[j][x[:, j : j + n]]
            k = s.argmax(1)
            where.append(k)
            best.append(np.take_along_axis(s, k[:, None], 1)[:, 0])
        return np.concatenate(best, 1) + self.bias, where

    def train(self, x: np.ndarray, y: np.ndarray, epochs: int = 3, batch: int = 128, rate: float = 0.004, seed: int = 7, least_steps: int = 300) -> None:
        """Adam on the cross entropy; max pooling sends a filter's gradient to its best place only. Small samples are gone through more often."""
        epochs = max(epochs, -(-least_steps // max(1, len(x) // batch)))
        rng, step = np.random.default_rng(seed), 0
        params = [*self.conv, self.bias, self.out, self.shift]
        first, second = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
        f = self.filters
        for _ in range(epochs):
            for rows in np.array_split(rng.permutation(len(x)), max(1, len(x) // batch)):
                xb, step = x[rows], step + 1
                pooled, where = self._pooled(xb)
                act = np.maximum(pooled, 0)
                p = softmax(act @ self.out + self.shift)
                p[np.arange(len(rows)), y[rows]] -= 1
                p /= len(rows)
                back = (p @ self.out.T) * (pooled > 0)
                grads = []
                for i, w in enumerate(WIDTHS):
                    g = np.zeros_like(self.conv[i])
                    part = back[:, i * f : (i + 1) * f]
                    for j in range(w):
                        byte = np.take_along_axis(xb, where[i] + j, 1)
                        np.add.at(g[j], (byte, np.arange(f)[None, :]), part)
                    grads.append(g)
                grads += [back.sum(0), act.T @ p, p.sum(0)]
                for q, g, m, v in zip(params, grads, first, second):
                    m += 0.1 * (g - m)
                    v += 0.001 * (g * g - v)
                    q -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)

    def joined(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Tables for inference: all widths by the first pair, then the rest of widths 3 and 4."""
        two, three, four = self.conv
        pair = lambda a, b: (a[:, None, :] + b[None, :, :]).reshape(65536, -1)
        return np.concatenate([pair(two[0], two[1]), pair(three[0], three[1]), pair(four[0], four[1])], 1), three[2], pair(four[2], four[3])

    def scorer(self):
        lead, third, rest = self.joined()
        f = self.filters

        def score(x: np.ndarray, block: int = 128) -> np.ndarray:
            out = []
            for i in range(0, len(x), block):
                b = x[i : i + block]
                pairs = b[:, :-1].astype("u2") << 8 | b[:, 1:]
                s = lead[pairs]
                s[:, :-1, f : 2 * f] += third[b[:, 2:]]
                s[:, :-2, 2 * f :] += rest[pairs[:, 2:]]
                pooled = np.concatenate([s[:, :, :f].max(1), s[:, :-1, f : 2 * f].max(1), s[:, :-2, 2 * f :].max(1)], 1)
                out.append(softmax(np.maximum(pooled + self.bias, 0) @ self.out + self.shift))
            return np.concatenate(out)

        return score


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


def windows(raw: bytes) -> np.ndarray:
    """A text's bytes in rows of WINDOW, the last filled with zeros."""
    rows = max(1, -(-len(raw) // WINDOW))
    return np.frombuffer(raw.ljust(rows * WINDOW, b"\0"), "u1").reshape(rows, WINDOW)


def training_windows(labelled: DataFrame, per_language: int = 700, per_text: int = 4) -> list[tuple[str, bytes]]:
    """A bounded sample for training: about per_language distinct texts of each language, at most per_text windows of each.

    `labelled` has text and lang. Repeats of a text count once, so a text that stands very often neither crowds out
    others nor is learned more often. Texts are chosen by a hash, windows by another, and no cut depends on the order
    of rows: the sample is the same each time. Every label is learned. Bound on the driver: two times per_language x
    per_text windows of 128 bytes for each label; labels are a closed set of names.
    """
    rows = labelled.where("lang is not null and text is not null and trim(text) <> ''").select("text", "lang", F.xxhash64("text").alias("mark"))
    counts = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.approx_count_distinct("mark", 0.02).alias("n")).collect()}
    if not counts:
        return []
    share = F.create_map(*(F.lit(v) for lang, n in sorted(counts.items()) for v in (lang, min(1.0, per_language / max(n, 1)))))
    chance = F.pmod("mark", F.lit(1_000_003)) / 1_000_003.0
    once = rows.where(chance < F.coalesce(share[F.col("lang")], F.lit(0.0))).groupBy("lang", "mark").agg(F.min("text").alias("text"))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(chance, "mark"))  # over some per_language rows a language
    chosen = once.withColumn("rank", rank).where(F.col("rank") <= 2 * per_language).select("text", "lang")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs, parts = [], []
            for text, lang in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                raw = text.encode()
                x = windows(raw)
                for k in np.random.default_rng(zlib.crc32(raw)).permutation(len(x))[:per_text]:
                    langs.append(lang)
                    parts.append(x[k].tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(langs, pa.string()), pa.array(parts, pa.binary())], names=["lang", "bytes"])

    found = chosen.transform(map_arrow, cut, "lang string, bytes binary").collect()
    return sorted((r["lang"], bytes(r["bytes"])) for r in found)


def train(labelled: DataFrame, **sample) -> ByteCNN | None:
    """A network for the languages of `labelled` (text, lang); None if nothing is labelled."""
    found = training_windows(labelled, **sample)
    if not found:
        return None
    languages = sorted({lang for lang, _ in found})
    x = np.frombuffer(b"".join(raw for _, raw in found), "u1").reshape(-1, WINDOW)
    y = np.array([languages.index(lang) for lang, _ in found])
    model = ByteCNN(languages)
    model.train(x, y)
    return model


def predict(df: DataFrame, model: ByteCNN | None, text_col: str = "text") -> DataFrame:
    """df with lang_pred and score (0 to 1), from the whole text alone.

    Null texts and texts without a letter are `und` with score 0, as is every text if there is no model. Long
    texts are scored window by window; nothing is cut off. Windows of many texts go through the network together.
    Scores are rounded to six places; repeated rows get equal answers. Other columns pass through; columns named
    like an output are replaced. An empty table gives an empty one.
    """

    def start():
        score = model.scorer() if model else None

        def made(texts):
            total, sizes = np.zeros((len(texts), len(model.languages) if model else 1)), np.zeros(len(texts))
            held: list[tuple[int, np.ndarray, np.ndarray]] = []
            rows = 0

            def flush() -> None:
                nonlocal rows
                if held:
                    p = score(np.concatenate([x for _, x, _ in held])) * np.concatenate([w for _, _, w in held])[:, None]
                    np.add.at(total, np.repeat([i for i, _, _ in held], [len(x) for _, x, _ in held]), p)
                held.clear()
                rows = 0

            for i, t in enumerate(texts):
                if not score or not t or not any(m.group().isalpha() for m in WORD_LIKE.finditer(t)):
                    continue
                raw = t.encode()
                sizes[i] = len(raw)
                for k in range(0, len(raw), BATCH * WINDOW):
                    x = windows(raw[k : k + BATCH * WINDOW])
                    weight = np.full(len(x), float(WINDOW))
                    weight[-1] = len(raw[k : k + BATCH * WINDOW]) - WINDOW * (len(x) - 1)
                    held.append((i, x, weight))
                    rows += len(x)
                    if rows >= BATCH:
                        flush()
            flush()
            best = total.argmax(1)
            return [[model.languages[b] if n else UNKNOWN for b, n in zip(best.tolist(), sizes.tolist())], [min(1.0, round(float(r[b] / n), 6)) if n else 0.0 for r, b, n in zip(total, best.tolist(), sizes.tolist())]]

        return made

    return add_columns(df, [text_col], "lang_pred string, score double", start)


def held_out(id_col: str = "doc_id"):
    """True for the quarter of documents that no model learns from; rows without an id are in neither part."""
    return F.coalesce(F.pmod(F.crc32(F.encode(F.col(id_col).cast("string"), "UTF-8")), F.lit(4)) == 2, F.lit(False))


def learned(docs: DataFrame) -> ByteCNN | None:
    """The model of the documents that are not held out."""
    return train(docs.where(F.col("doc_id").isNotNull() & ~held_out()))


def keep_known(docs: DataFrame, model: ByteCNN | None, least: float = 0.3) -> DataFrame:
    """docs without those whose language is unknown or scored below `least`; columns as they are, whatever their names."""
    moved, back = set_aside(docs, ["lang_pred", "score"])
    return back(predict(moved, model).where((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= least)))


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every whole text of documents."""
    docs = table(spark, sf_dir, "documents")
    model = learned(docs)
    return predict(docs.select("doc_id", "text", held_out().alias("held_out")), model).select("doc_id", "held_out", "lang_pred", "score")
