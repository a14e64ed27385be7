"""Line dedup by a segment-partition edit join.

A line is cut into threshold + 1 segments. If two lines are within the threshold of edits, one of the shorter
line's segments stands in the longer one, near its own place. So each line enters an index of its segments by
length and position, and probes the indexes of its own and slightly smaller lengths with the substrings that can
match. Lines that meet under a signature are verified by banded bit-parallel edit distance, many pairs at once in
numpy. Signatures are shuffled as pairs of integers; texts only of lines that met another. A signature shared by
many lines is verified in tiles, and each tile gives a spanning forest of its links, never all pairs.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimloom.llm.common import add_columns, dropped, kept, map_arrow, set_aside, sifted, table
from claimloom.llm.simhash import components, forest

EDITS, LEAST_CHARS = 2, 20
PAD = 0x110000  # no character has this code


def segments(length: int, edits: int) -> list[tuple[int, int]]:
    """(start, size) of the edits + 1 segments of a line of `length`: near-even, longer ones last."""
    n = edits + 1
    small, longer = divmod(length, n)
    out, at = [], 0
    for i in range(n):
        size = small + (i >= n - longer)
        out.append((at, size))
        at += size
    return out


def places(length: int, edits: int) -> list[tuple[int, int, int, int]]:
    """(indexed length, segment, start, size) of every probe of a line, its own segments included.

    A start is kept if both the edits left of the segment and those right of it can still be within the threshold.
    """
    out = []
    for d in range(min(edits, length - edits - 1) + 1):
        for i, (p, size) in enumerate(segments(length - d, edits)):
            low = max(0, p - i, p + d - (edits - i))
            high = min(length - size, p + i, p + d + (edits - i))
            out += [(length - d, i, s, size) for s in range(low, high + 1)]
    return out


def line_ids(lines: list[str]) -> np.ndarray:
    """The lines' names: XXH64 but for its lowest bit, which is free for a mark."""
    import xxhash

    return np.array([xxhash.xxh64_intdigest(x.encode(), 42) for x in lines], "u8").view("i8") & ~1


def line_checks(lines: list[str]) -> np.ndarray:
    """A second hash of each line, so that equal lines are told by 127 bits."""
    import xxhash

    return np.array([xxhash.xxh64_intdigest(x.encode(), 43) for x in lines], "u8").view("i8")


def signatures(lines: list[str], edits: int, known: dict[int, tuple[list, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """(signatures, lines): XXH64 of each probed substring, seeded by length and segment; a line's lowest bit marks its own segments.

    `known` keeps the probes of each length from call to call.
    """
    import xxhash

    digest = xxhash.xxh64_intdigest
    sigs: list[int] = []
    counts, marks = [], []
    for line in lines:
        n = len(line)
        if n not in known:
            if len(known) > 20_000:
                known.clear()
            own = {(n, i, *s) for i, s in enumerate(segments(n, edits))}
            probes = places(n, edits)
            known[n] = [(start, start + size, length * 16 + i) for length, i, start, size in probes], np.array([p in own for p in probes])
        probes, own_marks = known[n]
        raw = line.encode()
        if len(raw) == n:  # one byte a character
            sigs += [digest(raw[a:b], seed) for a, b, seed in probes]
        else:
            sigs += [digest(line[a:b].encode(), seed) for a, b, seed in probes]
        counts.append(len(probes))
        marks.append(own_marks)
    own = np.concatenate(marks) if marks else np.zeros(0, bool)
    return np.array(sigs, "u8").view("i8"), np.repeat(line_ids(lines), counts) | own


def within(codes: np.ndarray, starts: np.ndarray, lengths: np.ndarray, a: np.ndarray, b: np.ndarray, edits: int) -> np.ndarray:
    """Whether lines a[i] and b[i] are within `edits` edits, for all pairs at once.

    Bit-parallel columns of a band along the diagonal: a pair's band is one machine word, moved down one row with
    each character. Pairs that can no longer end within the threshold leave early. codes holds all lines, each
    followed and preceded by padding.
    """
    band = next(w for w in (8, 16, 32, 64) if w >= 2 * edits + 2)
    word = np.dtype(f"u{band // 8}")
    swap = lengths[a] < lengths[b]
    a, b = np.where(swap, b, a), np.where(swap, a, b)  # a is the longer
    m, n = lengths[a], lengths[b]
    ok = np.zeros(len(a), bool)
    live = np.flatnonzero(m - n <= edits)
    one = word.type(1)
    vp = np.full(len(live), ((1 << (edits + 1)) - 1) << (band - edits - 1), word)
    vn = np.zeros(len(live), word)
    far = np.full(len(live), edits, "i4")
    base_a, base_b, m, n = starts[a[live]], starts[b[live]], m[live], n[live]
    offsets = np.arange(band) + edits + 1 - band
    i = 0
    while len(live):
        done = n == i
        if done.any():
            ok[live[done & (far <= edits)]] = True
        alive = ~done & (far <= edits + n - (m - edits))
        if not alive.all():
            live, vp, vn, far, base_a, base_b, m, n = (x[alive] for x in (live, vp, vn, far, base_a, base_b, m, n))
            if not len(live):
                break
        at = base_a[:, None] + (i + offsets)[None, :]
        np.clip(at, 0, len(codes) - 1, out=at)
        same = codes[at] == codes[base_b + i][:, None]
        same &= (i + offsets)[None, :] >= 0
        eq = np.packbits(same, axis=1, bitorder="little").view(word)[:, 0]
        d0 = (((eq & vp) + vp) ^ vp) | eq | vn
        hp = vn | ~(d0 | vp)
        hn = d0 & vp
        down = m - edits > i  # still along the diagonal, later along the last row
        top = (d0 >> word.type(band - 1)) & one
        shift = np.clip(band - 2 - (i - (m - edits)), 0, band - 1).astype(word)
        far += np.where(down, 1 - top.astype("i4"), ((hp >> shift) & one).astype("i4") - ((hn >> shift) & one).astype("i4"))
        vp = hn | ~((d0 >> one) | hp)
        vn = (d0 >> one) & hp
        i += 1
    return ok


def _verified(edits: int, chunk: int = 1 << 15):
    """Links (a, b) among rows (grp, line, own, text) that arrive sorted by grp and line."""

    def links(grp: list[int], line: list[int], own: list[bool], text: list[str]) -> pa.RecordBatch | None:
        nodes = {}
        for k, t in zip(line, text):
            nodes.setdefault(k, t)
        idents = np.array(sorted(nodes), "i8")
        texts = [nodes[k] for k in idents.tolist()]
        lengths = np.array([len(t) for t in texts], "i8")
        raw = [np.frombuffer(t.encode("utf-32-le", "surrogatepass"), "<u4") for t in texts]
        gap = np.full(80, PAD, "<u4")
        codes = np.concatenate([x for r in raw for x in (gap, r)] + [gap])
        starts = np.cumsum(lengths + 80) - lengths
        at, g, o = np.searchsorted(idents, np.array(line, "i8")), np.array(grp, "i8"), np.array(own, bool)
        bounds = np.concatenate([[0], np.flatnonzero(np.diff(g)) + 1, [len(g)]])
        root = np.arange(len(idents))
        left, right, held = [], [], 0

        def flush() -> None:
            nonlocal root, left, right, held
            if left:
                x, y = np.concatenate(left), np.concatenate(right)
                low, high = np.minimum(x, y), np.maximum(x, y)
                pair = np.unique(low * len(idents) + high)
                x, y = pair // len(idents), pair % len(idents)
                open_ = root[x] != root[y]  # joined already: no need to look
                x, y = x[open_], y[open_]
                ok = within(codes, starts, lengths, x, y, edits)
                root = forest(len(idents), np.concatenate([x[ok], np.arange(len(root))]), np.concatenate([y[ok], root]))
            left, right, held = [], [], 0

        for s, e in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
            for i in range(s, e):
                x, mine = at[i], o[i]
                other, theirs = at[i + 1 : e], o[i + 1 : e]
                keep = (other != x) & (theirs | mine) & (abs(lengths[other] - lengths[x]) <= edits)
                if keep.any():
                    right.append(other[keep])
                    left.append(np.full(len(right[-1]), x))
                    held += len(right[-1])
                    if held >= chunk:
                        flush()
        flush()
        child = np.flatnonzero(root != np.arange(len(root)))
        if not len(child):
            return None
        return pa.RecordBatch.from_arrays([pa.array(idents[child]), pa.array(idents[root[child]])], names=["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list] = [[], [], [], []]
        size = 0
        for batch in batches:
            cols = [batch.column(c).to_pylist() for c in ("grp", "line", "own", "text")]
            for i in range(batch.num_rows):
                if held[0] and size > 4_000_000 and cols[0][i] != held[0][-1]:
                    if (out := links(*held)) is not None:
                        yield out
                    held, size = [[], [], [], []], 0
                for h, c in zip(held, cols):
                    h.append(c[i])
                size += len(cols[3][i]) + 100
        if held[0] and (out := links(*held)) is not None:
            yield out

    return run


def _takes_part(line: str, least: int, short: bool) -> bool:
    return len(line) >= least or short and bool(line.strip())


def _compared(text: str | None, least: int, short: bool = False) -> list[tuple[int, str]]:
    """(number, line) of the lines of a text that are long enough to be compared; with `short` of all that aren't blank, too."""
    return [(i, x) for i, x in enumerate((text or "").split("\n")) if _takes_part(x, least, short)]


def _met(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows sorted by (sig, line) those whose signature two or more lines have; repeated rows once.

    Rows are streamed: between batches only one row is kept, however many lines a signature has.
    """
    last: tuple[int, int, int] | None = None  # signature, line and mark of the row that is still open
    met = False  # whether that row's signature has had another line

    for batch in batches:
        sig, line = (batch.column(c).to_numpy() for c in ("sig", "line"))
        if not len(sig):
            continue
        if last is not None:
            sig, line = np.append(last[0], sig), np.append(last[1] | last[2], line)
        name = line & ~1
        first = np.flatnonzero(np.concatenate([[True], (sig[1:] != sig[:-1]) | (name[1:] != name[:-1])]))
        own = np.maximum.reduceat(line & 1, first)
        sig, name = sig[first], name[first]
        same = sig[1:] == sig[:-1]
        keep = np.concatenate([[met], same]) | np.concatenate([same, [False]])
        keep[-1] = False  # the last row stays open: more of it, or of its signature, may follow
        last, met = (int(sig[-1]), int(name[-1]), int(own[-1])), bool(same[-1]) if len(same) else met
        yield pa.RecordBatch.from_arrays([pa.array(sig[keep]), pa.array(name[keep]), pa.array(own[keep] > 0)], names=["sig", "line", "own"])
    if last is not None and met:
        yield pa.RecordBatch.from_arrays([pa.array([last[0]], pa.int64()), pa.array([last[1]], pa.int64()), pa.array([last[2] > 0])], names=["sig", "line", "own"])


def line_links(docs: DataFrame, text_col: str = "text", edits: int = EDITS, least: int = LEAST_CHARS, tile_rows: int = 1024, tile_chars: int = 2_000_000) -> DataFrame:
    """A spanning set (a, b) of the near-copy links among distinct lines, named by their 64-bit hashes."""

    def fresh(seen: set[int], texts: list) -> Iterator[str]:
        for t in texts:
            for _, x in _compared(t, least):
                k = hash(x)
                if k not in seen:  # a line met before in this task; the set is emptied when large, which only repeats work
                    if len(seen) > 300_000:
                        seen.clear()
                    seen.add(k)
                    yield x

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        known: dict = {}
        for batch in batches:
            for i in range(0, batch.num_rows, 256):
                sig, line = signatures(list(fresh(seen, batch.column(0)[i : i + 256].to_pylist())), edits, known)
                yield pa.RecordBatch.from_arrays([pa.array(sig), pa.array(line)], names=["sig", "line"])

    def spell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            for i in range(0, batch.num_rows, 256):
                lines = list(fresh(seen, batch.column(0)[i : i + 256].to_pylist()))
                yield pa.RecordBatch.from_arrays([pa.array(line_ids(lines)), pa.array(lines, pa.string())], names=["line", "text"])

    texts = docs.select(F.col(text_col).cast("string").alias("text"))
    rows = texts.transform(map_arrow, sign, "sig long, line long")
    met = kept(rows.repartition("sig").sortWithinPartitions("sig", "line").transform(map_arrow, _met, "sig long, line long, own boolean"), "met")
    wanted = kept(met.select("line").distinct(), "wanted")
    spelled = kept(sifted(texts.transform(map_arrow, spell, "line long, text string"), "line", wanted).join(wanted, "line").dropDuplicates(["line"]), "spelled")
    dropped(wanted)
    sized = met.join(spelled.select("line", F.length("text").alias("length")), "line")
    # A table, so that the join below has nothing but two exchanges under it and a heavy signature can be split.
    sizes = kept(sized.groupBy("sig").agg(F.count("*").alias("n"), F.max("length").alias("longest"), F.max("own").alias("any")).where("n > 1 and any").drop("any"), "sizes")
    cut = F.greatest(F.ceil(F.col("n") / tile_rows), F.ceil(F.col("n") * F.col("longest") / tile_chars)).cast("int")
    tiled = met.join(sizes, "sig").withColumn("cut", F.least(cut, F.col("n").cast("int"))).withColumn("tile", F.pmod(F.xxhash64("line", F.lit(1)), F.col("cut")).cast("int"))
    paired = tiled.select("sig", "line", "own", "tile", F.explode(F.sequence(F.lit(0), F.col("cut") - 1)).alias("other"))
    grouped = paired.select(F.xxhash64("sig", F.least("tile", "other"), F.greatest("tile", "other")).alias("grp"), "line", "own")
    full = grouped.join(spelled, "line")
    return full.repartition("grp").sortWithinPartitions("grp", "line").transform(map_arrow, _verified(edits), "a long, b long").distinct()


def mark_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", edits: int = EDITS, least: int = LEAST_CHARS, short: bool = False, **how) -> DataFrame:
    """(doc_id, line_no, line, class_id) of each compared line that repeats an earlier one: equal, or within `edits` edits of it or of a line linked to it.

    Earlier means a smaller (doc_id, line number); class_id is the smallest line hash of the class, line the line's
    own. Lines under `least` characters are compared only with `short`, and repeat only equal ones. Rows without an
    id take no part: they neither repeat nor link others.
    """
    docs = docs.where(F.col(id_col).cast("long").isNotNull())
    group = components(line_links(docs, text_col, edits, least, **how))

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, numbers, lines = [], [], []
            for d, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                for k, x in _compared(t, least, short):
                    ids.append(d)
                    numbers.append(k)
                    lines.append(x)
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(numbers, pa.int32()), pa.array(line_ids(lines)), pa.array(line_checks(lines))], names=["doc_id", "line_no", "line", "check"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    lines = rows.transform(map_arrow, split, "doc_id long, line_no int, line long, check long")
    apart = F.when(F.col("root").isNull(), F.col("check")).otherwise(0)  # lines without a link are told apart by both hashes
    classed = lines.join(group, lines["line"] == group["node"], "left").select("doc_id", "line_no", "line", F.coalesce("root", "line").alias("class_id"), apart.alias("check"))
    classed = kept(classed, "lines")
    # A table again: the join by class can then split a class that many lines have.
    first = kept(classed.groupBy("class_id", "check").agg(F.min(F.struct("doc_id", "line_no")).alias("first"), F.count("*").alias("n")).where("n > 1").drop("n"), "firsts")
    return classed.join(first, ["class_id", "check"]).where(F.struct("doc_id", "line_no") != F.col("first")).select("doc_id", "line_no", "line", "class_id")


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", edits: int = EDITS, least: int = LEAST_CHARS, short: bool = False, **how) -> DataFrame:
    """docs with repeated lines taken out of the text, and n_lines, n_dropped, chars_compared, chars_dropped and share_dropped.

    Lines are what newlines part. Lines under `least` characters are not compared and stay; with `short` those that
    aren't blank are compared for equality, and only short blank lines stay. Of each class of equal or near-equal
    lines the first stays, by document id and line number, also within one document. share_dropped is that of the
    characters of all lines that aren't blank, compared or not. Null texts stay null, with counts of zero. Rows
    without an id keep their text and nothing is compared with them. Rows of one id count as one document: of equal
    lines at the same number all stay or go, and a line goes only where it stands itself. Other columns pass
    through; columns named like an output are replaced, drop_lines__ and drop_id__ are reserved. An empty table
    gives an empty one.
    """
    drops = mark_lines(docs, id_col, text_col, edits, least, short, **how).groupBy("doc_id").agg(F.collect_set(F.struct("line_no", "line")).alias("drop_lines__"))
    joined = docs.join(drops.withColumnRenamed("doc_id", "drop_id__"), F.col(id_col).cast("long") == F.col("drop_id__"), "left").drop("drop_id__")
    types = dict(docs.dtypes)[text_col]

    def start():
        def made(texts, dropped):
            out: list[list] = [[] for _ in range(6)]
            for t, d in zip(texts, dropped):
                lines = t.split("\n") if t is not None else []
                pairs = {(r["line_no"], r["line"]) for r in d or () if r["line_no"] < len(lines)}
                here = list({k for k, _ in pairs})
                gone = {k for k, x in zip(here, line_ids([lines[k] for k in here]).tolist()) if (k, x) in pairs}
                left = [x for k, x in enumerate(lines) if k not in gone]
                full, lost = (sum(len(x) for x in some if x.strip()) for some in (lines, [lines[k] for k in gone]))
                row = ("\n".join(left) if t is not None else None, len(lines), len(gone), sum(len(x) for x in lines if _takes_part(x, least, short)), sum(len(lines[k]) for k in gone), lost / full if full else 0.0)
                for o, v in zip(out, row):
                    o.append(v)
            return out

        return made

    order = [c for c in docs.columns]
    done = add_columns(joined, [text_col, "drop_lines__"], f"{text_col} {types}, n_lines int, n_dropped int, chars_compared long, chars_dropped long, share_dropped double", start)
    extra = ["n_lines", "n_dropped", "chars_compared", "chars_dropped", "share_dropped"]
    return done.select(*(c for c in order if c not in extra), *extra)


def keep_fresh(docs: DataFrame, share: float = 0.8, short: bool = True, **how) -> DataFrame:
    """docs with repeated lines taken out, without the documents that are copies by their lines; columns as they are, whatever their names.

    A document goes if lines with `share` or more of the characters of its lines that aren't blank repeat earlier
    ones. n_chars, if
    there, follows the text.
    """
    moved, back = set_aside(docs, ["n_lines", "n_dropped", "chars_compared", "chars_dropped", "share_dropped", "drop_lines__", "drop_id__"])
    done = dedup_lines(moved, short=short, **how).where((F.col("n_dropped") == 0) | (F.col("share_dropped") < share))
    if "n_chars" in docs.columns:
        done = done.withColumn("n_chars", F.length("text").cast(dict(docs.dtypes)["n_chars"]))
    return back(done)


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every document's lines, short ones included: counts, and the digest of the text."""
    done = dedup_lines(table(spark, sf_dir, "documents"), short=True)
    return done.select("doc_id", "n_lines", "n_dropped", "chars_compared", "chars_dropped", F.sha2(F.encode("text", "UTF-8"), 256).alias("text_sha256"))
