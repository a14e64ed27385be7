"""Exact tokenization through a memo of pieces, over the bytes of whole Arrow columns.

A byte-pair tokenizer encodes every pre-token on its own. A step from a non-space character to ASCII white space, or
from a letter to an ASCII sign or digit, always ends a pre-token of the supported vocabularies. Such steps are safe
boundaries: cutting there and joining the ids of the cuts gives exactly the ids of the whole text. numpy finds all
boundaries of a column's buffer at once, Arrow numbers the distinct pieces, the tokenizers library encodes those that
a worker has not met, and the ids of all texts are gathered from the memo.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

BLANK, LETTER, SIGN, OTHER = range(4)
KIND = np.full(256, OTHER, "u1")
KIND[:128] = SIGN
KIND[[*range(9, 14), 32]] = BLANK
KIND[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] = LETTER
#: White space of more than one byte, by code point (the Unicode property White_Space).
WIDE_BLANKS = np.array([0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000])
BLANKS = b"\t\n\v\f\r "
#: What folding makes of ASCII: small letters, and one kind of space.
FOLD = np.arange(256, dtype="u1")
FOLD[range(0x41, 0x5B)] += 32
FOLD[[*range(9, 14)]] = 32
#: Pieces that a library call may take side by side: white space first and none at the end.
CHAINED = re.compile(rb"[\t-\r ].*[^\t-\r \x80-\xff]|[\t-\r ].*\xc3[\x80-\xbf]", re.DOTALL)
PLAIN = re.compile(rb"(?:[\x00-\x7f]|\xc3[\x80-\xbf])*")

#: The bits of a word's first 0 to 8 bytes.
MASK = np.array([(1 << 8 * n) - 1 for n in range(9)], "u8")

_ENCODERS: dict[str, "PieceEncoder"] = {}


def vocabulary(name: str) -> str:
    """The place of a public vocabulary file on this machine; the files are never copied."""
    import public_tokenizers

    return public_tokenizers.path(name)


def column_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """A string column's UTF-8 bytes in one array, and where each text starts and the last one ends. Nulls are empty."""
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_string())
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, "i8")[column.offset : column.offset + len(column) + 1] if len(column) else np.zeros(1, "i8")
    raw = np.frombuffer(data, "u1")[at[0] : at[-1]] if data is not None and at[-1] > at[0] else np.zeros(0, "u1")
    return raw, at - at[0]


def byte_balanced(column: pa.Array, batch_bytes: int) -> Iterator[slice]:
    """Row ranges of about batch_bytes UTF-8 bytes each; a longer text is a range of its own."""
    at = column_bytes(column)[1]
    start = 0
    while start < len(column):
        end = int(np.searchsorted(at, at[start] + batch_bytes, side="right")) - 1
        end = min(len(column), max(end, start + 1))
        yield slice(start, end)
        start = end


class Memo:
    """Distinct pieces with their ids: a hash table of rows (first eight bytes, next eight, number + 1) that numpy probes for many pieces at once.

    Pieces of over sixteen bytes, or with a zero byte, are kept in a dict. Keys are the pieces themselves, so nothing can be mistaken.
    """

    BITS, SHORT, LIMIT = 21, 16, 1_200_000

    def __init__(self) -> None:
        self.table = np.zeros((1 << self.BITS, 3), "u8")
        self.clear()

    def clear(self) -> None:
        self.table[:] = 0
        self.long: dict[bytes, int] = {}
        self.long_bytes = 0
        self.n, self.ends, self.ids = 0, np.zeros(1 << 16, "i8"), np.zeros(1 << 18, "u4")

    def add(self, ids: np.ndarray, lengths: np.ndarray) -> None:
        m, n = int(self.ends[self.n]), self.n + len(lengths)
        if n + 1 > len(self.ends):
            self.ends = np.resize(self.ends, 2 * n + 2)
        if m + len(ids) > len(self.ids):
            self.ids = np.resize(self.ids, 2 * (m + len(ids)))
        self.ends[self.n + 1 : n + 1] = m + np.cumsum(lengths)
        self.ids[m : m + len(ids)] = ids
        self.n = n

    def lengths(self, numbers: np.ndarray) -> np.ndarray:
        return self.ends[numbers + 1] - self.ends[numbers]

    def gather(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all pieces in order, and how many each has."""
        starts = self.ends[numbers]
        lengths = self.ends[numbers + 1] - starts
        before = np.cumsum(lengths) - lengths
        return self.ids[np.repeat(starts - before, lengths) + np.arange(int(lengths.sum()))], lengths

    def numbers(self, data: bytes, starts: np.ndarray, lengths: np.ndarray, learn) -> np.ndarray:
        """The number of each piece data[start : start + length]; `learn` gives the ids of those not met before. data has 16 spare bytes."""
        if self.n > self.LIMIT or self.long_bytes > 16 << 20:
            self.clear()
        words = np.ndarray(len(data) - 7, "<u8", data, strides=(1,))
        short = lengths <= self.SHORT
        if b"\0" in data[:-16]:
            zeros = np.append(0, np.cumsum(np.frombuffer(data, "u1") == 0))
            short &= zeros[starts + lengths] == zeros[starts]
        out = np.empty(len(starts), "i8")
        every = short.all()
        at, size = (starts, lengths) if every else (starts[short], lengths[short])
        key = np.empty((len(at), 3), "u8")
        key[:, 0] = words[at] & MASK[np.minimum(size, 8)]
        key[:, 1] = words[at + 8] & MASK[np.maximum(size - 8, 0)]
        key[:, 2] = 1 << 63  # seen, but not numbered yet
        h = key[:, 0] * np.uint64(0x9E3779B97F4A7C15) ^ key[:, 1] * np.uint64(0xC2B2AE3D27D4EB4F)
        h ^= h >> np.uint64(29)
        h *= np.uint64(0xBF58476D1CE4E5B9)
        place = (h >> np.uint64(64 - self.BITS)).astype("i8")
        open_ = np.arange(len(at))
        while len(open_):
            here = place[open_]
            rows = self.table[here]
            empty = rows[:, 2] == 0
            if empty.any():
                mine = open_[empty]
                self.table[here[empty]] = key[mine]  # the last of several wins the place
                rows[empty] = self.table[here[empty]]
            other = (rows[:, 0] != key[open_, 0]) | (rows[:, 1] != key[open_, 1])
            open_ = open_[other]
            place[open_] = (place[open_] + 1) & ((1 << self.BITS) - 1)
        found = self.table[place, 2]
        new = np.flatnonzero(found == 1 << 63)
        if len(new):
            spots, first = np.unique(place[new], return_index=True)
            first = new[first]
            self.table[spots, 2] = np.arange(self.n + 1, self.n + 1 + len(spots), dtype="u8")
            try:
                self.add(*learn([data[a : a + n] for a, n in zip(at[first].tolist(), size[first].tolist())]))
            except BaseException:
                self.clear()
                raise
            found = self.table[place, 2]
        if every:
            return found.astype("i8") - 1
        out[short] = found.astype("i8") - 1
        spelled = [data[a : a + n] for a, n in zip(starts[~short].tolist(), lengths[~short].tolist())]
        lost = [p for p in dict.fromkeys(spelled) if p not in self.long]
        if lost:
            numbered = range(self.n, self.n + len(lost))
            self.add(*learn(lost))
            self.long.update(zip(lost, numbered))
            self.long_bytes += sum(map(len, lost))
        out[~short] = [self.long[p] for p in spelled]
        return out


class PieceEncoder:
    """Encodes columns of texts with a tokenizers file.

    No begin, end or added special tokens, no truncation, no padding. A special string inside a text becomes its
    special id, which is the library's default. A null text counts as the empty one. The memo is emptied when full,
    which bounds memory at some 100 MB and changes nothing else. Texts of any length are taken in windows of
    `window_bytes` that end at boundaries; only a longer stretch without any boundary is encoded in one go.
    """

    def __init__(self, path: str, window_bytes: int = 4 << 20):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.no_padding()
        self.library.no_truncation()
        special = [t.content for t in self.library.get_added_tokens_decoder().values()]
        if any(not re.search("[A-Za-z][^A-Za-z\\s\x80-\U0010ffff]", s) for s in special):
            raise ValueError("a special string without a boundary inside can't be told from text")
        self.special = re.compile(b"|".join(re.escape(s.encode()) for s in sorted(special, key=len, reverse=True))) if special else None
        model = json.loads(self.library.to_str())
        normalizer = json.dumps(model["normalizer"])
        self.folds = '"Lowercase"' in normalizer and "\\\\s+" in normalizer  # case and kind of space make no difference, and spaces give no ids
        end = model["model"].get("end_of_word_suffix") or ""
        tokens = {i: t for t, i in self.library.get_vocab().items()}
        self.width = np.array([len(tokens.get(i, "").removesuffix(end) if end else tokens.get(i, "")) for i in range(max(tokens) + 1)], "i8")  # bytes of each id
        self.memo, self.window_bytes = Memo(), window_bytes

    def _boundaries(self, raw: np.ndarray) -> np.ndarray:
        """Whether a piece may start at each byte."""
        cut = np.zeros(len(raw), bool)
        for low in range(0, len(raw), 1 << 19):  # blocks that stay in the processor's cache
            start = max(0, low - 3)
            b = raw[start : low + (1 << 19)]
            kind = KIND[b]
            if int(b.max()) > 127:
                two = np.flatnonzero(b[:-1] == 0xC3) + 1
                kind[two[(b[two] != 0x97) & (b[two] != 0xB7)]] = LETTER  # Latin-1 letters
                for lead, size in ((0xC2, 2), (0xE1, 3), (0xE2, 3), (0xE3, 3)):
                    at = np.flatnonzero(b[: len(b) - size + 1] == lead)
                    if len(at):
                        point = (b[at + 1].astype("i4") & 63) if size == 2 else ((b[at].astype("i4") & 15) << 12 | (b[at + 1].astype("i4") & 63) << 6 | (b[at + 2].astype("i4") & 63))
                        kind[at[np.isin(point | (0x80 if size == 2 else 0), WIDE_BLANKS)] + size - 1] = BLANK
            before, here = kind[:-1], KIND[b[1:]]  # a wide blank has no cut before it
            found = (here == BLANK) & (before != BLANK)
            found |= (here == SIGN) & (before == LETTER)
            cut[start + 1 : start + len(b)] |= found
        if self.special is not None and b"|" in (text := raw.tobytes()):
            for m in self.special.finditer(text):
                cut[m.start() + 1 : m.end()] = False
                cut[m.start()] = True
                if m.end() < len(cut):
                    cut[m.end()] = True
        return cut

    def _folded(self, raw: np.ndarray) -> np.ndarray:
        codes = FOLD[raw]
        two = np.flatnonzero(raw[:-1] == 0xC3) + 1
        codes[two[(raw[two] >= 0x80) & (raw[two] <= 0x9E) & (raw[two] != 0x97)]] += 32
        return codes

    def _learn(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of distinct pieces in order, and how many each has: runs of plain pieces in one text each, told apart by the bytes of their ids."""
        plain = [i for i, p in enumerate(pieces) if len(p) < 256 and CHAINED.fullmatch(p) and (not self.folds or PLAIN.fullmatch(p))]
        chosen = [pieces[i] for i in plain]
        sizes = np.array([len(p.translate(None, BLANKS)) for p in chosen] if self.folds else list(map(len, chosen)), "i8")
        where, single = np.array(plain, "i8"), np.ones(len(pieces), bool)
        order, ids, lengths = [], [], []
        runs = [slice(i, i + 256) for i in range(0, len(plain), 256)]
        for run, e in zip(runs, self.library.encode_batch_fast([b"".join(chosen[r]).decode() for r in runs], add_special_tokens=False)):
            got = np.array(e.ids, "u4")
            ends, due = np.cumsum(self.width[got]), np.cumsum(sizes[run])
            stop = np.searchsorted(ends, due, side="right")
            if len(ends) and ends[-1] == due[-1] and (stop > 0).all() and (ends[stop - 1] == due).all():
                single[where[run]] = False
                order.append(where[run])
                ids.append(got)
                lengths.append(np.diff(stop, prepend=0))
        alone = np.flatnonzero(single)
        for e in self.library.encode_batch_fast([pieces[i].decode() for i in alone.tolist()], add_special_tokens=False):
            ids.append(np.array(e.ids, "u4"))
            lengths.append(np.array([len(e.ids)]))
        flat, n, order = np.concatenate(ids), np.concatenate(lengths), np.concatenate([*order, alone])
        starts, back = np.cumsum(n) - n, np.argsort(order)
        n, starts = n[back], starts[back]
        return flat[np.repeat(starts - (np.cumsum(n) - n), n) + np.arange(len(flat))], n

    def _windows(self, column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(numbers of the pieces in order, their starts) in windows."""
        raw, at = column_bytes(column)
        if not len(raw):
            return
        codes = self._folded(raw) if self.folds else raw
        cut = self._boundaries(raw)
        cut[at[:-1][at[:-1] < len(raw)]] = True
        bounds = np.append(np.flatnonzero(cut), len(raw))
        first = 0
        while first < len(bounds) - 1:
            last = int(np.searchsorted(bounds, bounds[first] + self.window_bytes, side="right")) - 1
            last = min(len(bounds) - 1, max(first + 1, last), first + 200_000)
            part = bounds[first : last + 1]
            data = codes[part[0] : part[-1]].tobytes() + bytes(16)
            yield self.memo.numbers(data, part[:-1] - part[0], np.diff(part), self._learn), part[:-1]
            first = last

    @staticmethod
    def _add_counts(total: np.ndarray, at: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> None:
        """Adds the ids of a window's pieces to their texts' totals."""
        before = np.concatenate([[0], np.cumsum(lengths)])
        low = int(np.searchsorted(at, starts[0], side="right")) - 1  # the text that the window starts in
        high = int(np.searchsorted(at, starts[-1], side="right"))
        edge = np.searchsorted(starts, at[low : high + 1])
        edge[0], edge[-1] = 0, len(starts)
        total[low:high] += np.diff(before[edge])

    def count(self, column: pa.Array) -> np.ndarray:
        """How many ids each text has."""
        at, total = column_bytes(column)[1], np.zeros(len(column), "i8")
        for numbers, starts in self._windows(column):
            self._add_counts(total, at, starts, self.memo.lengths(numbers))
        return total

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts in one array, and where each text's ids start and the last one's end."""
        at, total, found = column_bytes(column)[1], np.zeros(len(column), "i8"), [np.zeros(0, "u4")]
        for numbers, starts in self._windows(column):
            ids, lengths = self.memo.gather(numbers)
            found.append(ids)
            self._add_counts(total, at, starts, lengths)
        return np.concatenate(found), np.concatenate([[0], np.cumsum(total)])

    def encode_batch(self, texts: list[str | None]) -> list[bytes]:
        """The ids of each text as little-endian unsigned 32-bit integers."""
        ids, at = self.encode(pa.array(texts, pa.large_string()))
        raw = ids.astype("<u4").tobytes()
        return [raw[4 * a : 4 * b] for a, b in zip(at[:-1].tolist(), at[1:].tolist())]


def encoder(path: str) -> PieceEncoder:
    """One encoder in a Python worker; it outlives the task, so its memo is used again by tasks of the same vocabulary."""
    if path not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[path] = PieceEncoder(path)
    return _ENCODERS[path]
