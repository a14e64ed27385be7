"""Progressive JPEG: coefficients gathered over spectral-selection and successive-approximation scans.

The decoder reads any Huffman-coded progressive file of one or three components: it accumulates every scan into
coefficient arrays, inverse-transforms all blocks in numpy, upsamples chroma, and gives a full-resolution RGB tensor.
The encoder stores arbitrary bytes without loss: each byte is one quantised coefficient, 64 to a block, over Y, Cb
and Cr blocks in 4:2:0. Its Huffman tables give a value of s bits a code of 8 - s bits, so every coefficient takes
exactly one byte of a first scan, which numpy reads and writes at once; refining scans hold one bit a coefficient.
Scans coded that way are told by their tables; all others are read symbol by symbol.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimloom.llm.common import map_arrow, new_path, table

#: Row by row positions of the 64 coefficients in the order of the format (a fixed rule: diagonals in turn).
ZIGZAG = np.array(sorted(range(64), key=lambda p: (p // 8 + p % 8, (p // 8 if (p // 8 + p % 8) % 2 else p % 8))))
#: Bytes' coefficients in the AC positions: never of magnitude below 2, so that none is zero in the first scan.
AC_OF_BYTE = np.array([b - 129 if b < 128 else b - 126 for b in range(256)], "i2")
DC_OF_BYTE = np.arange(-128, 128, dtype="i2")
BANDS = ((1, 5), (6, 63))
NAME = b"CLMW"


def _flat_code() -> np.ndarray:
    """The one-byte code of each value -127 to 127 (at v + 127): the size's code, then the value's bits; 0xFF never occurs."""
    code = np.zeros(255, "u1")
    for v in range(-127, 128):
        s = abs(v).bit_length()
        prefix = ((1 << (7 - s)) - 1) << 1  # 7 - s ones and a zero
        bits = v if v >= 0 else v + (1 << s) - 1
        code[v + 127] = (prefix << s | bits) & 0xFF
    return code


FLAT = _flat_code()
UNFLAT = np.full(256, -128, "i2")
UNFLAT[FLAT] = np.arange(-127, 128)
#: Huffman tables (counts of code lengths 1 to 16, symbols): sizes 7 to 0 get codes of 1 to 8 bits.
DC_TABLE = (bytes([1] * 8 + [0] * 8), bytes(range(7, -1, -1)))
AC_TABLE = (bytes([1] * 7 + [0] * 9), bytes(range(7, 0, -1)))
#: For refining scans: 15 runs of end-of-band of up to 2**r blocks, five bits each.
EOB_TABLE = (bytes([0] * 4 + [15] + [0] * 11), bytes(r << 4 for r in range(15)))


def _segment(marker: int, body: bytes) -> bytes:
    return struct.pack(">BBH", 0xFF, marker, len(body) + 2) + body


def _dht(kind: int, ident: int, spec: tuple[bytes, bytes]) -> bytes:
    return _segment(0xC4, bytes([kind << 4 | ident]) + spec[0] + spec[1])


def _stuffed(raw: bytes) -> bytes:
    return raw.replace(b"\xff", b"\xff\x00")


def _scan(component: int, tables: int, start: int, end: int, high: int, low: int, data: bytes) -> bytes:
    return _segment(0xDA, bytes([1, component, tables, start, end, high << 4 | low])) + data


def encode(payload: bytes) -> bytes:
    """A progressive 4:2:0 file that holds payload (a positive multiple of 64 bytes) as its coefficients.

    Y blocks are filled first, then Cb, then Cr; blocks left over hold coefficients of byte 0. An APP9 segment
    names the number of payload blocks.
    """
    blocks = len(payload) // 64
    units = -(-blocks // 6)
    across = min(4095, max(1, int(np.ceil(np.sqrt(units)))))
    down = -(-units // across)
    if down > 4095:
        raise ValueError("a payload of more than 6 * 4095 * 4095 blocks needs more than one image")
    total = 6 * across * down
    data = np.zeros((total, 64), "u1")
    data.reshape(-1)[: len(payload)] = np.frombuffer(payload, "u1")
    values = AC_OF_BYTE[data]
    values[:, 0] = DC_OF_BYTE[data[:, 0]]
    out = [b"\xff\xd8", _segment(0xE9, NAME + struct.pack(">Q", blocks)), _segment(0xDB, bytes([0]) + bytes([1] * 64))]
    out.append(_segment(0xC2, struct.pack(">BHHB", 8, 16 * down, 16 * across, 3) + bytes([1, 0x22, 0, 2, 0x11, 0, 3, 0x11, 0])))
    out += [_dht(0, 0, DC_TABLE), _dht(1, 0, AC_TABLE), _dht(1, 1, EOB_TABLE)]
    y = 4 * across * down
    parts = [(1, values[:y]), (2, values[y : y + across * down]), (3, values[y + across * down :])]
    for c, v in parts:
        first = (v[:, 0] >> 1).astype("i2")
        out.append(_scan(c, 0x00, 0, 0, 0, 1, FLAT[np.diff(first, prepend=np.int16(0)) + 127].tobytes()))
    for a, b in BANDS:
        for c, v in parts:
            band = v[:, a : b + 1]
            out.append(_scan(c, 0x00, a, b, 0, 1, FLAT[np.where(band < 0, -(-band >> 1), band >> 1) + 127].tobytes()))
    for c, v in parts:
        bits = np.packbits((v[:, 0] & 1).astype("u1"))
        if len(v) % 8:  # fill the last byte with ones
            bits[-1] |= (1 << (8 - len(v) % 8)) - 1
        out.append(_scan(c, 0x00, 0, 0, 1, 0, _stuffed(bits.tobytes())))
    for a, b in BANDS:
        for c, v in parts:
            bits = (np.abs(v[:, a : b + 1]) & 1).astype("u1")
            runs, at = [], 0
            while at < len(bits):
                r = min(14, (len(bits) - at).bit_length() - 1)
                n = 1 << r
                # the code for run length 2**r: r as five bits, then r zero bits, then a correcting bit for each coefficient
                runs += [np.array([r >> k & 1 for k in range(4, -1, -1)] + [0] * r, "u1"), bits[at : at + n].reshape(-1)]
                at += n
            joined = np.concatenate(runs)
            joined = np.concatenate([joined, np.ones(-len(joined) % 8, "u1")])
            out.append(_scan(c, 0x01, a, b, 1, 0, _stuffed(np.packbits(joined).tobytes())))
    out.append(b"\xff\xd9")
    return b"".join(out)


@dataclass
class Component:
    ident: int
    across: int  # sampling factors
    down: int
    quant: int
    wide: int = 0  # blocks in the stored array, whole minimum coded units
    high: int = 0
    own_wide: int = 0  # blocks that a scan of this component alone holds
    own_high: int = 0
    coefficients: np.ndarray = field(default_factory=lambda: np.zeros((0, 64), "i4"))


@dataclass
class Image:
    width: int
    height: int
    components: list[Component]
    quant: dict[int, np.ndarray]
    blocks: int | None  # payload blocks, if the file names them


class Bits:
    """Bits of one entropy-coded interval, with the table-driven look-up of codes."""

    def __init__(self, raw: bytes):
        self.raw, self.at, self.held, self.n = raw, 0, 0, 0

    def need(self, n: int) -> None:
        while self.n < n:
            byte = self.raw[self.at] if self.at < len(self.raw) else 0xFF
            self.at += 1
            self.held = (self.held << 8 | byte) & 0xFFFFFFFFFF
            self.n += 8

    def take(self, n: int) -> int:
        if not n:
            return 0
        self.need(n)
        self.n -= n
        return self.held >> self.n & ((1 << n) - 1)

    def symbol(self, codes: dict[tuple[int, int], int]) -> int:
        code = 0
        for length in range(1, 17):
            code = code << 1 | self.take(1)
            if (length, code) in codes:
                return codes[length, code]
        raise ValueError("no such Huffman code")

    def value(self, size: int) -> int:
        v = self.take(size)
        return v if not size or v >> (size - 1) else v - (1 << size) + 1


def _codes(spec: tuple[bytes, bytes]) -> dict[tuple[int, int], int]:
    out, code, k = {}, 0, 0
    for length, n in enumerate(spec[0], 1):
        for _ in range(n):
            out[length, code] = spec[1][k]
            code, k = code + 1, k + 1
        code <<= 1
    return out


def _intervals(raw: bytes, at: int) -> tuple[list[bytes], int]:
    """The intervals of a scan from `at`, without stuffed bytes, and where the next marker stands."""
    out, start = [], at
    while True:
        k = raw.find(b"\xff", at)
        if k < 0 or k + 1 >= len(raw):
            return [*out, raw[start:].replace(b"\xff\x00", b"\xff")], len(raw)
        if raw[k + 1] == 0:
            at = k + 2
        elif raw[k + 1] == 0xFF:
            at = k + 1
        elif 0xD0 <= raw[k + 1] <= 0xD7:
            out.append(raw[start:k].replace(b"\xff\x00", b"\xff"))
            start = at = k + 2
        else:
            return [*out, raw[start:k].replace(b"\xff\x00", b"\xff")], k


def _flat_scan(part: Component, tables: dict, dc: int, ac: int, start: int, end: int, high: int, low: int, data: bytes) -> bool:
    """Reads a scan of one component whose codes are all of one length, at once; False if it isn't such a scan."""
    n = part.own_wide * part.own_high
    if (part.own_wide, part.own_high) != (part.wide, part.high):
        return False
    c = part.coefficients
    if start == 0:
        if high:
            bits = np.unpackbits(np.frombuffer(data, "u1"), count=n)
            c[:, 0] |= bits.astype("i4") << low
            return True
        if tables.get((0, dc)) != DC_TABLE or len(data) < n:
            return False
        c[:, 0] = np.cumsum(UNFLAT[np.frombuffer(data, "u1", n)], dtype="i4") << low
        return True
    width = end - start + 1
    if not high:
        if tables.get((1, ac)) != AC_TABLE or len(data) < n * width:
            return False
        v = UNFLAT[np.frombuffer(data, "u1", n * width)].astype("i4").reshape(n, width)
        if (v == 0).any() or (v == -128).any():
            return False
        c[:, start : end + 1] = v * (1 << low)
        return True
    if tables.get((1, ac)) != EOB_TABLE or not c[:, start : end + 1].all():
        return False
    bits, at, block = np.unpackbits(np.frombuffer(data, "u1")), 0, 0
    while block < n:
        r = int(np.packbits(bits[at : at + 5])[0]) >> 3
        at += 5
        run = 1 << r
        for k in range(r):
            run += int(bits[at + k]) << (r - 1 - k)
        at += r
        run = min(run, n - block)
        band = c[block : block + run, start : end + 1]
        add = bits[at : at + run * width].reshape(run, width).astype("i4") << low
        band += np.where(band < 0, -add, add)
        at, block = at + run * width, block + run
    return True


def _ac_first(bits: Bits, codes: dict, row: np.ndarray, start: int, end: int, low: int, run: int) -> int:
    """One block of a first AC scan; gives how many more blocks of the end-of-band run follow."""
    if run:
        return run - 1
    k = start
    while k <= end:
        rs = bits.symbol(codes)
        r, s = rs >> 4, rs & 15
        if s:
            k += r
            row[k] = bits.value(s) * (1 << low)
            k += 1
        elif r == 15:
            k += 16
        else:
            return (1 << r) + bits.take(r) - 1
    return 0


def _ac_refine(bits: Bits, codes: dict, row: np.ndarray, start: int, end: int, low: int, run: int) -> int:
    """One block of a refining AC scan: coefficients known already get a correcting bit as they are passed."""
    one, k = 1 << low, start

    def correct(k: int) -> None:
        if bits.take(1):
            row[k] += one if row[k] > 0 else -one

    if not run:
        while k <= end:
            rs = bits.symbol(codes)
            r, s = rs >> 4, rs & 15
            new = 0
            if s:
                new = one if bits.take(1) else -one
            elif r < 15:
                run = (1 << r) + bits.take(r)
                break
            while k <= end:
                if row[k]:
                    correct(k)
                elif r:
                    r -= 1
                else:
                    break
                k += 1
            if new and k <= end:
                row[k] = new
            k += 1
    if run:
        for i in range(k, end + 1):
            if row[i]:
                correct(i)
        return run - 1
    return 0


def _coded_scan(image: Image, parts: list[tuple[Component, int, int]], tables: dict, start: int, end: int, high: int, low: int, intervals: list[bytes], restart: int) -> None:
    """Reads any scan symbol by symbol."""
    if len(parts) == 1:
        c = parts[0][0]
        order = [[(0, y * c.wide + x)] for y in range(c.own_high) for x in range(c.own_wide)]
    else:
        units_wide = image.components[0].wide // image.components[0].across
        units_high = image.components[0].high // image.components[0].down
        order = [[(i, (uy * c.down + y) * c.wide + ux * c.across + x) for i, (c, _, _) in enumerate(parts) for y in range(c.down) for x in range(c.across)] for uy in range(units_high) for ux in range(units_wide)]
    codes = {key: _codes(spec) for key, spec in tables.items()}
    step = restart or len(order)
    for data, at in zip(intervals, range(0, len(order), step)):
        bits, last, run = Bits(data), [0] * len(parts), 0
        for unit in order[at : at + step]:
            for i, block in unit:
                c, dc, ac = parts[i]
                row = c.coefficients[block]
                if start == 0:
                    if high:
                        row[0] |= bits.take(1) << low
                    else:
                        last[i] += bits.value(bits.symbol(codes[0, dc]))
                        row[0] = last[i] * (1 << low)
                elif high:
                    run = _ac_refine(bits, codes[1, ac], row, start, end, low, run)
                else:
                    run = _ac_first(bits, codes[1, ac], row, start, end, low, run)


def decode(raw: bytes, flat: bool = True) -> Image:
    """All scans of a progressive file accumulated into its components' coefficient arrays (blocks, 64), in zigzag order.

    flat=False reads every scan symbol by symbol. A file that breaks off keeps what its scans gave so far. Any other
    fault is a ValueError; a frame of more blocks than the file has bits is one, so memory follows the file's length.
    """
    try:
        return _decode(raw, flat)
    except (IndexError, KeyError, OverflowError, TypeError, struct.error) as fault:
        raise ValueError("a broken file") from fault


def _decode(raw: bytes, flat: bool) -> Image:
    if raw[:2] != b"\xff\xd8":
        raise ValueError("no JPEG file")
    at, quant, tables, restart, blocks = 2, {}, {}, 0, None
    image = None
    while at + 4 <= len(raw):
        if raw[at] != 0xFF:
            raise ValueError("no marker where one is due")
        marker = raw[at + 1]
        if marker == 0xFF:
            at += 1
            continue
        if marker == 0xD9:
            break
        length = struct.unpack(">H", raw[at + 2 : at + 4])[0]
        body = raw[at + 4 : at + 2 + length]
        at += 2 + length
        if marker == 0xDB:
            while body:
                wide = body[0] >> 4
                quant[body[0] & 15] = np.frombuffer(body[1 : 65 + 64 * wide], ">u2" if wide else "u1").astype("f4")
                body = body[65 + 64 * wide :]
        elif marker == 0xC4:
            while body:
                n = sum(body[1:17])
                tables[body[0] >> 4, body[0] & 15] = (body[1:17], body[17 : 17 + n])
                body = body[17 + n :]
        elif marker == 0xDD:
            restart = struct.unpack(">H", body)[0]
        elif marker == 0xE9 and body[:4] == NAME:
            blocks = struct.unpack(">Q", body[4:12])[0]
        elif marker in (0xC0, 0xC1, 0xC3, *range(0xC5, 0xC8), *range(0xC9, 0xCC), *range(0xCD, 0xD0)):
            raise ValueError("only Huffman-coded progressive files are read")
        elif marker == 0xC2:
            _, height, width, n = struct.unpack(">BHHB", body[:6])
            parts = [Component(body[6 + 3 * i], body[7 + 3 * i] >> 4, body[7 + 3 * i] & 15, body[8 + 3 * i]) for i in range(n)]
            if n not in (1, 3):
                raise ValueError("files of one or three components are read")
            image = Image(width, height, parts, quant, None)
            most_a, most_d = max(c.across for c in parts), max(c.down for c in parts)
            for c in parts:
                if not most_a or not most_d:
                    raise ValueError("a component without samples")
                c.wide, c.high = -(-width // (8 * most_a)) * c.across, -(-height // (8 * most_d)) * c.down
                c.own_wide, c.own_high = -(-(-(-width * c.across // most_a)) // 8), -(-(-(-height * c.down // most_d)) // 8)
            if not all(c.across and c.down for c in parts) or sum(c.wide * c.high for c in parts) > 8 * len(raw):
                raise ValueError("a frame that the file can't fill")
            for c in parts:
                c.coefficients = np.zeros((c.wide * c.high, 64), "i4")
        elif marker == 0xDA:
            if image is None:
                raise ValueError("a scan before its frame")
            by = {c.ident: c for c in image.components}
            chosen = [(by[body[1 + 2 * i]], body[2 + 2 * i] >> 4, body[2 + 2 * i] & 15) for i in range(body[0])]
            start, end, approx = body[1 + 2 * body[0] : 4 + 2 * body[0]]
            data, at = _intervals(raw, at)
            how = (start, end, approx >> 4, approx & 15)
            c, dc, ac = chosen[0]
            if not (flat and len(chosen) == 1 and len(data) == 1 and _flat_scan(c, tables, dc, ac, *how, data[0])):
                _coded_scan(image, chosen, tables, *how, data, restart)
    if image is None:
        raise ValueError("no frame")
    image.blocks = blocks
    return image


def _basis() -> np.ndarray:
    """The inverse transform of a block as one matrix: 64 coefficients in zigzag order to 64 pixels in rows.

    In multiples of 1/4096: sums of a block's products are then exact in any order, so all machines give equal pixels.
    """
    k, x = np.arange(8)[:, None], np.arange(8)[None, :]
    one = np.where(k == 0, np.sqrt(0.125), 0.5) * np.cos((2 * x + 1) * k * np.pi / 16)  # (frequency, place)
    both = np.einsum("uy,vx->uvyx", one, one).reshape(64, 64)
    return np.round(both[ZIGZAG] * 4096) / 4096


BASIS = _basis()
EXACT = 129  # up to this magnitude 32-bit floats hold every sum


def planes(image: Image) -> list[np.ndarray]:
    """Each component's samples, 0 to 255, at its own resolution. A ValueError if the file lacks a table that a component names."""
    if any(c.quant not in image.quant for c in image.components):
        raise ValueError("a component's quantisation table is missing")
    out = []
    for c in image.components:
        most = max(int(c.coefficients.max(initial=0)), -int(c.coefficients.min(initial=0))) * float(image.quant[c.quant].max())
        kind = "f4" if most <= EXACT else "f8"
        scaled = (BASIS * image.quant[c.quant][:, None]).astype(kind)
        pixels = np.empty((c.wide * c.high, 64), kind)
        for i in range(0, len(pixels), 1 << 14):
            pixels[i : i + (1 << 14)] = c.coefficients[i : i + (1 << 14)].astype(kind) @ scaled
        pixels += 128.5
        np.clip(pixels, 0, 255, out=pixels)
        out.append(pixels.astype("u1").reshape(c.high, c.wide, 8, 8).transpose(0, 2, 1, 3).reshape(c.high * 8, c.wide * 8))
    return out


def rgb(image: Image) -> np.ndarray:
    """The full-resolution tensor (height, width, 3): chroma is repeated to the size of luma."""
    found = planes(image)
    most_a, most_d = max(c.across for c in image.components), max(c.down for c in image.components)
    full = []
    for p, c in zip(found, image.components):
        if (c.across, c.down) != (most_a, most_d):
            p = p.repeat(most_d // c.down, axis=0).repeat(most_a // c.across, axis=1)
        full.append(p[: image.height, : image.width])
    if len(full) == 1:
        return np.stack(full * 3, axis=-1)
    y, cb, cr = (p.astype("i4") for p in full)
    cb -= 128
    cr -= 128
    out = np.empty((image.height, image.width, 3), "u1")  # the format's weights, in 1/65536
    out[:, :, 0] = np.clip(y + ((91881 * cr + 32768) >> 16), 0, 255)
    out[:, :, 1] = np.clip(y - ((22554 * cb + 46802 * cr + 32768) >> 16), 0, 255)
    out[:, :, 2] = np.clip(y + ((116130 * cb + 32768) >> 16), 0, 255)
    return out


BYTE_OF_AC = np.zeros(512, "u1")
BYTE_OF_AC[AC_OF_BYTE + 256] = np.arange(256)


def payload(image: Image) -> bytes:
    """The bytes that `encode` stored, from the coefficients."""
    c = np.concatenate([x.coefficients for x in image.components])[: image.blocks]
    data = BYTE_OF_AC[np.clip(c, -256, 255) + 256]
    data[:, 0] = c[:, 0] + 128
    return data.tobytes()


def padded(text: str | None) -> bytes:
    raw = (text or "").encode()
    return raw.ljust(max(64, -(-len(raw) // 64) * 64), b"\0")


def encode_media(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_bytes and media: each whole text as a progressive file. Null texts are empty; every text has one row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1).to_pylist()
            for i in range(0, len(texts), 64):  # a few files at a time
                part = texts[i : i + 64]
                raw = [len((t or "").encode()) for t in part]
                yield pa.RecordBatch.from_arrays([ids[i : i + 64], pa.array(raw, pa.int64()), pa.array([encode(padded(t)) for t in part], pa.binary())], names=["doc_id", "n_bytes", "media"])

    rows = df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.transform(map_arrow, run, "doc_id long, n_bytes long, media binary")


def decode_media(media: DataFrame, media_col: str = "media") -> DataFrame:
    """width, height, tensor (RGB rows, 8-bit) and payload for each file, beside doc_id. A null or broken file gives nulls."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                raw = batch.column(1)[i].as_py()
                row: list = [None] * 4
                try:
                    if raw:
                        image = decode(raw)
                        row = [image.width, image.height, rgb(image).tobytes(), payload(image) if image.blocks is not None else None]
                except ValueError:
                    row = [None] * 4
                yield pa.RecordBatch.from_arrays([batch.column(0)[i : i + 1], *(pa.array([v], t) for v, t in zip(row, (pa.int32(), pa.int32(), pa.binary(), pa.binary())))], names=["doc_id", "width", "height", "tensor", "payload"])

    return media.select("doc_id", media_col).transform(map_arrow, run, "doc_id long, width int, height int, tensor binary, payload binary")


def write_media(df: DataFrame, out: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The files of encode_media written as a Parquet table at `out`, and the table as it is read back."""
    media = encode_media(df, id_col, text_col)
    media.write.option("compression", "zstd").parquet(out)
    return df.sparkSession.read.schema(media.schema).parquet(out)


def write_tensors(media: DataFrame, out: str) -> DataFrame:
    """The full-resolution tensors of decode_media written as a Parquet table at `out`, and the table as it is read back."""
    tensors = decode_media(media)
    tensors.write.option("compression", "zstd").parquet(out)
    return media.sparkSession.read.schema(tensors.schema).parquet(out)


def digest_media(media: DataFrame) -> DataFrame:
    """What is read back of each file of `encode_media`: digests of the payload and the file, and features of the tensor.

    Equal texts give equal values. The feature string is the image's width and height, the mean of each channel
    and the tensor's crc32. Tensors stay in the worker, one at a time. A null or broken file has nulls, but for the
    digest and size of the file that is there.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cols: list[list] = [[] for _ in range(6)]
            for raw in batch.column(2).to_pylist():
                row: tuple = (None,) * 4
                try:
                    if raw:
                        image = decode(raw)
                        tensor = rgb(image)
                        mean = tensor.reshape(-1, 3).mean(0, dtype="f8")
                        back = payload(image) if image.blocks is not None else None
                        row = (*((len(back), hashlib.sha256(back).hexdigest(), zlib.crc32(back[-64:])) if back is not None else (None,) * 3), f"{image.width}x{image.height}:{mean[0]:.3f},{mean[1]:.3f},{mean[2]:.3f}:{zlib.crc32(tensor):08x}")
                except ValueError:
                    row = (None,) * 4
                own = (len(raw), hashlib.sha256(raw).hexdigest()) if raw is not None else (None, None)
                for c, v in zip(cols, (*row[:3], *own, row[3])):
                    c.append(v)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), *(pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string())))],
                names=["doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature"],
            )

    return media.transform(map_arrow, run, "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string")


def op7_progressive_jpeg(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document stored as a progressive file in a table of the shared folder; the features are of what is read back."""
    return digest_media(write_media(table(spark, sf_dir, "documents"), new_path(spark, "media")))
