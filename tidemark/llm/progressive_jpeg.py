"""Progressive JPEG: scans into coefficient arrays, inverse transform in numpy, chroma upsampled, full-resolution RGB.

decode_coefficients() takes any Huffman-coded progressive file: spectral selection and successive approximation, first and
refining scans, interleaved or not, with or without restart markers. A scan whose Huffman table has one symbol has codes of
one length, so all its blocks are read at once as an array of bits; other scans are read symbol by symbol.

Bytes are stored losslessly as coefficients, the format's own unit: a block of 64 bytes is a block of 64 quantised
coefficients with value 256 + byte, in zigzag order. All of these have the same magnitude category, so every scan of such a
file has a table of one symbol.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import text_batches


def zigzag_order() -> np.ndarray:
    """Natural index (row * 8 + column) of each zigzag place: diagonals, walked up and down in turn."""
    cells = [(r, c) for r in range(8) for c in range(8)]
    cells.sort(key=lambda x: (x[0] + x[1], x[0] if (x[0] + x[1]) % 2 else x[1]))
    return np.array([r * 8 + c for r, c in cells])


ZIGZAG = zigzag_order()
#: Rows are frequencies: inverse transform of a block X is COSINE.T @ X @ COSINE.
COSINE = np.array([[math.sqrt((1 if u == 0 else 2) / 8) * math.cos((2 * x + 1) * u * math.pi / 16) for x in range(8)] for u in range(8)])


class Frame:
    """What the headers say, and the coefficients (component: blocks by 64, zigzag order)."""

    def __init__(self) -> None:
        self.height = self.width = 0
        self.components: list[tuple[int, int, int, int]] = []  # id, horizontal, vertical factor, quantiser
        self.quantisers: dict[int, np.ndarray] = {}
        self.coefficients: list[np.ndarray] = []
        self.padded: list[tuple[int, int]] = []  # blocks of each component in whole MCUs: rows, columns
        self.own: list[tuple[int, int]] = []  # blocks that the image itself needs
        self.comment = b""

    def lay_out(self) -> None:
        most_h, most_v = max(c[1] for c in self.components), max(c[2] for c in self.components)
        across, down = -(-self.width // (8 * most_h)), -(-self.height // (8 * most_v))
        for _, h, v, _ in self.components:
            self.padded.append((down * v, across * h))
            self.own.append((-(-(-(-self.height * v // most_v)) // 8), -(-(-(-self.width * h // most_h)) // 8)))
            self.coefficients.append(np.zeros((down * v * across * h, 64), dtype=np.int32))


def unstuffed(data: bytes) -> list[bytes]:
    """The intervals of entropy-coded data between restart markers, without stuffing."""
    raw = np.frombuffer(data, dtype=np.uint8)
    at = np.flatnonzero(raw[:-1] == 255) if len(raw) > 1 else np.zeros(0, np.int64)
    marks = at[(raw[at + 1] & 0xF8) == 0xD0]
    if not len(marks):
        return [data.replace(b"\xff\x00", b"\xff")]
    edges = [0, *(marks + 2).tolist()]
    return [data[a:b].replace(b"\xff\x00", b"\xff") for a, b in zip(edges, [*marks.tolist(), len(data)])]


def equal_intervals(data: bytes) -> np.ndarray | None:
    """Restart intervals of one length as rows of bytes, or None if they differ."""
    raw = np.frombuffer(data, dtype=np.uint8)
    keep, is_mark = np.ones(len(raw), bool), np.zeros(len(raw), bool)
    at = np.flatnonzero(raw[:-1] == 255)
    after = raw[at + 1]
    keep[at[after == 0] + 1] = False
    marks = at[(after & 0xF8) == 0xD0]
    keep[marks] = keep[marks + 1] = False
    is_mark[marks] = True
    lengths = np.diff(np.concatenate([[0], np.cumsum(keep)[marks], [keep.sum()]]))
    return raw[keep].reshape(len(lengths), -1) if len(lengths) and (lengths == lengths[0]).all() else None


class Bits:
    """Reader of one interval; past its end it reads ones."""

    def __init__(self, data: bytes) -> None:
        self.value, self.left, self.data, self.at = 0, 0, data, 0

    def take(self, n: int) -> int:
        while self.left < n:
            self.value = self.value << 8 | (self.data[self.at] if self.at < len(self.data) else 255)
            self.at += 1
            self.left += 8
        self.left -= n
        out = self.value >> self.left
        self.value &= (1 << self.left) - 1
        return out

    def symbol(self, table: dict[tuple[int, int], int]) -> int:
        code = 0
        for length in range(1, 17):
            code = code << 1 | self.take(1)
            if (length, code) in table:
                return table[length, code]
        raise ValueError("a code that the Huffman table lacks")

    def signed(self, size: int) -> int:
        v = self.take(size) if size else 0
        return v if not size or v >> (size - 1) else v - (1 << size) + 1


def huffman_table(counts: bytes, symbols: bytes) -> dict[tuple[int, int], int]:
    table, code, at = {}, 0, 0
    for length, n in enumerate(counts, 1):
        for _ in range(n):
            table[length, code] = symbols[at]
            code, at = code + 1, at + 1
        code <<= 1
    return table


def block_numbers(frame: Frame, parts: list[int]) -> list[list[tuple[int, int]]]:
    """(component, block) of every MCU of a scan."""
    if len(parts) == 1:
        (rows, cols), stride = frame.own[parts[0]], frame.padded[parts[0]][1]
        return [[(parts[0], r * stride + c)] for r in range(rows) for c in range(cols)]
    _, h0, v0, _ = frame.components[parts[0]]
    down, across = frame.padded[parts[0]][0] // v0, frame.padded[parts[0]][1] // h0
    out = []
    for my in range(down):
        for mx in range(across):
            out.append([(p, (my * v + y) * frame.padded[p][1] + mx * h + x) for p in parts for _, h, v, _ in [frame.components[p]] for y in range(v) for x in range(h)])
    return out


def read_scan(frame: Frame, parts: list[int], tables: list[tuple[dict, dict]], first: int, last: int, high: int, low: int, restart: int, data: bytes) -> None:
    """One scan, symbol by symbol."""
    units = block_numbers(frame, parts)
    step = restart or len(units)
    table_of = dict(zip(parts, tables))
    for interval, piece in enumerate(unstuffed(data)):
        bits, before, run = Bits(piece), dict.fromkeys(parts, 0), 0
        for unit in units[interval * step : (interval + 1) * step]:
            for part, number in unit:
                block = frame.coefficients[part][number]
                dc, ac = table_of[part]
                if first == 0:
                    if high:
                        block[0] |= bits.take(1) << low
                    else:
                        before[part] += bits.signed(bits.symbol(dc))
                        block[0] = before[part] << low
                elif not high:
                    run = first_ac(block, bits, ac, first, last, low, run)
                else:
                    run = refine_ac(block, bits, ac, first, last, low, run)


def first_ac(block, bits: Bits, table: dict, k: int, last: int, low: int, run: int) -> int:
    if run:
        return run - 1
    while k <= last:
        zeros, size = divmod(bits.symbol(table), 16)
        if size:
            k += zeros
            block[k] = bits.signed(size) * (1 << low)
            k += 1
        elif zeros == 15:
            k += 16
        else:
            return (1 << zeros) + bits.take(zeros) - 1
    return 0


def refine_ac(block, bits: Bits, table: dict, k: int, last: int, low: int, run: int) -> int:
    one = 1 << low

    def correct(at: int) -> None:
        if bits.take(1):
            block[at] += one if block[at] > 0 else -one

    while not run and k <= last:
        zeros, size = divmod(bits.symbol(table), 16)
        new = 0
        if size:
            new = one if bits.take(1) else -one
        elif zeros < 15:
            run = (1 << zeros) + bits.take(zeros)
            break
        while k <= last:
            if block[k]:
                correct(k)
            elif zeros == 0:
                break
            else:
                zeros -= 1
            k += 1
        if size and k <= last:
            block[k] = new
        k += 1
    if run:
        for at in range(k, last + 1):
            if block[at]:
                correct(at)
        return run - 1
    return 0


def read_even_scan(frame: Frame, part: int, symbol: int, first: int, last: int, high: int, low: int, restart: int, data: bytes) -> bool:
    """A scan of one component whose table has the one symbol, coded as a single 0 bit, read as an array of bits. False if
    its blocks are not all of one length."""
    (rows, cols), stride = frame.own[part], frame.padded[part][1]
    if stride != cols or frame.padded[part][0] != rows:
        return False
    blocks, n = frame.coefficients[part], rows * cols
    body = data.replace(b"\xff\x00", b"\xff") if not restart else None
    if first == 0 and high:
        if restart:
            return False
        blocks[:, 0] |= np.unpackbits(np.frombuffer(body, np.uint8))[:n].astype(np.int32) << low
        return True
    width = last - first + 1
    if high:
        # the symbol ends every block's band at once: all its coefficients are there already and get one bit each
        if restart or symbol != 0 or not (blocks[:, first : last + 1] != 0).all():
            return False
        bits = np.unpackbits(np.frombuffer(body, np.uint8))[: n * (width + 1)].reshape(n, width + 1)[:, 1:].astype(np.int32)
        own = blocks[:, first : last + 1]
        own += np.where(own > 0, bits, -bits) << low
        return True
    zeros, size = divmod(symbol, 16)
    if zeros or not 1 <= size <= 8:
        return False
    if first == 0:
        if restart != 1:
            return False  # differences from block to block: not of one length once summed
        table = equal_intervals(data)
        if table is None or len(table) != n:
            return False
        bits = np.unpackbits(table, axis=1)[:, 1 : 1 + size]
    else:
        if restart:
            return False
        bits = np.unpackbits(np.frombuffer(body, np.uint8))[: n * width * (size + 1)].reshape(n * width, size + 1)[:, 1:]
    value = np.packbits(bits, axis=1)[:, 0].astype(np.int32) >> (8 - size)
    value = np.where(value >> (size - 1), value, value - (1 << size) + 1) * (1 << low)
    blocks[:, first : last + 1] = value.reshape(n, width)
    return True


def decode_coefficients(data: bytes, max_pixels: int | None = None) -> Frame:
    """Parse a progressive JPEG and gather its coefficients; a file that declares more pixels than max_pixels is an error."""
    if data[:2] != b"\xff\xd8":
        raise ValueError("not a JPEG")
    frame, tables, restart, at = Frame(), {}, 0, 2
    while at < len(data):
        if data[at] != 255:
            raise ValueError("a marker is missing")
        kind = data[at + 1]
        if kind == 0xFF:  # a fill byte before the marker
            at += 1
            continue
        if kind == 0xD9:
            return frame
        size = int.from_bytes(data[at + 2 : at + 4], "big")
        body = data[at + 4 : at + 2 + size]
        at += 2 + size
        if kind == 0xDB:
            i = 0
            while i < len(body):
                wide = body[i] >> 4
                step = 128 if wide else 64
                frame.quantisers[body[i] & 15] = np.frombuffer(body[i + 1 : i + 1 + step], ">u2" if wide else np.uint8).astype(np.float64)
                i += 1 + step
        elif kind == 0xC2:
            frame.height, frame.width = int.from_bytes(body[1:3], "big"), int.from_bytes(body[3:5], "big")
            if max_pixels is not None and frame.height * frame.width > max_pixels:
                raise ValueError(f"{frame.height} x {frame.width} pixels are more than {max_pixels}")
            frame.components = [(body[i], body[i + 1] >> 4, body[i + 1] & 15, body[i + 2]) for i in range(6, 6 + 3 * body[5], 3)]
            frame.lay_out()
        elif kind in (0xC0, 0xC1, 0xC3, *range(0xC5, 0xC8), *range(0xC9, 0xCC), *range(0xCD, 0xD0)):
            raise ValueError("not a progressive Huffman-coded JPEG")
        elif kind == 0xC4:
            i = 0
            while i < len(body):
                counts = body[i + 1 : i + 17]
                tables[body[i]] = huffman_table(counts, body[i + 17 : i + 17 + sum(counts)])
                i += 17 + sum(counts)
        elif kind == 0xDD:
            restart = int.from_bytes(body[:2], "big")
        elif kind == 0xFE:
            frame.comment = body
        elif kind == 0xDA:
            end = at
            while True:  # the next marker that is neither stuffing nor a restart
                end = data.index(b"\xff", end)
                if data[end + 1] != 0 and data[end + 1] & 0xF8 != 0xD0:
                    break
                end += 2
            ids = [c[0] for c in frame.components]
            parts = [ids.index(body[1 + 2 * i]) for i in range(body[0])]
            pick = [body[2 + 2 * i] for i in range(body[0])]
            own = [(tables.get(p >> 4, {}), tables.get(16 | p & 15, {})) for p in pick]
            first, last, high, low = body[-3], body[-2], body[-1] >> 4, body[-1] & 15
            used = own[0][first > 0]
            even = len(parts) == 1 and (first == 0 and high or list(used) == [(1, 0)])
            if not (even and read_even_scan(frame, parts[0], used.get((1, 0), 0), first, last, high, low, restart, data[at:end])):
                read_scan(frame, parts, own, first, last, high, low, restart, data[at:end])
            at = end
    raise ValueError("the end is missing")


def to_rgb(frame: Frame) -> np.ndarray:
    """Height by width by 3 uint8: inverse transform, chroma repeated up to full resolution, YCbCr to RGB."""
    most_h, most_v = max(c[1] for c in frame.components), max(c[2] for c in frame.components)
    planes = []
    for (_, h, v, q), blocks, (rows, cols) in zip(frame.components, frame.coefficients, frame.padded):
        natural = np.zeros((len(blocks), 64), dtype=np.float32)
        natural[:, ZIGZAG] = blocks * frame.quantisers[q].astype(np.float32)
        cosine = COSINE.astype(np.float32)
        pixels = cosine.T @ natural.reshape(-1, 8, 8) @ cosine + np.float32(128)
        plane = pixels.reshape(rows, cols, 8, 8).transpose(0, 2, 1, 3).reshape(rows * 8, cols * 8)
        plane = np.clip(np.rint(plane), 0, 255)
        planes.append(plane.repeat(most_v // v, axis=0).repeat(most_h // h, axis=1)[: frame.height, : frame.width])
    if len(planes) == 1:
        rgb = [planes[0]] * 3
    else:
        y, cb, cr = planes[0], planes[1] - np.float32(128), planes[2] - np.float32(128)
        rgb = [y + np.float32(1.402) * cr, y - np.float32(0.344136) * cb - np.float32(0.714136) * cr, y + np.float32(1.772) * cb]
    return np.clip(np.rint(np.stack(rgb, axis=2)), 0, 255).astype(np.uint8)


def marker(kind: int, body: bytes) -> bytes:
    return bytes([255, kind]) + (len(body) + 2).to_bytes(2, "big") + body


def with_ones(bits: np.ndarray) -> bytes:
    """Bits as bytes, the last one filled with ones, then stuffed."""
    flat = bits.ravel()
    return np.packbits(np.concatenate([flat, np.ones(-len(flat) % 8, np.uint8)])).tobytes().replace(b"\xff", b"\xff\x00")


def first_bits(values: np.ndarray) -> bytes:
    """The one symbol's 0 bit before each 8-bit magnitude."""
    bits = np.zeros((len(values), 9), dtype=np.uint8)
    bits[:, 1:] = np.unpackbits(values).reshape(-1, 8)
    return with_ones(bits)


def dc_bits(values: np.ndarray) -> bytes:
    """One restart interval of two bytes for each block, so that no difference reaches over blocks."""
    bits = np.ones((len(values), 16), dtype=np.uint8)
    bits[:, 0] = 0
    bits[:, 1:9] = np.unpackbits(values).reshape(-1, 8)
    pair = np.packbits(bits, axis=1)
    out = np.zeros((len(values), 5), dtype=np.uint8)  # 2 bytes, stuffing, marker
    out[:, :2], out[:, 3] = pair, 255
    out[:, 4] = 0xD0 + np.arange(len(values)) % 8
    keep = np.ones(out.shape, bool)
    keep[:, 2] = pair[:, 1] == 255
    keep[-1, 3:] = False
    return out[keep].tobytes()


HEADER_TABLES = marker(0xDB, b"\x00" + b"\x01" * 64) + marker(0xC4, b"".join(bytes([t, 1]) + b"\x00" * 15 + bytes([s]) for t, s in ((0x00, 8), (0x10, 8), (0x11, 0))))


def store_payload(payload: bytes) -> bytes:
    """A progressive 4:2:0 JPEG that holds the payload (a multiple of 64 bytes) as coefficients; the comment has its length."""
    n = len(payload) // 64
    units = -(-n // 6)
    across = max(1, math.isqrt(units - 1) + 1 if units else 1)
    down = -(-units // across)
    total = across * down
    blocks = np.zeros((6 * total, 64), dtype=np.uint8)
    blocks[:n] = np.frombuffer(payload, np.uint8).reshape(n, 64)
    edges = [0, 4 * total, 5 * total, 6 * total]
    frame = b"\x08" + (16 * down).to_bytes(2, "big") + (16 * across).to_bytes(2, "big") + b"\x03" + bytes([1, 0x22, 0, 2, 0x11, 0, 3, 0x11, 0])
    out = [b"\xff\xd8", marker(0xFE, len(payload).to_bytes(8, "big")), HEADER_TABLES, marker(0xC2, frame)]
    upper, lowest = blocks >> 1 | 128, blocks & 1
    for part in range(3):
        own, low = upper[edges[part] : edges[part + 1]], lowest[edges[part] : edges[part + 1]]
        scan = lambda first, last, bits, table: marker(0xDA, bytes([1, part + 1, table, first, last, bits]))  # noqa: B023, E731
        refine = np.zeros((len(own), 64), dtype=np.uint8)
        refine[:, 1:] = low[:, 1:]
        out += [marker(0xDD, b"\x00\x01"), scan(0, 0, 0x01, 0x00), dc_bits(np.ascontiguousarray(own[:, 0])), marker(0xDD, b"\x00\x00")]
        for first, last in ((1, 5), (6, 63)):
            out += [scan(first, last, 0x01, 0x00), first_bits(own[:, first : last + 1].ravel())]
        out += [scan(0, 0, 0x10, 0x00), with_ones(low[:, 0]), scan(1, 63, 0x10, 0x01), with_ones(refine)]
    return b"".join(out) + b"\xff\xd9"


def read_payload(frame: Frame) -> bytes:
    size = int.from_bytes(frame.comment, "big")
    return (np.concatenate(frame.coefficients) - 256).astype(np.uint8).tobytes()[:size]


def padded_text(text: str | None) -> tuple[int, bytes]:
    """Length of the UTF-8 bytes, and these with bytes 0 up to a positive multiple of 64."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    return len(raw), raw + bytes(max(64, -(-len(raw) // 64) * 64) - len(raw))


def rgb_feature(rgb: np.ndarray) -> str:
    """Size, sums of the channels and crc32 of the tensor: whole numbers only."""
    return f"{rgb.shape[0]}x{rgb.shape[1]}:" + ",".join(str(int(x)) for x in rgb.sum(axis=(0, 1), dtype=np.int64)) + f":{zlib.crc32(rgb.tobytes())}"


def store_media(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Store every text as a progressive JPEG, read it back, and give payload, file and RGB tensor.

    Columns: id, n_bytes, payload_bytes, payload_sha256, tail_crc32 (of the bytes read back), media_bytes, media_sha256, media
    (the file), feature, height, width, rgb (row-major bytes, 3 a pixel). A null text counts as empty and is stored as one block
    of zeros; equal texts give equal values; repeated rows are stored each. Other columns are ignored; an empty table gives an
    empty table.
    """
    text_batches(docs.sparkSession)
    schema = "n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, media binary, feature string, height int, width int, rgb binary"

    @F.pandas_udf(schema)
    def store(series: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for part in series:
            rows = []
            for text in part:
                n, payload = padded_text(text)
                media = store_payload(payload)
                frame = decode_coefficients(media)
                back, rgb = read_payload(frame), to_rgb(frame)
                rows.append((n, len(back), hashlib.sha256(back).hexdigest(), zlib.crc32(back[-64:]), len(media), hashlib.sha256(media).hexdigest(), media, rgb_feature(rgb), rgb.shape[0], rgb.shape[1], rgb.tobytes()))
            yield pd.DataFrame(rows, columns=[x.split()[0] for x in schema.split(", ")]).astype({"height": "int32", "width": "int32"})

    return docs.select(F.col(id_col).alias(id_col), store(F.col(text_col)).alias("x")).select(id_col, "x.*")


def media_features(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """store_media without the file itself: the digests, the feature and the full-resolution RGB tensor of every text."""
    return store_media(docs, id_col, text_col).drop("media")


def decode_media(files: DataFrame, id_col: str = "id", data_col: str = "content", max_pixels: int = 1 << 24) -> DataFrame:
    """id, height, width, rgb (row-major bytes, 3 a pixel) and error of every file of a column of progressive JPEGs.

    A null or unreadable file, or one that declares more than max_pixels, has null sizes and rgb and says why in error; the
    others have a null error.
    """
    text_batches(files.sparkSession)

    @F.pandas_udf("height int, width int, rgb binary, error string")
    def decode(series: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for part in series:
            rows = []
            for data in part:
                try:
                    if data is None:
                        raise ValueError("null")
                    rgb = to_rgb(decode_coefficients(bytes(data), max_pixels))
                    rows.append((rgb.shape[0], rgb.shape[1], rgb.tobytes(), None))
                except (ValueError, IndexError, KeyError) as e:
                    rows.append((None, None, None, str(e) or type(e).__name__))
            out = pd.DataFrame(rows, columns=["height", "width", "rgb", "error"])
            yield out.astype({"height": "Int32", "width": "Int32"})

    return files.select(F.col(id_col), decode(F.col(data_col)).alias("x")).select(id_col, "x.*")
