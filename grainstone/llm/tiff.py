"""TIFF columns: a reader that gives one row per page, and a writer for lossless payloads.

The reader follows the public TIFF 6.0 layout: either byte order, BigTIFF too; the chain of
image directories; strips or tiles, interleaved or in planes; no compression, PackBits, LZW
or deflate; horizontal and floating-point predictors. Pixels come out row by row with the
samples of a pixel together, in the machine's byte order (little).
"""

from __future__ import annotations

import hashlib
import re
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..cluster import ship_code
from .words import binary, runs

#: Fixed values of the format.
NONE, LZW, DEFLATE, OLD_DEFLATE, PACKBITS = 1, 5, 8, 32946, 32773
_TYPES = {1: "B", 2: "s", 3: "H", 4: "I", 5: "II", 6: "b", 7: "B", 8: "h", 9: "i", 10: "ii", 11: "f", 12: "d", 13: "I", 16: "Q", 17: "q", 18: "Q"}
_CLEAR, _EOI = 256, 257
#: A page with more pixels' bytes than this is an error, not an allocation.
MOST_BYTES = 1 << 30


class BadTiff(ValueError):
    """The bytes aren't a TIFF that can be read."""


@dataclass
class Page:
    page: int
    width: int
    height: int
    samples: int
    bits: int
    compression: int
    predictor: int
    tiled: bool
    pixels: bytes


# -- codecs ---------------------------------------------------------------------------


def packbits_encode(data: bytes) -> bytes:
    out = bytearray()

    def literal(low: int, high: int) -> None:
        for s in range(low, high, 128):
            part = data[s : min(s + 128, high)]
            out.append(len(part) - 1)
            out.extend(part)

    at = 0
    for m in re.finditer(rb"(.)\1{2,}", data, re.DOTALL):
        literal(at, m.start())
        n = m.end() - m.start()
        while n >= 2:
            k = min(n, 128)
            out += bytes((257 - k, m[1][0]))
            n -= k
        at = m.end() - n
    literal(at, len(data))
    return bytes(out)


def packbits_decode(data: bytes, size: int) -> bytes:
    out, at, n = bytearray(), 0, len(data)
    while at < n and len(out) < size:
        k = data[at]
        if k < 128:
            out += data[at + 1 : at + 2 + k]
            at += k + 2
        else:
            if k > 128 and at + 1 < n:
                out += data[at + 1 : at + 2] * (257 - k)
            at += 2 if k > 128 else 1
    return bytes(out)


def _lzw_widths(n: int) -> np.ndarray:
    """Bits of the first n codes after a clear code: the table grows one code early."""
    k = np.arange(n)
    return 9 + (k >= 254).astype(np.int64) + (k >= 766) + (k >= 1790)


def lzw_encode(data: bytes) -> bytes:
    chunks: list[list[int]] = [[]]
    codes = chunks[0]
    table: dict[tuple[int, int], int] = {}
    after, prefix = 258, -1
    for b in data:
        if prefix < 0:
            prefix = b
            continue
        key = (prefix, b)
        known = table.get(key)
        if known is not None:
            prefix = known
            continue
        codes.append(prefix)
        table[key] = after
        after += 1
        prefix = b
        if after >= 4094:
            codes.append(_CLEAR)
            codes = []
            chunks.append(codes)
            table, after = {}, 258
    if prefix >= 0:
        codes.append(prefix)
    codes.append(_EOI)
    bits = [_code_bits([_CLEAR], np.array([9]))]
    bits += [_code_bits(c, _lzw_widths(len(c))) for c in chunks if c]
    return np.packbits(np.concatenate(bits)).tobytes()


def _code_bits(codes: list[int], widths: np.ndarray) -> np.ndarray:
    values = np.array(codes, np.uint16)
    parts = []
    for w in range(9, 13):
        own = values[widths == w]
        if len(own):
            parts.append((own[:, None] >> np.arange(w - 1, -1, -1, dtype=np.uint16) & 1).astype(np.uint8).ravel())
    return np.concatenate(parts)


def lzw_decode(data: bytes, size: int) -> bytes:
    """Codes are cut out per width up to each clear code, then looked up one by one."""
    bits = np.unpackbits(np.frombuffer(data, np.uint8))
    first = [bytes((i,)) for i in range(256)] + [b"", b""]
    out: list[bytes] = []
    done = at = 0
    spans = ((9, 254), (10, 512), (11, 1024), (12, 1 << 20))
    while done < size and at + 9 <= len(bits):
        table, last, ended = list(first), b"", False
        for w, most in spans:
            n = min(most, (len(bits) - at) // w, 4096 if w == 12 else most)
            if n <= 0:
                ended = True
                break
            powers = (1 << np.arange(w - 1, -1, -1)).astype(np.int64)
            codes = (bits[at : at + n * w].reshape(n, w) @ powers).tolist()
            stop = None
            for i, c in enumerate(codes):
                if c == _CLEAR or c == _EOI:
                    stop, ended = i + 1, c == _EOI
                    break
                if c < len(table):
                    entry = table[c]
                elif c == len(table) and last:
                    entry = last + last[:1]
                else:
                    raise BadTiff("LZW code outside the table")
                out.append(entry)
                done += len(entry)
                if last and len(table) < 4096:
                    table.append(last + entry[:1])
                last = entry
                if done >= size:
                    return b"".join(out)[:size]
            at += w * (n if stop is None else stop)
            if stop is not None:
                break
        if ended:
            break
    return b"".join(out)[:size]


def _inflate(data: bytes, size: int) -> bytes:
    try:
        return zlib.decompressobj().decompress(data, size)
    except zlib.error as e:
        raise BadTiff(f"deflate: {e}") from e


# -- reader ---------------------------------------------------------------------------


class _File:
    def __init__(self, data: bytes):
        self.data = data
        order = {b"II": "<", b"MM": ">"}.get(data[:2])
        if order is None or len(data) < 8:
            raise BadTiff("no byte order mark")
        self.order = order
        version = self.get("H", 2)[0]
        if version not in (42, 43):
            raise BadTiff("no TIFF version")
        self.big = version == 43
        self.first = self.get("Q", 8)[0] if self.big else self.get("I", 4)[0]

    def get(self, form: str, at: int) -> tuple:
        try:
            return struct.unpack_from(self.order + form, self.data, at)
        except struct.error as e:
            raise BadTiff("offset outside the file") from e

    def directories(self) -> Iterator[dict[int, tuple]]:
        at, seen = self.first, set()
        count, entry, word = ("Q", 20, "Q") if self.big else ("H", 12, "I")
        while at:
            if at in seen:
                raise BadTiff("directories form a loop")
            seen.add(at)
            n = self.get(count, at)[0]
            at += struct.calcsize(count)
            if n * entry > len(self.data):
                raise BadTiff("directory outside the file")
            tags = {}
            for i in range(n):
                tag, kind, many = self.get("HH" + word, at + i * entry)
                form = _TYPES.get(kind)
                if form is None:
                    continue
                where = at + i * entry + 4 + struct.calcsize(word)
                size = struct.calcsize("=" + form) * many
                if size > len(self.data):
                    raise BadTiff("value outside the file")
                if size > struct.calcsize(word):
                    where = self.get(word, where)[0]
                tags[tag] = self.get(f"{many}s" if form == "s" else form * many if len(form) > 1 else f"{many}{form}", where)
            yield tags
            at = self.get(word, at + n * entry)[0]


def _unpredict(rows: np.ndarray, samples: int, predictor: int, kind: np.dtype) -> np.ndarray:
    """rows: (height, width * samples) of the sample type, or its bytes for predictor 3."""
    if predictor == 2:
        h = rows.shape[0]
        unsigned = rows.view(f"u{rows.itemsize}") if rows.dtype.kind == "f" else rows
        return np.cumsum(unsigned.reshape(h, -1, samples), axis=1, dtype=unsigned.dtype).reshape(h, -1)
    return rows


def _unpredict_float(data: bytes, height: int, width: int, samples: int, size: int) -> np.ndarray:
    """Floating point predictor: bytes of a row by weight, most significant first, differenced."""
    rows = np.frombuffer(data, np.uint8).reshape(height, -1, samples)
    rows = np.cumsum(rows, axis=1, dtype=np.uint8).reshape(height, size, width * samples)
    return np.ascontiguousarray(rows[:, ::-1].transpose(0, 2, 1)).view(f"<f{size}").reshape(height, width * samples)


def pages(data: bytes) -> Iterator[Page]:
    """The pages of a TIFF, in the order of its directories. BadTiff if it can't be read."""
    f = _File(data)
    for number, tags in enumerate(f.directories()):
        one = lambda tag, default: (tags.get(tag) or (default,))[0]  # noqa: E731, B023
        width, height = one(256, 0), one(257, 0)
        samples, bits = one(277, 1), one(258, 1)
        compression, predictor, planar, form = one(259, NONE), one(317, 1), one(284, 1), one(339, 1)
        if not width or not height or len(set(tags.get(258, (bits,)))) > 1:
            raise BadTiff("no size, or samples of different sizes")
        if bits not in (1, 2, 4, 8, 16, 32, 64) or predictor not in (1, 2, 3) or (predictor > 1 and bits < 8):
            raise BadTiff("bits or predictor not known")
        wide = bits if bits < 8 else bits // 8  # bytes a sample takes while bits are spread out
        if width * height * samples * max(bits // 8, 1) > MOST_BYTES:
            raise BadTiff("page too large")
        tiled = 322 in tags
        if tiled:
            block_w, block_h, offsets, counts = one(322, 0), one(323, 0), tags.get(324, ()), tags.get(325, ())
        else:
            block_w, block_h, offsets, counts = width, min(one(278, height), height), tags.get(273, ()), tags.get(279, ())
        if not block_w or not block_h or len(offsets) != len(counts):
            raise BadTiff("no strips or tiles")
        across, down = -(-width // block_w), -(-height // block_h)
        planes = samples if planar == 2 else 1
        if len(offsets) < across * down * planes or block_w * block_h * samples * wide > MOST_BYTES:
            raise BadTiff("strips or tiles are missing")
        own = samples // planes
        size = max(bits // 8, 1)
        kind = np.dtype(f"{f.order}{'f' if form == 3 and size > 1 else 'u'}{size}")
        image = np.zeros((height, width, samples), np.dtype(kind).newbyteorder("<"))
        for p in range(planes):
            for y in range(down):
                for x in range(across):
                    i = (p * down + y) * across + x
                    rows = block_h if tiled else min(block_h, height - y * block_h)
                    stride = -(-block_w * own * bits // 8)
                    raw = _decoded(data[offsets[i] : offsets[i] + counts[i]], compression, stride * rows)
                    if predictor == 3 and form == 3:
                        block = _unpredict_float(raw, rows, block_w, own, size)
                    elif bits < 8:
                        whole = np.unpackbits(np.frombuffer(raw, np.uint8).reshape(rows, stride), axis=1)
                        weights = (1 << np.arange(bits - 1, -1, -1)).astype(np.uint8)
                        block = (whole[:, : block_w * own * bits].reshape(rows, -1, bits) * weights).sum(2, dtype=np.uint8)
                    else:
                        block = np.frombuffer(raw, kind).reshape(rows, -1)
                        block = _unpredict(block.astype(kind.newbyteorder("<")), own, predictor, kind)
                    part = block.view(image.dtype).reshape(rows, block_w, own)
                    h, w = min(block_h, height - y * block_h), min(block_w, width - x * block_w)
                    image[y * block_h : y * block_h + h, x * block_w : x * block_w + w, p * own : (p + 1) * own] = part[:h, :w]
        yield Page(number, width, height, samples, bits, compression, predictor, tiled, image.tobytes())


def _decoded(part: bytes, compression: int, size: int) -> bytes:
    if compression == NONE:
        raw = part[:size]
    elif compression == PACKBITS:
        raw = packbits_decode(part, size)
    elif compression == LZW:
        raw = lzw_decode(part, size)
    elif compression in (DEFLATE, OLD_DEFLATE):
        raw = _inflate(part, size)
    else:
        raise BadTiff(f"compression {compression} is not known")
    if len(raw) < size:
        raise BadTiff("a strip or tile is too short")
    return raw[:size]


# -- writer ---------------------------------------------------------------------------


def write(images: list[np.ndarray], compression: int = DEFLATE, predictor: int = 1, tile: int = 0, rows_per_strip: int = 64) -> bytes:
    """A little-endian TIFF of 8-bit images (height, width, samples), a page for each."""
    out = bytearray(b"II*\0\0\0\0\0")
    link = 4
    for image in images:
        height, width, samples = image.shape
        blocks = []
        if tile:
            for y in range(0, height, tile):
                for x in range(0, width, tile):
                    block = np.zeros((tile, tile, samples), np.uint8)
                    part = image[y : y + tile, x : x + tile]
                    block[: part.shape[0], : part.shape[1]] = part
                    blocks.append(block)
        else:
            blocks = [image[y : y + rows_per_strip] for y in range(0, height, rows_per_strip)]
        offsets, counts = [], []
        for block in blocks:
            if predictor == 2:
                block = np.concatenate([block[:, :1], np.diff(block, axis=1)], axis=1)
            raw = block.tobytes()
            data = {NONE: bytes, PACKBITS: packbits_encode, LZW: lzw_encode, DEFLATE: lambda b: zlib.compress(b, 6)}[compression](raw)
            offsets.append(len(out))
            counts.append(len(data))
            out += data + b"\0" * (len(data) & 1)
        tags = [(256, 4, [width]), (257, 4, [height]), (258, 3, [8] * samples), (259, 3, [compression]), (262, 3, [2 if samples >= 3 else 1]), (277, 3, [samples]), (284, 3, [1]), (317, 3, [predictor])]
        tags += [(322, 4, [tile]), (323, 4, [tile]), (324, 4, offsets), (325, 4, counts)] if tile else [(273, 4, offsets), (278, 4, [rows_per_strip]), (279, 4, counts)]
        entries = b""
        for tag, kind, values in sorted(tags):
            body = struct.pack(f"<{len(values)}{_TYPES[kind]}", *values)
            if len(body) > 4:
                where = len(out)
                out += body + b"\0" * (len(body) & 1)
                body = struct.pack("<I", where)
            entries += struct.pack("<HHI", tag, kind, len(values)) + body.ljust(4, b"\0")
        struct.pack_into("<I", out, link, len(out))
        out += struct.pack("<H", len(tags)) + entries
        link = len(out)
        out += b"\0\0\0\0"
    return bytes(out)


# -- DataFrame operators --------------------------------------------------------------

PAGE = "page int, width int, height int, samples int, bits int, compression int, predictor int, tiled boolean, pixels binary, error string"


def read_pages(media: DataFrame, key: str, column: str) -> DataFrame:
    """One row per page of each TIFF in a binary column: the key and PAGE.

    Null and empty media have no pages. Media that can't be read give the pages before the
    fault and a last row with only the error. Repeated rows each give their pages; other
    columns don't matter.
    """
    ship_code(media.sparkSession)
    kind = dict(media.dtypes)[key]
    names = ["k", *(f.split()[0] for f in PAGE.split(", "))]

    def run(batches):
        for batch in batches:
            types = [batch.schema.field(0).type, *[pa.int32()] * 7, pa.bool_(), pa.binary(), pa.string()]
            for k, data in zip(batch.column(0).to_pylist(), binary(batch.column(1))):
                data = data.as_py()
                found = []
                try:
                    for p in pages(data) if data else ():
                        found.append((k, p.page, p.width, p.height, p.samples, p.bits, p.compression, p.predictor, p.tiled, p.pixels, None))
                except BadTiff as e:
                    found.append((k, *[None] * 9, str(e)))
                if found:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*found), types)], names)

    return media.select(F.col(key).alias("k"), F.col(column).cast("binary").alias("media")).mapInArrow(run, f"k {kind}, {PAGE}").withColumnRenamed("k", key)


#: A payload is rows of ROW bytes, COLOURS samples a pixel, in pages of PAGE_ROWS rows.
ROW, COLOURS, PAGE_ROWS = 192, 3, 256


def store(payload: bytes) -> bytes:
    """A payload of whole rows as TIFF. The payload's CRC says which way: LZW, PackBits or
    deflate with the horizontal predictor, in strips or tiles."""
    image = np.frombuffer(payload, np.uint8).reshape(-1, ROW // COLOURS, COLOURS)
    way = zlib.crc32(payload)
    compression = (DEFLATE, LZW, PACKBITS)[way % 3]
    images = [image[y : y + PAGE_ROWS] for y in range(0, len(image), PAGE_ROWS)]
    return write(images, compression, 2 if compression == DEFLATE else 1, 64 if way // 3 % 2 else 0)


def payload_of(text: bytes) -> bytes:
    """The text with spaces up to a positive multiple of ROW bytes."""
    return text + b" " * (-len(text) % ROW or (0 if text else ROW))


def feature(image: np.ndarray) -> str:
    """Rows, mean and deviation of the samples, and a 64-bit average hash of the image."""
    grey = image.astype(np.int64).sum(2)
    ys = np.linspace(0, len(grey), 9).astype(int)
    cells = np.array([[grey[a : max(b, a + 1), x : x + 8].mean() for x in range(0, 64, 8)] for a, b in zip(np.minimum(ys, len(grey) - 1), ys[1:])])
    bits = np.packbits((cells > grey.mean()).ravel()).tobytes().hex()
    return f"rows={len(grey)} mean={image.mean():.4f} deviation={image.std():.4f} hash={bits}"


def media_digest(docs: DataFrame, key: str = "doc_id") -> DataFrame:
    """Each text stored as TIFF, its pages read back, and what they hold.

    Null is the empty text. Very long texts are stored whole, on many pages. Repeated rows
    each get theirs, null keys stay null; equal texts have equal values; other columns don't
    matter; no rows give no rows.
    """
    ship_code(docs.sparkSession)
    kind = dict(docs.dtypes)[key]
    names = ["k", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "pages", "feature"]

    def run(batches):
        for batch in batches:
            for part, texts in runs(batch):
                rows = []
                for text in texts:
                    media = store(payload_of(text))
                    read = list(pages(media))
                    back = b"".join(p.pixels for p in read)
                    image = np.frombuffer(back, np.uint8).reshape(-1, ROW // COLOURS, COLOURS)
                    rows.append((len(text), len(back), hashlib.sha256(back).hexdigest(), zlib.crc32(back[-16:]), len(media), hashlib.sha256(media).hexdigest(), len(read), feature(image)))
                columns = [pa.array(c, t) for c, t in zip(zip(*rows), [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.int32(), pa.string()])]
                yield pa.RecordBatch.from_arrays([part.column(0), *columns], names)

    return docs.select(F.col(key).alias("k"), "text").mapInArrow(run, f"k {kind}, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, pages int, feature string").withColumnRenamed("k", key)
