import hashlib
import random
import struct
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from grainstone.llm import tiff

from .fixtures import DOCS, docs


@settings(max_examples=150, deadline=None)
@given(st.binary(max_size=3000), st.integers(1, 60))
def test_codecs_round_trip(data, times):
    data = data * times
    assert tiff.packbits_decode(tiff.packbits_encode(data), len(data)) == data
    assert tiff.lzw_decode(tiff.lzw_encode(data), len(data)) == data


def test_lzw_fills_its_table():
    data = random.Random(1).randbytes(60000)
    assert tiff.lzw_decode(tiff.lzw_encode(data), len(data)) == data


def test_published_examples():
    assert tiff.packbits_decode(bytes.fromhex("FEAA0280002AFDAA0380002A22F7AA"), 24).hex() == "aaaaaa80002aaaaaaaaa80002a22" + "aa" * 10
    codes = [256, 7, 258, 8, 8, 258, 6, 6, 257]
    bits = "".join(f"{c:09b}" for c in codes).ljust(88, "0")
    assert tiff.lzw_encode(bytes([7, 7, 7, 8, 8, 7, 7, 6, 6])) == int(bits, 2).to_bytes(11, "big")
    assert tiff.lzw_decode(tiff.lzw_encode(bytes([7, 7, 7, 8, 8, 7, 7, 6, 6])), 9) == bytes([7, 7, 7, 8, 8, 7, 7, 6, 6])


@pytest.mark.parametrize("compression", [tiff.NONE, tiff.LZW, tiff.DEFLATE, tiff.PACKBITS])
@pytest.mark.parametrize("predictor, tile", [(1, 0), (2, 0), (1, 16), (2, 16)])
def test_pages_round_trip(compression, predictor, tile):
    rng = np.random.default_rng(1)
    images = [rng.integers(0, 9, (h, w, s), np.uint8) for h, w, s in ((70, 33, 3), (1, 1, 1), (130, 64, 4))]
    got = list(tiff.pages(tiff.write(images, compression, predictor, tile)))
    assert [(p.page, p.height, p.width, p.samples) for p in got] == [(i, *x.shape) for i, x in enumerate(images)]
    assert [p.pixels for p in got] == [x.tobytes() for x in images]


def built(order, tags, body, big=False):
    """A one-page file, its strip data first."""
    word, count = ("Q", "Q") if big else ("I", "H")
    head = (b"II" if order == "<" else b"MM") + (struct.pack(order + "HHH", 43, 8, 0) if big else struct.pack(order + "H", 42))
    at = len(head) + struct.calcsize(word)
    out = head + struct.pack(order + word, at + len(body)) + body
    entries = b""
    for tag, kind, value in sorted([*tags, (273, 4, at), (279, 4, len(body))]):
        entries += struct.pack(order + "HH" + word, tag, kind, 1) + struct.pack(order + {3: "H", 4: "I"}[kind], value).ljust(struct.calcsize(word), b"\0")
    return out + struct.pack(order + count, len(tags) + 2) + entries + struct.pack(order + word, 0)


def test_orders_sizes_predictors_and_planes():
    x = np.arange(12, dtype=np.uint16).reshape(3, 4) * 1000
    for order in "<>":
        for big in (False, True):
            for predictor, body in ((1, x), (2, np.concatenate([x[:, :1], np.diff(x, axis=1)], 1))):
                data = built(order, [(256, 3, 4), (257, 3, 3), (258, 3, 16), (259, 3, 1), (277, 3, 1), (278, 3, 3), (317, 3, predictor)], body.astype(order + "u2").tobytes(), big)
                assert next(tiff.pages(data)).pixels == x.astype("<u2").tobytes()
    f = np.random.default_rng(0).random((3, 5)).astype(np.float32)
    rows = f.view(np.uint8).reshape(3, 5, 4)[:, :, ::-1].transpose(0, 2, 1).reshape(3, 20)
    coded = np.concatenate([rows[:, :1], np.diff(rows, axis=1)], 1).tobytes()
    data = built("<", [(256, 3, 5), (257, 3, 3), (258, 3, 32), (259, 3, 8), (277, 3, 1), (278, 3, 3), (317, 3, 3), (339, 3, 3)], zlib.compress(coded))
    assert next(tiff.pages(data)).pixels == f.tobytes()
    bits = built(">", [(256, 3, 10), (257, 3, 2), (258, 3, 1), (259, 3, 1), (277, 3, 1), (278, 3, 2)], bytes([0b10110011, 0b01000000, 0b00000001, 0b11000000]))
    assert list(next(tiff.pages(bits)).pixels) == [1, 0, 1, 1, 0, 0, 1, 1, 0, 1, 0, 0, 0, 0, 0, 0, 0, 1, 1, 1]


def test_faults(spark):
    good = tiff.write([np.zeros((4, 4, 3), np.uint8)] * 2, tiff.LZW)
    loop = bytearray(tiff.write([np.zeros((4, 4, 3), np.uint8)]))
    struct.pack_into("<I", loop, len(loop) - 4, struct.unpack_from("<I", loop, 4)[0])
    rows = [(1, good), (2, None), (3, b""), (4, b"GIF89a.."), (5, good[:-20]), (6, bytes(loop)), (1, good)]
    df = spark.createDataFrame([(k, v, 1, "x") for k, v in rows], "k2 long, media binary, page int, error string")
    out = tiff.read_pages(df, "k2", "media").collect()
    assert sorted((r.k2, r.page) for r in out if r.error is None) == [(1, 0), (1, 0), (1, 1), (1, 1), (5, 0), (6, 0)]
    assert sorted(r.k2 for r in out if r.error) == [4, 5, 6]
    for n in range(0, len(good), 3):
        try:
            list(tiff.pages(good[:n] + b"\xff\xff" + good[n + 2 :]))
        except tiff.BadTiff:
            pass


def test_digest_of_documents(spark):
    texts = [None, "", "x", "é" * 96, "y" * 192, "word " * 30000, "aaa" * 500, "same", "same"]
    df = docs(spark, texts).selectExpr("*", "1 as k", "2 as pages")
    out = sorted(tiff.media_digest(df).collect(), key=lambda r: r.doc_id)
    for r, t in zip(out, texts):
        b = (t or "").encode()
        p = b.ljust(max(192, -(-len(b) // 192) * 192))
        assert (r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) == (len(b), len(p), hashlib.sha256(p).hexdigest(), zlib.crc32(p[-16:]))
    assert out[-1][1:] == out[-2][1:] and out[0][1:] == out[1][1:] and out[5].pages > 1
    assert tiff.media_digest(spark.createDataFrame([], DOCS)).count() == 0


def test_feature_equals_brute_force():
    rng = random.Random(12)
    for n in (1, 5, 8, 9, 100, 300):
        data = bytes(rng.choice([0, 255, 32, rng.randrange(256)]) for _ in range(n * tiff.ROW))
        image = np.frombuffer(data, np.uint8).reshape(n, tiff.ROW // tiff.COLOURS, tiff.COLOURS)
        mean = sum(data) / len(data)
        deviation = (sum((v - mean) ** 2 for v in data) / len(data)) ** 0.5
        grey = [[sum(data[tiff.ROW * y + 3 * x : tiff.ROW * y + 3 * x + 3]) for x in range(64)] for y in range(n)]
        whole = sum(map(sum, grey)) / (64 * n)
        bits = ""
        for k in range(8):
            a, b = min(n * k // 8, n - 1), n * (k + 1) // 8
            band = grey[a : max(b, a + 1)]
            bits += "".join("1" if sum(sum(r[x : x + 8]) for r in band) / (8 * len(band)) > whole else "0" for x in range(0, 64, 8))
        got = dict(p.split("=") for p in tiff.feature(image).split())
        assert got["rows"] == str(n) and got["hash"] == f"{int(bits, 2):016x}"
        assert abs(float(got["mean"]) - mean) < 1e-4 and abs(float(got["deviation"]) - deviation) < 1e-4


def test_one_bit_pages_are_bounded_by_what_they_take():
    good = tiff.write([np.zeros((4, 64, 1), np.uint8)], tiff.NONE)
    assert len(list(tiff.pages(good))) == 1
    large = bytearray(good)
    for tag, value in ((256, 1 << 15), (257, 1 << 16), (258, 1)):
        at = large.index(struct.pack("<H", tag), 264)
        struct.pack_into("<I", large, at + 8, value)
    with pytest.raises(tiff.BadTiff):
        list(tiff.pages(bytes(large)))
