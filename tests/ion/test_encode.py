"""The encoder of whole batches against the encoder of single values."""

import datetime as dt
import random
from decimal import Decimal

import pyarrow as pa
import pytest

from grainstone.sources import ionbinary as B
from grainstone.sources.ionencode import _NULLS, rows
from grainstone.sources.values import DAY, SECOND, Struct, Timestamp
from grainstone.sources.writer import single

KINDS = [
    pa.int64(), pa.int32(), pa.int16(), pa.int8(), pa.float64(), pa.float32(), pa.bool_(), pa.string(), pa.large_string(), pa.binary(), pa.decimal128(18, 3), pa.decimal128(9, 0), pa.decimal128(38, 10),
    pa.date32(), pa.timestamp("us"), pa.timestamp("us", tz="Europe/Berlin"), pa.list_(pa.int64()), pa.list_(pa.list_(pa.string())), pa.struct([("x", pa.string()), ("y", pa.list_(pa.float64()))]), pa.map_(pa.string(), pa.int64()),
]


def one(rng, kind, nulls=0.15):
    if rng.random() < nulls:
        return None
    if pa.types.is_integer(kind):
        top = (1 << kind.bit_width - 1) - 1
        return rng.choice([0, 1, -1, top, -top - 1, top // 3, -(top // 200), 127, -128])
    if pa.types.is_floating(kind):
        return rng.choice([0.0, -0.0, 1.5, -2.25e10, float("inf"), 0.125])
    if pa.types.is_boolean(kind):
        return rng.random() < 0.5
    if pa.types.is_string(kind) or pa.types.is_large_string(kind):
        return rng.choice(["", "a", "é" * rng.randint(0, 90), "x" * 13, "x" * 14, "y" * 20000])
    if pa.types.is_binary(kind):
        return bytes(rng.randint(0, 200))
    if pa.types.is_decimal(kind):
        n = rng.choice([0, 1, -1, 127, -128, 128, 10 ** (kind.precision - 1), -(10 ** (kind.precision - 1))])
        return Decimal((int(n < 0), tuple(map(int, str(abs(n)))), -kind.scale))
    if pa.types.is_date(kind):
        return rng.choice([dt.date(1970, 1, 1), dt.date(2024, 2, 29), dt.date(127, 5, 6), dt.date(9999, 12, 31), dt.date(1899, 12, 31)])
    if pa.types.is_timestamp(kind):
        at = rng.choice([dt.datetime(1970, 1, 1), dt.datetime(1969, 12, 31, 23, 59, 59, 999999), dt.datetime(2024, 2, 29, 1, 2, 3, 4), dt.datetime(100, 1, 2, 3, 4, 5), dt.datetime(2000, 1, 1, 0, 0, 0, 500000)])
        return at.replace(tzinfo=dt.timezone.utc) if kind.tz else at
    if pa.types.is_list(kind):
        return [one(rng, kind.value_type, nulls) for _ in range(rng.randint(0, 6))]
    if pa.types.is_struct(kind):
        return {f.name: one(rng, f.type, nulls) for f in kind}
    return [(f"k{i}", one(rng, kind.item_type, nulls)) for i in range(rng.randint(0, 3))]


def slow(value, kind, symbols):
    if value is None:
        return bytes((next((n for test, n in _NULLS if test(kind)), 0) << 4 | 15,))
    if pa.types.is_map(kind) or pa.types.is_decimal(kind):
        return single(kind)(value)
    if pa.types.is_list(kind):
        return B.tagged(11, b"".join(slow(v, kind.value_type, symbols) for v in value))
    if pa.types.is_struct(kind):
        return B.tagged(13, b"".join(B.varuint(symbols.sid(f.name)) + slow(value[f.name], f.type, symbols) for f in kind))
    if pa.types.is_date(kind):
        return B.encode_timestamp(Timestamp(DAY, value.year, value.month, value.day))
    if pa.types.is_timestamp(kind):
        value = value.replace(tzinfo=None)
        return B.encode_timestamp(Timestamp(SECOND, value.year, value.month, value.day, value.hour, value.minute, value.second, f"{value.microsecond:06d}" if value.microsecond else "", 0))
    if pa.types.is_float32(kind):
        return b"\x44" + pa.array([value], kind).to_numpy().astype(">f4").tobytes()
    if pa.types.is_float64(kind):
        return b"\x48" + pa.array([value], kind).to_numpy().astype(">f8").tobytes()
    return B.encode(value, symbols)


@pytest.mark.parametrize("seed", range(30))
def test_equals_single_values(seed):
    rng = random.Random(seed)
    kinds = [rng.choice(KINDS) for _ in range(rng.randint(0, 160 if seed == 3 else 12))]
    n, nulls = rng.choice([0, 1, 40]), rng.choice([0, 0.2, 1])
    table = [[one(rng, k, nulls) for _ in range(n + 5)] for k in kinds]
    names = [f"c{i}" for i in range(len(kinds))]
    batch = pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(table, kinds)], names) if kinds else None
    if batch is None:
        return
    batch = batch.slice(3, n)
    symbols, other = B.Symbols(), B.Symbols()
    got = rows(batch, symbols, single)
    heads = [B.varuint(other.sid(x)) for x in names]
    want = b"".join(B.tagged(13, b"".join(h + slow(c[3 + i], k, other) for h, c, k in zip(heads, table, kinds))) for i in range(n))
    assert got == want
    assert len(list(B.BinaryReader(B.MARK + symbols.table(False) + got).values())) == n


def test_read_back():
    batch = pa.RecordBatch.from_pylist([{"a": 1, "b": [None, "x"], "c": {"d": Decimal("1.50")}}, {"a": None, "b": [], "c": None}])
    symbols = B.Symbols()
    data = rows(batch, symbols, single)
    assert list(B.BinaryReader(B.MARK + symbols.table(False) + data).values()) == [Struct([("a", 1), ("b", [None, "x"]), ("c", Struct([("d", Decimal("1.50"))]))]), Struct([("a", None), ("b", []), ("c", None)])]
