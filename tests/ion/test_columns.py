"""The reader by columns against the cursor, value by value."""

import random
from decimal import Decimal

import pyarrow as pa
import pytest
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from grainstone.operators.coerce import coerce
from grainstone.plans.types import plain
from grainstone.sources import ionbinary as B
from grainstone.sources.ioncolumns import ColumnReader
from grainstone.sources.reader import _arrays, _batch
from grainstone.sources.values import DAY, MINUTE, SECOND, IonError, Struct, Timestamp

KINDS = [
    T.LongType(), T.IntegerType(), T.ShortType(), T.DoubleType(), T.BooleanType(), T.StringType(), T.TimestampType(), T.TimestampNTZType(),
    T.DecimalType(18, 3), T.DecimalType(38, 10), T.ArrayType(T.LongType()), T.StructType([T.StructField("x", T.StringType())]), T.BinaryType(), T.DateType(),
]


def one(rng, kind):
    if rng.random() < 0.15:
        return None
    if isinstance(kind, T.LongType):
        return rng.choice([0, 1, -1, 255, 256, -(1 << 63), (1 << 63) - 1, rng.getrandbits(40), -rng.getrandbits(20)])
    if isinstance(kind, T.IntegerType):
        return rng.choice([0, (1 << 31) - 1, -(1 << 31), rng.getrandbits(20)])
    if isinstance(kind, T.ShortType):
        return rng.choice([0, 32767, -32768, 9])
    if isinstance(kind, T.DoubleType):
        return rng.choice([0.0, -0.0, 1.5, rng.random() * 1e9, float("inf"), 7, -(10**30), Decimal("12.25"), Decimal("-0.1"), Decimal("1E+3"), Decimal("-0.00"), Decimal(str(rng.random()))])
    if isinstance(kind, T.BooleanType):
        return rng.random() < 0.5
    if isinstance(kind, T.StringType):
        return rng.choice(["", "a", "é" * 20, "x" * rng.randint(0, 300), "\0\n\""])
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        f = rng.choice(["", "5", "000001", "123456", "1234567"])
        return rng.choice([Timestamp(SECOND, rng.randint(1, 9998), rng.randint(1, 12), rng.randint(1, 28), 23, 59, rng.randint(0, 59), f, rng.choice([0, None, 330, -480, 60])), Timestamp(DAY, 2020, 2, 29), Timestamp(MINUTE, 2020, 2, 29, 1, 2, offset=0)])
    if isinstance(kind, T.DecimalType):
        return rng.choice([Decimal("0"), Decimal("1.25"), Decimal("-99.999"), Decimal("0.0005"), 12, -7, Decimal("123456789012.5"), Decimal("-0.0")])
    if isinstance(kind, T.ArrayType):
        return [one(rng, kind.elementType) for _ in range(rng.randint(0, 5))]
    if isinstance(kind, T.StructType):
        return Struct([("x", one(rng, T.StringType())), ("y", 1)])
    if isinstance(kind, T.DateType):
        return Timestamp(DAY, 1999, 12, 31)
    return bytes(rng.randint(0, 20))


def read(data, schema, listed=False):
    kinds = [to_arrow_type(plain(f.dataType)) for f in schema]
    got = list(ColumnReader(data, schema, kinds, listed).batches())
    values = B.BinaryReader(data).values()
    want = [_batch(c, n, kinds, schema.names) for c, n in _arrays(next(values, ()) if listed else values, schema, True)]
    return [pa.Table.from_batches(x) if x else None for x in (got, want)]


@pytest.mark.parametrize("seed", range(25))
def test_equals_the_cursor(seed):
    rng = random.Random(seed)
    fields = [(f"c{i}", rng.choice(KINDS)) for i in range(rng.randint(1, 30))]
    shuffled, tame = seed % 3 == 0, seed % 2 == 0
    rows = []
    for _ in range(200):
        own = [(n, one(rng, k)) for n, k in fields if tame or rng.random() < 0.9]
        if shuffled:
            rng.shuffle(own)
        if not tame:
            own += [(n, one(rng, k)) for n, k in rng.sample(fields, 1)]  # a repeated field
        rows.append(None if not tame and rng.random() < 0.02 else Struct(own))
    asked = rng.sample(fields, rng.randint(0, len(fields)))
    schema = T.StructType([T.StructField(n, k) for n, k in asked] + [T.StructField("absent", T.LongType())])
    for data, listed in ((B.dumps(rows), False), (B.dumps([rows]), True)):
        got, want = read(data, schema, listed)
        assert got.equals(want) or got.to_pydict().__repr__() == want.to_pydict().__repr__()


def test_only_decimals_at_an_exact_scale_are_fast():
    schema = T.StructType([T.StructField("d", T.DoubleType()), T.StructField("e", T.DecimalType(9, 2))])
    rows = [Struct([("d", Decimal(s)), ("e", Decimal(s))]) for s in ("0.1", "-0.25", "12345.67", "0", "-0.0", "1.005")]
    got, want = read(B.dumps(rows), schema)
    assert repr(got.to_pydict()) == repr(want.to_pydict())


def test_symbols_annotations_padding_and_several_tables():
    table = B.Symbols()
    first = B.MARK + B.encode(Struct([("a", 1)]), table)
    first = B.MARK + (table.table(False) or b"") + first[4:]
    table = B.Symbols()
    body = B.encode(Struct([("b", 2), ("a", 3)]), table)
    second = B.MARK + table.table(False) + body
    # a field with an annotation, a symbol value, padding in a struct and between values
    noted = bytes((0x8A, 0xE4, 0x81, 0x84, 0x21, 0x09))
    padded = bytes((0xD6, 0x8A, 0x21, 0x07, 0x80, 0x01, 0xFF, 0x02, 0xAA, 0xBB))
    data = first + second + bytes((0xD0 | len(noted),)) + noted + padded + b"\xd3\x8a\x71\x04"
    schema = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.StringType())])
    values = [dict(v) for v in B.BinaryReader(data).values()]
    assert values == [{"a": 1}, {"b": 2, "a": 3}, {"b": 9}, {"b": 7}, {"b": "name"}]
    got = pa.Table.from_batches(ColumnReader(data, schema, [pa.int64(), pa.string()], False).batches()).to_pylist()
    assert got == [{"a": v.get("a"), "b": coerce(v["b"], T.StringType()) if "b" in v else None} for v in values]


@pytest.mark.parametrize("data", [B.MARK + b"\xde\x90", B.MARK + b"\xd5\x84\x21", B.MARK + b"\xd3\x84\x25\x01", B.MARK + b"\x21\x01", B.MARK + b"\xd3\xff\x21\x01", b"\xe0\x02\x00\xea", B.MARK + b"\xd2\x84\x8e"])
def test_faults(data):
    with pytest.raises(IonError):
        list(ColumnReader(data, T.StructType([T.StructField("name", T.StringType())]), [pa.string()], False).batches())


def test_chunks(monkeypatch):
    from grainstone.sources import ioncolumns

    monkeypatch.setattr(ioncolumns, "ROWS", 7)
    rows = [Struct([("name", str(i)), ("version", i)]) for i in range(100)]
    schema = T.StructType([T.StructField("version", T.LongType())])
    reader = ColumnReader(B.dumps(rows), schema, [pa.int64()], False)
    sizes = [b.num_rows for b in reader.batches()]
    assert sum(sizes) == 100 and max(sizes) == 7
