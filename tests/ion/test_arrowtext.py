"""Ion text of whole columns against the text of single values."""

import datetime as dt
import random
from decimal import Decimal

import pyarrow as pa
import pytest

from grainstone.functions.arrowtext import float_text, ion_texts, row_texts
from grainstone.functions.sql import literal

KINDS = [
    pa.int64(), pa.int8(), pa.float64(), pa.float32(), pa.bool_(), pa.string(), pa.large_string(), pa.binary(), pa.decimal128(18, 3), pa.date32(), pa.timestamp("us"), pa.timestamp("us", tz="UTC"), pa.null(),
    pa.list_(pa.int64()), pa.list_(pa.list_(pa.string())), pa.struct([("x", pa.string()), ("odd name", pa.list_(pa.float64()))]), pa.map_(pa.string(), pa.int64()), pa.struct([]),
]


def one(rng, kind, nulls=0.2):
    if rng.random() < nulls or pa.types.is_null(kind):
        return None
    if pa.types.is_integer(kind):
        return rng.choice([0, 1, -1, 127, -128])
    if pa.types.is_floating(kind):
        return rng.choice([0.0, -0.0, 1.5, 100.0, 1e-3, 9.99e-4, 1e-4, 9e-5, 1e7, 9999999.0, 1e15, 1e16, -2.25e22, float("inf"), float("-inf"), float("nan"), rng.random(), rng.random() * 1e6, 0.1 + 0.2])
    if pa.types.is_boolean(kind):
        return rng.random() < 0.5
    if pa.types.is_string(kind) or pa.types.is_large_string(kind):
        return rng.choice(["", "a", 'q"\\\n\r\t', "é😀", "null"])
    if pa.types.is_binary(kind):
        return bytes(rng.randint(0, 9))
    if pa.types.is_decimal(kind):
        return Decimal(rng.choice(["0.000", "1.500", "-0.001", "123456789.125"]))
    if pa.types.is_date(kind):
        return rng.choice([dt.date(1970, 1, 1), dt.date(1000, 2, 3), dt.date(9999, 12, 31)])
    if pa.types.is_timestamp(kind):
        at = rng.choice([dt.datetime(1970, 1, 1), dt.datetime(1969, 12, 31, 23, 59, 59, 999999), dt.datetime(2024, 2, 29, 1, 2, 3, 500000), dt.datetime(2024, 2, 29, 10, 20, 30), dt.datetime(999, 1, 1)])
        return at.replace(tzinfo=dt.timezone.utc) if kind.tz else at
    if pa.types.is_list(kind):
        return [one(rng, kind.value_type, nulls) for _ in range(rng.randint(0, 4))]
    if pa.types.is_struct(kind):
        return {f.name: one(rng, f.type, nulls) for f in kind}
    return [(f"k{i}", one(rng, kind.item_type, nulls)) for i in range(rng.randint(0, 3))]


@pytest.mark.parametrize("kind", KINDS, ids=str)
def test_equals_single_values(kind):
    rng = random.Random(str(kind))
    for n, nulls in ((0, 0), (1, 0), (1, 1), (60, 0.2), (60, 0)):
        values = pa.array([one(rng, kind, nulls) for _ in range(n + 4)], kind).slice(2, n)
        assert ion_texts(values, literal).to_pylist() == [literal(v, kind) for v in values.to_pylist()]


def test_floats_are_reprs():
    rng = random.Random(1)
    values = [rng.uniform(-1, 1) * 10 ** rng.randint(-8, 18) for _ in range(20000)] + [float(i) for i in range(1000)] + [None]
    assert float_text(pa.array(values)).to_pylist() == [None if v is None else repr(v) for v in values]


def test_rows():
    batch = pa.RecordBatch.from_pylist([{"a": 1, "b c": "x"}, {"a": None, "b c": None}])
    assert row_texts(batch, literal).to_pylist() == ["{a: 1, 'b c': \"x\"}", "{a: null, 'b c': null}"]
