"""Binary Ion from Arrow columns, whole batches at a time.

Each column is laid out as a node that knows how many bytes each of its rows takes and can
put them at given places of a buffer. A struct's size is that of its fields with their names,
a list's that of its items, so a batch is sized from the leaves up and filled from the top
down, with a numpy step for each byte of a field instead of a Python step for each value.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa

from .ionbinary import Symbols, varint, varuint

#: Type codes.
BOOL, POSITIVE, NEGATIVE, FLOAT, DECIMAL, TIMESTAMP, STRING, BLOB, LIST, STRUCT = 1, 2, 3, 4, 5, 6, 8, 10, 11, 13


class Short:
    """Rows of few bytes: a table of them, from the left."""

    def __init__(self, table: np.ndarray, size: np.ndarray):
        self.table, self.size = table, size

    def put(self, out: np.ndarray, at: np.ndarray) -> None:
        for j in range(self.table.shape[1]):
            live = self.size > j
            if live.all():
                out[at + j] = self.table[:, j]
            else:
                out[at[live] + j] = self.table[live, j]


def _head(kind: int, n: np.ndarray) -> Short:
    """Heads of values of n bytes."""
    groups = 1 + sum((n >= 1 << 7 * k).astype(np.int64) for k in range(1, 6))
    size = np.where(n < 14, 1, 1 + groups)
    table = np.zeros((len(n), int(size.max(initial=1))), np.uint8)
    table[:, 0] = kind << 4 | np.minimum(n, 14)
    for j in range(1, table.shape[1]):
        live = size > j
        left = np.maximum(groups - j, 0)
        byte = n >> 7 * left & 0x7F | np.where(left == 0, 0x80, 0)
        table[live, j] = byte[live]
    return Short(table, size)


class Long:
    """Rows of a head and a run of bytes."""

    def __init__(self, kind: int, data: np.ndarray, ends: np.ndarray):
        self.data, self.length = data, np.diff(ends)
        self.first = ends[:-1].astype(np.int64)
        self.head = _head(kind, self.length.astype(np.int64))
        self.size = self.head.size + self.length

    def put(self, out: np.ndarray, at: np.ndarray) -> None:
        self.head.put(out, at)
        _copy(out, at + self.head.size, self.data, self.first, self.length)


def _copy(out: np.ndarray, at: np.ndarray, data: np.ndarray, first: np.ndarray, length: np.ndarray) -> None:
    before = np.cumsum(length) - length
    run = np.arange(int(length.sum()))
    out[np.repeat(at - before, length) + run] = data[np.repeat(first - before, length) + run]


class Raw:
    """Rows that are encoded already."""

    def __init__(self, rows: list[bytes]):
        self.data = np.frombuffer(b"".join(rows), np.uint8)
        self.size = np.fromiter(map(len, rows), np.int64, len(rows))

    def put(self, out: np.ndarray, at: np.ndarray) -> None:
        _copy(out, at, self.data, np.cumsum(self.size) - self.size, self.size)


class Fields:
    """Structs of columns, none of them null."""

    def __init__(self, rows: int, names: list[bytes], columns: list):
        self.names, self.columns = names, columns
        body = np.zeros(rows, np.int64)
        for name, c in zip(names, columns):
            body += len(name) + c.size
        self.head = _head(STRUCT, body)
        self.size = self.head.size + body

    def put(self, out: np.ndarray, at: np.ndarray) -> None:
        self.head.put(out, at)
        at = at + self.head.size
        for name, c in zip(self.names, self.columns):
            for j, byte in enumerate(name):
                out[at + j] = byte
            c.put(out, at + len(name))
            at = at + len(name) + c.size


class Items:
    """Lists of items, none of them null."""

    def __init__(self, items, lengths: np.ndarray):
        self.items, self.lengths = items, lengths
        total = np.concatenate([[0], np.cumsum(items.size)])
        ends = np.cumsum(lengths)
        body = total[ends] - total[ends - lengths]
        self.head = _head(LIST, body)
        self.size = self.head.size + body

    def put(self, out: np.ndarray, at: np.ndarray) -> None:
        self.head.put(out, at)
        own = self.items.size
        before = np.cumsum(own) - own
        first = np.cumsum(self.lengths) - self.lengths
        begin = np.concatenate([before, [0]])[np.minimum(first, len(before))]
        self.items.put(out, np.repeat(at + self.head.size - begin, self.lengths) + before)


class Nullable:
    """A node of the rows that aren't null, among those that are."""

    def __init__(self, node, valid: np.ndarray, null: int):
        self.node, self.valid, self.null = node, valid, null
        self.size = np.ones(len(valid), np.int64)
        self.size[valid] = node.size

    def put(self, out: np.ndarray, at: np.ndarray) -> None:
        self.node.put(out, at[self.valid])
        out[at[~self.valid]] = self.null


def to_bytes(node) -> bytes:
    """The rows one after another."""
    ends = np.cumsum(node.size)
    out = np.empty(int(ends[-1]) if len(ends) else 0, np.uint8)
    node.put(out, ends - node.size)
    return out.tobytes()


# -- columns ------------------------------------------------------------------------------


def _big(table: np.ndarray, at: int, value: np.ndarray, size: np.ndarray) -> None:
    """The last `size` bytes of each value, from column `at` of the table on."""
    for j in range(int(size.max(initial=0))):
        shift = np.maximum(size - 1 - j, 0).astype(np.uint64) * np.uint64(8)
        table[:, at + j] = value >> shift & np.uint64(0xFF)


def _magnitude(value: np.ndarray) -> np.ndarray:
    return np.where(value < 0, ~value.astype(np.uint64) + np.uint64(1), value.astype(np.uint64))


def _whole(value: np.ndarray) -> Short:
    size_of = _magnitude(value.astype(np.int64))
    size = sum((size_of >= np.uint64(1 << 8 * k)).astype(np.int64) for k in range(8))
    table = np.zeros((len(value), 1 + int(size.max(initial=0))), np.uint8)
    table[:, 0] = np.where(value < 0, NEGATIVE, POSITIVE) << 4 | size
    _big(table, 1, size_of, size)
    return Short(table, size + 1)


def _signed(value: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Magnitudes and sizes with room for the sign, and the sign's bit; 0 has no bytes."""
    size_of = _magnitude(value)
    size = np.where(value == 0, 0, 1 + sum((size_of >= np.uint64(1 << 8 * k - 1)).astype(np.int64) for k in range(1, 9)))
    return size_of, size, np.where(value < 0, 0x80, 0).astype(np.uint8)


def _floats(value: np.ndarray, form: str, low: int) -> Short:
    n = np.dtype(form).itemsize
    table = np.empty((len(value), 1 + n), np.uint8)
    table[:, 0] = FLOAT << 4 | low
    table[:, 1:] = value.astype(form).view(np.uint8).reshape(-1, n)
    return Short(table, np.full(len(value), 1 + n))


def _decimals(value: np.ndarray, scale: int) -> Short:
    """Coefficients of one scale."""
    power = varint(-scale)
    size_of, n, sign = _signed(value)
    table = np.zeros((len(value), 1 + len(power) + int(n.max(initial=0))), np.uint8)
    for j, byte in enumerate(power):
        table[:, 1 + j] = byte
    _big(table, 1 + len(power), size_of, n)
    some = n > 0
    if some.any():
        table[some, 1 + len(power)] |= sign[some]
    body = len(power) + n
    if not scale:
        body = np.where(some, body, 0)
    table[:, 0] = DECIMAL << 4 | body
    return Short(table, 1 + body)


def _days(days: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    date = days.astype("datetime64[D]")
    month = date.astype("datetime64[M]")
    years = month.astype("datetime64[Y]").astype(np.int64) + 1970
    return years, month.astype(np.int64) % 12 + 1, (date - month.astype("datetime64[D]")).astype(np.int64) + 1


def _date_bytes(table: np.ndarray, years: np.ndarray, *parts: np.ndarray) -> None:
    table[:, 2], table[:, 3] = years >> 7, years & 0x7F | 0x80
    for j, p in enumerate(parts):
        table[:, 4 + j] = p | 0x80


def _dates(days: np.ndarray) -> Short | None:
    years, month, day = _days(days)
    if ((years < 128) | (years > 9999)).any():
        return None
    table = np.zeros((len(days), 6), np.uint8)
    table[:, 0], table[:, 1] = TIMESTAMP << 4 | 5, 0xC0
    _date_bytes(table, years, month, day)
    return Short(table, np.full(len(days), 6))


def _timestamps(micros: np.ndarray) -> Short | None:
    second, fraction = np.divmod(micros, 1_000_000)
    days, second = np.divmod(second, 86400)
    years, month, day = _days(days)
    if ((years < 128) | (years > 9999)).any():
        return None
    size_of, n, _ = _signed(fraction)
    some = fraction > 0
    table = np.zeros((len(micros), 9 + (1 + int(n.max(initial=0)) if some.any() else 0)), np.uint8)
    _date_bytes(table, years, month, day, second // 3600, second // 60 % 60, second % 60)
    body = np.where(some, 9 + n, 8)
    table[:, 0], table[:, 1] = TIMESTAMP << 4 | body, 0x80
    if some.any():
        table[:, 9] = varint(-6)[0]
        _big(table, 10, size_of, n)
    return Short(table, 1 + body)


def _numbers(column: pa.Array, form: type) -> np.ndarray:
    """The buffer of a column of fixed width, without copying."""
    width = np.dtype(form).itemsize
    return np.frombuffer(column.buffers()[1], form, len(column), column.offset * width) if len(column) else np.zeros(0, form)


#: Codes of typed nulls.
_NULLS: list[tuple[Callable, int]] = [
    (pa.types.is_boolean, BOOL), (pa.types.is_integer, POSITIVE), (pa.types.is_floating, FLOAT), (pa.types.is_decimal, DECIMAL), (pa.types.is_date, TIMESTAMP), (pa.types.is_timestamp, TIMESTAMP),
    (pa.types.is_string, STRING), (pa.types.is_large_string, STRING), (pa.types.is_binary, BLOB), (pa.types.is_large_binary, BLOB), (pa.types.is_list, LIST), (pa.types.is_struct, STRUCT),
]


def node(column: pa.Array, symbols: Symbols, encode: Callable[[pa.DataType], Callable]):
    """A column's node. encode gives a function for single values of a type, for what has
    no form of its own here."""
    if column.null_count:
        code = next((n for test, n in _NULLS if test(column.type)), 0)
        return Nullable(node(column.drop_null(), symbols, encode), column.is_valid().to_numpy(zero_copy_only=False), code << 4 | 15)
    kind, own = column.type, None
    if pa.types.is_boolean(kind):
        table = np.where(column.to_numpy(zero_copy_only=False), 0x11, 0x10).astype(np.uint8)[:, None]
        own = Short(table, np.ones(len(table), np.int64))
    elif pa.types.is_signed_integer(kind):
        own = _whole(column.to_numpy(zero_copy_only=False).astype(np.int64))
    elif pa.types.is_float64(kind):
        own = _floats(column.to_numpy(zero_copy_only=False), ">f8", 8)
    elif pa.types.is_float32(kind):
        own = _floats(column.to_numpy(zero_copy_only=False), ">f4", 4)
    elif pa.types.is_decimal128(kind) and kind.precision <= 18 and 0 <= kind.scale:
        words = np.frombuffer(column.buffers()[1], np.int64, 2 * len(column), column.offset * 16) if len(column) else np.zeros(0, np.int64)
        own = _decimals(words[::2], kind.scale)
    elif pa.types.is_date32(kind):
        own = _dates(_numbers(column, np.int32))
    elif pa.types.is_timestamp(kind) and kind.unit == "us":
        own = _timestamps(_numbers(column, np.int64))
    elif pa.types.is_string(kind) or pa.types.is_large_string(kind) or pa.types.is_binary(kind) or pa.types.is_large_binary(kind):
        code = STRING if "string" in str(kind) else BLOB
        form = np.int64 if "large" in str(kind) else np.int32
        _, ends, data = column.buffers()
        if len(column):
            own = Long(code, np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8), np.frombuffer(ends, form, len(column) + 1, column.offset * np.dtype(form).itemsize))
    elif pa.types.is_struct(kind):
        names = [varuint(symbols.sid(f.name)) for f in kind]
        own = Fields(len(column), names, [node(c, symbols, encode) for c in column.flatten()])
    elif (pa.types.is_list(kind) or pa.types.is_large_list(kind)) and len(column):
        own = Items(node(column.flatten(), symbols, encode), column.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64))
    if own is None:
        one = encode(kind)
        own = Raw([one(v) for v in column.to_pylist()])
    return own


def rows(batch: pa.RecordBatch, symbols: Symbols, encode: Callable[[pa.DataType], Callable]) -> bytes:
    """The batch's rows as structs, one after another."""
    names = [varuint(symbols.sid(n)) for n in batch.schema.names]
    return to_bytes(Fields(batch.num_rows, names, [node(c, symbols, encode) for c in batch.columns]))
