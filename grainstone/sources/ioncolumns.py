"""Binary Ion by columns: batches of rows without a Python step for each field.

Rows are found by their lengths. Then all rows of a chunk step through their fields at once:
each step reads the next field's name and head in every row that has one, notes where the
wanted ones lie, and goes on by the lengths. A column's places are decoded together for the
forms that its type mostly comes in; a column with any other form goes through the cursor.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import types as T

from ..operators.coerce import coerce
from ..plans.types import is_json
from .ionbinary import MARK, BinaryReader
from .iontext import SYSTEM_SYMBOLS
from .values import IonError

#: Rows, and bytes of rows, that are stepped through at once.
ROWS, BYTES = 1 << 16, 16 << 20
_NOT_LIST = "with format='array' a file has to begin with a list"
_NOT_RECORD = "records have to be structs"
_WHOLE = {T.ByteType: 8, T.ShortType: 16, T.IntegerType: 32, T.LongType: 64}


class Places:
    """Where a column's values lie: for each row its type code, low nibble, begin and end."""

    def __init__(self, rows: int):
        self.kind = np.full(rows, -1, np.int8)
        self.low = np.zeros(rows, np.int8)
        self.at = np.zeros(rows, np.int64)
        self.end = np.zeros(rows, np.int64)

    def put(self, rows, kind, low, at, end) -> None:
        self.kind[rows], self.low[rows], self.at[rows], self.end[rows] = kind, low, at, end


class ColumnReader(BinaryReader):
    """Record batches of the structs of one file."""

    def __init__(self, data: bytes, schema: T.StructType, kinds: list[pa.DataType], listed: bool):
        super().__init__(data)
        self.bytes = np.frombuffer(data, np.uint8)
        self.schema, self.kinds, self.listed = schema, kinds, listed

    def batches(self) -> Iterator[pa.RecordBatch]:
        for starts, stops in self._rows():
            starts, stops = np.array(starts, np.int64), np.array(stops, np.int64)
            if not len(self.schema):
                yield pa.RecordBatch.from_arrays([pa.nulls(len(starts), pa.bool_())], ["__none"])
                continue
            try:
                places = self._fields(starts, stops)
                columns = [self._column(p, f.dataType, k) for p, f, k in zip(places, self.schema, self.kinds)]
            except IndexError as e:
                raise IonError("value is cut off") from e
            yield pa.RecordBatch.from_arrays(columns, self.schema.names)

    def _rows(self) -> Iterator[tuple[list[int], list[int]]]:
        """Begins and ends of the structs' bodies, in chunks in which the symbols stay the
        same. A null is an empty struct."""
        data, at, size = self.data, 0, len(self.data)
        inside = False
        starts: list[int] = []
        stops: list[int] = []
        done = 0
        while at < size:
            b = data[at]
            if 0xD1 < b < 0xDE or b == 0xD0:
                starts.append(at + 1)
                at += 1 + (b & 15)
                stops.append(at)
            elif b == 0xDE or b == 0xD1:
                n, at = self._varuint(at + 1)
                starts.append(at)
                at += n
                stops.append(at)
            elif b == 0xE0 and not inside:
                if data[at : at + 4] != MARK:
                    raise IonError("version of binary Ion is not known")
                if starts:
                    yield starts, stops
                    starts, stops = [], []
                self.symbols = list(SYSTEM_SYMBOLS)
                at += 4
                done = at
                continue
            else:
                kind, low, begin, end = self._head(at)
                if end > size:
                    raise IonError("value is cut off")
                if kind == 0 and low != 15:
                    at = end
                    continue
                if kind == 14:
                    notes, inner = self._annotations(begin)
                    k, n, s, e = self._head(inner)
                    if not inside and notes and notes[0] == "$ion_symbol_table" and k == 13:
                        if starts:
                            yield starts, stops
                            starts, stops = [], []
                        self._table(dict(self._struct(s, e, n)) if n != 15 else {})
                        at = done = end
                        continue
                    kind, low, begin, after = k, n, s, e
                else:
                    after = end
                if self.listed and not inside:
                    if kind != 11 or low == 15:
                        raise IonError(_NOT_LIST)
                    at, size, inside = begin, after, True
                    done = at
                    continue
                if low == 15:
                    begin = after = 0
                elif kind != 13:
                    raise IonError(_NOT_RECORD)
                starts.append(begin)
                stops.append(after)
                at = end
            if at > size:
                raise IonError("value is cut off")
            if self.listed and not inside:
                raise IonError(_NOT_LIST)
            if len(starts) >= ROWS or at - done >= BYTES:
                yield starts, stops
                starts, stops = [], []
                done = at
        if starts:
            yield starts, stops

    def _varuints(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The numbers at these places and the places after them."""
        byte = self.bytes[at]
        value, at = (byte & 0x7F).astype(np.int64), at + 1
        more = np.flatnonzero(byte < 0x80)
        while len(more):
            byte = self.bytes[at[more]]
            if (value[more] >> 40).any():
                raise IonError("number is too large")
            value[more] = value[more] << 7 | (byte & 0x7F)
            at[more] += 1
            more = more[byte < 0x80]
        return value, at

    def _fields(self, starts: np.ndarray, stops: np.ndarray) -> list[Places]:
        """The places of each column of the schema."""
        names = self.schema.names
        out = [Places(len(starts)) for _ in names]
        column_of = np.full(len(self.symbols) + 1, -1, np.int64)
        for i, name in enumerate(names):
            for sid, symbol in enumerate(self.symbols, 1):
                if symbol == name:
                    column_of[sid] = i
        live = np.flatnonzero(starts < stops)
        pos, stop = starts[live], stops[live]
        while len(live):
            sid, at = self._varuints(pos)
            head = self.bytes[at]
            kind, low = head >> 4, head & 15
            at = at + 1
            size = low.astype(np.int64)
            size[(low == 15) | (kind == 1)] = 0
            long = np.flatnonzero((low == 14) & (kind != 1) | (head == 0xD1))
            if len(long):
                size[long], at[long] = self._varuints(at[long])
            end = at + size
            if (end > stop).any():
                raise IonError("field is longer than its struct")
            if (sid > len(self.symbols)).any():
                raise IonError(f"symbol ${int(sid.max())} is not in the table")
            column = column_of[sid]
            column[(low == 15) | (kind == 0)] = -1
            first = int(column[0])
            if (column == first).all():
                found = [(first, slice(None))] if first >= 0 else []
            else:
                found = [(int(c), column == c) for c in np.unique(column[column >= 0])]
            noted = (kind == 14) & (column >= 0)
            for c, own in found:
                if noted.any():
                    own = ~noted if isinstance(own, slice) else own & ~noted
                out[c].put(live[own], kind[own], low[own], at[own], end[own])
            for i in np.flatnonzero(noted).tolist():
                k, n, s, e = self._head(self._annotations(int(at[i]))[1])
                if n != 15:
                    out[column[i]].put(live[i], k, n, s, e)
            rest = end < stop
            if rest.all():
                pos = end
            else:
                live, pos, stop = live[rest], end[rest], stop[rest]
        return out

    # -- columns ----------------------------------------------------------------------

    def _column(self, p: Places, want: T.DataType, arrow: pa.DataType) -> pa.Array:
        have = p.kind >= 0
        if not have.any():
            return pa.nulls(len(have), arrow)
        rows = slice(None) if have.all() else np.flatnonzero(have)
        own = p.kind[rows], p.low[rows], p.at[rows], p.end[rows]
        fast = None
        if type(want) in _WHOLE:
            fast = self._longs(*own, _WHOLE[type(want)])
        elif type(want) is T.DoubleType:
            fast = self._doubles(*own)
        elif type(want) is T.BooleanType and (own[0] == 1).all() and (own[1] <= 1).all():
            fast = own[1] == 1
        elif type(want) in (T.TimestampType, T.TimestampNTZType):
            fast = self._micros(*own)
        elif type(want) is T.StringType and not is_json(want):
            return self._strings(p, have, arrow) if (own[0] == 8).all() else self._slow(p, have, want, arrow)
        elif isinstance(want, T.DecimalType):
            parts = self._decimals(*own)
            if parts is not None and (unscaled := _scaled(*parts, want)) is not None:
                return _decimal128(_spread(unscaled, rows, len(have)), have, arrow)
        if fast is None:
            return self._slow(p, have, want, arrow)
        full = _spread(fast, rows, len(have))
        if pa.types.is_timestamp(arrow):
            return pa.array(full, pa.int64(), mask=~have).view(arrow)
        return pa.array(full, mask=~have).cast(arrow)

    def _slow(self, p: Places, have: np.ndarray, want: T.DataType, arrow: pa.DataType) -> pa.Array:
        out: list = [None] * len(have)
        kind, low, at, end = p.kind.tolist(), p.low.tolist(), p.at.tolist(), p.end.tolist()
        for i in np.flatnonzero(have).tolist():
            value = self._read(kind[i], low[i], at[i], end[i])
            out[i] = None if value is None else coerce(value, want)
        return pa.array(out, arrow)

    def _big(self, at: np.ndarray, size: np.ndarray, mask: int = 0xFF) -> np.ndarray:
        """Big-endian numbers of up to eight bytes; of the first byte the masked bits count."""
        value = np.zeros(len(at), np.uint64)
        last = len(self.bytes) - 1
        same = len(size) > 0 and bool((size == size[0]).all())
        for j in range(int(size.max()) if len(size) else 0):
            byte = self.bytes[at + j if same else np.minimum(at + j, last)].astype(np.uint64)
            if j == 0:
                byte &= np.uint64(mask)
            moved = value << np.uint64(8) | byte
            value = moved if same else np.where(j < size, moved, value)
        return value

    def _longs(self, kind, low, at, end, bits: int):
        if not ((kind == 2) | (kind == 3)).all() or (end - at > 8).any():
            return None
        value = self._big(at, end - at)
        if (value >= np.uint64(1) << np.uint64(bits - 1)).any():
            return None
        value = value.astype(np.int64)
        return np.where(kind == 3, -value, value) if (kind == 3).any() else value

    def _doubles(self, kind, low, at, end):
        out = np.zeros(len(kind))
        for k in np.unique(kind).tolist():
            own = slice(None) if (kind == k).all() else np.flatnonzero(kind == k)
            a, e = at[own], end[own]
            if k in (2, 3):
                value = self._longs(kind[own], low[own], a, e, 54)
            elif k == 4:
                value = self._floats(a, e - a)
            elif k == 5:
                parts = self._decimals(kind[own], low[own], a, e)
                value = None
                if parts is not None and (np.abs(parts[0]) < 1 << 53).all() and (parts[1] <= 0).all() and (parts[1] >= -22).all():
                    value = parts[0] / 10.0 ** -parts[1]  # both are exact, so the quotient is the nearest
                    if parts[2].any():
                        value = np.where(parts[2], -np.abs(value), value)
            else:
                return None
            if value is None:
                return None
            out[own] = value
        return out

    def _floats(self, at, size):
        out = np.zeros(len(at))
        for n, form in ((8, ">f8"), (4, ">f4")):
            own = np.flatnonzero(size == n)
            if len(own):
                out[own] = self.bytes[at[own][:, None] + np.arange(n)].view(form)[:, 0]
        return out if ((size == 0) | (size == 4) | (size == 8)).all() else None

    def _decimals(self, kind, low, at, end):
        """Coefficients, powers of ten and whether the sign is minus; None for wide ones."""
        if (kind == 2).all() or ((kind == 2) | (kind == 3)).all():
            value = self._longs(kind, low, at, end, 64)
            return None if value is None else (value, np.zeros(len(at), np.int64), np.zeros(len(at), bool))
        if not (kind == 5).all():
            return None
        size = end - at
        first = self.bytes[np.minimum(at, len(self.bytes) - 1)]
        some = size > 0
        if (size > 8).any() or (some & (first < 0x80)).any():
            return None
        power = np.where(some, (first & 0x3F).astype(np.int64), 0)
        power = np.where(some & (first & 0x40 > 0), -power, power)
        n = np.maximum(size - 1, 0)
        minus = (n > 0) & (self.bytes[np.minimum(at + 1, len(self.bytes) - 1)] >= 0x80)
        value = self._big(at + 1, n, 0x7F).astype(np.int64)
        return np.where(minus, -value, value), power, minus

    def _micros(self, kind, low, at, end):
        """Microseconds since 1970 of timestamps with seconds, at most six digits after them
        and an offset that takes one byte; None for others."""
        size = end - at
        if not (kind == 6).all() or (size < 8).any() or (size > 13).any():
            return None
        head = self.bytes[at[:, None] + np.arange(8)].astype(np.int64)
        if (head[:, 0] < 0x80).any() or (head[:, 1] >= 0x80).any() or (head[:, 2:] < 0x80).any():
            return None
        year = head[:, 1] << 7 | head[:, 2] & 0x7F
        month, day, hour, minute, second = (head[:, i] & 0x7F for i in range(3, 8))
        if (month < 1).any() or (month > 12).any() or (day < 1).any() or (year < 1).any():
            return None
        months = ((year - 1970) * 12 + month - 1).astype("datetime64[M]")
        days = months.astype("datetime64[D]").astype(np.int64) + day - 1
        if ((days.astype("datetime64[D]").astype("datetime64[M]") != months) | (hour > 23) | (minute > 59) | (second > 59)).any():
            return None
        micros = (days * 86400 + hour * 3600 + minute * 60 + second) * 1_000_000
        own = np.flatnonzero(size > 8)
        if len(own):
            power = self.bytes[at[own] + 8].astype(np.int64)
            digits = power & 0x3F
            if (power < 0xC0).any() or (digits > 6).any():
                return None
            fraction = self._big(at[own] + 9, size[own] - 9).astype(np.int64)
            if (fraction >= 10**digits).any():
                return None
            micros[own] += fraction * 10 ** (6 - digits)
        return micros

    def _strings(self, p: Places, have: np.ndarray, arrow: pa.DataType) -> pa.Array:
        size = np.where(have, p.end - p.at, 0)
        ends = np.cumsum(size)
        offsets = np.zeros(len(size) + 1, np.int32)
        offsets[1:] = ends
        index = np.repeat(p.at - offsets[:-1], size)
        index += np.arange(len(index))
        valid = None if have.all() else pa.array(have).buffers()[1]
        out = pa.Array.from_buffers(pa.string(), len(size), [valid, pa.py_buffer(offsets), pa.py_buffer(self.bytes[index])])
        out.validate(full=True)
        return out if arrow == out.type else out.cast(arrow)


def _spread(values: np.ndarray, rows, n: int) -> np.ndarray:
    if isinstance(rows, slice):
        return values
    out = np.zeros(n, values.dtype)
    out[rows] = values
    return out


def _scaled(value: np.ndarray, power: np.ndarray, minus: np.ndarray, want: T.DecimalType):
    """Coefficients at the type's scale, if none is rounded and all fit."""
    up = power + want.scale
    if (up < 0).any() or (up > 18).any():
        return None
    if (np.abs(value).astype(float) * 10.0**up >= min(9e18, 10.0**want.precision) * 0.999).any():
        return None
    return value * 10**up


def _decimal128(unscaled: np.ndarray, have: np.ndarray, arrow: pa.DataType) -> pa.Array:
    words = np.empty((len(unscaled), 2), np.int64)
    words[:, 0], words[:, 1] = unscaled, unscaled >> 63
    valid = None if have.all() else pa.array(have).buffers()[1]
    return pa.Array.from_buffers(arrow, len(unscaled), [valid, pa.py_buffer(words)])
