"""Ion 1.0 binary: a reader that passes over what isn't asked for, and a writer."""

from __future__ import annotations

import datetime as dt
import struct
from collections.abc import Iterator
from decimal import Decimal

from .iontext import SYSTEM_SYMBOLS
from .values import DAY, MINUTE, MONTH, SECOND, YEAR, IonError, Sexp, Struct, Timestamp

MARK = b"\xe0\x01\x00\xea"


class BinaryReader:
    """Top-level values of binary Ion. With `wanted`, fields of top-level structs that it
    doesn't name are passed over by their lengths, and no struct is entered if it is empty."""

    def __init__(self, data: bytes, wanted: frozenset[str] | None = None):
        self.data, self.wanted = data, wanted
        self.symbols: list[str | None] = list(SYSTEM_SYMBOLS)

    def values(self) -> Iterator[object]:
        data, at, size = self.data, 0, len(self.data)
        while at < size:
            if data[at] == 0xE0:
                if data[at : at + 4] != MARK:
                    raise IonError("version of binary Ion is not known")
                self.symbols = list(SYSTEM_SYMBOLS)
                at += 4
                continue
            kind, low, start, end = self._head(at)
            if end > size:
                raise IonError("value is cut off")
            at = end
            if kind == 0 and low != 15:
                continue
            if kind == 14:
                notes, inner = self._annotations(start)
                k, n, s, e = self._head(inner)
                if notes and notes[0] == "$ion_symbol_table" and k == 13:
                    self._table(dict(self._struct(s, e, n) if n != 15 else Struct()))
                    continue
                kind, low, start, end = k, n, s, e
            if kind == 13 and low != 15:
                yield self._struct(start, end, low, self.wanted)
            else:
                yield self._read(kind, low, start, end)

    def _table(self, fields: dict) -> None:
        if fields.get("imports") != "$ion_symbol_table":
            self.symbols = list(SYSTEM_SYMBOLS)
        self.symbols += [s if isinstance(s, str) else None for s in fields.get("symbols") or ()]

    def _varuint(self, at: int) -> tuple[int, int]:
        value = 0
        while True:
            try:
                b = self.data[at]
            except IndexError as e:
                raise IonError("value is cut off") from e
            at += 1
            value = value << 7 | b & 0x7F
            if b & 0x80:
                return value, at

    def _varint(self, at: int) -> tuple[int, int, bool]:
        """The number, the place after it, and whether its sign is minus (-0 too)."""
        b = self.data[at]
        minus, value = bool(b & 0x40), b & 0x3F
        at += 1
        while not b & 0x80:
            b = self.data[at]
            at += 1
            value = value << 7 | b & 0x7F
        return -value if minus else value, at, minus

    def _head(self, at: int) -> tuple[int, int, int, int]:
        b = self.data[at]
        kind, low = b >> 4, b & 15
        at += 1
        if low == 15 or kind == 1:
            return kind, low, at, at
        if low == 14 or (kind == 13 and low == 1):
            n, at = self._varuint(at)
            return kind, low, at, at + n
        return kind, low, at, at + low

    def _annotations(self, at: int) -> tuple[list[str | None], int]:
        n, at = self._varuint(at)
        stop, notes = at + n, []
        while at < stop:
            sid, at = self._varuint(at)
            notes.append(self._symbol(sid))
        return notes, stop

    def _symbol(self, sid: int) -> str | None:
        if sid > len(self.symbols):
            raise IonError(f"symbol ${sid} is not in the table")
        return self.symbols[sid - 1] if sid else None

    def _struct(self, at: int, end: int, low: int, wanted: frozenset[str] | None = None) -> Struct:
        out, symbols = Struct(), self.symbols
        if wanted is not None and not wanted:
            return out
        while at < end:
            sid, at = self._varuint(at)
            name = symbols[sid - 1] if 0 < sid <= len(symbols) else self._symbol(sid)
            kind, n, start, stop = self._head(at)
            if stop > end:
                raise IonError("field is longer than its struct")
            at = stop
            if kind == 0 and n != 15 or wanted is not None and name not in wanted:
                continue
            out.append((name, self._read(kind, n, start, stop)))
        return out

    def _read(self, kind: int, low: int, at: int, end: int):
        data = self.data
        if kind == 14:
            _, inner = self._annotations(at)
            return self._read(*self._head(inner))
        if low == 15:
            return None
        if kind == 8:
            return data[at:end].decode("utf-8")
        if kind == 2:
            return int.from_bytes(data[at:end], "big")
        if kind == 3:
            return -int.from_bytes(data[at:end], "big")
        if kind == 1:
            if low > 1:
                raise IonError("bool is neither 0 nor 1")
            return low == 1
        if kind == 4:
            if end - at not in (0, 4, 8):
                raise IonError("float of a size that is not known")
            return struct.unpack(">d" if end - at == 8 else ">f", data[at:end])[0] if end > at else 0.0
        if kind == 5:
            if at == end:
                return Decimal("0")
            power, at, _ = self._varint(at)
            return self._decimal(power, at, end)
        if kind == 6:
            return self._timestamp(at, end)
        if kind == 7:
            return self._symbol(int.from_bytes(data[at:end], "big"))
        if kind == 9:
            return data[at:end].decode("utf-8", "replace")
        if kind == 10:
            return data[at:end]
        if kind in (11, 12):
            out = [] if kind == 11 else Sexp()
            while at < end:
                k, n, s, e = self._head(at)
                at = e
                if k or n == 15:
                    out.append(self._read(k, n, s, e))
            return out
        if kind == 13:
            return self._struct(at, end, low)
        raise IonError(f"type code {kind} is not known")

    def _decimal(self, power: int, at: int, end: int) -> Decimal:
        part = self.data[at:end]
        if not part:
            return Decimal((0, (0,), power))
        minus = part[0] & 0x80
        n = int.from_bytes(bytes((part[0] & 0x7F,)) + part[1:], "big")
        return Decimal((1 if minus else 0, tuple(map(int, str(n))), power))

    def _timestamp(self, at: int, end: int) -> Timestamp:
        offset, at, minus = self._varint(at)
        known = not (minus and offset == 0)
        parts = []
        while at < end and len(parts) < 6:
            v, at = self._varuint(at)
            parts.append(v)
        precision = {1: YEAR, 2: MONTH, 3: DAY, 5: MINUTE, 6: SECOND}.get(len(parts))
        if precision is None:
            raise IonError("timestamp of a precision that is not known")
        fraction = ""
        if at < end:
            power, at, _ = self._varint(at)
            value = self._decimal(power, at, end)
            if value:
                fraction = f"{value:f}".partition(".")[2]
            else:
                fraction = "0" * max(-power, 0)
        if precision >= MINUTE:
            local = dt.datetime(*(parts + [0])[:6]) + dt.timedelta(minutes=offset)
            parts = [local.year, local.month, local.day, local.hour, local.minute, local.second]
        return Timestamp(precision, *parts[:6], fraction=fraction, offset=(offset if known else None) if precision >= MINUTE else None)


# -- writing --------------------------------------------------------------------------


def varuint(n: int) -> bytes:
    out = [n & 0x7F | 0x80]
    n >>= 7
    while n:
        out.append(n & 0x7F)
        n >>= 7
    return bytes(reversed(out))


def varint(n: int, minus_zero: bool = False) -> bytes:
    minus, n = n < 0 or minus_zero, abs(n)
    out = [n & 0x7F]
    n >>= 7
    while n:
        out.append(n & 0x7F)
        n >>= 7
    if out[-1] & 0x40:
        out.append(0)
    out[0] |= 0x80
    if minus:
        out[-1] |= 0x40
    return bytes(reversed(out))


def signed(n: int, minus_zero: bool = False) -> bytes:
    """Sign and magnitude; nothing for 0."""
    if not n:
        return b"\x80" if minus_zero else b""
    size = (abs(n).bit_length() + 8) // 8
    out = bytearray(abs(n).to_bytes(size, "big"))
    if n < 0:
        out[0] |= 0x80
    return bytes(out)


def tagged(kind: int, body: bytes) -> bytes:
    n = len(body)
    if n < 14:
        return bytes((kind << 4 | n,)) + body
    return bytes((kind << 4 | 14,)) + varuint(n) + body


def encode_int(n: int) -> bytes:
    return tagged(2 if n >= 0 else 3, abs(n).to_bytes((n.bit_length() + 7) // 8, "big"))


def encode_decimal(d: Decimal) -> bytes:
    sign, digits, power = d.as_tuple()
    n = int("".join(map(str, digits)) or 0)
    if not n and not sign and not power:
        return b"\x50"
    return tagged(5, varint(power) + signed(-n if sign else n, bool(sign and not n)))


def encode_timestamp(t: Timestamp) -> bytes:
    if t.precision < MINUTE:
        return tagged(6, b"\xc0" + b"".join(varuint(x) for x in (t.year, t.month, t.day)[: t.precision]))
    utc = dt.datetime(t.year, t.month, t.day, t.hour, t.minute, t.second) - dt.timedelta(minutes=t.offset or 0)
    parts = [utc.year, utc.month, utc.day, utc.hour, utc.minute] + ([utc.second] if t.precision == SECOND else [])
    body = (varint(0, True) if t.offset is None else varint(t.offset)) + b"".join(map(varuint, parts))
    if t.fraction:
        body += varint(-len(t.fraction)) + signed(int(t.fraction))
    return tagged(6, body)


class Symbols:
    """A local symbol table that grows as names come."""

    def __init__(self):
        self.ids = {s: i + 1 for i, s in enumerate(SYSTEM_SYMBOLS)}
        self.new: list[str] = []

    def sid(self, name: str) -> int:
        got = self.ids.get(name)
        if got is None:
            got = self.ids[name] = len(self.ids) + 1
            self.new.append(name)
        return got

    def table(self, append: bool) -> bytes:
        """The annotated struct that adds the new names, and forgets that they are new."""
        if not self.new:
            return b""
        body = b"".join(tagged(8, s.encode()) for s in self.new)
        fields = (varuint(6) + b"\x71\x03" if append else b"") + varuint(7) + tagged(11, body)
        self.new = []
        return tagged(14, b"\x81\x83" + tagged(13, fields))


def encode(value, symbols: Symbols) -> bytes:
    """A value as the readers give them."""
    if value is None:
        return b"\x0f"
    if value is True or value is False:
        return b"\x11" if value else b"\x10"
    if isinstance(value, int):
        return encode_int(value)
    if isinstance(value, str):
        return tagged(8, value.encode())
    if isinstance(value, float):
        return b"\x48" + struct.pack(">d", value) if value or str(value)[0] == "-" else b"\x40"
    if isinstance(value, Decimal):
        return encode_decimal(value)
    if isinstance(value, Timestamp):
        return encode_timestamp(value)
    if isinstance(value, (bytes, bytearray)):
        return tagged(10, bytes(value))
    if isinstance(value, Struct):
        return tagged(13, b"".join(varuint(symbols.sid(k) if k is not None else 0) + encode(v, symbols) for k, v in value))
    if isinstance(value, list):
        return tagged(12 if isinstance(value, Sexp) else 11, b"".join(encode(v, symbols) for v in value))
    raise TypeError(f"{type(value).__name__} is no Ion value")


def dumps(values) -> bytes:
    """A whole stream: version mark, symbol table, values."""
    symbols = Symbols()
    body = b"".join(encode(v, symbols) for v in values)
    return MARK + symbols.table(False) + body


def transcode(text: str) -> bytes:
    """Ion text as binary Ion."""
    from .iontext import TextReader

    return dumps(TextReader(text).values())
