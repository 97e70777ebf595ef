"""Ion values to values of a column's type, and their text forms."""

from __future__ import annotations

import base64
import datetime as dt
import json
import math
import re
from decimal import ROUND_HALF_EVEN, ROUND_HALF_UP, Context, Decimal, InvalidOperation

from pyspark.sql import types as T

from ..plans.inference import kind_of
from ..plans.types import is_json, promote
from ..sources.values import IonError, Sexp, Struct, Timestamp

_WIDE = Context(prec=100)
_EPOCH = dt.datetime(1970, 1, 1)
_RANGES = {T.ByteType: 8, T.ShortType: 16, T.IntegerType: 32, T.LongType: 64}


def to_json(value) -> str:
    """JSON text, valid at every depth: separators ", " and ": ", floats with 17 digits."""
    if value is None:
        return "null"
    if value is True or value is False:
        return "true" if value else "false"
    if isinstance(value, int):
        return str(value)
    if isinstance(value, float):
        return f"{value:.17g}" if math.isfinite(value) else "null"
    if isinstance(value, Decimal):
        return decimal_text(value)
    if isinstance(value, Timestamp):
        return json.dumps(value.text())
    if isinstance(value, str):
        return json.dumps(value, ensure_ascii=False)
    if isinstance(value, bytes):
        return json.dumps(base64.b64encode(value).decode())
    if isinstance(value, Sexp):
        raise IonError("s-expressions can't be read as columns")
    if isinstance(value, Struct):
        return "{" + ", ".join(json.dumps(k or "", ensure_ascii=False) + ": " + to_json(v) for k, v in value) + "}"
    return "[" + ", ".join(map(to_json, value)) + "]"


def decimal_text(d: Decimal) -> str:
    """A decimal as Ion writes it, with e for d: plain, or a power that isn't in the digits."""
    sign, digits, power = d.as_tuple()
    n = "".join(map(str, digits))
    if power > 0:
        return f"{'-' if sign else ''}{n}e{power}"
    return f"{d:f}"


_PLAIN = re.compile(r"[^\s'\"(),:=\[\]{}\\][^'\"(),:=\[\]{}\\]*(?<!\s)")


def _nested(value, kind: T.DataType) -> str:
    text = show(value, kind)
    if isinstance(kind, (T.ArrayType, T.StructType, T.MapType)) or value is None:
        return text
    if isinstance(kind, T.StringType) and not (text and text.upper() != "NULL" and _PLAIN.fullmatch(text)):
        return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return f"'{text}'"
    return text


def show(value, kind: T.DataType) -> str:
    """A coerced value as a VARCHAR cast shows it."""
    if value is None:
        return "NULL"
    if isinstance(kind, T.StringType):
        return value
    if isinstance(kind, T.BooleanType):
        return "true" if value else "false"
    if isinstance(kind, T.DecimalType):
        return f"{value:.{kind.scale}f}"
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        return repr(value)
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        at = _EPOCH + dt.timedelta(microseconds=value)
        text = at.strftime("%Y-%m-%d %H:%M:%S").rjust(19, "0") + (f".{at.microsecond:06d}".rstrip("0") if at.microsecond else "")
        return text + ("+00" if isinstance(kind, T.TimestampType) else "")
    if isinstance(kind, T.BinaryType):
        return "".join(chr(b) if 32 <= b < 127 and b not in (34, 39, 92) else f"\\x{b:02X}" for b in value)
    if isinstance(kind, T.ArrayType):
        return "[" + ", ".join(_nested(v, kind.elementType) for v in value) + "]"
    if isinstance(kind, T.StructType):
        return "{" + ", ".join("'" + f.name.replace("'", "\\'") + "': " + _nested(value.get(f.name), f.dataType) for f in kind) + "}"
    if isinstance(kind, T.MapType):
        return "{" + ", ".join(f"{_nested(k, kind.keyType)}={_nested(v, kind.valueType)}" for k, v in value) + "}"
    return str(value)


def natural(value) -> tuple[object, T.DataType]:
    """A value with the type it has by itself; the elements of a list share theirs."""
    if value is None:
        return None, T.NullType()
    kind = kind_of(value)
    if isinstance(value, Sexp):
        raise IonError("s-expressions can't be read as columns")
    if isinstance(kind, T.ArrayType):
        parts = [natural(v) for v in value]
        item: T.DataType = T.NullType()
        for _, t in parts:
            item = promote(item, t) if not isinstance(t, T.NullType) else item
        return [cast(v, t, item) for v, t in parts], T.ArrayType(item)
    if isinstance(kind, T.StructType):
        fields = {k: natural(v) for k, v in value if k is not None}
        return {k: v for k, (v, _) in fields.items()}, T.StructType([T.StructField(k, t) for k, (_, t) in fields.items()])
    if isinstance(kind, T.DecimalType):
        try:
            return _decimal(value, kind), kind
        except IonError:
            return decimal_text(value), T.StringType()
    if isinstance(kind, T.TimestampType):
        return value.micros(), kind
    return value, kind


def _decimal(value: Decimal, kind: T.DecimalType) -> Decimal:
    try:
        out = value.quantize(Decimal(1).scaleb(-kind.scale), ROUND_HALF_UP, _WIDE)
    except InvalidOperation as e:
        raise IonError(f"{value} doesn't fit DECIMAL({kind.precision},{kind.scale})") from e
    if len(out.as_tuple().digits) > kind.precision and out:
        raise IonError(f"{value} doesn't fit DECIMAL({kind.precision},{kind.scale})")
    return out


def _whole(value, kind: T.DataType) -> int:
    if isinstance(value, float):
        if not math.isfinite(value):
            raise IonError(f"{value} is no whole number")
        value = int(Decimal(value).to_integral_value(ROUND_HALF_EVEN))
    elif isinstance(value, Decimal):
        value = int(value.to_integral_value(ROUND_HALF_UP, _WIDE))
    bits = _RANGES[type(kind)]
    if not -(1 << bits - 1) <= value < 1 << bits - 1:
        raise IonError(f"{value} is outside the range of {bits} bits")
    return int(value)


_DATE = re.compile(r"\s*(\d{4})-(\d{1,2})-(\d{1,2})(?:[ T](\d{1,2}):(\d{2})(?::(\d{2})(?:\.(\d+))?)?\s*(Z|[+-]\d{2}(?::?\d{2})?)?)?\s*")


def _moment(text: str) -> int:
    m = _DATE.fullmatch(text)
    if not m:
        raise IonError(f"{text!r} is no timestamp")
    y, mo, d, h, mi, s, f, zone = m.groups()
    offset = 0
    if zone and zone != "Z":
        offset = (-1 if zone[0] == "-" else 1) * (int(zone[1:3]) * 60 + int(zone[3:].strip(":") or 0))
    return Timestamp(5, int(y), int(mo), int(d), int(h or 0), int(mi or 0), int(s or 0), f or "", offset).micros()


def cast(value, have: T.DataType, want: T.DataType):
    """A value of one column type as another."""
    if value is None or isinstance(have, T.NullType):
        return None
    if is_json(want) and not is_json(have):
        return json.dumps(value, default=str)
    if isinstance(want, T.StringType):
        return value if isinstance(have, T.StringType) else show(value, have)
    try:
        if type(want) in _RANGES:
            if isinstance(have, T.StringType):
                value = Decimal(value.strip())
            elif not isinstance(value, (bool, int, float, Decimal)) or isinstance(have, (T.TimestampType, T.TimestampNTZType)):
                raise IonError("no cast")
            return _whole(value, want)
        if isinstance(want, (T.DoubleType, T.FloatType)):
            if isinstance(have, (T.BooleanType, T.LongType, T.DoubleType, T.DecimalType, T.StringType)):
                return float(value)
        elif isinstance(want, T.DecimalType):
            if isinstance(have, T.StringType):
                return _decimal(Decimal(value.strip()), want)
            if isinstance(have, (T.BooleanType, T.LongType, T.DoubleType, T.DecimalType)):
                return _decimal(Decimal(repr(value)) if isinstance(value, float) else Decimal(value), want)
        elif isinstance(want, T.BooleanType):
            if isinstance(have, T.BooleanType):
                return value
            if isinstance(have, T.StringType):
                found = {"true": True, "t": True, "1": True, "yes": True, "y": True, "false": False, "f": False, "0": False, "no": False, "n": False}.get(value.strip().lower())
                if found is not None:
                    return found
            elif isinstance(have, (T.LongType, T.DoubleType, T.DecimalType)):
                return bool(value)
        elif isinstance(want, (T.TimestampType, T.TimestampNTZType)):
            if isinstance(have, (T.TimestampType, T.TimestampNTZType)):
                return value
            if isinstance(have, T.StringType):
                return _moment(value)
        elif isinstance(want, T.DateType):
            if isinstance(have, T.StringType):
                value = _moment(value)
            elif not isinstance(have, (T.TimestampType, T.TimestampNTZType)):
                raise IonError("no cast")
            return (_EPOCH + dt.timedelta(microseconds=value)).date()
        elif isinstance(want, T.BinaryType):
            if isinstance(have, T.BinaryType):
                return value
            if isinstance(have, T.StringType):
                return re.sub(rb"\\x([0-9A-Fa-f]{2})", lambda m: bytes((int(m[1], 16),)), value.encode())
        elif isinstance(want, T.ArrayType):
            if isinstance(have, T.ArrayType):
                return [cast(v, have.elementType, want.elementType) for v in value]
        elif isinstance(want, T.StructType):
            if isinstance(have, T.StructType):
                if len(have) and len(want) and not set(have.names) & set(want.names):
                    raise IonError("no field of the struct has a name that is asked for")
                return {f.name: cast(value.get(f.name), have[f.name].dataType, f.dataType) if f.name in have.names else None for f in want}
        elif isinstance(want, T.MapType):
            if isinstance(have, T.StructType):
                return [(cast(f.name, T.StringType(), want.keyType), cast(value.get(f.name), f.dataType, want.valueType)) for f in have]
            if isinstance(have, T.MapType):
                return [(cast(k, have.keyType, want.keyType), cast(v, have.valueType, want.valueType)) for k, v in value]
    except (ValueError, ArithmeticError) as e:
        raise IonError(f"{value!r} can't be read as {want.simpleString()}: {e}") from e
    raise IonError(f"{have.simpleString()} can't be read as {want.simpleString()}")


def coerce(value, want: T.DataType):
    """An Ion value as a column's value. Timestamps are microseconds, structs dicts, maps pairs."""
    if value is None:
        return None
    if is_json(want):
        return to_json(value)
    if isinstance(value, Sexp):
        raise IonError("s-expressions can't be read as columns")
    kind = type(want)
    if kind is T.StringType and isinstance(value, str):
        return value
    if kind is T.LongType and type(value) is int:
        if -(1 << 63) <= value < 1 << 63:
            return value
        raise IonError(f"{value} is outside the range of 64 bits")
    if kind is T.DoubleType and isinstance(value, (int, float, Decimal)):
        return float(value)
    if kind is T.DecimalType and isinstance(value, Decimal):
        return _decimal(value, want)
    if kind in (T.TimestampType, T.TimestampNTZType) and isinstance(value, Timestamp):
        return value.micros()
    if kind is T.BinaryType and isinstance(value, bytes):
        return value
    if kind is T.StructType and isinstance(value, Struct):
        own = dict(value)
        if own and len(want) and not any(n in own for n in want.names):
            raise IonError("no field of the struct has a name that is asked for")
        return {f.name: coerce(own.get(f.name), f.dataType) for f in want}
    if kind is T.MapType and isinstance(value, Struct):
        return [(cast(k or "", T.StringType(), want.keyType), coerce(v, want.valueType)) for k, v in dict(value).items()]
    if kind is T.ArrayType and isinstance(value, list) and not isinstance(value, Struct):
        if _mixed(value, want.elementType):
            return cast(*natural(value), want)
        return [coerce(v, want.elementType) for v in value]
    return cast(*natural(value), want)


def _mixed(items: list, want: T.DataType) -> bool:
    """Whether a list for a string column has kinds that take one type before they are shown."""
    return isinstance(want, T.StringType) and not is_json(want) and len({type(v) for v in items if v is not None}) > 1
