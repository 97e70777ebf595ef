"""A fast way through lines of one shape.

Files are mostly written by one program, so lines have the same fields in the same order.
From the first line a regular expression is made that takes a whole line at once: scalar
fields by their canonical forms, nested values as they stand. Lines it doesn't match go
through the parser, so nothing depends on the guess but speed.
"""

from __future__ import annotations

import re
from decimal import Decimal

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import types as T

from .iontext import TextReader
from .values import IonError, Struct, Timestamp

_FLAT = r'[^\[\]{}()"\'/:]'
_INSIDE = rf'(?:{_FLAT}|:(?!:)|"[^"\\\n]*")'
#: What a field may look like, by the kind of its value in the first line. A null fits any.
_FORMS = {
    int: r"-?(?:0|[1-9]\d{0,17})",
    Decimal: r"-?(?:0|[1-9]\d*)\.\d+",
    float: r"-?(?:0|[1-9]\d*)(?:\.\d+)?[eE][+-]?\d+",
    bool: r"true|false",
    str: r'"[^"\\\n]*"',
    Timestamp: r"\d{4}-\d\d-\d\dT\d\d:\d\d:\d\d(?:\.\d{1,6})?Z",
    Struct: rf"\{{{_INSIDE}*\}}",
    list: rf"\[{_INSIDE}*\]",
}


class Shape:
    """How lines like the first one are taken; `columns` are those that are asked for."""

    def __init__(self, first: str, columns: T.StructType):
        self.pattern: re.Pattern | None = None
        self.names: list[str] = []
        try:
            values = list(TextReader(first).values())
        except (IonError, ValueError):
            return
        if len(values) != 1 or not isinstance(values[0], Struct) or "::" in first or "'" in first:
            return
        fields = values[0]
        names = [k for k, _ in fields]
        if len(set(names)) < len(names):
            return
        parts = []
        for name, value in fields:
            form = _FORMS.get(type(value))
            if form is None or name is None or not re.fullmatch(r"[A-Za-z_]\w*", name, re.ASCII):
                return
            if isinstance(value, str) and f'{name}: "' not in first and f'{name}:"' not in first:
                return  # a symbol
            wanted = name in columns.names
            parts.append(rf"{name}: ?{'(' if wanted else '(?:'}{form}|null)")
            if wanted:
                self.names.append(name)
                self.kinds = [*getattr(self, "kinds", []), type(value)]
        self.pattern = re.compile(r"[ \t]*\{" + ", ?".join(parts) + r"\}[ \t\r]*", re.ASCII)

    def take(self, lines: list[str]) -> tuple[list[tuple], list[int]]:
        """Captured fields of the lines that match, and the places of those that don't."""
        match = self.pattern.fullmatch
        found = [match(x) for x in lines]
        return [m.groups() for m in found if m is not None], [i for i, m in enumerate(found) if m is None]


def fast_column(texts: list[str], kind: type, want: T.DataType, arrow: pa.DataType) -> pa.Array | None:
    """Captured texts as a column, where Arrow's own casts do what the parser does."""
    if kind is str and type(want) is T.StringType:
        return pa.array([None if t == "null" else t[1:-1] for t in texts], pa.string()).cast(arrow)
    if kind is bool and type(want) is T.BooleanType:
        return pa.array([None if t == "null" else t == "true" for t in texts], arrow)
    numeric = (kind is int and type(want) in (T.LongType, T.DoubleType)) or (kind in (float, Decimal) and type(want) is T.DoubleType)
    if numeric or (kind is Decimal and isinstance(want, T.DecimalType)):
        raw = pa.array([None if t == "null" else t for t in texts], pa.string())
        if isinstance(want, T.DecimalType):
            point = pc.max(pc.subtract(pc.utf8_length(raw), pc.find_substring(raw, "."))).as_py() or 0
            if point - 1 > want.scale:
                return None  # would be rounded; left to the parser's rules
            return raw.cast(arrow)
        return raw.cast(arrow)
    if kind is Timestamp and type(want) is T.TimestampType:
        return pa.array([None if t == "null" else t[:-1] for t in texts], pa.string()).cast(pa.timestamp("us")).cast(arrow)
    return None
