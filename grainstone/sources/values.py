"""Ion values in Python.

null is None; bool, int, float, Decimal, str (string, symbol and clob) and bytes (blob) are
themselves; a list is a list. Timestamps keep their precision and offset; structs keep their
fields in order, repeated names too.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

_EPOCH = dt.datetime(1970, 1, 1)


class IonError(ValueError):
    """Input that isn't Ion, or Ion that can't be read as asked."""


class Struct(list):
    """Fields (name, value) in order."""

    __slots__ = ()


class Sexp(list):
    __slots__ = ()


YEAR, MONTH, DAY, MINUTE, SECOND = range(1, 6)


@dataclass(frozen=True)
class Timestamp:
    """Local fields, as text has them; offset in minutes, None if unknown."""

    precision: int
    year: int
    month: int = 1
    day: int = 1
    hour: int = 0
    minute: int = 0
    second: int = 0
    fraction: str = ""
    offset: int | None = None

    def text(self) -> str:
        if self.precision == YEAR:
            return f"{self.year:04d}T"
        if self.precision == MONTH:
            return f"{self.year:04d}-{self.month:02d}T"
        out = f"{self.year:04d}-{self.month:02d}-{self.day:02d}"
        if self.precision == DAY:
            return out
        out += f"T{self.hour:02d}:{self.minute:02d}"
        if self.precision == SECOND:
            out += f":{self.second:02d}" + (f".{self.fraction}" if self.fraction else "")
        if self.offset is None:
            return out + "-00:00"
        if not self.offset:
            return out + "Z"
        return out + f"{'-' if self.offset < 0 else '+'}{abs(self.offset) // 60:02d}:{abs(self.offset) % 60:02d}"

    def micros(self) -> int:
        """Microseconds since 1970 in UTC; finer fractions are cut off."""
        if self.precision < DAY:
            raise IonError(f"timestamp {self.text()} has no day")
        at = dt.datetime(self.year, self.month, self.day, self.hour, self.minute, self.second) - _EPOCH
        whole = (at.days * 86400 + at.seconds - 60 * (self.offset or 0)) * 1_000_000
        return whole + int(self.fraction[:6].ljust(6, "0") or 0)
