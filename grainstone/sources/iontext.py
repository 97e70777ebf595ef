"""Ion text: a pull parser over one string."""

from __future__ import annotations

import base64
import binascii
import re
from collections.abc import Iterator
from decimal import Decimal

from .values import DAY, MINUTE, MONTH, SECOND, YEAR, IonError, Sexp, Struct, Timestamp

#: The system symbols of Ion 1.0, numbered from 1.
SYSTEM_SYMBOLS = ["$ion", "$ion_1_0", "$ion_symbol_table", "name", "version", "imports", "symbols", "max_id", "$ion_shared_symbol_table"]
_NULL_TYPES = {"null", "bool", "int", "float", "decimal", "timestamp", "string", "symbol", "blob", "clob", "struct", "list", "sexp"}

_SPACE = re.compile(r"(?:[ \t\r\n\f\v\0]+|//[^\n\r]*|/\*.*?\*/)*", re.DOTALL)
_TIMESTAMP = re.compile(
    r"(\d{4})(?:-(\d\d)(?:-(\d\d)(?:T(?:(\d\d):(\d\d)(?::(\d\d)(?:\.(\d+))?)?(Z|[+-]\d\d:\d\d))?)?|T)|T)(?=[\s,)\]}/]|$)"
)
_HEX = re.compile(r"(-?)0[xX]([0-9a-fA-F]+(?:_[0-9a-fA-F]+)*)")
_BITS = re.compile(r"(-?)0[bB]([01]+(?:_[01]+)*)")
_NUMBER = re.compile(r"(-?(?:0|[1-9]\d*(?:_\d+)*))(\.(?:\d+(?:_\d+)*)?)?(?:([eEdD])([+-]?\d+))?")
_INFINITE = re.compile(r"[+-]inf\b")
_STOP = re.compile(r"[\s,)\]}{\[(\"'/:]|$")
_NAME = re.compile(r"[A-Za-z_$][A-Za-z0-9_$]*")
_OPERATOR = re.compile(r"[!#%&*+\-./;<=>?@^`|~]+")
_STRING = re.compile(r'"((?:[^"\\\n]|\\(?:\r\n|.))*)"', re.DOTALL)
_SYMBOL = re.compile(r"'((?:[^'\\\n]|\\(?:\r\n|.))*)'", re.DOTALL)
_LONG = re.compile(r"'''((?:[^'\\]|\\(?:\r\n|.)|'(?!''))*)'''", re.DOTALL)
_ESCAPE = re.compile(r"\\(x[0-9a-fA-F]{2}|u[0-9a-fA-F]{4}|U[0-9a-fA-F]{8}|\r\n|.)", re.DOTALL)
_ESCAPES = {"a": "\a", "b": "\b", "t": "\t", "n": "\n", "f": "\f", "r": "\r", "v": "\v", "0": "\0", '"': '"', "'": "'", "?": "?", "\\": "\\", "/": "/", "\n": "", "\r": "", "\r\n": ""}


def _unescaped(m: re.Match) -> str:
    e = m[1]
    if e in _ESCAPES:
        return _ESCAPES[e]
    if e[0] in "xuU" and len(e) > 1:
        return chr(int(e[1:], 16))
    raise IonError(f"escape \\{e} is not known")


def unescape(text: str) -> str:
    if "\\" not in text:
        return text
    out = _ESCAPE.sub(_unescaped, text)
    if any("\ud800" <= c <= "\udfff" for c in out):  # a pair of \u escapes is one character
        out = out.encode("utf-16", "surrogatepass").decode("utf-16", "replace")
    return out


class TextReader:
    """Top-level values of Ion text. Annotations are dropped; version markers and local
    symbol tables are taken in, not given."""

    def __init__(self, text: str):
        self.text = text
        self.symbols: list[str | None] = list(SYSTEM_SYMBOLS)
        #: Where the value begins that `values` is at, after all that it has given.
        self.done = 0

    def fail(self, what: str, at: int) -> IonError:
        line = self.text.count("\n", 0, at) + 1
        return IonError(f"{what} in line {line}, near {self.text[at : at + 20]!r}")

    def skip(self, at: int) -> int:
        return _SPACE.match(self.text, at).end()

    def values(self) -> Iterator[object]:
        at = self.skip(0)
        while at < len(self.text):
            self.done = at
            value, at, notes, bare = self._value(at)
            at = self.skip(at)
            if notes and notes[0] == "$ion_symbol_table" and isinstance(value, Struct):
                self._table(value)
            elif bare == "$ion_1_0" and not notes:
                self.symbols = list(SYSTEM_SYMBOLS)
            else:
                yield value

    def _table(self, table: Struct) -> None:
        fields = dict(table)
        if fields.get("imports") != "$ion_symbol_table":
            self.symbols = list(SYSTEM_SYMBOLS)
        self.symbols += [s if isinstance(s, str) else None for s in fields.get("symbols") or ()]

    def _resolve(self, name: str, at: int) -> str | None:
        if len(name) > 1 and name[0] == "$" and name[1:].isdigit():
            sid = int(name[1:])
            if sid == 0:
                return None
            if sid > len(self.symbols):
                raise self.fail(f"symbol {name} is not in the table", at)
            return self.symbols[sid - 1]
        return name

    def _value(self, at: int, sexp: bool = False):
        """A value, the place after it, its annotations, and the name if it is a bare one."""
        text, notes = self.text, []
        while True:
            c = text[at : at + 1]
            if c == '"':
                m = _STRING.match(text, at)
                if not m:
                    raise self.fail("string without end", at)
                return unescape(m[1]), m.end(), notes, None
            if c == "'":
                if text.startswith("'''", at):
                    value, at = self._long(at)
                    return value, at, notes, None
                m = _SYMBOL.match(text, at)
                if not m:
                    raise self.fail("symbol without end", at)
                name, after = unescape(m[1]), m.end()
                quoted = True
            elif c.isdigit() or (c == "-" and text[at + 1 : at + 2].isdigit()):
                value, at = self._number(at)
                return value, at, notes, None
            elif c == "{":
                value, at = self._lob(at) if text.startswith("{{", at) else self._struct(at)
                return value, at, notes, None
            elif c == "[":
                value, at = self._items(at, "]", [])
                return value, at, notes, None
            elif c == "(":
                value, at = self._items(at, ")", Sexp())
                return value, at, notes, None
            elif c in "+-" and c and (m := _INFINITE.match(text, at)):
                return float(m[0]), m.end(), notes, None
            else:
                m = _NAME.match(text, at)
                if not m:
                    if sexp and (m := _OPERATOR.match(text, at)):
                        return m[0], m.end(), notes, None
                    raise self.fail("no value", at)
                name, after, quoted = m[0], m.end(), False
            follow = self.skip(after)
            if text.startswith("::", follow) and not (not quoted and name in ("null", "true", "false", "nan")):
                notes.append(name if quoted else self._resolve(name, at))
                at = self.skip(follow + 2)
                continue
            if quoted:
                return name, after, notes, None
            if name == "null":
                if text.startswith(".", after) and (m := _NAME.match(text, after + 1)):
                    if m[0] not in _NULL_TYPES:
                        raise self.fail("type of null is not known", at)
                    after = m.end()
                return None, after, notes, None
            if name in ("true", "false"):
                return name == "true", after, notes, None
            if name == "nan":
                return float("nan"), after, notes, None
            return self._resolve(name, at), after, notes, name

    def _number(self, at: int):
        text = self.text
        if m := _TIMESTAMP.match(text, at):
            return self._timestamp(m, at), m.end()
        if m := _HEX.match(text, at):
            value, end = int(m[1] + m[2].replace("_", ""), 16), m.end()
        elif m := _BITS.match(text, at):
            value, end = int(m[1] + m[2].replace("_", ""), 2), m.end()
        else:
            m = _NUMBER.match(text, at)
            whole, fraction, kind, power = m.groups()
            if fraction is None and kind is None:
                value = int(whole)
            elif kind in ("e", "E"):
                value = float(m[0].replace("_", ""))
            else:
                value = Decimal((whole + (fraction or "")).replace("_", "") + (f"E{power}" if kind else ""))
            end = m.end()
        if not _STOP.match(text, end):
            raise self.fail("number runs on", at)
        return value, end

    def _timestamp(self, m: re.Match, at: int) -> Timestamp:
        y, mo, d, h, mi, s, f, zone = m.groups()
        try:
            if mo is None:
                return Timestamp(YEAR, int(y))
            if d is None:
                return Timestamp(MONTH, int(y), int(mo))
            if h is None:
                return Timestamp(DAY, int(y), int(mo), int(d))
            offset = 0 if zone == "Z" else None if zone == "-00:00" else (-1 if zone[0] == "-" else 1) * (int(zone[1:3]) * 60 + int(zone[4:]))
            return Timestamp(SECOND if s else MINUTE, int(y), int(mo), int(d), int(h), int(mi), int(s or 0), f or "", offset)
        except ValueError as e:
            raise self.fail(str(e), at) from e

    def _long(self, at: int):
        parts = []
        while m := _LONG.match(self.text, at):
            parts.append(unescape(m[1].replace("\r\n", "\n").replace("\r", "\n")))
            end = m.end()
            at = self.skip(end)
        if not parts:
            raise self.fail("string without end", at)
        return "".join(parts), end

    def _lob(self, at: int):
        start = re.compile(r"[ \t\r\n\f\v]*").match(self.text, at + 2).end()
        if self.text[start : start + 1] in ('"', "'"):
            if self.text[start] == '"':
                m = _STRING.match(self.text, start)
                if not m:
                    raise self.fail("clob without end", at)
                value, end = unescape(m[1]), m.end()
            else:
                value, end = self._long(start)
            end = re.compile(r"[ \t\r\n\f\v]*").match(self.text, end).end()
            if not self.text.startswith("}}", end):
                raise self.fail("clob without end", at)
            return value, end + 2
        end = self.text.find("}}", start)
        if end < 0:
            raise self.fail("blob without end", at)
        try:
            return base64.b64decode("".join(self.text[start:end].split()), validate=True), end + 2
        except binascii.Error as e:
            raise self.fail("blob is not base64", at) from e

    def _items(self, at: int, close: str, out: list):
        at, sexp = self.skip(at + 1), close == ")"
        while not self.text.startswith(close, at):
            value, at, _, _ = self._value(at, sexp)
            out.append(value)
            at = self.skip(at)
            if not sexp:
                if self.text.startswith(",", at):
                    at = self.skip(at + 1)
                elif not self.text.startswith(close, at):
                    raise self.fail("list without end", at)
            elif at >= len(self.text):
                raise self.fail("s-expression without end", at)
        return out, at + 1

    def _struct(self, at: int):
        text, out = self.text, Struct()
        at = self.skip(at + 1)
        while not text.startswith("}", at):
            if m := _NAME.match(text, at):
                name, at = self._resolve(m[0], at), m.end()
            elif text.startswith("'''", at):
                name, at = self._long(at)
            elif m := _SYMBOL.match(text, at) or _STRING.match(text, at):
                name, at = unescape(m[1]), m.end()
            else:
                raise self.fail("no field name", at)
            at = self.skip(at)
            if not text.startswith(":", at) or text.startswith("::", at):
                raise self.fail("no colon after a field name", at)
            value, at, _, _ = self._value(self.skip(at + 1))
            out.append((name, value))
            at = self.skip(at)
            if text.startswith(",", at):
                at = self.skip(at + 1)
            elif not text.startswith("}", at):
                raise self.fail("struct without end", at)
        return out, at + 1
