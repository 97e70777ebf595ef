"""Column types: SQL type strings, their rendering, and the promotion lattice."""

from __future__ import annotations

import re

from pyspark.sql import types as T


class JsonType(T.StringType):
    """A string column that holds JSON text. Spark sees a string; the codec sees the mark."""

    def __init__(self):
        super().__init__()


def is_json(t: T.DataType) -> bool:
    return isinstance(t, JsonType)


def is_string(t: T.DataType) -> bool:
    return isinstance(t, T.StringType) and not is_json(t)


def same(a: T.DataType, b: T.DataType) -> bool:
    if is_json(a) != is_json(b) or type(a).__name__ != type(b).__name__:
        return False
    if isinstance(a, T.StructType):
        return [f.name for f in a] == [f.name for f in b] and all(same(x.dataType, y.dataType) for x, y in zip(a, b))
    if isinstance(a, T.ArrayType):
        return same(a.elementType, b.elementType)
    if isinstance(a, T.MapType):
        return same(a.keyType, b.keyType) and same(a.valueType, b.valueType)
    return a == b


def struct_of(fields: list[tuple[str, T.DataType]]) -> T.StructType:
    return T.StructType([T.StructField(n, t) for n, t in fields])


def promote(have: T.DataType, new: T.DataType) -> T.DataType:
    """The type that holds both; the first rule that fits."""
    if is_json(have) or is_json(new):
        return JsonType()
    if isinstance(have, T.NullType):
        return new
    if same(have, new):
        return have
    if isinstance(have, T.StructType) and isinstance(new, T.StructType):
        fields = {f.name: f.dataType for f in have}
        for f in new:
            fields[f.name] = promote(fields[f.name], f.dataType) if f.name in fields else f.dataType
        return struct_of(list(fields.items()))
    if isinstance(have, T.ArrayType) and isinstance(new, T.ArrayType):
        return T.ArrayType(promote(have.elementType, new.elementType))
    pair = (have, new)
    if any(isinstance(t, T.StringType) for t in pair):
        return T.StringType()
    if any(isinstance(t, T.DoubleType) for t in pair):
        return T.DoubleType()
    if any(isinstance(t, T.DecimalType) for t in pair):
        return T.DecimalType(38, 18)
    if {type(t) for t in pair} == {T.LongType, T.BooleanType}:
        return T.LongType()
    return T.StringType()


def normalize(t: T.DataType) -> T.DataType:
    """Decimals found by inference have 18 digits, 3 of them after the point; maps keep theirs."""
    if isinstance(t, T.DecimalType):
        return T.DecimalType(18, 3)
    if isinstance(t, T.ArrayType):
        return T.ArrayType(normalize(t.elementType))
    if isinstance(t, T.StructType):
        return struct_of([(f.name, normalize(f.dataType)) for f in t])
    return t


#: SQL names of types and the Spark types that stand for them.
_NAMES = {
    "BOOLEAN": T.BooleanType(), "BOOL": T.BooleanType(), "LOGICAL": T.BooleanType(),
    "TINYINT": T.ByteType(), "INT1": T.ByteType(),
    "SMALLINT": T.ShortType(), "INT2": T.ShortType(), "SHORT": T.ShortType(), "UTINYINT": T.ShortType(),
    "INTEGER": T.IntegerType(), "INT": T.IntegerType(), "INT4": T.IntegerType(), "SIGNED": T.IntegerType(), "USMALLINT": T.IntegerType(),
    "BIGINT": T.LongType(), "INT8": T.LongType(), "LONG": T.LongType(), "UINTEGER": T.LongType(),
    "HUGEINT": T.DecimalType(38, 0), "UBIGINT": T.DecimalType(20, 0), "UHUGEINT": T.DecimalType(38, 0),
    "FLOAT": T.FloatType(), "FLOAT4": T.FloatType(), "REAL": T.FloatType(),
    "DOUBLE": T.DoubleType(), "FLOAT8": T.DoubleType(),
    "DATE": T.DateType(),
    "TIMESTAMP": T.TimestampNTZType(), "DATETIME": T.TimestampNTZType(),
    "TIMESTAMPTZ": T.TimestampType(), "TIMESTAMP WITH TIME ZONE": T.TimestampType(),
    "VARCHAR": T.StringType(), "CHAR": T.StringType(), "BPCHAR": T.StringType(), "TEXT": T.StringType(), "STRING": T.StringType(), "UUID": T.StringType(),
    "BLOB": T.BinaryType(), "BYTEA": T.BinaryType(), "BINARY": T.BinaryType(), "VARBINARY": T.BinaryType(),
    "NULL": T.NullType(),
}
_TOKEN = re.compile(r'\s*(?:"((?:[^"]|"")*)"|([A-Za-z_][A-Za-z0-9_]*)|(\d+)|([(),\[\]]))')


class TypeParser:
    def __init__(self, text: str):
        self.text, self.tokens, at = text, [], 0
        text = text.rstrip()
        while at < len(text):
            m = _TOKEN.match(text, at)
            if not m:
                raise ValueError(f"type {self.text!r} can't be read")
            self.tokens.append((m[1].replace('""', '"') if m[1] is not None else m[2] or m[3] or m[4], m[1] is not None))
            at = m.end()
        self.at = 0

    def peek(self) -> str:
        return self.tokens[self.at][0] if self.at < len(self.tokens) else ""

    def take(self, want: str | None = None) -> str:
        got = self.peek()
        if not got or (want and got != want):
            raise ValueError(f"type {self.text!r} can't be read")
        self.at += 1
        return got

    def parse(self) -> T.DataType:
        name = self.take().upper()
        if name in ("STRUCT", "ROW"):
            self.take("(")
            fields = []
            while self.peek() != ")":
                fields.append((self.take(), self.parse()))
                if self.peek() != ")":
                    self.take(",")
            self.take(")")
            kind = struct_of(fields)
        elif name == "MAP":
            self.take("(")
            key = self.parse()
            self.take(",")
            kind = T.MapType(key, self.parse())
            self.take(")")
        elif name in ("DECIMAL", "NUMERIC", "DEC"):
            kind = T.DecimalType(18, 3)
            if self.peek() == "(":
                self.take("(")
                p, s = int(self.take()), 0
                if self.peek() == ",":
                    self.take(",")
                    s = int(self.take())
                self.take(")")
                kind = T.DecimalType(p, s)
        elif name == "JSON":
            kind = JsonType()
        elif name == "LIST" and self.peek() == "(":
            self.take("(")
            kind = T.ArrayType(self.parse())
            self.take(")")
        else:
            if name == "TIMESTAMP" and self.peek().upper() == "WITH":
                for word in ("WITH", "TIME", "ZONE"):
                    if self.take().upper() != word:
                        raise ValueError(f"type {self.text!r} can't be read")
                name = "TIMESTAMPTZ"
            elif self.peek() == "(" and name in ("VARCHAR", "CHAR", "TEXT"):
                self.take("(")
                self.take()
                self.take(")")
            if name not in _NAMES:
                raise ValueError(f"type {name} is not known")
            kind = _NAMES[name]
        while self.peek() == "[":
            self.take("[")
            if self.peek() != "]":
                self.take()
            self.take("]")
            kind = T.ArrayType(kind)
        return kind


def parse_type(text: str) -> T.DataType:
    parser = TypeParser(text)
    kind = parser.parse()
    if parser.at != len(parser.tokens):
        raise ValueError(f"type {text!r} can't be read")
    return kind


_SHOWN = {
    "boolean": "BOOLEAN", "byte": "TINYINT", "short": "SMALLINT", "integer": "INTEGER", "long": "BIGINT", "float": "FLOAT", "double": "DOUBLE",
    "date": "DATE", "timestamp_ntz": "TIMESTAMP", "timestamp": "TIMESTAMP WITH TIME ZONE", "string": "VARCHAR", "binary": "BLOB", "void": '"NULL"',
}
#: SQL key words that are quoted as field names.
_QUOTED = {"name", "value", "type", "key", "date", "time", "timestamp", "order", "group", "select", "from", "where", "table", "values", "year", "month", "day", "hour", "minute", "second", "all", "and", "or", "not", "null", "true", "false", "map", "row", "struct", "list", "end", "case", "when", "then", "else", "in", "is", "as", "on", "by", "to", "limit", "offset", "union", "distinct"}


def type_name(t: T.DataType) -> str:
    """The type as SQL shows it."""
    if is_json(t):
        return "JSON"
    if isinstance(t, T.ArrayType):
        return type_name(t.elementType) + "[]"
    if isinstance(t, T.MapType):
        return f"MAP({type_name(t.keyType)}, {type_name(t.valueType)})"
    if isinstance(t, T.StructType):
        name = lambda n: n if re.fullmatch("[a-z_][a-z0-9_]*", n) and n not in _QUOTED else '"' + n.replace('"', '""') + '"'
        return "STRUCT(" + ", ".join(f"{name(f.name)} {type_name(f.dataType)}" for f in t) + ")"
    if isinstance(t, T.DecimalType):
        return f"DECIMAL({t.precision},{t.scale})"
    return _SHOWN[t.typeName()]


def plain(t: T.DataType) -> T.DataType:
    """The type without marks, for Spark."""
    if is_json(t):
        return T.StringType()
    if isinstance(t, T.ArrayType):
        return T.ArrayType(plain(t.elementType))
    if isinstance(t, T.MapType):
        return T.MapType(plain(t.keyType), plain(t.valueType))
    if isinstance(t, T.StructType):
        return T.StructType([T.StructField(f.name, plain(f.dataType), True, {"logical": "json"} if is_json(f.dataType) else {}) for f in t])
    return t
