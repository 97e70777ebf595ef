"""Schema inference: a tree of what a sample holds, lowered to types."""

from __future__ import annotations

from dataclasses import dataclass, field
from decimal import Decimal

from pyspark.sql import types as T

from ..sources.values import IonError, Sexp, Struct, Timestamp
from .types import JsonType, normalize, promote, same, struct_of

#: Structs of this similarity of children and above can be maps.
SIMILAR = 0.8


def kind_of(value) -> T.DataType:
    """The bare type of a value that isn't null; lists and structs without what they hold."""
    if isinstance(value, bool):
        return T.BooleanType()
    if isinstance(value, int):
        return T.LongType()
    if isinstance(value, float):
        return T.DoubleType()
    if isinstance(value, Decimal):
        return T.DecimalType(38, 18)
    if isinstance(value, Timestamp):
        return T.TimestampType()
    if isinstance(value, bytes):
        return T.BinaryType()
    if isinstance(value, Struct):
        return T.StructType([])
    if isinstance(value, list) and not isinstance(value, Sexp):
        return T.ArrayType(T.NullType())
    return T.StringType()


@dataclass
class Node:
    count: int = 0
    nulls: int = 0
    type: T.DataType | None = None
    conflict: bool = False
    item: Node | None = None
    fields: dict[str, Node] = field(default_factory=dict)

    def observe(self, value, depth: int, most: float) -> None:
        self.count += 1
        if value is None:
            self.nulls += 1
            return
        kind = kind_of(value)
        if self.type is None:
            self.type = kind
        elif type(self.type) is not type(kind) and not self.conflict:
            both = promote(self.type, kind)
            if isinstance(both, T.StringType):
                self.conflict = True
            else:
                self.type = both
        if depth >= most:
            return
        if isinstance(kind, T.ArrayType):
            for v in value:
                self.item = self.item or Node()
                self.item.observe(v, depth + 1, most)
        elif isinstance(kind, T.StructType):
            for k, v in value:
                if k is not None:
                    self.fields.setdefault(k, Node()).observe(v, depth + 1, most)


@dataclass(frozen=True)
class Rules:
    depth: float
    appearance: float
    map_size: float | None  # None: no maps
    json: bool


def lower(node: Node, depth: int, rules: Rules) -> T.DataType:
    if depth >= rules.depth:
        return T.StringType()
    if node.type is None:
        return T.NullType()
    if node.conflict:
        return JsonType() if rules.json else T.StringType()
    if isinstance(node.type, T.ArrayType):
        return T.ArrayType(normalize(lower(node.item, depth + 1, rules)) if node.item else T.NullType())
    if isinstance(node.type, T.StructType):
        return _lower_struct(node, depth, rules)
    return normalize(node.type)


def _lower_struct(node: Node, depth: int, rules: Rules) -> T.DataType:
    if not node.fields:
        return T.StringType() if rules.map_size is None else T.MapType(T.StringType(), T.NullType())
    types = [(k, lower(n, depth + 1, rules)) for k, n in node.fields.items()]
    if rules.map_size is not None:
        seen = sum(n.count for n in node.fields.values()) / max(node.count - node.nulls, 1) / len(types)
        wide = len(types) >= rules.map_size
        if seen < rules.appearance or wide:
            merged: T.DataType = T.NullType()
            for _, t in types:
                merged = promote(merged, t)
            if seen < rules.appearance or sum(similarity(t, merged, depth + 1, rules.depth) for _, t in types) / len(types) >= SIMILAR:
                return T.MapType(T.StringType(), merged)
    return struct_of(types)


def similarity(t: T.DataType, merged: T.DataType, depth: int, most: float) -> float:
    """How much of the merged type a type has; -1 if it is another kind."""
    if isinstance(t, T.NullType) or depth >= most or same(t, merged):
        return 1.0
    if isinstance(merged, T.StructType):
        if not isinstance(t, T.StructType):
            return -1.0
        own = {f.name: f.dataType for f in t}
        total = 0.0
        for name, kind in own.items():
            if name not in merged.names:
                return -1.0
            part = similarity(kind, merged[name].dataType, depth + 1, most)
            if part < 0:
                return -1.0
            total += part
        return total / len(merged)
    if isinstance(merged, T.MapType):
        if isinstance(t, T.MapType):
            return similarity(t.valueType, merged.valueType, depth + 1, most)
        if isinstance(t, T.StructType) and len(t):
            parts = [similarity(f.dataType, merged.valueType, depth + 1, most) for f in t]
            return -1.0 if min(parts) < 0 else sum(parts) / len(parts)
        return -1.0
    if isinstance(merged, T.ArrayType):
        return similarity(t.elementType, merged.elementType, depth + 1, most) if isinstance(t, T.ArrayType) else -1.0
    return 1.0


class Inference:
    """What a sample has shown so far; it can go on from file to file."""

    def __init__(self, records: bool | None, depth: float):
        self.records, self.depth = records, depth
        self.columns: dict[str, Node] = {}
        self.scalar = Node()
        self.seen = 0

    def add(self, value) -> None:
        self.seen += 1
        if value is None:
            return
        if self.records is None:
            self.records = isinstance(value, Struct)
        if not self.records:
            self.scalar.observe(value, 0, self.depth)
            return
        if not isinstance(value, Struct):
            raise IonError("records have to be structs")
        for k, v in value:
            if k is not None:
                self.columns.setdefault(k, Node()).observe(v, 0, self.depth)

    def schema(self, rules: Rules) -> tuple[T.StructType, bool]:
        """The types, and whether the values are records."""
        if self.records and self.columns:
            return struct_of([(k, lower(n, 0, rules)) for k, n in self.columns.items()]), True
        return struct_of([("ion", lower(self.scalar, 0, rules))]), False



