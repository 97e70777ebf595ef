"""to_ion and helpers as SQL functions."""

from __future__ import annotations

import base64
import datetime as dt
from decimal import Decimal

import pyarrow as pa
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from ..cluster import ship_code
from .arrowtext import ion_texts
from .to_ion import symbol

_ESCAPES = str.maketrans({"\\": "\\\\", '"': '\\"', "\n": "\\n", "\r": "\\r", "\t": "\\t"})


def literal(value, kind: pa.DataType) -> str:
    """A Python value of an Arrow type as Ion text, as the expression of `to_ion` gives it."""
    if value is None:
        return "null"
    if pa.types.is_boolean(kind):
        return "true" if value else "false"
    if pa.types.is_floating(kind):
        return {"inf": "+inf", "-inf": "-inf", "nan": "nan"}.get(repr(value), repr(value))
    if isinstance(value, Decimal):
        return f"{value:f}"
    if isinstance(value, str):
        return f'"{value.translate(_ESCAPES)}"'
    if isinstance(value, bytes):
        return "{{" + base64.b64encode(value).decode() + "}}"
    if isinstance(value, dt.datetime):
        if value.tzinfo is not None:
            value = value.astimezone(dt.timezone.utc)
        text = value.strftime("%Y-%m-%dT%H:%M:%S").rjust(19, "0")
        return text + (f".{value.microsecond:06d}".rstrip("0") if value.microsecond else "") + "Z"
    if isinstance(value, dt.date):
        return value.isoformat()
    if pa.types.is_map(kind):
        shown = lambda v: "NULL" if v is None else str(v)
        return literal("{" + ", ".join(f"{shown(k)}={shown(v)}" for k, v in value) + "}", pa.string())
    if pa.types.is_list(kind) or pa.types.is_large_list(kind):
        return "[" + ", ".join(literal(v, kind.value_type) for v in value) + "]"
    if pa.types.is_struct(kind):
        return "{" + ", ".join(f"{symbol(f.name)}: {literal(value[f.name], f.type)}" for f in kind) + "}"
    return str(value)


def register(spark: SparkSession) -> None:
    """Make `to_ion(anything)` known to SQL. (For `list_extract` SQL has `try_element_at`, which
    keeps the elements' type; a registered function would need one type for all lists.)

    The SQL form takes its argument's type when it runs, in Arrow batches; in DataFrame code
    `to_ion` of this package is an expression and faster.
    """
    ship_code(spark)

    def text(x: pa.Array) -> pa.Array:
        return ion_texts(x, literal)

    spark.udf.register("to_ion", F.arrow_udf(text, "string"))


def list_extract(values: Column | str, index: int) -> Column:
    """The element at a place from 1, or from the end if it is negative; null outside."""
    c = F.col(values) if isinstance(values, str) else values
    return F.lit(None) if index == 0 else F.try_element_at(c, F.lit(index))
