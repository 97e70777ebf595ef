"""to_ion: any column as Ion text, as one expression that Spark compiles.

The expression is made from the column's type, so no Python runs on the executors. Lists
and nested structs inside them go through `transform`.
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Words that are no symbols when they stand alone.
RESERVED = {"null", "true", "false", "nan"}


def symbol(name: str) -> str:
    """A field name as Ion text."""
    if re.fullmatch("[A-Za-z_][A-Za-z0-9_]*", name) and name not in RESERVED:
        return name
    for a, b in (("\\", "\\\\"), ("'", "\\'"), ("\n", "\\n"), ("\r", "\\r"), ("\t", "\\t")):
        name = name.replace(a, b)
    return f"'{name}'"


def _quoted(c: Column) -> Column:
    for a, b in (("\\", "\\\\"), ('"', '\\"'), ("\n", "\\n"), ("\r", "\\r"), ("\t", "\\t")):
        c = F.replace(c, F.lit(a), F.lit(b))
    return F.concat(F.lit('"'), c, F.lit('"'))


def python_float(c: Column) -> Column:
    """The same text as `_float`, in Arrow batches.

    Rows with many floats of 17 digits are written faster so: the expression's formatting
    takes some microseconds a number, and dozens of them overflow a compiled method.
    """

    def text(x: pa.Array) -> pa.Array:
        from .arrowtext import float_text

        return float_text(x)

    return F.arrow_udf(text, "string")(c)


def _let(value: Column, use) -> Column:
    """use(value), the value worked out once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _float(c: Column) -> Column:
    """Shortest digits that give the number back; plain from 1e-4 up to 1e16.

    What Java shows plainly and short is so already. Other numbers go through lambdas, which
    keeps the generated code small. Java may show 17 digits where 16 do; such numbers are
    formatted with 16 and kept so if they read back as the same.
    """
    s = c.cast("string")
    usual = (F.abs(c) < F.lit(1e7)) & (F.length(s) < 18) & ~s.contains("E")
    return F.when(usual, s).otherwise(_let(c.cast("double"), lambda x: _rare(x, s)))


def _rare(x: Column, s: Column) -> Column:
    short = F.format_string("%.15e", x)
    text = F.when((F.length(s) >= 18) & (short.cast("double") == x), short).otherwise(s)
    names = F.when(F.isnan(x), F.lit("nan")).when(x == float("inf"), F.lit("+inf")).when(x == float("-inf"), F.lit("-inf"))

    def parts(t: Column) -> Column:
        part = lambda i: F.regexp_extract(t, r"^(-?)(\d)\.(\d+)[eE]([+-]?\d+)$", i)
        return F.struct(t.alias("t"), part(1).alias("sign"), part(2).alias("first"), F.regexp_replace(part(3), "0+$", "").alias("tail"), part(4).cast("int").alias("power"))

    def shown(p: Column) -> Column:
        sign, first, tail, power = p["sign"], p["first"], p["tail"], p["power"]
        digits = F.concat(first, tail)
        longer = F.rpad(digits, F.greatest(power + 1, F.length(digits)), F.lit("0"))
        plain = F.concat(sign, F.substring(longer, F.lit(1), power + 1), F.lit("."), F.when(F.length(digits) > power + 1, F.substring(longer, power + 2, F.lit(400))).otherwise("0"))
        small = F.concat(sign, F.lit("0."), F.repeat(F.lit("0"), -power - 1), digits)
        mantissa = F.concat(sign, first, F.when(tail == "", F.lit("")).otherwise(F.concat(F.lit("."), tail)))
        size = F.abs(power).cast("string")
        far = F.concat(mantissa, F.when(power < 0, F.lit("e-")).otherwise(F.lit("e+")), F.lpad(size, F.greatest(F.length(size), F.lit(2)), F.lit("0")))
        return F.when(p["power"].isNull(), p["t"]).when(power.between(0, 15), plain).when(power.between(-4, -1), small).otherwise(far)

    return F.coalesce(names, _let(F.when(text.rlike("[eE]"), parts(text)).otherwise(F.struct(text.alias("t"), F.lit("").alias("sign"), F.lit("").alias("first"), F.lit("").alias("tail"), F.lit(None).cast("int").alias("power"))), shown))


def ion_text(c: Column, kind: T.DataType, floats: str = "plain", shown=_float) -> Column:
    """The expression for a column of this type. Null is the text `null`.

    floats: 'plain' writes 12.5, which reads as a decimal; 'exponent' writes 12.5e0, which
    reads as the same float. shown: how a float's digits come about.
    """
    return F.coalesce(_text(c, kind, floats, shown), F.lit("null"))


def _text(c: Column, kind: T.DataType, floats: str, shown) -> Column:
    if isinstance(kind, T.NullType):
        return F.lit("null")
    if isinstance(kind, T.BooleanType) or isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.DecimalType)):
        return c.cast("string")
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        text = shown(c)
        if floats == "exponent":
            text = F.when(text.contains("e") | F.isnan(c) | text.contains("inf"), text).otherwise(F.concat(text, F.lit("e0")))
        return text
    if isinstance(kind, T.StringType):
        return _quoted(c)
    if isinstance(kind, T.DateType):
        return F.date_format(c, "yyyy-MM-dd")
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        if isinstance(kind, T.TimestampType):
            c = F.to_utc_timestamp(c, F.current_timezone())
        text = F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
        return F.concat(F.regexp_replace(F.regexp_replace(text, "0+$", ""), r"\.$", ""), F.lit("Z"))
    if isinstance(kind, T.BinaryType):
        return F.concat(F.lit("{{"), F.regexp_replace(F.base64(c), r"[\r\n]+", ""), F.lit("}}"))
    if isinstance(kind, T.ArrayType):
        return F.concat(F.lit("["), F.array_join(F.transform(c, lambda x: ion_text(x, kind.elementType, floats)), ", "), F.lit("]"))
    if isinstance(kind, T.StructType):
        fields = [F.concat(F.lit(symbol(f.name) + ": "), ion_text(c.getField(f.name), f.dataType, floats, shown)) for f in kind]
        body = F.concat(F.lit("{"), F.concat_ws(", ", *fields), F.lit("}"))
        return F.when(c.isNotNull(), body)
    if isinstance(kind, T.MapType):
        pairs = F.transform(F.map_entries(c), lambda e: F.concat(e["key"].cast("string"), F.lit("="), F.coalesce(e["value"].cast("string"), F.lit("NULL"))))
        return _quoted(F.concat(F.lit("{"), F.array_join(pairs, ", "), F.lit("}")))
    return _quoted(c.cast("string"))


def to_ion(df: DataFrame, column: str | Column | None = None, floats: str = "plain", shown=_float) -> Column:
    """A column of df, or its whole row as a struct, as Ion text.

    A nullable column's null is the text `null`; a row is never null.
    """
    if column is None:
        fields = [F.concat(F.lit(symbol(f.name) + ": "), ion_text(df[_escaped(f.name)], f.dataType, floats, shown)) for f in df.schema]
        return F.concat(F.lit("{"), F.concat_ws(", ", *fields), F.lit("}"))
    c = F.col(column) if isinstance(column, str) else column
    return ion_text(c, df.select(c).schema[0].dataType, floats, shown)


def _escaped(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"
