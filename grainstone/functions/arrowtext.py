"""Arrow columns as Ion text, a column at a time by Arrow's own functions."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from .to_ion import symbol

_ESCAPES = (("\\", "\\\\"), ('"', '\\"'), ("\n", "\\n"), ("\r", "\\r"), ("\t", "\\t"))
_NAMES = {float("inf"): "+inf", float("-inf"): "-inf"}


def float_text(column: pa.Array) -> pa.Array:
    """Shortest digits, plain from 1e-4 up to 1e16, as Python's repr shows them. Arrow's
    digits are the same for usual sizes but for the `.0` of whole numbers."""
    values = column.cast(pa.float64())
    size = np.abs(values.fill_null(0.0).to_numpy(zero_copy_only=False))
    usual = (size >= 1e-3) & (size < 1e7)
    if pa.types.is_float64(column.type) and usual.all():
        text = values.cast(pa.string())
        return pc.if_else(pc.match_substring(text, "."), text, pc.binary_join_element_wise(text, ".0", ""))
    if pa.types.is_float64(column.type) and usual.any():
        rows = np.flatnonzero(usual)
        rest = np.flatnonzero(~usual)
        parts = pa.concat_arrays([float_text(values.take(pa.array(rows))), _reprs(values.take(pa.array(rest)))])
        order = np.empty(len(column), np.int64)
        order[rows], order[rest] = np.arange(len(rows)), np.arange(len(rows), len(column))
        return parts.take(pa.array(order))
    return _reprs(column)


def _reprs(column: pa.Array) -> pa.Array:
    return pa.array([None if v is None else _NAMES.get(v) or (repr(v) if v == v else "nan") for v in column.to_pylist()], pa.string())


def _quoted(text: pa.Array) -> pa.Array:
    if pc.any(pc.match_substring_regex(text, r'[\\"\n\r\t]')).as_py():
        for a, b in _ESCAPES:
            text = pc.replace_substring(text, a, b)
    return pc.binary_join_element_wise('"', text, '"', "")


def ion_texts(column: pa.Array, single: Callable) -> pa.Array:
    """A column's Ion text; null is the text `null`. single(value, type) is for the types
    that have no form of their own here."""
    kind, text = column.type, None
    if pa.types.is_null(kind):
        return pa.array(["null"] * len(column), pa.string())
    if pa.types.is_boolean(kind) or pa.types.is_integer(kind):
        text = column.cast(pa.string())
    elif pa.types.is_float64(kind):
        text = float_text(column)
    elif pa.types.is_string(kind) or pa.types.is_large_string(kind):
        text = _quoted(column.cast(pa.string()))
    elif pa.types.is_timestamp(kind) and kind.unit == "us":
        text = _whole_seconds(column)
    elif pa.types.is_date32(kind):
        text = column.cast(pa.string())
    elif pa.types.is_struct(kind) and kind.num_fields:
        parts: list = []
        for i, (f, c) in enumerate(zip(kind, column.flatten())):
            parts += [("{" if not i else ", ") + symbol(f.name) + ": ", ion_texts(c, single)]
        text = pc.if_else(column.is_valid(), pc.binary_join_element_wise(*parts, "}", ""), pa.scalar(None, pa.string()))
    elif pa.types.is_list(kind):
        items = ion_texts(column.flatten(), single)
        lengths = column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
        ends = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
        joined = pc.binary_join(pa.ListArray.from_arrays(pa.array(ends), items), ", ")
        text = pc.if_else(column.is_valid(), pc.binary_join_element_wise("[", joined, "]", ""), pa.scalar(None, pa.string()))
    if text is None:
        text = pa.array([None if v is None else single(v, kind) for v in column.to_pylist()], pa.string())
    return text.fill_null("null")


def _whole_seconds(column: pa.Array) -> pa.Array | None:
    """Timestamps in UTC with as many digits after the second as they have."""
    plain = column.cast(pa.timestamp("us"))
    micros = plain.cast(pa.int64())
    low, high = (x.as_py() for x in pc.min_max(micros).values())
    if low is not None and not (-30610224000_000000 <= low and high < 253402300800_000000):
        return None  # years that don't have four digits by themselves
    text = pc.strftime(plain, "%Y-%m-%dT%H:%M:%S")
    short = pc.utf8_slice_codeunits(text, 0, 19)
    if (micros.fill_null(0).to_numpy(zero_copy_only=False) % 1_000_000 != 0).any():
        short = pc.if_else(pc.match_substring_regex(text, r"\.0+$"), short, pc.utf8_rtrim(text, "0"))
    return pc.binary_join_element_wise(short, "Z", "")


def row_texts(batch: pa.RecordBatch, single: Callable) -> pa.Array:
    """The batch's rows as structs."""
    if not batch.num_columns:
        return pa.array(["{}"] * batch.num_rows, pa.string())
    parts: list = []
    for i, (name, column) in enumerate(zip(batch.schema.names, batch.columns)):
        parts += [("{" if not i else ", ") + symbol(name) + ": ", ion_texts(column, single)]
    return pc.binary_join_element_wise(*parts, "}", "")
