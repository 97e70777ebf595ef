"""Words of texts as bytes, and the batches in which operators take them from Arrow."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

_KEEP = {*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)}
_ALNUM = bytes(b if b in _KEEP else b + 32 if 0x41 <= b <= 0x5A else 32 for b in range(256))

#: Texts are worked on in runs of about this many bytes, so memory doesn't follow the batch.
RUN_BYTES = 4 << 20


def alnum_words(text: bytes) -> list[bytes]:
    """Words [^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+ of UTF-8 text after lower-casing A-Z.

    All bytes of a character above ASCII are 0x80 or more, so bytes and characters agree.
    """
    return text.translate(_ALNUM).split()


def space_words(text: bytes) -> list[bytes]:
    """Words [^\\x20\\x09-\\x0D]+ of UTF-8 text after lower-casing A-Z."""
    return text.lower().split()


def binary(column: pa.Array) -> pa.Array:
    """A string or binary column as large binary, whatever its Arrow form."""
    if pa.types.is_string_view(column.type):
        column = column.cast(pa.string())
    return column.cast(pa.large_binary())


def runs(batch: pa.RecordBatch, column: str = "text", most: int = RUN_BYTES) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Slices of the batch of about `most` bytes of text, with the texts; null is empty."""
    texts = binary(batch.column(batch.schema.get_field_index(column)))
    start = size = 0
    found: list[bytes] = []
    for i, value in enumerate(texts):
        found.append(value.as_py() or b"")
        size += len(found[-1])
        if size >= most:
            yield batch.slice(start, i + 1 - start), found
            start, size, found = i + 1, 0, []
    if found:
        yield batch.slice(start), found


def filter_rows(docs: DataFrame, passes: Callable[[list[bytes]], np.ndarray]) -> DataFrame:
    """The rows of docs, with all their columns, whose texts pass; passes gets texts in runs."""

    def run(batches):
        for batch in batches:
            for part, texts in runs(batch):
                yield part.filter(pa.array(np.asarray(passes(texts), bool)))

    return docs.mapInArrow(run, docs.schema)
