"""Options of reading and writing, with the messages of options that can't be."""

from __future__ import annotations

import math
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import types as T

from ..plans.inference import Rules
from ..plans.types import parse_type, struct_of

#: Values looked at when the schema is inferred, over all files.
SAMPLE_SIZE, SAMPLE_FILES = 20480, 32


class OptionError(ValueError):
    """An option or input that can't be used."""


@dataclass(frozen=True)
class ReadOptions:
    columns: T.StructType | None = None
    format: str = "auto"
    records: bool | None = None
    maximum_depth: float = math.inf
    field_appearance_threshold: float = 0.1
    map_inference_threshold: float | None = 200
    sample_size: float = SAMPLE_SIZE
    maximum_sample_files: float = SAMPLE_FILES
    union_by_name: bool = False
    conflict_mode: str = "varchar"
    profile: bool = False

    @property
    def rules(self) -> Rules:
        return Rules(self.maximum_depth, self.field_appearance_threshold, self.map_inference_threshold, self.conflict_mode == "json")


#: Messages that users' tests compare.
_NO_STRUCT = 'read_ion "columns" parameter requires a struct as input.'
_NO_TYPE = 'read_ion "columns" parameter type specification cannot be NULL.'
_NO_TEXT = 'read_ion "columns" parameter type specification must be VARCHAR.'
_UNKNOWN = 'Invalid named parameter "{}" for function read_ion'


def _wrong(name: str, value, wanted: str) -> OptionError:
    return OptionError(f"option {name} of read_ion is {value!r}; it takes {wanted}")


def _columns(value) -> T.StructType:
    if isinstance(value, T.StructType):
        value = {f.name: f.dataType for f in value}
    if not isinstance(value, Mapping):
        raise OptionError(_NO_STRUCT)
    fields = []
    for name, kind in value.items():
        if kind is None:
            raise OptionError(_NO_TYPE)
        if not isinstance(kind, (str, T.DataType)):
            raise OptionError(_NO_TEXT)
        fields.append((name, parse_type(kind) if isinstance(kind, str) else kind))
    if not fields:
        raise _wrong("columns", {}, "one column or more")
    return struct_of(fields)


def _choice(name: str, value, known: list[str]) -> str:
    if not isinstance(value, str) or value.lower() not in known:
        raise _wrong(name, value, " or ".join(known))
    return value.lower()


def _records(value) -> bool | None:
    if isinstance(value, bool):
        return value
    known = {"auto": None, "true": True, "false": False}
    if not isinstance(value, str) or value.lower() not in known:
        raise _wrong("records", value, "true, false or auto")
    return known[value.lower()]


def _count(name: str, value, less: str) -> float:
    number = int(value)
    if number == -1:
        return math.inf
    if number <= 0:
        raise _wrong(name, value, f"a number from 1 on, or -1 {less}")
    return number


def _bool(name: str, value) -> bool:
    if not isinstance(value, bool):
        raise _wrong(name, value, "true or false")
    return value


def read_options(given: Mapping) -> ReadOptions:
    found: dict[str, object] = {}
    for key, value in given.items():
        name = key.lower()
        if value is None:
            raise OptionError(f"option {name} of read_ion can't be NULL")
        if name == "columns":
            found[name] = _columns(value)
        elif name == "format":
            found[name] = _choice(name, value, ["auto", "newline_delimited", "array"])
        elif name == "records":
            found[name] = _records(value)
        elif name == "maximum_depth":
            found[name] = _count(name, value, "for any")
        elif name == "field_appearance_threshold":
            if not 0 <= float(value) <= 1:
                raise _wrong(name, value, "a share from 0 to 1")
            found[name] = float(value)
        elif name == "map_inference_threshold":
            if int(value) < -1:
                raise _wrong(name, value, "a number from 0 on, or -1 for no maps")
            found[name] = None if int(value) == -1 else int(value)
        elif name == "sample_size":
            found[name] = _count(name, value, "for all values")
        elif name == "maximum_sample_files":
            found[name] = _count(name, value, "for any")
        elif name in ("union_by_name", "profile"):
            found[name] = _bool(name, value)
        elif name == "use_extractor":
            _bool(name, value)  # accepted; the readers here always pass over what isn't asked for
        elif name == "conflict_mode":
            found[name] = _choice(name, value, ["varchar", "json"])
        else:
            raise OptionError(_UNKNOWN.format(key))
    out = ReadOptions(**found)
    if out.records is False and out.columns is not None:
        raise OptionError("with records=false there are no fields, so read_ion takes no columns")
    return out
