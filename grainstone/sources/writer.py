"""write_ion: a DataFrame as Ion text or binary files.

Text is an expression and a sink of Spark's own, so partitions, compression, append and
commit are Spark's. A list over the whole file and binary Ion need a file of their own form:
each task writes one under a temporary name, and the driver makes the names final once all
tasks have ended; a task that runs again writes another temporary file.
"""

from __future__ import annotations

import datetime as dt
import tempfile
import uuid

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..cluster import ship_code
from ..functions.arrowtext import row_texts
from ..functions.sql import literal
from ..functions.to_ion import python_float, to_ion
from .ionbinary import MARK, Symbols, encode_decimal, encode_timestamp, tagged, varuint
from .ionencode import rows
from .options import OptionError
from .reader import list_files
from .values import DAY, SECOND, Timestamp

_OPTIONS = {
    "array", "binary", "dateformat", "date_format", "timestampformat", "timestamp_format", "compression", "mode", "partition_by", "max_records_per_file", "floats",
    "overwrite", "append", "overwrite_or_ignore", "file_extension", "file_size_bytes", "return_files", "write_partition_columns",
}
#: Options that say what is so in any case: each task writes its own files, under temporary
#: names, in the order of its rows, in UTF-8.
_SETTLED = {"per_thread_output": True, "use_tmp_file": True, "preserve_order": True, "encoding": "utf-8", "write_empty_file": True}
_BINARY_EXTENSION, _TEXT_EXTENSION = "10n", "ion"
#: Strftime codes and the patterns of Spark's date_format.
_CODES = {"Y": "yyyy", "y": "yy", "m": "MM", "d": "dd", "H": "HH", "I": "hh", "M": "mm", "S": "ss", "f": "SSSSSS", "g": "SSS", "p": "a", "j": "DDD", "b": "MMM", "B": "MMMM", "a": "EEE", "A": "EEEE", "-d": "d", "-m": "M", "-H": "H", "-I": "h", "-M": "m", "-S": "s", "%": "'%'"}


def date_pattern(codes: str) -> str:
    """A strftime format as a pattern of date_format."""
    out, at, literal = "", 0, ""

    def flush() -> str:
        return "'" + literal.replace("'", "''") + "'" if literal else ""

    while at < len(codes):
        if codes[at] == "%":
            code = codes[at + 1 : at + 3] if codes[at + 1 : at + 2] == "-" else codes[at + 1 : at + 2]
            if code not in _CODES:
                raise OptionError(f"%{code} is not known in a date format")
            out, literal = out + flush() + _CODES[code], ""
            at += 1 + len(code)
        else:
            literal += codes[at]
            at += 1
    return out + flush()


def write_options(given: dict) -> dict:
    found = {}
    for key, value in given.items():
        name = key.lower()
        if name not in _OPTIONS and name not in _SETTLED:
            raise OptionError(f"write_ion has no option {name!r}")
        if isinstance(value, (list, tuple)) and name != "partition_by":
            if len(value) != 1:
                raise OptionError(f"{name} takes one value")
            value = value[0]
        if name in _SETTLED:
            if (value.lower() if isinstance(value, str) else value) != _SETTLED[name]:
                raise OptionError(f"{name} can only be {_SETTLED[name]}")
            continue
        found[name.replace("_format", "format")] = value
    for name, mode in (("append", "append"), ("overwrite", "overwrite"), ("overwrite_or_ignore", "overwrite")):
        if found.pop(name, False):
            found.setdefault("mode", mode)
    if found.get("binary") and ("dateformat" in found or "timestampformat" in found):
        raise OptionError("date and timestamp formats can't be used with binary Ion")
    return found


def _formatted(df: DataFrame, options: dict) -> DataFrame:
    """Top-level dates, and timestamps without zone, as strings if there is a format."""
    for f in df.schema:
        for kind, option in ((T.DateType, "dateformat"), (T.TimestampNTZType, "timestampformat")):
            if isinstance(f.dataType, kind) and option in options:
                df = df.withColumn(f.name, F.date_format(f.name, date_pattern(options[option])))
    return df


#: Rows of more columns are written as text in Arrow batches: their expression would be larger
#: than what Spark compiles.
WIDE = 24


def text_rows(df: DataFrame, floats: str = "plain") -> DataFrame:
    """df's rows as one column `value` of Ion text."""
    if len(df.columns) <= WIDE or floats != "plain":
        return df.select(to_ion(df, floats=floats, shown=python_float).alias("value"))
    ship_code(df.sparkSession)

    def run(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([row_texts(batch, literal)], ["value"])

    return df.mapInArrow(run, "value string")


def write_ion(df: DataFrame, path: str, **given) -> list[str] | None:
    """Write df's rows as structs; with return_files, tell the files that the folder then has.

    array: each file is one list. binary: binary Ion. dateformat, timestampformat: strftime
    formats for top-level columns (text only). compression ('gzip'), mode ('error',
    'append', 'overwrite', 'ignore'), partition_by (text without array),
    max_records_per_file: as in Spark. write_partition_columns: partition columns also stay
    in the rows. file_extension: three letters for text, `ion` if not given; `10n` for binary.
    file_size_bytes: lists and binary files end with the batch in which they pass this size.
    append, overwrite, overwrite_or_ignore: other ways to say mode. floats: see `to_ion`. An
    empty DataFrame gives a folder with an empty file or list.
    """
    options = write_options(given)
    _write(df, path, options)
    if options.get("return_files"):
        return list_files(df.sparkSession, f"{path.rstrip('/')}{'/*' * len(options.get('partition_by') or ())}")
    return None


def _write(df: DataFrame, path: str, options: dict) -> None:
    if not options.get("binary") and not options.get("array"):
        parts = list(options.get("partition_by") or [])
        extension = options.get("file_extension", _TEXT_EXTENSION)
        if len(extension) != 3 or not extension.isalpha():
            raise OptionError("file_extension of text needs to be three letters")
        rows, floats = _formatted(df, options), options.get("floats", "plain")
        if parts:
            kept = rows if options.get("write_partition_columns") else rows.drop(*parts)
            lines = rows.select(to_ion(kept, floats=floats, shown=python_float).alias("value"), *parts)
        else:
            lines = text_rows(rows, floats)
        # The sink for separated values lets the ending be chosen. Lines have no tab of their
        # own, so there is nothing that it would quote.
        writer = lines.write.mode(options.get("mode", "error")).options(sep="\t", quote="", escapeQuotes=False, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False, extension=extension)
        if parts:
            writer = writer.partitionBy(*parts)
        for name, spark_name in (("compression", "compression"), ("max_records_per_file", "maxRecordsPerFile")):
            if name in options:
                writer = writer.option(spark_name, options[name])
        writer.csv(path)
        return
    _write_files(_formatted(df, options), path, options)


def _write_files(df: DataFrame, path: str, options: dict) -> None:
    spark = df.sparkSession
    ship_code(spark)
    jvm = spark._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    fs = where.getFileSystem(spark._jsc.hadoopConfiguration())
    mode = options.get("mode", "error")
    if fs.exists(where):
        if mode in ("error", "errorifexists"):
            raise OptionError(f"{path} is there already")
        if mode == "ignore":
            return
    binary, array, zipped = bool(options.get("binary")), bool(options.get("array")), options.get("compression") == "gzip"
    if options.get("compression") not in (None, "none", "gzip", "uncompressed"):
        raise OptionError("only gzip compresses lists and binary Ion")
    job = uuid.uuid4().hex
    root = fs.makeQualified(where).toString()
    temporary = f"{root}/_temporary-{job}"
    ending = options.get("file_extension", _BINARY_EXTENSION if binary else _TEXT_EXTENSION) + (".gz" if zipped else "")
    schema = df.schema
    told = df if binary else text_rows(df, options.get("floats", "plain"))
    most, largest = int(options.get("max_records_per_file") or 0), int(options.get("file_size_bytes") or 0)

    def write(batches):
        part, attempt, n = TaskContext.get().partitionId(), TaskContext.get().taskAttemptId(), 0
        sink, left = None, 0

        def begin():
            nonlocal n
            name = f"part-{part:05d}-{n:03d}-{job}.{ending}"
            n += 1
            return name, _Sink(f"{temporary}/{attempt}/{name}", zipped, binary, array, schema)

        for batch in batches:
            at = 0
            while at < batch.num_rows:
                if sink is None:
                    name, sink = begin()
                    left = most or 1 << 62
                own = batch.slice(at, min(left, batch.num_rows - at))
                sink.add(own)
                at += own.num_rows
                left -= own.num_rows
                if not left or (largest and sink.size >= largest):
                    sink.close()
                    yield pa.RecordBatch.from_arrays([pa.array([f"{attempt}/{name}"])], ["name"])
                    sink = None
        if sink is None and not n and part == 0:
            name, sink = begin()
        if sink is not None:
            sink.close()
            yield pa.RecordBatch.from_arrays([pa.array([f"{attempt}/{name}"])], ["name"])

    path_of = jvm.org.apache.hadoop.fs.Path
    try:
        # One name for each file; of tasks that ran twice only the one that counted is told.
        names = [r.name for r in told.mapInArrow(write, "name string").collect()]
        if mode == "overwrite" and fs.exists(where):
            for s in fs.listStatus(where):
                if s.getPath().getName() != f"_temporary-{job}":
                    fs.delete(s.getPath(), True)
        for name in names:
            if not fs.rename(path_of(f"{temporary}/{name}"), path_of(f"{root}/{name.partition('/')[2]}")):
                raise OSError(f"{name} could not be put in place")
        fs.create(path_of(f"{root}/_SUCCESS"), True).close()
    finally:
        fs.delete(path_of(temporary), True)


def _open(path: str):
    """A stream to a file in any store that pyarrow knows; local ones without it."""
    from pyarrow import fs as arrow_fs

    store, inner = arrow_fs.FileSystem.from_uri(path)
    store.create_dir(inner.rpartition("/")[0], recursive=True)
    return store.open_output_stream(inner, compression=None)


class _Sink:
    def __init__(self, path: str, zipped: bool, binary: bool, array: bool, schema: T.StructType):
        raw = _open(path)
        self.raw = raw
        self.out = pa.CompressedOutputStream(raw, "gzip") if zipped else raw
        self.binary, self.array, self.first = binary, array, True
        self.symbols = Symbols()
        self.schema = schema
        self.body = self.out
        self.size = 0
        if binary:
            _known_names(schema, self.symbols)
            self.out.write(MARK + self.symbols.table(False))
            if array:  # a list begins with its length, so its items wait beside the task
                self.body = tempfile.TemporaryFile()
        elif array:
            self.out.write(b"[\n")

    def add(self, batch: pa.RecordBatch) -> None:
        if not self.binary:
            lines = ",\n".join(batch.column(0).to_pylist()).encode()
            self.out.write(lines if self.first else b",\n" + lines)
            self.size += len(lines)
            self.first = False
            return
        data = rows(batch, self.symbols, single)
        self.body.write(data)
        self.size += len(data)

    def close(self) -> None:
        if self.binary and self.array:
            size = self.body.tell()
            self.out.write(bytes((0xB0 | size,)) if size < 14 else b"\xbe" + varuint(size))
            self.body.seek(0)
            while part := self.body.read(_PART):
                self.out.write(part)
            self.body.close()
        elif self.array:
            self.out.write(b"\n]\n")
        self.out.close()
        if self.out is not self.raw:
            self.raw.close()


def _known_names(kind: T.DataType, symbols: Symbols) -> None:
    """All field names of a type go into the table before the first value."""
    if isinstance(kind, T.StructType):
        for f in kind:
            symbols.sid(f.name)
            _known_names(f.dataType, symbols)
    elif isinstance(kind, T.ArrayType):
        _known_names(kind.elementType, symbols)


#: Bytes that are copied at once.
_PART = 8 << 20


def single(kind: pa.DataType):
    """A function from one Python value of an Arrow type to binary Ion, for the types and
    ranges that have no form for whole columns."""
    if pa.types.is_decimal(kind):
        return encode_decimal
    if pa.types.is_date(kind):
        return lambda v: encode_timestamp(Timestamp(DAY, v.year, v.month, v.day))
    if pa.types.is_timestamp(kind):

        def timestamp(v: dt.datetime) -> bytes:
            if v.tzinfo is not None:
                v = v.astimezone(dt.timezone.utc).replace(tzinfo=None)
            return encode_timestamp(Timestamp(SECOND, v.year, v.month, v.day, v.hour, v.minute, v.second, f"{v.microsecond:06d}" if v.microsecond else "", 0))

        return timestamp
    if pa.types.is_map(kind):

        def shown(v) -> bytes:
            pairs = v.items() if isinstance(v, dict) else v
            return tagged(8, ("{" + ", ".join(f"{k}={'NULL' if x is None else x}" for k, x in pairs) + "}").encode())

        return shown
    return lambda v: tagged(8, str(v).encode())
