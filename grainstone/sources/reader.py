"""read_ion: Ion files as a DataFrame.

Files are listed and read by Spark, so paths can be in any store it knows. Text with
format='newline_delimited' is read by lines, which Spark splits and reads in parallel; any
other file is one task's, as Ion text can only be cut where its values are known to end. The
schema comes from `columns` or from a bounded sample that an executor looks through; the
scan hands Arrow batches to Spark. Only columns that are asked for are decoded.
"""

from __future__ import annotations

import gzip
import math
import pickle
import time
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from ..cluster import ship_code
from ..operators.coerce import coerce
from ..plans.inference import Inference
from ..plans.types import plain
from .ionbinary import MARK, BinaryReader
from .ioncolumns import ColumnReader
from .iontext import TextReader
from .options import OptionError, ReadOptions, read_options
from .shape import Shape, fast_column
from .values import IonError, Struct

BATCH = 8192
#: Text files of more bytes are looked through, whether they can be read by lines.
LARGE = 16 << 20
_LIST = "with format='array' a file has to begin with a list"
_RECORDS = "records have to be structs"


def file_values(data: bytes, form: str) -> Iterator[object]:
    """Top-level values of a file, text or binary, gzipped or not; with form 'array' the
    elements of its first one."""
    if data[:2] == b"\x1f\x8b":
        data = gzip.decompress(data)
    if data[:4] == MARK:
        values = BinaryReader(data).values()
    else:
        values = TextReader(data.decode("utf-8-sig")).values()
    if form != "array":
        yield from values
        return
    first = next(values, ())
    if not isinstance(first, list) or isinstance(first, Struct):
        raise IonError(_LIST)
    yield from first


def list_files(spark: SparkSession, path) -> list[str]:
    """Files of a path or glob, or of a list of them, in order."""
    return [p for p, _ in _listed(spark, path)]


def _listed(spark: SparkSession, path) -> list[tuple[str, int]]:
    """The files with their sizes."""
    given = [path] if isinstance(path, str) else path
    if not isinstance(given, (list, tuple)) or not given or not all(isinstance(p, str) for p in given):
        raise OptionError("read_ion takes a path or a list of paths")
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    found = []
    for p in given:
        where = jvm.org.apache.hadoop.fs.Path(p)
        fs = where.getFileSystem(conf)
        matches = fs.globStatus(where)
        own = []
        for m in matches or ():
            if m.isDirectory():
                own += [(s.getPath().toString(), s.getLen()) for s in fs.listStatus(m.getPath()) if s.isFile() and s.getPath().getName()[0] not in "._"]
            elif m.getPath().getName()[0] not in "._" or len(matches) == 1:
                own.append((m.getPath().toString(), m.getLen()))
        if not own:
            raise OptionError(f'No files found that match the pattern "{p}"')
        found += sorted(own)
    return found


def _closed(depth: int) -> str:
    """A pattern of one struct that begins and ends in its line, of nested values up to a depth.

    Comments, long strings and quoted symbols, which could go over lines, aren't in it, and
    between structs nothing joins, so of lines that all match each is one value.
    """
    plain = r'(?:[^{}\[\]()"\'/\r]|"(?:[^"\\\r]|\\[^\r])*")*'
    inner = plain
    for _ in range(depth):
        inner = rf"{plain}(?:[{{\[(]{inner}[}}\])]{plain})*"
    return rf"^\s*(?:\{{{inner}\}}\s*)?$"


_CLOSED = _closed(8)


def _by_lines(spark: SparkSession, listed: list[tuple[str, int]], options: ReadOptions) -> list[str]:
    """Files that can be read by lines: all with format='newline_delimited', with 'auto' large
    ones in which every line is found to be a struct by itself. That takes a pass over these."""
    if options.format != "auto":
        return [p for p, _ in listed] if options.format == "newline_delimited" else []
    jvm = spark._jvm
    codecs = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(spark._jsc.hadoopConfiguration())
    large = [p for p, size in listed if size > LARGE and codecs.getCodec(jvm.org.apache.hadoop.fs.Path(p)) is None]
    large = [p for p in large if _beginning(spark, p).lstrip()[:1] in (b"{", b"")]
    if not large:
        return []

    def unlike(batches):
        told = set()
        for batch in batches:
            odd = pc.invert(pc.match_substring_regex(batch.column(0), _CLOSED))
            told.update(batch.column(1).filter(pc.fill_null(odd, True)).unique().to_pylist())
        yield pa.RecordBatch.from_arrays([pa.array(list(told), pa.int64())], ["file"])

    number = F.xxhash64("_metadata.file_path").alias("file")
    rows = spark.read.option("lineSep", "\n").text(large).select("value", number)
    others = {r.file for r in rows.mapInArrow(unlike, "file long").distinct().collect()}
    numbers = spark.read.format("binaryFile").load(large).select("path", number).collect()
    own = {r.path for r in numbers if r.file not in others}
    return [p for p in large if p in own]


def _beginning(spark: SparkSession, path: str) -> bytes:
    """The first bytes of a file, as many as the mark has; fewer of a shorter file."""
    jvm = spark._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    stream = where.getFileSystem(spark._jsc.hadoopConfiguration()).open(where)
    try:
        own = [stream.read() for _ in MARK]
        return bytes(b for b in own if b >= 0)
    finally:
        stream.close()


class Lines:
    """Values of lines as they come in batches. Mostly a line is a value; where one isn't,
    the lines are a stream: values, comments and symbol tables may go over several, also from
    batch to batch."""

    #: What a value without end may grow to before it is taken for a fault.
    MOST = 16 << 20

    def __init__(self):
        self.symbols: list[str | None] | None = None
        self.open = ""

    def values(self, lines: list[str], last: bool = False) -> Iterator[object]:
        """The values that end in these lines; with `last`, there can be no others."""
        reader = TextReader("\n".join([self.open, *lines] if self.open else lines))
        reader.symbols = self.symbols or reader.symbols
        self.open = ""
        try:
            yield from reader.values()
        except IonError as e:
            self.open = reader.text[reader.done :]
            if last or len(self.open) > self.MOST:
                raise IonError(f"{e}; with format='newline_delimited' a value has to end in the split that it begins in") from e
        self.symbols = reader.symbols

    def each(self, lines: list[str]) -> list[object] | None:
        """The values of lines that each are some; None if they aren't."""
        if self.open:
            return None
        reader = TextReader("")
        reader.symbols = self.symbols or reader.symbols
        found: list[object] = []
        try:
            for reader.text in lines:
                found += reader.values()
        except IonError:
            return None
        self.symbols = reader.symbols
        return found


def infer(spark: SparkSession, files: list[str], options: ReadOptions, by_lines: list[str]) -> tuple[T.StructType, bool]:
    """The schema and whether values are records, from a sample in the order of the files.

    Files without a value say nothing and aren't counted: tasks without rows write such ones,
    and the first may be among them. Without union_by_name the first file that has a value is
    the only one.
    """
    most = options.maximum_sample_files if options.union_by_name else 1
    state = Inference(options.records, options.maximum_depth)
    looked, lined = 0, set(by_lines)
    for path in files:
        left = options.sample_size - state.seen
        if left <= 0 or looked >= most:
            break
        begins = _beginning(spark, path)
        if not begins:
            continue
        before = state.seen
        state = _sample(spark, path, options, state, left, path in lined and begins != MARK)
        looked += state.seen > before
    return state.schema(options.rules)


def _sample(spark: SparkSession, path: str, options: ReadOptions, state: Inference, left: float, lined: bool) -> Inference:
    begin, form = pickle.dumps(state), options.format

    def look(batches):
        own, n, taken = pickle.loads(begin), 0, Lines()
        for batch in batches:
            if pa.types.is_string(batch.column(0).type) or pa.types.is_large_string(batch.column(0).type):
                values = taken.values(batch.column(0).to_pylist())
            else:
                values = (v for data in batch.column(0).to_pylist() for v in file_values(data, form))
            for v in values:
                own.add(v)
                n += 1
                if n >= left:
                    break
            if n >= left:
                break
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(own)], pa.binary())], ["state"])

    if lined:
        rows = spark.read.text(path)
        rows = rows.where("trim(value) <> ''").limit(int(left)) if left != math.inf else rows
        rows = rows.coalesce(1)
    else:
        rows = spark.read.format("binaryFile").load(path).select("content")
    row = rows.mapInArrow(look, "state binary").first()
    return pickle.loads(row[0]) if row else state  # an empty file has no partition


def _arrays(values: Iterator[object], schema: T.StructType, records: bool) -> Iterator[list[list]]:
    names = [f.name for f in schema]
    kinds = [f.dataType for f in schema]
    place = {n: i for i, n in enumerate(names)}
    columns: list[list] = [[] for _ in names]
    n = 0
    for value in values:
        if not records:
            if columns:
                columns[0].append(coerce(value, kinds[0]))
        elif value is None:
            for c in columns:
                c.append(None)
        elif not isinstance(value, Struct):
            raise IonError(_RECORDS)
        else:
            row: list = [None] * len(names)
            for k, v in value:
                i = place.get(k)
                if i is not None and v is not None:
                    row[i] = coerce(v, kinds[i])
            for c, v in zip(columns, row):
                c.append(v)
        n += 1
        if n == BATCH:
            yield columns, n
            columns, n = [[] for _ in names], 0
    if n:
        yield columns, n


def _batch(columns: list[list], n: int, kinds: list[pa.DataType], names: list[str]) -> pa.RecordBatch:
    if not names:
        return pa.RecordBatch.from_arrays([pa.nulls(n, pa.bool_())], ["__none"])
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)


def _lines_scan(lines: list[str], schema: T.StructType, records: bool, kinds: list[pa.DataType], shape: Shape | None, taken: Lines) -> Iterator[pa.RecordBatch]:
    """Batches of a run of lines: those of the shape at once, the rest by the parser. If the
    rest aren't values each, all lines are a stream."""
    names = [f.name for f in schema]
    found: list[tuple] = []
    values: Iterator[object] | list[object] | None = None
    if shape is not None and shape.pattern is not None and not taken.open:
        found, odd = shape.take(lines)
        values = taken.each([lines[i] for i in odd])
    if values is None:
        found, values = [], taken.values(lines)
    if found:
        columns = list(zip(*found)) if shape.names else []
        arrays = []
        for f, kind in zip(schema, kinds):
            if f.name not in shape.names:
                arrays.append(pa.nulls(len(found), kind))
                continue
            i = shape.names.index(f.name)
            array = fast_column(columns[i], shape.kinds[i], f.dataType, kind)
            if array is None:
                array = pa.array([coerce(next(TextReader(t).values()), f.dataType) for t in columns[i]], kind)
            arrays.append(array)
        yield pa.RecordBatch.from_arrays(arrays, names) if names else _batch([], len(found), [], [])
    for columns, n in _arrays(iter(values), schema, records):
        yield _batch(columns, n, kinds, names)


def _lines_end(schema: T.StructType, records: bool, kinds: list[pa.DataType], taken: Lines) -> Iterator[pa.RecordBatch]:
    """What is open when there are no more lines: nothing, or a fault."""
    for columns, n in _arrays(taken.values([], last=True) if taken.open else iter(()), schema, records):
        yield _batch(columns, n, kinds, schema.names)


def read_ion(spark: SparkSession, path, select: list[str] | None = None, **given) -> DataFrame:
    """Ion files as a DataFrame; options as in `read_options`.

    `select` names the columns that are decoded, in their order; an empty list decodes none
    and is for counting (see `count_ion`). Null values give rows of nulls; fields that aren't
    in the schema are passed over, fields that are absent are null.
    """
    options = read_options(given)
    ship_code(spark)
    listed = _listed(spark, path)
    files, by_lines = [p for p, _ in listed], _by_lines(spark, listed, options)
    if options.columns is not None:
        schema, records = options.columns, True
    else:
        schema, records = infer(spark, files, options, by_lines)
    if select is not None:
        missing = [c for c in select if c not in schema.names]
        if missing:
            raise OptionError(f"read_ion has no column {missing[0]!r}; there are {', '.join(schema.names)}")
        schema = T.StructType([schema[c] for c in select])
    return _scan(spark, files, by_lines, options, schema, records)


def _scan(spark: SparkSession, files: list[str], by_lines: list[str], options: ReadOptions, schema: T.StructType, records: bool) -> DataFrame:
    names = [f.name for f in schema]
    kinds = [to_arrow_type(plain(f.dataType)) for f in schema]
    shown = plain(schema) if names else T.StructType([T.StructField("__none", T.BooleanType())])
    form = options.format
    sc = spark.sparkContext
    rows_read, seconds = (sc.accumulator(0), sc.accumulator(0.0)) if options.profile else (None, None)

    def told(batches):
        if rows_read is None:
            yield from batches
            return
        batches = iter(batches)
        while True:
            began = time.perf_counter()
            b = next(batches, None)
            seconds.add(time.perf_counter() - began)
            if b is None:
                return
            rows_read.add(b.num_rows)
            yield b

    def decoded(data: bytes) -> Iterator[pa.RecordBatch]:
        if records:
            yield from ColumnReader(data, schema, kinds, form == "array").batches()
        else:
            for columns, n in _arrays(file_values(data, form), schema, records):
                yield _batch(columns, n, kinds, names)

    def lines(batches):
        shape, taken, now = None, Lines(), None
        binary: _Binary | None = None
        for batch in batches:
            for value, file, size in _by_file(batch):
                if file != now:
                    if binary is not None:
                        yield from told(decoded(binary.data()))
                    yield from told(_lines_end(schema, records, kinds, taken))
                    binary, taken, now = None, Lines(), file
                    if value[0].as_py()[:4] == MARK:  # no text begins so: the mark isn't UTF-8
                        binary = _Binary(size, [])
                if binary is not None:
                    binary.parts += value.to_pylist()
                    continue
                own = value.cast(pa.string()).to_pylist()
                if shape is None and records and (first := next((x for x in own if x and not x.isspace()), None)):
                    shape = Shape(first, schema)
                yield from told(_lines_scan(own, schema, records, kinds, shape, taken))
        if binary is not None:
            yield from told(decoded(binary.data()))
        yield from told(_lines_end(schema, records, kinds, taken))

    def whole(batches):
        for batch in batches:
            for data in batch.column(0).to_pylist():
                if records and form != "array" and data[:4] != MARK and data[:2] != b"\x1f\x8b":
                    text = data.decode("utf-8-sig")
                    taken = _same_shape(text, schema, kinds)
                    if taken is not None:
                        yield from told(taken)
                        continue
                if data[:2] == b"\x1f\x8b":
                    data = gzip.decompress(data)
                if data[:4] == MARK:
                    yield from told(decoded(data))
                    continue
                for columns, n in _arrays(file_values(data, form), schema, records):
                    yield from told([_batch(columns, n, kinds, names)])

    parts, lined = [], set(by_lines)
    if by_lines:
        rows = spark.read.option("lineSep", "\n").text(by_lines)
        size = F.when(F.col("_metadata.file_path").endswith(".gz"), -1).otherwise(F.col("_metadata.file_size"))
        rows = rows.select(F.col("value").cast("binary").alias("value"), F.xxhash64("_metadata.file_path").alias("file"), size.alias("size"))
        parts.append(rows.mapInArrow(lines, shown))
    if rest := [p for p in files if p not in lined]:
        parts.append(spark.read.format("binaryFile").load(rest).select("content").mapInArrow(whole, shown))
    df = parts[0] if len(parts) == 1 else parts[0].unionAll(parts[1])
    if rows_read is not None:
        df.ion_rows_read, df.ion_seconds = rows_read, seconds
    return df


@dataclass
class _Binary:
    """A binary file that comes as lines, as it lies among text files."""

    size: int
    parts: list[bytes]

    def data(self) -> bytes:
        data = b"\n".join(self.parts)
        if len(data) == self.size - 1:
            data += b"\n"  # a last line end is no line
        if self.size >= 0 and len(data) != self.size:
            raise IonError("a binary file as large as this one can't be read with format='newline_delimited'")
        return data


def _by_file(batch: pa.RecordBatch) -> Iterator[tuple[pa.Array, int, int]]:
    """The batch's lines in runs of one file, with its number and size."""
    value = batch.column(0)
    files, sizes = (batch.column(i).to_numpy(zero_copy_only=False) for i in (1, 2))
    bounds = [0, *(np.flatnonzero(np.diff(files)) + 1).tolist(), len(value)]
    for low, high in zip(bounds, bounds[1:]):
        if low < high:
            yield value.slice(low, high - low), int(files[low]), int(sizes[low])


def _same_shape(text: str, schema: T.StructType, kinds: list[pa.DataType]) -> Iterator[pa.RecordBatch] | None:
    """Batches of a file whose lines all have one shape; None for any other file."""
    lines = text.split("\n")
    if lines and not lines[-1]:
        lines.pop()
    if len(lines) < 2:
        return None
    shape = Shape(lines[0], schema)
    if shape.pattern is None or not all(map(shape.pattern.fullmatch, lines)):
        return None
    return (b for low in range(0, len(lines), 1 << 16) for b in _lines_scan(lines[low : low + (1 << 16)], schema, True, kinds, shape, Lines()))


def count_ion(spark: SparkSession, path, **given) -> int:
    """How many top-level values the files hold. No field of a record is decoded."""
    return read_ion(spark, path, select=[], **given).count()


class IonFrame:
    """Ion files whose scan isn't made yet: `select` and `where` narrow what it decodes."""

    def __init__(self, spark: SparkSession, path, **given):
        self.spark, self.options = spark, read_options(given)
        ship_code(spark)
        listed = _listed(spark, path)
        self.files, self.by_lines = [p for p, _ in listed], _by_lines(spark, listed, self.options)
        if self.options.columns is not None:
            self.schema, self.records = self.options.columns, True
        else:
            self.schema, self.records = infer(spark, self.files, self.options, self.by_lines)

    @property
    def columns(self) -> list[str]:
        return self.schema.names

    def df(self, columns: list[str] | None = None) -> DataFrame:
        kept = self.schema if columns is None else T.StructType([self.schema[c] for c in columns])
        return _scan(self.spark, self.files, self.by_lines, self.options, kept, self.records)

    def select(self, *columns: str | Column) -> DataFrame:
        """A selection; the scan decodes only what its expressions name."""
        return self._needing(*columns).select(*columns)

    def where(self, condition: str, *columns: str) -> DataFrame:
        """Columns of the rows that pass; the scan decodes those and the condition's."""
        return self._needing(F.expr(condition), *columns).where(condition).select(*columns)

    def count(self) -> int:
        return self.df([]).count()

    def _needing(self, *expressions: str | Column) -> DataFrame:
        empty = self.spark.createDataFrame([], plain(self.schema))
        plan = empty.select(*(F.expr(e) if isinstance(e, str) else e for e in expressions))
        used = {a.name() for a in _scala_list(plan._jdf.queryExecution().analyzed().references().toSeq())}
        return self.df([c for c in self.columns if c in used])


def _scala_list(seq) -> list:
    return [seq.apply(i) for i in range(seq.size())]


def ion_view(spark: SparkSession, name: str, path, **given) -> DataFrame:
    """Make the files a temporary view for SQL."""
    df = read_ion(spark, path, **given)
    df.createOrReplaceTempView(name)
    return df
