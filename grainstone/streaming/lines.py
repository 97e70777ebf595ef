"""Newline-delimited Ion as a stream, and Ion text as a streaming sink."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.streaming import StreamingQuery

from ..cluster import ship_code
from ..functions.to_ion import to_ion
from ..plans.types import plain
from ..sources.options import OptionError, read_options
from ..sources.reader import Lines, _lines_end, _lines_scan
from ..sources.shape import Shape


def read_ion_stream(spark: SparkSession, path: str, **given) -> DataFrame:
    """New files of a folder, each value on its line, as a streaming DataFrame.

    A stream's schema can't come from a sample, so `columns` is needed.
    """
    options = read_options(given)
    if options.columns is None:
        raise OptionError('a stream of Ion needs "columns"')
    ship_code(spark)
    schema = options.columns
    kinds = [to_arrow_type(plain(f.dataType)) for f in schema]

    def parse(batches):
        shape, taken = None, Lines()
        for batch in batches:
            own = batch.column(0).to_pylist()
            if shape is None and (first := next((x for x in own if x and not x.isspace()), None)):
                shape = Shape(first, schema)
            yield from _lines_scan(own, schema, True, kinds, shape, taken)
        yield from _lines_end(schema, True, kinds, taken)

    return spark.readStream.text(path).mapInArrow(parse, plain(schema))


def write_ion_stream(df: DataFrame, path: str, checkpoint: str, **trigger) -> StreamingQuery:
    """Append a stream's rows as Ion text; trigger as in `DataStreamWriter.trigger`."""
    rows = df.select(to_ion(df).alias("value"))
    return rows.writeStream.format("text").option("path", path).option("checkpointLocation", checkpoint).trigger(**trigger).start()
