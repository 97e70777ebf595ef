import datetime as dt
import gzip
import json
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from grainstone import catalog
from grainstone.functions.sql import list_extract, register
from grainstone.functions.to_ion import to_ion
from grainstone.operators.coerce import coerce, show
from grainstone.plans.types import parse_type, promote, type_name
from grainstone.sources import ionbinary as B
from grainstone.sources.options import OptionError
from grainstone.sources.reader import IonFrame, count_ion, read_ion
from grainstone.sources.writer import date_pattern, write_ion
from grainstone.streaming.lines import read_ion_stream, write_ion_stream

FILES = {
    "sample": '{bigint: 1, varchar: "two", bool: true, decimal: 12.34d0, timestamptz: 2020-01-02T03:04:05.678Z, blob: {{AQID}}}\n{bigint: 2, varchar: "three"}\n{bool: false}\n',
    "scalars": "1\n2\n3\n",
    "array": '[\n  {bigint: 1, varchar: "two", bool: true},\n  {bigint: 2, varchar: "three", bool: false}\n]\n',
    "floats": "1e0\n3.5\n-2.25\n",
    "nested": '{id: 1, nested: {name: "alpha", score: 10}, tags: ["x", "y"], nums: [1, 2]}\n{id: "two", nested: {name: "beta"}, tags: ["z"], nums: [3]}\n',
    "conflicts": '{nested: {score: 10}, nums: [1, 2]}\n{nested: {score: "high"}, nums: ["x"]}\n{nested: {score: 12.5}, nums: [3]}\n{nested: {score: 7}, nums: [{k: 1}]}\n',
    "sparse": "{obj: {a: 1}}\n{obj: {b: 2}}\n{obj: {a: 3, b: 4}}\n",
    "wide": "{obj: {a: 1, b: 2}}\n{obj: {a: 3, b: 4}}\n",
    "multi_1": '{id: 1, name: "a"}\n{id: 2, name: "b"}\n',
    "multi_2": '{id: 3, name: "c"}\n',
    "union_1": "{a: 1}\n",
    "union_2": "{b: 2}\n",
    "nulls": '{a: null.int, b: null.string, c: null.decimal, d: null.timestamp, e: null.bool}\n{a: 1, b: "x", c: 12.34d0, d: 2020-01-01T00:00:00Z, e: true}\n',
    "allnull": "null\nnull.struct\n",
    "empty": "",
    "odd": "{a: 1, a: null, b: {x: 1, x: 2}}\n{a: (s e x p), b: {}}\n",
}


@pytest.fixture(scope="module", params=["text", "binary", "gzip"])
def at(request, tmp_path_factory):
    folder = tmp_path_factory.mktemp(request.param)
    for name, text in FILES.items():
        data = B.transcode(text) if request.param == "binary" else text.encode()
        (folder / f"{name}.ion").write_bytes(gzip.compress(data) if request.param == "gzip" else data)
    return lambda name: str(folder / f"{name}.ion")


def types(df):
    return [type_name(f.dataType) for f in df.schema]


def rows(df):
    return [tuple(r) for r in df.collect()]


def test_golden_files(spark, at):
    df = read_ion(spark, at("sample"))
    assert types(df) == ["BIGINT", "VARCHAR", "BOOLEAN", "DECIMAL(18,3)", "TIMESTAMP WITH TIME ZONE", "BLOB"]
    assert rows(df)[0] == (1, "two", True, Decimal("12.340"), dt.datetime(2020, 1, 2, 3, 4, 5, 678000), b"\1\2\3")
    assert rows(df.select("bigint", "bool")) == [(1, True), (2, None), (None, False)]
    assert rows(read_ion(spark, at("scalars"), records=False)) == [(1,), (2,), (3,)]
    assert rows(read_ion(spark, at("array"), format="array")) == [(1, "two", True), (2, "three", False)]
    assert types(read_ion(spark, at("array"))) == ["STRUCT(bigint BIGINT, varchar VARCHAR, bool BOOLEAN)[]"]
    assert types(read_ion(spark, at("floats"))) == ["DOUBLE"]
    df = read_ion(spark, at("nested"))
    assert types(df) == ["VARCHAR", 'STRUCT("name" VARCHAR, score BIGINT)', "VARCHAR[]", "BIGINT[]"]
    assert rows(df.select("id", "nested.name", list_extract("tags", 1), list_extract("nums", 2), list_extract("nums", 0))) == [("1", "alpha", "x", 2, None), ("two", "beta", "z", None, None)]
    assert types(read_ion(spark, at("nested"), maximum_depth=1))[1:] == ['STRUCT("name" VARCHAR, score VARCHAR)', "VARCHAR[]", "VARCHAR[]"]
    assert rows(read_ion(spark, at("conflicts")).select("nested.score", F.col("nums")[0])) == [("10", "1"), ("high", "x"), ("12.500000000000000000", "3"), ("7", "{'k': 1}")]
    assert rows(read_ion(spark, at("conflicts"), conflict_mode="json").select("nested.score", F.col("nums")[0]))[1::2] == [('"high"', '"x"'), ("7", '{"k": 1}')]
    assert types(read_ion(spark, at("sparse"), field_appearance_threshold=0.8)) == ["MAP(VARCHAR, BIGINT)"]
    assert types(read_ion(spark, at("sparse"), field_appearance_threshold=0.8, map_inference_threshold=-1)) == ["STRUCT(a BIGINT, b BIGINT)"]
    assert types(read_ion(spark, at("wide"), map_inference_threshold=2)) == ["MAP(VARCHAR, BIGINT)"]
    assert read_ion(spark, at("multi_[12]")).count() == read_ion(spark, [at("multi_1"), at("multi_2")]).count() == 3
    assert read_ion(spark, [at("union_1"), at("union_2")], union_by_name=True).columns == ["a", "b"]
    df = read_ion(spark, [at("union_1"), at("union_2")], union_by_name=True, maximum_sample_files=1, sample_size=1)
    assert rows(df) == [(1,), (None,)]
    assert types(read_ion(spark, at("nulls"))) == ["BIGINT", "VARCHAR", "DECIMAL(18,3)", "TIMESTAMP WITH TIME ZONE", "BOOLEAN"]
    assert count_ion(spark, at("sample")) == 3 and IonFrame(spark, at("sample")).count() == 3


def test_edges(spark, at):
    assert rows(read_ion(spark, at("allnull"))) == [(None,), (None,)]
    assert rows(read_ion(spark, at("empty"))) == []
    assert read_ion(spark, at("odd"), select=["b"]).count() == 2
    with pytest.raises(Exception, match="s-expressions"):
        read_ion(spark, at("odd"), select=["a"]).collect()
    assert read_ion(spark, at("odd"), columns={"b": "MAP(VARCHAR, SMALLINT)"}).collect()[0].b == {"x": 2}
    with pytest.raises(Exception, match="to be structs"):
        read_ion(spark, at("scalars"), columns={"a": "BIGINT"}).collect()
    with pytest.raises(Exception, match="begin with a list"):
        read_ion(spark, at("scalars"), format="array", columns={"a": "BIGINT"}).collect()
    frame = IonFrame(spark, at("nested"))
    assert rows(frame.where("size(nums) > 1", "id")) == [("1",)]
    assert rows(frame.select(F.col("nested.score").alias("s"))) == [(10,), (None,)]


@pytest.mark.parametrize("given, says", [
    ({"columns": "BIGINT"}, "requires a struct as input"), ({"columns": {"b": None}}, "cannot be NULL"), ({"columns": {"b": 1}}, "must be VARCHAR"), ({"columns": {}}, "one column or more"),
    ({"foo": 1}, 'Invalid named parameter "foo"'), ({"format": "csv"}, "auto or newline_delimited or array"), ({"format": 1}, "is 1; it takes auto"), ({"records": "x"}, "true, false or auto"), ({"records": 1}, "true, false or auto"),
    ({"maximum_depth": 0}, "from 1 on, or -1 for any"), ({"field_appearance_threshold": 2}, "from 0 to 1"), ({"map_inference_threshold": -2}, "-1 for no maps"), ({"sample_size": 0}, "-1 for all values"),
    ({"maximum_sample_files": 0}, "-1 for any"), ({"union_by_name": "x"}, "true or false"), ({"profile": 1}, "true or false"), ({"use_extractor": "x"}, "true or false"), ({"conflict_mode": "x"}, "varchar"), ({"profile": None}, "profile of read_ion can.t be NULL"),
    ({"records": False, "columns": {"a": "INT"}}, "records=false"),
])
def test_option_errors(spark, at, given, says):
    with pytest.raises(OptionError, match=says):
        read_ion(spark, at("sample"), **given)


def test_paths(spark, at):
    for path, says in ((5, "a path or a list of paths"), ([], "a path or a list of paths"), ([None], "a path or a list of paths"), (at("nothing*"), "No files found")):
        with pytest.raises(OptionError, match=says):
            read_ion(spark, path)


def test_lines_of_one_shape_and_others(spark, tmp_path):
    shaped = [f'{{id: {i}, c: "w{i}", d: {i}.25, f: {i}e0, b: {str(i % 2 == 0).lower()}, t: 2020-01-0{i % 9 + 1}T00:00:00.5Z, s: {{x: {i}}}, l: ["a", {i}]}}' for i in range(50)]
    odd = ['{id: 50, c: sym, d: 1d1, f: 2, b: null, s: null, extra: [{y: z}]}', "null", '  {c:"x\\n", id:51}  // end']
    (tmp_path / "a.ion").write_text("\n".join([*shaped, *odd]) + "\n")
    (tmp_path / "b.ion").write_text("\n".join(shaped))
    for select in (None, ["d", "id"], ["s"], []):
        got = [read_ion(spark, str(tmp_path / "a.ion"), select=select, format=f) for f in ("auto", "newline_delimited")]
        assert sorted(map(repr, rows(got[0]))) == sorted(map(repr, rows(got[1]))) and got[0].count() == 53
    whole = read_ion(spark, str(tmp_path / "b.ion"))
    assert rows(whole) == rows(read_ion(spark, str(tmp_path / "b.ion"), columns={f.name: type_name(f.dataType) for f in whole.schema}))
    r = whole.where("id = 7").first()
    assert (r.c, r.d, r.f, r.b, r.t, r.s.x, r.l) == ("w7", Decimal("7.250"), 7.0, False, dt.datetime(2020, 1, 8, 0, 0, 0, 500000), 7, ["a", "7"])
    df = read_ion(spark, str(tmp_path / "b.ion"), profile=True)
    df.count()
    assert df.ion_rows_read.value == 50


def everything(spark):
    return spark.sql("""select id, cast(id as double) / 3 d, cast(1.5 as float) f, cast(id as decimal(10,2)) n, concat('a"\\\\\\n\\t', id) s, timestamp_ntz'2020-01-02 03:04:05.678' ts,
        timestamp'2020-01-02 03:04:05' tz, array(1L, null) l, named_struct('null', 'a', 'b c', id) st, map('k', id) m, cast(null as string) e, unhex('010203') b, date'2020-02-03' dt, id = 1 q from range(4)""")


@pytest.mark.parametrize("how", [{}, {"array": True}, {"binary": True}, {"binary": True, "array": True}, {"compression": "gzip"}, {"binary": True, "compression": "gzip"}, {"array": True, "compression": "gzip"}, {"binary": True, "max_records_per_file": 1}])
def test_round_trips(spark, tmp_path, how):
    df = everything(spark).repartition(2)
    path = str(tmp_path / "out")
    write_ion(df, path, **how)
    columns = {"id": "BIGINT", "d": "DOUBLE", "f": "FLOAT", "n": "DECIMAL(10,2)", "s": "VARCHAR", "ts": "TIMESTAMP", "tz": "TIMESTAMPTZ", "l": "BIGINT[]", "st": 'STRUCT("null" VARCHAR, "b c" BIGINT)', "m": "VARCHAR", "e": "VARCHAR", "b": "BLOB", "dt": "DATE", "q": "BOOL"}
    got = read_ion(spark, path, columns=columns, **({"format": "array"} if how.get("array") else {}))
    want = df.withColumn("m", F.concat(F.lit("{k="), "id", F.lit("}")))
    assert sorted(rows(got), key=repr) == sorted(rows(want), key=repr)
    with pytest.raises(Exception):
        write_ion(df, path, **how)
    write_ion(df.limit(1), path, mode="overwrite", **how)
    write_ion(df.where("false"), path, mode="append", **how)
    assert read_ion(spark, path, columns={"id": "BIGINT"}, **({"format": "array"} if how.get("array") else {})).count() == 1


def test_wide_rows_have_the_same_text(spark, monkeypatch):
    from grainstone.sources import writer

    df = everything(spark)
    narrow = rows(writer.text_rows(df))
    monkeypatch.setattr(writer, "WIDE", 3)
    assert rows(writer.text_rows(df)) == narrow


def test_to_ion_goldens(spark):
    one = lambda sql: (lambda df: df.select(to_ion(df, "v").alias("v")).first().v)(spark.sql(f"select {sql} as v"))
    register(spark)
    cases = {
        "named_struct('a', 1, 'b', 'x')": '{a: 1, b: "x"}',
        r"named_struct('a', 1, 'b', 'line\\nbreak')": r'{a: 1, b: "line\\nbreak"}',
        "named_struct('ts', timestamp_ntz'2020-01-02 03:04:05.678')": "{ts: 2020-01-02T03:04:05.678Z}",
        "date'2020-01-02'": "2020-01-02",
        "cast(null as int)": "null",
        "array(1.50, null)": "[1.50, null]",
        "named_struct('null', true, 'x y', unhex('00ff'))": "{'null': true, 'x y': {{AP8=}}}",
        "array(array('a'), null, array())": '[["a"], null, []]',
        "map('k', 1)": '"{k=1}"',
        "cast(12.5 as float)": "12.5",
    }
    for sql, want in cases.items():
        assert one(sql) == want
        assert spark.sql(f"select to_ion({sql}) v").first().v == want
    numbers = [0.1, 1.0, 123456789.125, 1e16, 1e15, 9999999.0, 1e7, 1.5e-4, 1e-5, 2e-323, 6.668646000000001e16, 66686.460000000006, -1.25e300, 5e-4, 0.0]
    df = spark.createDataFrame([(x,) for x in numbers], "v double")
    assert [r.v for r in df.select(to_ion(df, "v").alias("v")).collect()] == [repr(x) for x in numbers]
    df = spark.createDataFrame([(float("nan"),), (float("inf"),), (float("-inf"),)], "v double")
    assert [r.v for r in df.select(to_ion(df, "v").alias("v")).collect()] == ["nan", "+inf", "-inf"]


def test_write_options(spark, tmp_path):
    df = spark.sql("select date'2020-02-03' d, timestamp_ntz'2020-01-02 03:04:05' t")
    write_ion(df, str(tmp_path / "a"), dateformat="%d.%m.%Y it's", timestamp_format="%H-%M")
    assert rows(read_ion(spark, str(tmp_path / "a"))) == [("03.02.2020 it's", "03-04")]
    assert date_pattern("%Y%%") == "yyyy'%'"
    for how, says in (({"x": 1}, "no option"), ({"array": [True, False]}, "takes one value"), ({"binary": True, "dateformat": "%Y"}, "binary"), ({"dateformat": "%Q"}, "not known")):
        with pytest.raises(OptionError, match=says):
            write_ion(df, str(tmp_path / "b"), **how)


def test_types_and_coercion():
    for name in ("BIGINT", "DECIMAL(18,3)", "VARCHAR[]", "MAP(VARCHAR, DOUBLE)", 'STRUCT(a BIGINT, "name" VARCHAR[])', "TIMESTAMP WITH TIME ZONE", "JSON"):
        assert type_name(parse_type(name)) == name
    for bad in ("", "FOO", "STRUCT(a)", "BIGINT x", "LIST(", "a$b"):
        with pytest.raises(ValueError):
            parse_type(bad)
    p = lambda a, b: type_name(promote(parse_type(a), parse_type(b)))
    assert [p("BIGINT", "BOOLEAN"), p("BIGINT", "DECIMAL(18,3)"), p("BLOB", "DOUBLE"), p("BIGINT[]", "DOUBLE[]"), p("NULL", "BIGINT"), p("BIGINT", "NULL"), p("JSON", "DOUBLE")] == ["BIGINT", "DECIMAL(38,18)", "DOUBLE", "DOUBLE[]", "BIGINT", "VARCHAR", "JSON"]
    assert p("STRUCT(a BIGINT)", "STRUCT(b BIGINT, a DOUBLE)") == "STRUCT(a DOUBLE, b BIGINT)"
    c = lambda v, t: coerce(v, parse_type(t))
    assert [c(2.5, "BIGINT"), c(3.5, "BIGINT"), c(Decimal("2.5"), "BIGINT"), c("1.6", "BIGINT"), c(True, "BIGINT")] == [2, 4, 3, 2, 1]
    assert c(Decimal("12.3455"), "DECIMAL(18,3)") == Decimal("12.346") and c([1, Decimal("2.5")], "VARCHAR[]") == ["1.000000000000000000", "2.500000000000000000"]
    for v, t in ((1 << 70, "BIGINT"), (300, "TINYINT"), ("x", "DOUBLE"), (b"x", "BIGINT"), (Decimal("1e20"), "DECIMAL(18,3)")):
        with pytest.raises(ValueError):
            c(v, t)
    shown = show({"k": "x", "v": None, "d": "it's", "e": "", "a": 0}, parse_type("STRUCT(k VARCHAR, v VARCHAR, d VARCHAR, e VARCHAR, a TIMESTAMP)"))
    assert shown == "{'k': x, 'v': NULL, 'd': 'it\\'s', 'e': '', 'a': '1970-01-01 00:00:00'}"


def test_streams(spark, tmp_path):
    source, out = tmp_path / "in", tmp_path / "out"
    source.mkdir()
    (source / "a.ion").write_text('{id: 1, v: "a"}\n\n{id: 2, v: sym}\n')
    q = write_ion_stream(read_ion_stream(spark, str(source), columns={"id": "BIGINT", "v": "VARCHAR"}), str(out), str(tmp_path / "c"), availableNow=True)
    q.awaitTermination(60)
    assert sorted(rows(read_ion(spark, str(out)))) == [(1, "a"), (2, "sym")]


def test_every_query_has_sql_with_its_columns(spark):
    import duckdb

    base = "/root/testdata/sf0.001"
    con = duckdb.connect()
    for name in ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings"):
        con.execute(f"create view {name} as select * from '{base}/{name}.parquet'")
    for name in ("ion_text_roundtrip_nation", "ion_map_wide", "ion_conflict_json", "to_ion_double", "ion_list_extract"):
        want = con.execute(catalog.ORACLES[name]).fetchall()
        got = catalog.QUERIES[name](spark, base)
        order = [got.columns.index(d[0]) for d in con.description]
        assert sorted(repr([r[i] for i in order]) for r in rows(got)) == sorted(repr(list(r)) for r in want)
    assert json.dumps(sorted(catalog.QUERIES)) == json.dumps(sorted(catalog.ORACLES))
