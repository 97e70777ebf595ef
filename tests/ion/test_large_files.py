import gzip
import re

import pytest
from pyspark.sql import functions as F

from grainstone.sources import ionbinary as B
from grainstone.sources import reader
from grainstone.sources.reader import IonFrame, count_ion, read_ion

SPARSE = [f"{{id: {i}, obj: {{{'a' if i % 2 else 'b'}: {i}}}}}" for i in range(3000)]
ODD = {
    "long": ["{id: 1, obj: {a: 1}, s: '''x", "{id: 2}", "'''}"],
    "comment": ["{id: 1, obj: {a: 1}} /*", "{id: 2}", "*/"],
    "string": ['{id: 1, obj: {a: 1}, s: "x\\', '{id: 2}"}'],
    "open": ["{id: 1, obj:", "{a: 1}", "}"],
    "symbols": ["{id: 1}", '$ion_symbol_table::{symbols: ["id"]}', "{$10: 2}"],
    "two": ["{id: 1} {id: 2}"],
    "scalars": ["{id: 1}", "null"],
}


@pytest.mark.parametrize("line, own", [
    ("{}", True), ("", True), (" \t", True), ('  {a: "}{[", b: [1, {c: (d e)}], c: {{AQID}}, d: a::1, e: 2020-01-02T03:04:05Z}  ', True), ('{a: "é\\"}", b: "\\\\"}', True),
    ("{a: 1", False), ("a: 1}", False), ("{a: 1}}", False), ("{a: 1}{a: 2}", False), ("{a: 1},", False), ("[{a: 1}]", False), ("a::{a: 1}", False), ("1", False), ('{a: "}', False), ("{a: 1} // x", False), ("{a: '''}", False),
    ("{a: 1}\r{a: 2}", False), ("{a: 1}\r", True), ("{a:" * 9 + "1" + "}" * 9, True), ("{a:" * 10 + "1" + "}" * 10, False),
])
def test_lines_that_are_structs(line, own):
    assert bool(reader.pc.match_substring_regex(reader.pa.array([line]), reader._CLOSED)[0].as_py()) is own


def test_large_files_are_split(spark, tmp_path, monkeypatch):
    """With 'auto' one task took the whole file, however large."""
    monkeypatch.setattr(reader, "LARGE", 1000)
    (tmp_path / "a.ion").write_text("\n\n".join(SPARSE) + "\n")
    given = {"field_appearance_threshold": 0.8}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16k")
    try:
        df = read_ion(spark, f"{tmp_path}/a.ion", **given)
        assert df.rdd.getNumPartitions() > 3
        assert df.dtypes == [("id", "bigint"), ("obj", "map<string,bigint>")]
        assert sorted((r.id, *r.obj.items()) for r in df.collect()) == [(i, ("a" if i % 2 else "b", i)) for i in range(3000)]
        assert count_ion(spark, f"{tmp_path}/a.ion") == IonFrame(spark, f"{tmp_path}/a.ion").count() == 3000
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_other_large_files_stay_whole(spark, tmp_path, monkeypatch):
    """Beside a file of lines, with the same rows as when none is looked through."""
    (tmp_path / "lines.ion").write_text("\n".join(SPARSE))
    for name, lines in ODD.items():
        (tmp_path / f"{name}.ion").write_text("\n".join(lines) + "\n")
    text = "\n".join(SPARSE[:50])
    for name, data in {"gzip.ion.gz": gzip.compress(text.encode()), "zipped.ion": gzip.compress(text.encode()), "mark.ion": text.encode("utf-8-sig"), "binary.10n": B.transcode(text)}.items():
        (tmp_path / name).write_bytes(data)
    columns = {"id": "BIGINT", "obj": "MAP(VARCHAR, BIGINT)", "s": "VARCHAR"}
    rows = lambda path: sorted(map(repr, read_ion(spark, path, columns=columns).collect()))
    want = rows(str(tmp_path))
    monkeypatch.setattr(reader, "LARGE", -1)
    listed = reader._listed(spark, str(tmp_path))
    by_lines = reader._by_lines(spark, listed, reader.read_options({}))
    assert [re.sub(".*/", "", p) for p in by_lines] == ["lines.ion"]
    assert rows(str(tmp_path)) == want and len(want) > 3200
    df = read_ion(spark, str(tmp_path), columns=columns, profile=True)
    assert df.agg(F.sum("id")).first()[0] > 0 and df.ion_rows_read.value == len(want)
