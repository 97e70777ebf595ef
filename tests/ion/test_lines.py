"""Lines that aren't a value each."""

import pytest

from grainstone.sources.reader import Lines, read_ion
from grainstone.sources.values import IonError, Struct
from grainstone.sources.writer import write_ion

LINES = {"format": "newline_delimited"}


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_values_over_batches():
    taken = Lines()
    assert list(taken.values(["{a: 1}", "{a:"])) == [Struct([("a", 1)])]
    assert list(taken.values(["  2,"])) == [] and taken.each(["{a: 1}"]) is None
    assert list(taken.values(["} /* a", " comment"])) == [Struct([("a", 2)])]
    assert list(taken.values(["*/ $ion_symbol_table::{symbols: [\"name9\"]}", "{$10: '''x", "", "y'''}"])) == [Struct([("name9", "x\n\ny")])]
    assert list(taken.values(["{$10: 3}"], last=True)) == [Struct([("name9", 3)])]
    with pytest.raises(IonError):
        list(taken.values(["{a: "], last=True))


def test_streams_of_lines(spark, tmp_path):
    text = """
{a: 1, b: "x"}
// a comment
{a: 2, b: "y"} {a: 3, b: "z"}
/* a comment
{a: 9, b: "no"}
over lines */
{a: 4,
 b: '''two
lines'''}

$ion_symbol_table::{symbols: ["a", "b"]}
{$10: 5, $11: "w"}
{a: 6, b: "v"}\r
"""
    folder = tmp_path / "t"
    folder.mkdir()
    (folder / "one.ion").write_bytes(text.encode())
    (folder / "two.ion").write_text('{a: 7, b: "u"}\n')
    want = [(1, "x"), (2, "y"), (3, "z"), (4, "two\nlines"), (5, "w"), (6, "v"), (7, "u")]
    columns = {"a": "BIGINT", "b": "VARCHAR"}
    assert rows(read_ion(spark, str(folder), columns=columns, **LINES)) == want
    assert rows(read_ion(spark, str(folder), columns=columns)) == want
    assert read_ion(spark, str(folder), **LINES).schema.names == ["a", "b"]
    # symbols end with their file, and so does a value
    (folder / "two.ion").write_text('{$10: 7, $11: "u"}\n')
    with pytest.raises(Exception, match="not in the table"):
        read_ion(spark, str(folder), columns=columns, **LINES).collect()
    (folder / "two.ion").write_text('{a: 7, b: "u"\n')
    with pytest.raises(Exception, match="has to end"):
        read_ion(spark, str(folder), columns=columns, **LINES).collect()


def test_binary_among_many_text_files(spark, tmp_path):
    df = spark.range(60).selectExpr("id", "concat('s', id) s")
    for i in range(12):
        write_ion(df.where(f"id % 12 = {i}").coalesce(1), f"{tmp_path}/{i:02d}")
    write_ion(df.coalesce(1), f"{tmp_path}/zz", binary=True)
    write_ion(df.coalesce(1), f"{tmp_path}/zzz", binary=True, compression="gzip")
    got = read_ion(spark, f"{tmp_path}/*/part*", columns={"id": "BIGINT", "s": "VARCHAR"}, **LINES)
    assert rows(got) == sorted([(i, f"s{i}") for i in range(60)] * 3, key=repr)


def test_profile(spark, tmp_path):
    write_ion(spark.range(1000), str(tmp_path / "p"))
    df = read_ion(spark, str(tmp_path / "p"), columns={"id": "BIGINT"}, profile=True, **LINES)
    assert df.count() == 1000 and df.ion_rows_read.value == 1000 and df.ion_seconds.value > 0
