import gzip

import pytest
from pyspark.sql import functions as F

from grainstone import catalog
from grainstone.sources import ionbinary as B
from grainstone.sources.reader import IonFrame, count_ion, read_ion
from grainstone.sources.writer import write_ion


@pytest.mark.parametrize("binary", [False, True])
@pytest.mark.parametrize("form", ["auto", "newline_delimited"])
def test_task_without_rows_comes_first(spark, tmp_path, binary, form):
    """The first task has no rows, so the first file has no values."""
    df = spark.range(0, 40, 1, 4).where("id > 29").withColumn("name", F.concat(F.lit("n"), "id"))
    write_ion(df, f"{tmp_path}/a", binary=binary)
    got = read_ion(spark, f"{tmp_path}/a", format=form)
    assert got.dtypes == [("id", "bigint"), ("name", "string")]
    assert sorted(map(tuple, got.collect())) == [(i, f"n{i}") for i in range(30, 40)]
    assert IonFrame(spark, f"{tmp_path}/a", format=form).columns == ["id", "name"]
    assert read_ion(spark, f"{tmp_path}/a", format=form, select=["id"]).agg(F.sum("id")).first()[0] == 345
    assert count_ion(spark, f"{tmp_path}/a", format=form) == 10


def test_empty_files_are_not_counted(spark, tmp_path):
    """Also more of them than files are sampled; the first one with a value is enough."""
    for i in range(40):
        (tmp_path / f"{i:02}.ion").write_bytes([b"", b" \n\n", gzip.compress(b""), B.transcode("")][i if i < 4 else 0])
    (tmp_path / "40.ion").write_text('{a: 1, b: "x"}\n')
    (tmp_path / "41.ion").write_text("{a: 2, c: 1}\n")
    assert read_ion(spark, f"{tmp_path}/*").columns == ["a", "b"]
    assert read_ion(spark, f"{tmp_path}/*", union_by_name=True, maximum_sample_files=1).columns == ["a", "b"]
    got = read_ion(spark, f"{tmp_path}/*", union_by_name=True)
    assert got.columns == ["a", "b", "c"] and sorted(r.a for r in got.collect()) == [1, 2]
    assert read_ion(spark, f"{tmp_path}/[0-3]*").columns == ["ion"]


@pytest.mark.parametrize("name", ["ion_anti_join", "ion_map_sparse", "ion_exponent_floats_roundtrip_events", "ion_rollup", "ion_window", "ion_write_date_format", "ion_write_timestamp_format", "ion_conflict_json", "ion_join", "ion_conflict_varchar", "ion_max_depth", "ion_text_double_as_decimal", "ion_profile", "ion_use_extractor"])
def test_queries_over_tables_whose_first_split_has_no_rows(spark, tmp_path, monkeypatch, name):
    """A table's splits are cut by bytes, and the first may have no row group's middle."""
    plain = catalog.table
    empty_first = lambda spark, d, t: plain(spark, d, t).limit(0).coalesce(1).unionAll(plain(spark, d, t))
    want = catalog.QUERIES[name](spark, "/root/testdata/sf0.001")
    monkeypatch.setattr(catalog, "table", empty_first)
    got = catalog.QUERIES[name](spark, "/root/testdata/sf0.001")
    assert got.schema == want.schema and got.count() == want.count() > 0
    assert got.exceptAll(want).count() == 0
