import pytest

from grainstone import catalog


@pytest.mark.parametrize("name", ["ion_map_sparse", "ion_exponent_floats_roundtrip_events", "ion_rollup", "ion_window", "ion_write_date_format", "ion_write_timestamp_format"])
def test_first_task_writes_a_file_without_values(spark, monkeypatch, name):
    """A table's splits are cut by bytes, and the first may not have its row group's middle."""
    plain = catalog.table
    # Not limit(0): the optimizer would leave that part out, and its task with it.
    none = lambda df: df.repartition(1).mapInArrow(lambda batches: iter(()), df.schema)
    empty_first = lambda spark, d, t: none(plain(spark, d, t)).unionAll(plain(spark, d, t))
    want = catalog.QUERIES[name](spark, "/root/testdata/sf0.001")
    monkeypatch.setattr(catalog, "table", empty_first)
    got = catalog.QUERIES[name](spark, "/root/testdata/sf0.001")
    assert got.schema == want.schema and got.count() == want.count() > 0
    assert got.exceptAll(want).count() == 0
