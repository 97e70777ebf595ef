import zlib
from collections import defaultdict

from grainstone.llm import sharding

from .fixtures import DOCS, docs


def jump(key, shards):
    key &= (1 << 64) - 1
    b, j = -1, 0
    while j < shards:
        b = j
        key = (key * 2862933555777941757 + 1) & ((1 << 64) - 1)
        j = int((b + 1) * (float(1 << 31) / float((key >> 33) + 1)))
    return b


def test_matches_the_published_walk(spark):
    keys = [0, 1, 2, -1, -5, 2**63 - 1, -(2**63), 123456789, *range(1000, 3000, 7)]
    df = spark.createDataFrame([(k,) for k in keys], "k long")
    for n in (1, 2, 8, 9, 40):
        got = {r.k: r.shard for r in sharding.shard_rows(df, "k", n).collect()}
        assert got == {k: jump(k, n) for k in keys}


def test_growth_moves_rows_only_into_the_new_shard(spark):
    df = sharding.shard_rows(sharding.shard_rows(spark.range(20000), "id", 8), "id", 9, "grown")
    moved = df.where("shard <> grown")
    assert moved.where("grown <> 8").count() == 0
    assert 0.08 < moved.count() / 20000 < 0.15


def test_manifest_with_nulls_copies_and_clashing_columns(spark):
    rows = [(None, None), (None, None), (None, "x"), (5, ""), (5, ""), (6, "é" * 3), *[(7, "same")] * 50, *[(i, f"t{i}") for i in range(300)]]
    df = spark.createDataFrame([(k, t, -1, -1, -1, -1) for k, t in rows], "doc_id long, text string, shard int, slot int, size int, bucket int")
    out = sharding.shard_manifest(df, "doc_id", "text", 8).collect()
    assert sorted((str(r.doc_id), r["size"], r.text_crc32) for r in out) == sorted((str(k), len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for k, t in rows)
    slots = defaultdict(list)
    for r in out:
        assert r.shard == jump(r.doc_id or 0, 8) and r.grown_shard == jump(r.doc_id or 0, 9) and r.law == "key"
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_empty_table_and_long_text(spark):
    assert sharding.shard_manifest(spark.createDataFrame([], DOCS), "doc_id", "text", 8).count() == 0
    assert sharding.shard_manifest(docs(spark, ["a" * 3_000_000]), "doc_id", "text", 8).first()["size"] == 3_000_001


def test_string_keys(spark):
    df = sharding.shard_rows(spark.createDataFrame([("a",), ("b",), (None,), ("a",)], "k string"), "k", 4)
    got = [r.shard for r in df.collect()]
    assert got[0] == got[3] and all(0 <= s < 4 for s in got)
