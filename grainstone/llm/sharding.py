"""Jump consistent hashing of stable keys to shards, in DataFrame expressions only.

The published algorithm (Lamping and Veach, 2014) walks b = -1, j = 0; while j < shards:
b = j; key = key * 2862933555777941757 + 1 (mod 2^64); j = floor((b + 1) * 2^31 /
((key >> 33) + 1)). b is the shard. Appending a shard moves about 1 / (shards + 1) of the
keys, all of them into the new shard.

Spark's bigint product raises on overflow, so a key is held as two 32-bit halves and
multiplied by the constant's four 16-bit parts; no partial sum passes 2^52.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Fixed value: the multiplier of the algorithm's linear congruential generator.
MULTIPLIER = 2862933555777941757
_PARTS = [(MULTIPLIER >> s) & 0xFFFF for s in (0, 16, 32, 48)]
_LOW32 = 0xFFFFFFFF
#: Slots are numbered within this many buckets of a shard; the table of bucket sizes has
#: at most shards * SLOT_BUCKETS rows whatever the input.
SLOT_BUCKETS = 4096
#: Repeated rows are put back in runs of at most this many.
RUN = 65536


def _step(hi: Column, lo: Column) -> tuple[Column, Column]:
    """key * MULTIPLIER + 1 mod 2^64 on 32-bit halves."""
    c0, c1, c2, c3 = (F.lit(c).cast("long") for c in _PARTS)
    low = lo * c0 + F.shiftleft((lo * c1).bitwiseAND(F.lit(0xFFFF)), 16) + F.lit(1)
    high = (
        F.shiftright(low, 32)
        + F.shiftright(lo * c1, 16)
        + lo * c2
        + F.shiftleft((lo * c3).bitwiseAND(F.lit(0xFFFF)), 16)
        + hi * c0
        + F.shiftleft((hi * c1).bitwiseAND(F.lit(0xFFFF)), 16)
    )
    return high.bitwiseAND(F.lit(_LOW32)), low.bitwiseAND(F.lit(_LOW32))


def key64(key: Column, kind: str) -> Column:
    """The 64-bit key: integers as they are, other types by xxHash64; null is 0."""
    if kind in ("bigint", "int", "smallint", "tinyint"):
        return F.coalesce(key.cast("long"), F.lit(0).cast("long"))
    return F.when(key.isNull(), F.lit(0).cast("long")).otherwise(F.xxhash64(key))


def _halves(key: Column) -> tuple[Column, Column]:
    return F.shiftrightunsigned(key, 32).bitwiseAND(F.lit(_LOW32)), key.bitwiseAND(F.lit(_LOW32))


def jump_shard(key: Column, shards: int) -> Column:
    """The shard, 0 to shards - 1, of a 64-bit key column.

    The walk visits each shard at most once, so a fold over `shards` steps holds it; after
    the walk has passed the last shard the state stays as it is.
    """
    if shards < 1:
        raise ValueError("shards must be 1 or more")
    hi, lo = _halves(key)
    start = F.struct(
        F.lit(-1).cast("long").alias("b"), F.lit(0).cast("long").alias("j"), hi.alias("hi"), lo.alias("lo")
    )

    def walk(state: Column, _: Column) -> Column:
        hi2, lo2 = _step(state["hi"], state["lo"])
        draw = F.shiftright(hi2, 1) + F.lit(1)
        ahead = F.floor((state["j"] + F.lit(1)).cast("double") * F.lit(2147483648.0) / draw.cast("double"))
        return F.when(
            state["j"] < F.lit(shards),
            F.struct(state["j"].alias("b"), ahead.cast("long").alias("j"), hi2.alias("hi"), lo2.alias("lo")),
        ).otherwise(state)

    return F.aggregate(F.sequence(F.lit(1), F.lit(shards)), start, walk, lambda s: s["b"].cast("int"))


def shard_rows(df: DataFrame, key: str, shards: int, out: str = "shard") -> DataFrame:
    """df with the shard of each row. No shuffle; all columns stay, a former `out` goes.

    Equal keys share a shard, null keys that of key 0; an empty table gives an empty one.
    """
    return df.withColumn(out, jump_shard(key64(F.col(key), dict(df.dtypes)[key]), shards))


def shard_manifest(df: DataFrame, key: str, text: str, shards: int) -> DataFrame:
    """One row per row of df: key, size, text_crc32, law, shard, slot, grown_shard.

    size is the text's UTF-8 bytes plus 1 (null text: 1). slot numbers a shard's rows from
    0 without gaps: rows go to SLOT_BUCKETS buckets of their shard by key and text, bucket
    sizes are summed up in order, and a row's place in its bucket is added. Rows equal in
    key, size and CRC are counted before the shuffle and put back afterwards, so a hot key
    or a group of copies never gathers in a task. Other columns of df don't matter.
    """
    kind = dict(df.dtypes)[key]
    body = F.coalesce(F.col(text).cast("binary"), F.lit(b""))
    rows = df.select(
        F.col(key).alias("k"), (F.octet_length(body).cast("long") + F.lit(1)).alias("size"), F.crc32(body).alias("crc")
    )
    k64 = key64(F.col("k"), kind)
    hi, lo = _halves(k64)
    first = _step(hi, lo)[0]
    kinds = rows.groupBy("k", "size", "crc").agg(F.count(F.lit(1)).alias("n"))
    dealt = kinds.select(
        "k",
        "size",
        "crc",
        "n",
        jump_shard(k64, shards).alias("shard"),
        jump_shard(k64, shards + 1).alias("grown_shard"),
        ((F.shiftright(first, 8) + F.col("crc")) % F.lit(SLOT_BUCKETS)).cast("int").alias("bucket"),
    )
    none = F.lit(0).cast("long")
    offsets = (
        dealt.groupBy("shard", "bucket")
        .agg(F.sum("n").alias("n"))
        .select(
            "shard",
            "bucket",
            F.coalesce(F.sum("n").over(Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)), none).alias("base"),
        )
    )
    own = Window.partitionBy("shard", "bucket").orderBy("k", "crc", "size")
    placed = dealt.join(F.broadcast(offsets), ["shard", "bucket"]).select(
        "*", (F.col("base") + F.coalesce(F.sum("n").over(own.rowsBetween(Window.unboundedPreceding, -1)), none)).alias("first")
    )
    runs = placed.withColumn("run", F.explode(F.sequence(none, F.floor((F.col("n") - 1) / RUN).cast("long"))))
    last = F.least(F.col("n") - 1, F.col("run") * RUN + (RUN - 1))
    return runs.withColumn("i", F.explode(F.sequence(F.col("run") * RUN, last))).select(
        F.col("k").alias(key),
        "size",
        F.col("crc").alias("text_crc32"),
        F.lit("key").alias("law"),
        "shard",
        (F.col("first") + F.col("i")).alias("slot"),
        "grown_shard",
    )

