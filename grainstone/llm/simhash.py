"""SimHash fingerprints, and exact pairs within a Hamming distance by vantage-point trees.

A plain vantage-point tree can't prune here: fingerprints of unrelated texts lie 32 +- 4
bits apart, so nearly all of them are within the search radius of every median ball. The
first level is therefore a forest over masked distances: 64 bits are cut into blocks, and
two fingerprints within `radius` bits agree wholly on all blocks but `radius` of them. For
each choice of the blocks that agree, the fingerprints' bits there name the shard, which is
the radius-0 case of the triangle bound under that mask. A shard with more than `most`
fingerprints is split into rings of distance to two vantage points of its own; fingerprints
near a ring's boundary are in both rings, so no pair is lost. Inside a shard a vantage-point
tree prunes by the triangle bound on all 64 bits and compares what is left exactly.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..cluster import forget, keep, ship_code
from .components import components
from .words import runs, space_words

SHINGLE = 4
RADIUS = 4
SEED = 42
#: Fingerprints in a shard above which it is split into rings.
MOST = 16384
#: Shards are narrowed by more blocks until about this many fingerprints share one.
AIM = 2048
_LEAF = 384
#: Tasks that the fingerprints of one component are dealt to when they learn its smallest key.
SALTS = 16


def shingle_hashes(words: list[bytes], size: int) -> tuple[Iterator[int], int]:
    """XXH64 of each shingle, and how many there are."""
    if len(words) < size:
        return map(xxhash.xxh64_intdigest, [b" ".join(words)] if words else [], repeat(SEED)), int(bool(words))
    joined = map(b" ".join, zip(*(words[i:] for i in range(size))))
    return map(xxhash.xxh64_intdigest, joined, repeat(SEED)), len(words) - size + 1


def _votes(h: np.ndarray) -> np.ndarray:
    """For each of 64 bits, in how many of the hashes it is set."""
    return np.unpackbits(h.view(np.uint8).reshape(len(h), 8), axis=1, bitorder="little").sum(0, dtype=np.int64)


def majority(votes: np.ndarray, n: int) -> int:
    """The number whose bits are set in over half of n hashes; 0 of none."""
    return int(np.packbits(votes * 2 > n, bitorder="little").view("<u8")[0]) if n else 0


def fingerprint_batch(texts: list[bytes], size: int = SHINGLE) -> np.ndarray:
    """Fingerprints (uint64) of UTF-8 texts: a bit is 1 if set in over half the hashes."""
    out = np.zeros(len(texts), np.uint64)
    for i, t in enumerate(texts):
        hashes, n = shingle_hashes(space_words(t), size)
        votes = np.zeros(64, np.int64)
        for low in range(0, n, 1 << 17):
            votes += _votes(np.fromiter(hashes, "<u8", min(n - low, 1 << 17)))
        out[i] = majority(votes, n)
    return out


def fingerprints(docs: DataFrame, key: str = "doc_id", size: int = SHINGLE) -> DataFrame:
    """(key, fp long) for each row of docs. Null and wordless texts have fingerprint 0."""
    ship_code(docs.sparkSession)
    kind = dict(docs.dtypes)[key]

    def run(batches):
        for batch in batches:
            for rows, texts in runs(batch):
                yield pa.RecordBatch.from_arrays([rows.column(0), pa.array(fingerprint_batch(texts, size).view(np.int64))], ["k", "fp"])

    return docs.select(F.col(key).alias("k"), F.col("text")).mapInArrow(run, f"k {kind}, fp long").withColumnRenamed("k", key)


def _links(x: np.ndarray, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of places in x within radius, in blocks: each pair at least once, or a way
    between its ends by other pairs.

    The tree is walked for the whole set at once: a node's points are split at the median
    distance to its vantage point, both sides are searched by themselves, and pairs across
    are only possible between points whose distances differ by the radius at most.
    """
    stack = [np.arange(len(x))]
    while stack:
        own = stack.pop()
        if len(own) <= _LEAF:
            yield from _across(x, own, own, radius)
            continue
        middle = np.uint64(majority(_votes(x[own]), len(own)))
        v = own[np.bitwise_count(x[own] ^ middle).argmin()]
        d = np.bitwise_count(x[own] ^ x[v]).astype(np.int64)
        ball = d <= radius
        if ball.sum() * 4 >= len(own):
            # All of the ball link to v, so none of their own pairs matters.
            yield np.full(int(ball.sum()), v), own[ball]
            yield from _across(x, own[ball], own[~ball & (d <= 2 * radius)], radius)
            stack.append(own[~ball])
            continue
        d = np.bitwise_count(x[own] ^ x[own[0]]).astype(np.int64)
        cut = int(np.median(d))
        inner, outer = d <= cut, d > cut
        if not outer.any():
            inner, outer = d < cut, d >= cut
        if not inner.any():  # all at one distance: the bound says nothing
            for low in range(0, len(own), _LEAF):
                yield from _across(x, own[low : low + _LEAF], own, radius)
            continue
        stack += [own[inner], own[outer]]
        top = d[inner].max()
        for k in range(int(top) - radius + 1, int(top) + 1):  # rings inside the boundary
            ring = inner & (d == k)
            if ring.any():
                yield from _across(x, own[ring], own[outer & (d <= k + radius)], radius)


def _across(x: np.ndarray, a: np.ndarray, b: np.ndarray, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    step = max(1, (1 << 20) // max(len(b), 1))
    for low in range(0, len(a) if len(b) else 0, step):
        part = a[low : low + step]
        i, j = np.nonzero(np.bitwise_count(x[part][:, None] ^ x[b][None, :]) <= radius)
        yield part[i], b[j]


def forest(x: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """Edges (place, place) of a spanning forest of the links within radius among x."""
    root = np.arange(len(x))
    for i, j in _links(x, radius):
        while True:
            a, b = root[i], root[j]
            live = a != b
            if not live.any():
                break
            i, j, a, b = i[live], j[live], a[live], b[live]
            np.minimum.at(root, np.maximum(a, b), np.minimum(a, b))
            while True:
                up = root[root]
                if (up == root).all():
                    break
                root = up
    return [(p, int(r)) for p, r in enumerate(root) if p != r]


def block_masks(blocks: int, radius: int) -> list[int]:
    """Masks of the bits that agree: all blocks but `radius`, in every choice."""
    edges = [64 * i // blocks for i in range(blocks + 1)]
    bits = [((1 << edges[i + 1]) - 1) ^ ((1 << edges[i]) - 1) for i in range(blocks)]
    return [sum(c) for c in combinations(bits, blocks - radius)]


def blocks_for(rows: int, radius: int, aim: int = AIM) -> int:
    """The fewest blocks for which `rows` random fingerprints make shards of `aim` at most."""
    blocks = radius + 1
    while blocks < 2 * radius and rows / 2 ** (64 * (blocks - radius) // blocks) > aim:
        blocks += 1
    return blocks


def _signed(v: int) -> int:
    return v - (1 << 64) if v >> 63 else v


def edges_within(points: DataFrame, radius: int = RADIUS, most: int = MOST, aim: int = AIM) -> DataFrame:
    """Edges (a, b) that connect all of points' distinct `fp` values within radius.

    Each shard gives the edges of a spanning forest, not its pairs: fewer than it has rows.
    """
    spark = points.sparkSession
    blocks = blocks_for(points.count(), radius, aim)
    masks = block_masks(blocks, radius)
    keyed = points.select("fp", F.explode(F.array(*(F.struct(F.lit(t).alias("t"), F.col("fp").bitwiseAND(F.lit(_signed(m))).alias("key")) for t, m in enumerate(masks)))).alias("s")).select("fp", "s.t", "s.key")
    shards = keyed.groupBy("t", "key").agg(F.count(F.lit(1)).alias("n"), F.min("fp").alias("v"), F.max("fp").alias("w"))
    sized = keyed.join(shards.where("n > 1"), ["t", "key"])

    def rings(vantage: str):
        d = F.bit_count(F.col("fp").bitwiseXOR(F.col(vantage)))
        width = F.lit(radius + 1)
        near = F.floor(F.greatest(d - F.lit(radius), F.lit(0)) / width)
        return F.when(F.col("n") > most, F.array_distinct(F.array(F.floor(d / width).cast("int"), near.cast("int")))).otherwise(F.array(F.lit(0)))

    dealt = sized.withColumn("r", F.explode(rings("v"))).withColumn("q", F.explode(rings("w"))).select(F.xxhash64("t", "key", "r", "q").alias("cell"), "fp")

    def search(batches):
        held_cell, held = None, []
        for batch in batches:
            cells = batch.column(0).to_numpy(zero_copy_only=False)
            fps = batch.column(1).to_numpy(zero_copy_only=False)
            if not len(cells):
                continue
            cuts = np.flatnonzero(np.diff(cells)) + 1
            bounds = [0, *cuts.tolist(), len(cells)]
            out: list[tuple[int, int]] = []
            for low, high in zip(bounds, bounds[1:]):
                if held and cells[low] != held_cell:
                    out += _told(np.concatenate(held), radius)
                    held = []
                held_cell = cells[low]
                held.append(fps[low:high])
            yield _pairs(out)
        if held:
            yield _pairs(_told(np.concatenate(held), radius))

    return dealt.repartition("cell").sortWithinPartitions("cell").mapInArrow(search, "a long, b long")


def _told(values: np.ndarray, radius: int) -> list[tuple[int, int]]:
    x = np.unique(values).view(np.uint64)
    if len(x) < 2:
        return []
    own = x.view(np.int64)
    return [(int(own[a]), int(own[b])) for a, b in forest(x, radius)]


def _pairs(rows: list[tuple[int, int]]) -> pa.RecordBatch:
    table = np.array(rows, np.int64).reshape(-1, 2)
    return pa.RecordBatch.from_arrays([pa.array(table[:, 0].copy()), pa.array(table[:, 1].copy())], ["a", "b"])


def near_duplicates(docs: DataFrame, key: str = "doc_id", radius: int = RADIUS, size: int = SHINGLE) -> DataFrame:
    """(key, fp, component_id) for each row of docs; component_id is the smallest key that
    links within radius reach.

    Null and empty texts have fingerprint 0 and link like any other. Repeated rows each get
    their row. A null key takes its group's smallest key, null if the group has none. Other
    columns don't matter; an empty table gives an empty one.
    """
    told = keep(fingerprints(docs, key, size))
    points = keep(told.groupBy("fp").agg(F.min(key).alias("least")))
    found = components(edges_within(points, radius))
    labelled = keep(points.join(found, points.fp == found.node, "left").select("fp", "least", "component"))
    forget(points, found)
    alone = labelled.where("component is null").select("fp", F.col("least").alias("component_id"))
    salts = F.lit(SALTS)
    heads = labelled.where("component is not null").groupBy("component").agg(F.min("least").alias("component_id"))
    heads = heads.withColumn("salt", F.explode(F.sequence(F.lit(0), salts - 1)))
    groups = labelled.where("component is not null").withColumn("salt", F.pmod(F.xxhash64("fp"), salts).cast("int"))
    known = alone.unionByName(groups.join(heads, ["component", "salt"]).select("fp", "component_id"))
    return told.join(known, "fp").select(key, "fp", "component_id")


def hex_digits(fp):
    """A fingerprint column as 16 lower-case hexadecimal digits."""
    return F.lower(F.lpad(F.hex(fp), 16, "0"))
