"""Near copies by exact Jaccard similarity of word shingles, with one document kept of each.

SimHash fingerprints of the shingles and the vantage-point shards of `simhash` propose pairs
first, and what they propose is compared exactly. But no radius of 64-bit fingerprints
proposes every pair of similarity 0.8: such pairs lie about 10 bits apart, some over 15,
where unrelated ones begin. The rest is therefore proposed by two filters that lose none.
Pairs of sets of over _SHORT shingles are proposed by parts: sets of n and m shingles differ
in k = (1 - t) / (1 + t) (n + m) at most, so of more than k parts, into which shingles fall by
their hash, one at least is the same in both. A part's key is the sum of its hashes, some
three or four of them, so unrelated sets that share a passage or a frequent shingle seldom
have a key in common, and keys grow with the input. Any other pair is proposed by a
prefix filter: of n shingles, in one order for all documents, the first
n - ceil(t n) + 1 must share one with any set of similarity t. Of two such sets the smaller
has the first shingle that they share among its first n - ceil(2 t n / (1 + t)) + 1, as what
follows has to hold the rest; those after are marked by a negative n, and a bucket's pair
only counts if its smaller set isn't so marked there. The order is by counts over
cells of shingles, rare ones first; any order is right, this one makes few pairs. Of two sets
the parities of 1,024 cells differ in no more cells than the sets differ in shingles, so
that many pairs fall without their sets being read; the rest is compared exactly. Documents with equal sets are one node from the start.

Buckets of a shared key are linked by stars around a changing hub as long as there are
many pairs in them that aren't linked yet and a turn still links many; then all the pairs
that are left are compared, within a bucket by arrays of parities, so that only pairs that
pass become rows. Large buckets are cut into blocks, each two of which are a bucket of their own. Any
pair that is never compared has its ends in one component already, so nothing is lost.
"""

from __future__ import annotations

import math
from bisect import bisect_left
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..cluster import forget, keep, let_go, ship_code
from .components import components
from .simhash import RADIUS, _votes, edges_within, majority, shingle_hashes
from .words import runs, space_words

SHINGLE = 5
SIMILARITY = 0.8
#: Cells in which shingles are counted for their order.
_CELL_BITS = 18
#: Pairs with a set of so many shingles or fewer are found by prefixes, others by parts.
_SHORT = 16
#: All unlinked pairs are compared once they are at most so many for each row of a bucket.
_PAIRS_A_ROW = 0.25
_ROUNDS = 12
#: A turn that leaves more than this share of the pairs unlinked is the last of stars.
_STALLED = 0.75
_PARITY = 1024
#: Rows of a bucket that are compared in one place, and pairs that are at once.
_BLOCK = 4096
_AT_ONCE = 1 << 16
#: So many rows are looked up by broadcast, more by a shuffle.
_BROADCAST_ROWS = 1 << 20
#: Shingles that are sent at once at least, when sets are compared.
_SENT = 1 << 22


def _numbered(docs: DataFrame) -> DataFrame:
    """docs with the number of each row, by partition and place, as `_told` gives it: the
    same whenever the same files are read again."""
    return docs.withColumn("__row", F.monotonically_increasing_id())


def shingle_set(text: bytes, size: int) -> np.ndarray:
    """The distinct shingles of a text, sorted, by their XXH64."""
    hashes, n = shingle_hashes(space_words(text), size)
    return np.unique(np.fromiter(hashes, "<u8", n))


def _name(own: np.ndarray) -> int:
    return xxhash.xxh64_intdigest(own.tobytes())


def _signed(values) -> pa.Array:
    return pa.array(np.array(values, np.uint64).view(np.int64))


def _cells(own: np.ndarray) -> np.ndarray:
    return (own >> np.uint64(64 - _CELL_BITS)).astype(np.int64)


def _differing(n: int, m: int, similarity: float) -> int:
    """In how many shingles sets of n and m can differ."""
    return math.floor((1 - similarity) / (1 + similarity) * (n + m) + 1e-9)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


class Parts:
    """Keys of sets of over _SHORT shingles, of which two of the similarity share one at least.

    Sizes fall into classes whose ends lie within the similarity, so a set meets those of its
    own class and of the next. In a class all sets are cut into as many parts, more than two
    can differ in. Each gives its first k + 1 parts with shingles, where it differs from no
    other in more than k: before the first of both sets has given its last, k parts at most
    of these differ, so one is given by both. A set with fewer gives those of its first k + 1
    parts that are empty as well, so the same holds for two of this kind.
    """

    def __init__(self, similarity: float):
        self.similarity = similarity
        self.ends = [_SHORT]

    def _class(self, n: int) -> int:
        while self.ends[-1] < n:
            self.ends.append(math.floor((self.ends[-1] + 1) / self.similarity + 1e-9))
        return bisect_left(self.ends, n)

    def keys(self, own: np.ndarray) -> np.ndarray:
        n = len(own)
        if n <= _SHORT:
            return own[:0]
        largest = math.floor(n / self.similarity + 1e-9)
        first, last = self._class(n), self._class(largest)
        return np.concatenate([self._of(own, c, _differing(n, min(largest, self.ends[c]), self.similarity)) for c in range(first, last + 1)])

    def _of(self, own: np.ndarray, c: int, k: int) -> np.ndarray:
        most = _differing(self.ends[c], self.ends[c], self.similarity)
        hashes = _mixed(own + np.uint64(c + 1))
        # A few parts more than have to be, as some are empty.
        parts = ((hashes >> np.uint64(32)) * np.uint64(most + 2 + most // 32) >> np.uint64(32)).astype(np.int64)
        order = np.argsort(parts)
        starts = np.flatnonzero(np.diff(parts[order], prepend=-1))
        sums, parts = np.add.reduceat(_mixed(hashes[order]), starts), parts[order][starts]
        if len(parts) <= k:
            empty = np.setdiff1d(np.arange(k + 1), parts)
            sums, parts = np.concatenate([sums, np.zeros(len(empty), np.uint64)]), np.concatenate([parts, empty])
        else:
            sums, parts = sums[: k + 1], parts[: k + 1]
        return _mixed(sums + _mixed(parts.astype(np.uint64) + np.uint64((c + 1) << 32)))


def _told(docs: DataFrame, key: str, size: int, similarity: float) -> DataFrame:
    """(k, row, node, fp, bits) for each row of docs, and `counts` of the cells for each task,
    in sets that have prefixes."""
    kind = dict(docs.dtypes)[key]
    names = ["k", "row", "node", "fp", "bits", "counts"]

    def run(batches):
        at = TaskContext.get().partitionId() << 33
        total = np.zeros(1 << _CELL_BITS, np.int64)
        k = None
        for batch in batches:
            k = batch.column(0).type
            for rows, texts in runs(batch):
                sets = [shingle_set(t, size) for t in texts]
                few = [s for s in sets if len(s) <= _SHORT / similarity + 1e-9]
                if few:
                    total += np.bincount(_cells(np.concatenate(few)), minlength=len(total))
                bits = np.stack([np.packbits(np.bincount((s & np.uint64(_PARITY - 1)).astype(np.int64), minlength=_PARITY) & 1).view(np.int64) for s in sets])
                ends = np.arange(0, bits.size + 1, bits.shape[1], dtype=np.int32)
                yield pa.RecordBatch.from_arrays(
                    [rows.column(0), pa.array(np.arange(at, at + len(texts))), _signed([_name(s) for s in sets]), _signed([majority(_votes(s), len(s)) for s in sets]), pa.ListArray.from_arrays(pa.array(ends), pa.array(bits.ravel())), pa.nulls(len(texts), pa.list_(pa.int64()))],
                    names,
                )
                at += len(texts)
        if total.any():
            yield pa.RecordBatch.from_arrays([pa.nulls(1, k), *[pa.nulls(1, pa.int64())] * 3, pa.nulls(1, pa.list_(pa.int64())), pa.array([total], pa.list_(pa.int64()))], names)

    return docs.select(F.col(key).alias("k"), "text").mapInArrow(run, f"k {kind}, row long, node long, fp long, bits array<long>, counts array<long>")


def _prefixes(docs: DataFrame, size: int, similarity: float, weights) -> DataFrame:
    """(s, node, n): the keys of each document's set of n shingles, the prefix of a short one
    and those by parts; of a prefix, n is negative where only a smaller set can share its first
    shingle with this one."""

    def run(batches):
        held, done, parts = weights.value, set(), Parts(similarity)
        for batch in batches:
            for _, texts in runs(batch):
                shingles, nodes, sizes = [], [], []
                for t in texts:
                    own = shingle_set(t, size)
                    node = _name(own)
                    if node in done or not len(own):
                        continue
                    done.add(node)
                    keys = parts.keys(own)
                    shingles.append(keys)
                    nodes += [node] * len(keys)
                    sizes += [len(own)] * len(keys)
                    if len(own) > _SHORT / similarity + 1e-9:
                        continue
                    w = held[_cells(own)]
                    n = len(own) - math.ceil(similarity * len(own) - 1e-9) + 1
                    shingles.append(own[np.argsort(w, kind="stable")[:n]])
                    nodes += [node] * n
                    inner = len(own) - math.ceil(2 * similarity / (1 + similarity) * len(own) - 1e-9) + 1
                    sizes += [len(own)] * inner + [-len(own)] * (n - inner)
                if nodes:
                    yield pa.RecordBatch.from_arrays([_signed(np.concatenate(shingles)), _signed(nodes), pa.array(sizes, pa.int64())], ["s", "node", "n"])

    return docs.select("text").mapInArrow(run, "s long, node long, n long")


def _sets(docs: DataFrame, size: int) -> DataFrame:
    """(node, own): the shingles of each row of docs."""

    def run(batches):
        for batch in batches:
            for _, texts in runs(batch):
                sets = [shingle_set(t, size) for t in texts]
                ends = np.cumsum([0, *map(len, sets)]).astype(np.int32)
                own = pa.ListArray.from_arrays(pa.array(ends), _signed(np.concatenate(sets)))
                yield pa.RecordBatch.from_arrays([_signed([_name(s) for s in sets]), own], ["node", "own"])

    return docs.select("text").mapInArrow(run, "node long, own array<long>")


def _possible(pairs: DataFrame, nodes: DataFrame, similarity: float) -> DataFrame:
    """Those of pairs (a, n, b, m, either way round and more than once) that the lengths, the
    marks and the parities allow to reach the similarity."""
    first = F.col("a") > F.col("b")
    once = pairs.where(_near(similarity)).select(F.when(first, F.col("a")).otherwise(F.col("b")).alias("a"), F.least("a", "b").alias("b"), (F.abs("n") + F.abs("m")).alias("both")).distinct()
    told = once.join(nodes.select(F.col("node").alias("a"), F.col("bits").alias("x")), "a").join(nodes.select(F.col("node").alias("b"), F.col("bits").alias("y")), "b")
    apart = sum((F.bit_count(F.col("x")[i].bitwiseXOR(F.col("y")[i])) for i in range(_PARITY // 64)), F.lit(0))
    return told.where(apart <= F.lit((1 - similarity) / (1 + similarity)) * F.col("both") + F.lit(1e-6)).select("a", "b")


def _within(buckets: DataFrame, nodes: DataFrame, similarity: float) -> DataFrame:
    """Pairs (a, b) of nodes of one bucket (s, node, n, label, rows) and two labels that the
    lengths, the marks and the parities allow to reach the similarity; once each."""
    blocks = F.ceil(F.col("rows") / _BLOCK).cast("int")
    placed = buckets.join(nodes.select("node", "bits"), "node").withColumn("own", F.pmod(F.xxhash64("node"), blocks).cast("int"))
    placed = placed.withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
    placed = placed.select("s", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"), "own", "node", "n", "label", "bits")
    places = ["s", "low", "high"]

    def run(batches):
        for rows in _whole(batches, places):
            own, node, n, label = (rows.column(c).to_numpy(zero_copy_only=False) for c in ("own", "node", "n", "label"))
            low, high = (rows.column(c).to_numpy(zero_copy_only=False) for c in places[1:])
            bits = rows.column("bits").flatten().to_numpy(zero_copy_only=False).view(np.uint64).reshape(len(n), -1)
            size, plain = np.abs(n), n > 0
            for x, y in _pairs(_starts(rows, places), own, low, high):
                both = size[x] + size[y]
                keep = (label[x] != label[y]) & (np.minimum(size[x], size[y]) >= similarity * np.maximum(size[x], size[y]) - 1e-9)
                keep &= np.where(size[x] <= size[y], plain[x], True) & np.where(size[x] >= size[y], plain[y], True)
                x, y, both = x[keep], y[keep], both[keep]
                apart = np.bitwise_count(bits[x] ^ bits[y]).sum(1, dtype=np.int64)
                keep = apart <= (1 - similarity) / (1 + similarity) * both + 1e-6
                ends = np.stack([node[x[keep]], node[y[keep]]], 1)
                ends = np.unique(np.sort(ends, 1), axis=0)
                yield pa.RecordBatch.from_arrays([pa.array(ends[:, 1]), pa.array(ends[:, 0])], ["a", "b"])

    return placed.repartition(*places).sortWithinPartitions(*places).mapInArrow(run, "a long, b long").distinct()


def _starts(rows: pa.RecordBatch, places: list[str]) -> np.ndarray:
    """Where rows with other places than those before begin, and the end."""
    new = np.ones(rows.num_rows + 1, bool)
    if rows.num_rows:
        new[1:-1] = np.any([np.diff(rows.column(c).to_numpy(zero_copy_only=False)) != 0 for c in places], axis=0)
    return np.flatnonzero(new)


def _whole(batches, places: list[str]):
    """The rows of batches, sorted by places, in batches that hold all of a place."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        starts = _starts(batch, places)
        if not batch.num_rows:
            continue
        same = held and all(held[-1].column(c)[-1] == batch.column(c)[0] for c in places)
        ready = starts[1] if same else 0  # rows that go on with what is held
        if held and ready < batch.num_rows:
            yield pa.concat_batches([*held, batch.slice(0, ready)])
            batch, held = batch.slice(ready), []
            starts = starts[starts >= ready] - ready
        if len(starts) > 2:
            yield pa.concat_batches([*held, batch.slice(0, starts[-2])])
            batch, held = batch.slice(starts[-2]), []
        held.append(batch)
    if held:
        yield pa.concat_batches(held)


def _pairs(starts: np.ndarray, own: np.ndarray, low: np.ndarray, high: np.ndarray):
    """All pairs of rows of a place, in arrays of about _AT_ONCE: of a block's own rows, or of
    the rows of two blocks."""
    xs, ys, n = [], [], 0
    for i, j in zip(starts[:-1].tolist(), starts[1:].tolist()):
        if j - i == 2 and low[i] == high[i]:
            parts = [(np.array([i]), np.array([i + 1]))]
        elif low[i] == high[i]:
            parts = [(np.array([k]), np.arange(k + 1, j)) for k in range(i, j - 1)]
        else:
            second = i + np.flatnonzero(own[i:j] == high[i])
            parts = [(np.array([k]), second) for k in (i + np.flatnonzero(own[i:j] == low[i])).tolist()]
        for x, y in parts:
            xs.append(np.broadcast_to(x, y.shape))
            ys.append(y)
            n += len(y)
            if n >= _AT_ONCE:
                yield np.concatenate(xs), np.concatenate(ys)
                xs, ys, n = [], [], 0
    if n:
        yield np.concatenate(xs), np.concatenate(ys)


def _similar(pairs: DataFrame, sets: DataFrame, others: DataFrame, similarity: float, few: bool) -> DataFrame:
    """Those of pairs (a, b), of a in sets and b in others, that reach the similarity; few
    pairs are broadcast, so that only the sets of a are sent, to those of b."""
    told = (F.broadcast(pairs) if few else pairs).join(sets.select(F.col("node").alias("a"), F.col("own").alias("x")), "a")
    second = others.select(F.col("node").alias("b"), F.col("own").alias("y"))
    second = second.join(F.broadcast(pairs.select("b").distinct()), "b", "left_semi") if few else second
    told = told.join(second, "b")
    common = F.size(F.array_intersect("x", "y"))
    return told.where(common >= F.lit(similarity) * (F.size("x") + F.size("y") - common) - F.lit(1e-9)).select("a", "b")


def _portions(pairs: int, sets: int, shingles: int) -> int:
    """In how many portions so many pairs are compared, by the key of b: each sends about as
    many shingles as all the sets have, or _SENT."""
    return max(1, math.ceil(pairs * shingles / max(sets, 1) / max(shingles, _SENT)))


def _read(docs: DataFrame, nodes: DataFrame, wanted: DataFrame, size: int) -> DataFrame:
    """The sets of the wanted nodes, from one document of each; kept."""
    rows = keep(nodes.join(wanted, "node", "left_semi").select(F.col("least.row").alias("__row")))
    few = rows.count() <= _BROADCAST_ROWS
    sets = keep(_sets(_numbered(docs.select("text")).join(F.broadcast(rows) if few else rows, "__row", "left_semi"), size))
    forget(rows)
    return sets


def _near(similarity: float):
    """Whether sets of n and m shingles can be similar by a bucket's shingle; see `_prefixes`."""
    n, m = F.abs("n"), F.abs("m")
    alike = F.least(n, m) >= F.lit(similarity) * F.greatest(n, m) - F.lit(1e-9)
    return alike & F.when(n < m, F.col("n") > 0).when(n > m, F.col("m") > 0).otherwise((F.col("n") > 0) & (F.col("m") > 0))


def _seeds(docs: DataFrame, nodes: DataFrame, similarity: float, size: int) -> DataFrame:
    """Similar pairs (a, b) among those whose fingerprints lie within RADIUS: each node with
    the least one of its fingerprint, and those with one another."""
    points = keep(nodes.groupBy("fp").agg(F.min("node").alias("head")))
    same = nodes.select("node", "fp").join(points, "fp").where("node <> head").select(F.col("node").alias("a"), F.col("head").alias("b"))
    near = edges_within(points.select("fp"), RADIUS).distinct()
    near = near.join(points.select(F.col("fp").alias("a"), F.col("head").alias("x")), "a").join(points.select(F.col("fp").alias("b"), F.col("head").alias("y")), "b")
    pairs = keep(same.unionByName(near.select(F.col("x").alias("a"), F.col("y").alias("b"))))
    forget(points)
    return _checked(docs, nodes, pairs, similarity, size)


def _checked(docs: DataFrame, nodes: DataFrame, pairs: DataFrame, similarity: float, size: int, edges: DataFrame | None = None) -> DataFrame:
    """Edges and those of pairs that are similar, kept instead of both."""
    wanted = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()
    sets = _read(docs, nodes, wanted, size)
    n, held = pairs.count(), sets.agg(F.count(F.lit(1)), F.sum(F.size("own"))).first()
    portions = _portions(n, held[0], held[1] or 0)
    found = [] if edges is None else [edges]
    for i in range(portions):

        def own(df: DataFrame, node: str) -> DataFrame:
            return df if portions == 1 else df.where(F.pmod(F.xxhash64(node), F.lit(portions)) == i)

        found.append(keep(_similar(own(pairs, "b"), sets, own(sets, "node"), similarity, n <= portions * _BROADCAST_ROWS)))
        let_go(docs.sparkSession)
    out = keep(reduce(DataFrame.unionByName, found))
    forget(sets, pairs, *found)
    return out


def _linked(docs: DataFrame, nodes: DataFrame, buckets: DataFrame, similarity: float, size: int) -> DataFrame:
    """(node, component) for the nodes that have a similar one; kept, and buckets aren't."""
    edges = _seeds(docs, nodes, similarity, size)
    found = components(edges)
    rows, before = buckets.count(), math.inf
    for turn in range(_ROUNDS + 1):
        known = keep(buckets.join(found, "node", "left").select("s", "node", "n", F.coalesce("component", "node").alias("label")))
        many = known.groupBy("s", "label").agg(F.count(F.lit(1)).cast("double").alias("c"), F.sum((F.col("n") < 0).cast("double")).alias("p"))
        pairs_of = lambda c: (F.sum(c) ** 2 - F.sum(F.col(c) ** 2)) / 2
        lots = keep(many.groupBy("s").agg((pairs_of("c") - pairs_of("p")).alias("open"), F.sum("c").alias("rows")).where("open > 0"))
        left = lots.agg(F.sum("open")).first()[0] or 0
        if not left:
            forget(known, lots)
            break
        # Buckets that are linked through stay so; the next turn does without them.
        open_ = keep(known.join(lots.select("s", "rows"), "s"))
        forget(known, lots, buckets)
        buckets = open_.select("s", "node", "n")
        buckets.kept_at = open_.kept_at
        # Where a turn has linked little, what is left aren't near copies, and no hub helps.
        whole = left <= _PAIRS_A_ROW * rows or left > _STALLED * before or turn == _ROUNDS
        before = left
        if whole:
            pairs = keep(_within(open_, nodes, similarity))
        else:
            hub = open_.groupBy("s").agg(F.min(F.struct(F.xxhash64("node", F.lit(turn)).alias("h"), "node", "n", "label")).alias("hub"))
            pairs = open_.join(hub, "s").where("label <> hub.label").select(F.col("node").alias("a"), F.col("hub.node").alias("b"), "n", F.col("hub.n").alias("m"))
            pairs = keep(_possible(pairs, nodes, similarity))
        forget(found)
        edges = _checked(docs, nodes, pairs, similarity, size, edges)
        found = components(edges)
        if whole:
            break
    forget(edges, buckets)
    return found


def representatives(docs: DataFrame, key: str = "doc_id", similarity: float = SIMILARITY, size: int = SHINGLE) -> DataFrame:
    """One row, with all columns, of each group that pairs of the similarity link: that with
    the smallest key, null keys last, and of rows with that key the first read.

    The similarity is the Jaccard coefficient of the sets of `size`-word shingles, over words
    as in simhash; a text of fewer words is one shingle. Null and wordless texts are one
    group. docs has to be a table that gives the same rows when it is read twice.
    """
    spark = docs.sparkSession
    ship_code(spark)
    told = keep(_told(docs, key, size, similarity))
    weights = np.zeros(1 << _CELL_BITS, np.int64)
    counts = told.where("counts is not null").select(F.posexplode("counts").alias("cell", "n")).groupBy("cell").agg(F.sum("n").alias("n")).toArrow()
    weights[counts["cell"].to_numpy()] = counts["n"].to_numpy()
    least = F.min(F.struct(F.col("k").isNull().alias("none"), "k", "row")).alias("least")
    nodes = keep(told.where("node is not null").groupBy("node").agg(least, F.first("fp").alias("fp"), F.first("bits").alias("bits")))

    own = Window.partitionBy("s")
    prefixes = _prefixes(docs, size, similarity, spark.sparkContext.broadcast(weights))
    marked = prefixes.withColumn("before", F.lag("node").over(own.orderBy("node"))).withColumn("low", F.min("node").over(own)).withColumn("high", F.max("node").over(own)).withColumn("most", F.max("n").over(own))
    buckets = keep(marked.where("low <> high and most > 0 and (before is null or before <> node)").select("s", "node", "n"))
    forget(told)
    found = _linked(docs, nodes, buckets, similarity, size)
    labelled = nodes.join(found, "node", "left").select("least", F.coalesce("component", "node").alias("component"))
    heads = keep(labelled.groupBy("component").agg(F.min("least").alias("least")).select(F.col("least.row").alias("__row")))
    forget(found, nodes)
    few = heads.count() <= _BROADCAST_ROWS
    return _numbered(docs).join(F.broadcast(heads) if few else heads, "__row", "left_semi").drop("__row")
