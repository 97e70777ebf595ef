"""Benchmark decontamination: a prefix-filtered set join with exact containment.

Every run of `window` words of a benchmark item is a window (a shorter item is one window).
A document contains a window exactly if it contains all its shingles in place, so by the
prefix filter one necessary shingle decides the candidates: the window's rarest in the
documents. Windows are found by that shingle, length and place give the only start a
candidate can have, starts outside the document are dropped, and the words are compared.

Shingles are two neighbouring words (one word for a window of one). Words are numbered by
the benchmark's vocabulary; any other word is 0 and can't take part.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..cluster import ship_code
from .words import alnum_words, filter_rows, runs

WINDOW = 10
#: Text and ids of a benchmark that are made an index of and broadcast at once: about ten
#: times as many bytes. A larger benchmark is taken in parts.
PART_BYTES = 2 << 20
_CANDIDATES = 1 << 18
#: Separates documents in a run; no word can be this byte, as it is a separator itself.
_END = b"\x00"

RESULT = "n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean"


class Index:
    """Windows of benchmark items, findable by their rarest shingle.

    Windows are rows of word numbers, each kept once, and the numbers of their items lie in
    a row behind each other; so a word of benchmark takes some 100 bytes, its own included.
    """

    def __init__(self, items: list[tuple[str, bytes]], window: int):
        self.vocab: dict[bytes, int] = {_END: -1}
        self.items = sorted({item for item, _ in items})
        place = {item: i for i, item in enumerate(self.items)}
        rows, owners = [np.zeros((0, window), np.int32)], [np.zeros(0, np.int64)]
        for item, text in items:
            number = self.vocab.setdefault
            ids = np.array([number(w, len(self.vocab)) for w in alnum_words(text)], np.int32)
            if len(ids) >= window:
                rows.append(np.lib.stride_tricks.sliding_window_view(ids, window))
            elif len(ids):
                rows.append(np.pad(ids, (0, window - len(ids)))[None, :])
            owners.append(np.full(max(len(ids) - window + 1, 1) if len(ids) else 0, place[item]))
        table = np.concatenate(rows)
        owner = np.concatenate(owners)
        whole = np.ascontiguousarray(table).view([("", np.int32)] * window).ravel()
        _, first, which = np.unique(whole, return_index=True, return_inverse=True)
        self.words = table[first]
        self.length = (self.words > 0).sum(1).astype(np.int64)
        pairs = np.unique(which * len(self.items) + owner) if len(owner) else owner
        self.owner = (pairs % max(len(self.items), 1)).astype(np.int32)
        self.owned = np.searchsorted(pairs, np.arange(len(first) + 1) * len(self.items))
        self.base = len(self.vocab) + 1
        self.codes = np.unique(self._codes()[1])
        self.prefix = np.zeros(0, np.int64)

    def _codes(self) -> tuple[np.ndarray, np.ndarray]:
        """Which places of the windows' rows have a shingle, and their codes, row by row."""
        w = self.words.astype(np.int64)
        two = np.concatenate([w[:, 1:], np.zeros((len(w), 1), np.int64)], axis=1)
        has = two > 0
        has[:, 0] |= self.length == 1
        return has, (w * self.base + two)[has]

    def order_by_rarity(self, codes: np.ndarray, counts: np.ndarray) -> None:
        """Choose each window's prefix: its shingle with the lowest count, then lowest code,
        then first place."""
        many = np.zeros(len(self.codes), np.int64)
        many[np.searchsorted(self.codes, codes)] = counts
        rank = np.empty(len(self.codes), np.int64)
        rank[np.lexsort((self.codes, many))] = np.arange(len(self.codes))
        has, own = self._codes()
        ranks = np.full(has.shape, len(self.codes), np.int64)
        ranks[has] = rank[np.searchsorted(self.codes, own)]
        at = ranks.argmin(1) if len(ranks) else np.zeros(0, np.int64)
        chosen = np.zeros(has.shape, np.int64)
        chosen[has] = own
        code = chosen[np.arange(len(at)), at]
        order = np.argsort(code, kind="stable")
        self.prefix, first = np.unique(code[order], return_index=True)
        self.first = np.append(first, len(order))
        self.entry, self.place = order, at[order]

    def items_of(self, window: int) -> list[str]:
        return [self.items[i] for i in self.owner[self.owned[window] : self.owned[window + 1]]]

    def word_ids(self, texts: list[bytes]) -> np.ndarray:
        """Word ids of the texts in a row, each text followed by -1."""
        words: list[bytes] = []
        for t in texts:
            words += alnum_words(t)
            words.append(_END)
        get = self.vocab.get
        return np.fromiter((get(w, 0) for w in words), np.int64, len(words))

    def shingle_codes(self, ids: np.ndarray, known: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places and codes of the shingles in ids that `known`, sorted codes, has."""
        if not len(known):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        one = np.flatnonzero(ids > 0)
        two = one[ids[one + 1] > 0]
        at = np.concatenate([two, one])
        codes = np.concatenate([ids[two] * self.base + ids[two + 1], ids[one] * self.base])
        found = np.minimum(np.searchsorted(known, codes), len(known) - 1)
        kept = known[found] == codes
        return at[kept], codes[kept]

    def matches(self, ids: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Starts in ids and numbers of the windows that occur there, in blocks."""
        at, codes = self.shingle_codes(ids, self.prefix)
        which = np.searchsorted(self.prefix, codes)
        many = self.first[which + 1] - self.first[which]
        ends = np.cumsum(many)
        low = 0
        while low < len(at):
            done = ends[low - 1] if low else 0
            high = max(low + 1, int(np.searchsorted(ends, done + _CANDIDATES, "right")))
            n = many[low:high]
            rank = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            entry = np.repeat(self.first[which[low:high]], n) + rank
            window = self.entry[entry]
            start = np.repeat(at[low:high], n) - self.place[entry]
            size = self.length[window]
            fits = (start >= 0) & (start + size <= len(ids))
            start, window, size = start[fits], window[fits], size[fits]
            same = np.ones(len(start), bool)
            for p in range(self.words.shape[1]):
                live = same & (p < size)
                same[live] = ids[start[live] + p] == self.words[window[live], p]
            yield start[same], window[same]
            low = high


def _index(docs: DataFrame, items: list[tuple[str, bytes]], window: int):
    """The broadcast index, its shingles ordered by their counts over all documents."""
    spark = docs.sparkSession
    index = Index(items, window)
    raw = spark.sparkContext.broadcast(index)

    def count(batches):
        ix = raw.value
        total = np.zeros(len(ix.codes), np.int64)
        for batch in batches:
            for _, texts in runs(batch):
                _, codes = ix.shingle_codes(ix.word_ids(texts), ix.codes)
                total += np.bincount(np.searchsorted(ix.codes, codes), minlength=len(total))
        seen = np.flatnonzero(total)
        for i in range(0, len(seen), 10000):
            part = seen[i : i + 10000]
            yield pa.RecordBatch.from_arrays([pa.array(ix.codes[part]), pa.array(total[part])], ["code", "n"])

    counts = docs.select("text").mapInArrow(count, "code long, n long").groupBy("code").agg(F.sum("n").alias("n"))
    found = counts.toArrow()
    index.order_by_rarity(found["code"].to_numpy(), found["n"].to_numpy())
    return spark.sparkContext.broadcast(index)


def _found(index: Index, texts: list[bytes]) -> tuple[np.ndarray, list[np.ndarray], np.ndarray, list[set[str]]]:
    """Word ids, per text its first place, a hit flag for each place, per text its items."""
    ids = index.word_ids(texts)
    ends = np.flatnonzero(ids == -1)
    delta = np.zeros(len(ids) + 1, np.int64)
    items: list[set[str]] = [set() for _ in texts]
    for start, window in index.matches(ids):
        np.add.at(delta, start, 1)
        np.add.at(delta, start + index.length[window], -1)
        pairs = np.unique(np.stack([np.searchsorted(ends, start), window], 1), axis=0)
        for d, w in pairs.tolist():
            items[d].update(index.items_of(w))
    return ids, ends, np.cumsum(delta[:-1]) > 0, items


def _digest(items: set[str]) -> str:
    return hashlib.sha256(",".join(sorted(items)).encode()).hexdigest()


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, part_bytes: int = PART_BYTES, key: str = "doc_id") -> DataFrame:
    """One row per row of docs: its key and RESULT.

    docs has the key and `text`; benchmark has `item_id` and `text`; other columns don't
    matter. A null or wordless text has no words and no hits; a null or wordless item has
    no windows, and an item without id has the id "". Repeated rows each get their result.
    An empty benchmark hits nothing. items_sha256 of no items is that of the empty string.

    The benchmark is measured first. Up to part_bytes of text it is broadcast whole; beyond,
    its items are taken in parts of that size, one pass over docs for each, and the hit
    ranges of the few documents that have any are merged by key and text.
    """
    ship_code(docs.sparkSession)
    docs = docs.select(F.col(key).alias("k"), F.col("text"))
    kind = docs.schema["k"].dataType.simpleString()
    parts = _parts(benchmark, part_bytes)
    hits = None
    for own in parts:
        held = _index(docs, own(), window)
        if len(parts) == 1:
            return _whole(docs, held, kind).withColumnRenamed("k", key)
        found = _hits(docs, held)
        hits = found if hits is None else hits.unionByName(found)
    return _merged(docs, hits).withColumnRenamed("k", key)


def clean(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, part_bytes: int = PART_BYTES) -> DataFrame:
    """The rows of docs, all columns, that have no window of any benchmark item; null, empty
    and wordless texts have none. Each of repeated rows stays or goes alike. docs are read
    once for each part of the benchmark, and once for the result.
    """
    ship_code(docs.sparkSession)
    indexes = [_index(docs, own(), window) for own in _parts(benchmark, part_bytes)]
    return filter_rows(docs, lambda texts: ~np.any([[bool(x) for x in _found(held.value, texts)[3]] for held in indexes], axis=0))


def _parts(benchmark: DataFrame, part_bytes: int):
    """The benchmark's items in parts of about part_bytes, each a function that collects it."""
    items = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"), F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("text"))
    size = items.agg(F.coalesce(F.sum(F.octet_length("text") + F.octet_length("item")), F.lit(0))).first()[0]
    n = max(1, -(-size // part_bytes))
    dealt = items.withColumn("part", F.pmod(F.xxhash64("item", "text"), F.lit(n)))
    return [lambda p=p: [(r.item, bytes(r.text)) for r in dealt.where(F.col("part") == p).collect()] for p in range(n)]


def _whole(docs: DataFrame, held, kind: str) -> DataFrame:
    def find(batches):
        index = held.value
        for batch in batches:
            for rows, texts in runs(batch):
                ids, ends, hit, items = _found(index, texts)
                first = np.concatenate([[0], ends[:-1] + 1])
                total = np.concatenate([[0], np.cumsum(hit)])
                n_hit = total[ends] - total[first]
                yield pa.RecordBatch.from_arrays(
                    [
                        rows.column(0),
                        pa.array(ends - first, pa.int64()),
                        pa.array(n_hit, pa.int64()),
                        pa.array([len(x) for x in items], pa.int64()),
                        pa.array([_digest(x) for x in items], pa.string()),
                        pa.array(n_hit > 0),
                    ],
                    ["k", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"],
                )

    return docs.mapInArrow(find, f"k {kind}, {RESULT}")


def _digest_of():
    """SHA-256 of key and text, which no two rows that differ have in common."""
    k = F.coalesce(F.col("k").cast("string"), F.lit(""))
    return F.sha2(F.concat(F.length(k).cast("string"), F.when(F.col("k").isNull(), "-").otherwise(":"), k, F.coalesce("text", F.lit(""))).cast("binary"), 256)


def _hits(docs: DataFrame, held) -> DataFrame:
    """Documents that have hits: digest of key and text, hit places as runs, items."""

    def find(batches):
        index = held.value
        for batch in batches:
            for rows, texts in runs(batch):
                _, ends, hit, items = _found(index, texts)
                first = np.concatenate([[0], ends[:-1] + 1])
                for d in (i for i, x in enumerate(items) if x):
                    own = np.flatnonzero(np.diff(np.concatenate([[0], hit[first[d] : ends[d]].astype(np.int8), [0]])))
                    spans = [{"a": int(a), "b": int(b)} for a, b in own.reshape(-1, 2)]
                    yield pa.RecordBatch.from_pylist([{"digest": rows.column(2)[d].as_py(), "spans": spans, "items": sorted(items[d])}], pa.schema([("digest", pa.string()), ("spans", pa.list_(pa.struct([("a", pa.int64()), ("b", pa.int64())]))), ("items", pa.list_(pa.string()))]))

    return docs.withColumn("digest", _digest_of()).mapInArrow(find, "digest string, spans array<struct<a:long,b:long>>, items array<string>")


def _merged(docs: DataFrame, hits: DataFrame) -> DataFrame:
    """The result from the hit ranges of all parts of the benchmark."""
    one = hits.groupBy("digest").agg(F.array_distinct(F.flatten(F.collect_set("items"))).alias("items"), F.flatten(F.collect_set("spans")).alias("spans"))
    told = docs.select("k", "text", _digest_of().alias("digest")).join(one, "digest", "left")
    low = F.translate(F.coalesce("text", F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    places = F.array_distinct(F.flatten(F.transform("spans", lambda s: F.sequence(s["a"], s["b"] - F.lit(1)))))
    items = F.coalesce("items", F.array().cast("array<string>"))
    n_hit = F.coalesce(F.size(places), F.lit(0)).cast("long")
    n_hit = F.when(F.col("spans").isNull(), F.lit(0).cast("long")).otherwise(n_hit)
    return told.select(
        "k",
        F.size(F.regexp_extract_all(low, F.lit(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"), F.lit(0))).cast("long").alias("n_words"),
        n_hit.alias("n_hit"),
        F.size(items).cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort(items), ","), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )
