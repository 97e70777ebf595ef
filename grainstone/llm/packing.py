"""Order-preserving packing of token streams into windows, by dynamic programming.

The documents of a partition, in their order, make one stream of tokens. Windows are cut at
places that cost nothing (a document's end), little (a sentence's end) or more (inside a
sentence, only where its tokens would not fit otherwise). The cheapest cuts minimise padding
plus these penalties: best(j) = penalty(j) + min over i within a window before j of
best(i) + (window - (p_j - p_i)). The term in j doesn't depend on i, so the minimum of
best(i) + p_i over a sliding range is kept in a monotone queue, and each place costs O(1).

A partition is packed by itself, in the order it is read, without a shuffle. Tokens are taken
in runs, and what comes after a run's last cut waits for the next. What is left at a partition's end, less
than a window or one, goes with its ids to a second pass, where the ends of GROUP partitions
in a row are packed as one stream; so padding doesn't follow the number of partitions.
"""

from __future__ import annotations

from bisect import bisect_left
from collections import deque
from zlib import crc32

import numpy as np
import pyarrow as pa
import public_tokenizers
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..cluster import keep, ship_code
from .tokens import held
from .words import runs

WINDOW = 4096
END = 2
#: Cost in tokens of a cut at a sentence's end and inside a sentence.
AT_SENTENCE, INSIDE = 2.0, 24.0
#: Inside a sentence, places to cut are this part of a window apart.
STEPS = 64
#: Tokens that are cut into windows at once.
RUN_TOKENS = 1 << 19
#: Partitions whose ends are packed together: GROUP * window tokens at most.
GROUP = 256

PIECE = "start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, at_boundary boolean"


def best_cuts(places: np.ndarray, penalties: np.ndarray, window: int, going_on: bool = False) -> list[int]:
    """Indexes into places where windows end, the last place among them.

    places are increasing token counts after 0, at most `window` apart; a window goes from
    a cut, or 0, to a later one and holds `window` tokens at most. going_on: what comes after
    the last cut, a window at most, isn't cut and costs nothing yet.
    """
    p = [0, *places.tolist()]
    cost = [0.0, *penalties.tolist()]
    back = [0] * len(p)
    value = [0.0] * len(p)
    queue: deque[int] = deque([0])
    for j in range(1, len(p)):
        low = p[j] - window
        while p[queue[0]] < low:
            queue.popleft()
        i = queue[0]
        back[j] = i
        value[j] = value[i] + p[i] + cost[j] + window  # less p[j], which all share
        mine = value[j]
        value[j] -= p[j]
        while queue and value[queue[-1]] + p[queue[-1]] >= mine:
            queue.pop()
        queue.append(j)
    cuts = []
    j = len(p) - 1
    if going_on:
        j = min(range(bisect_left(p, p[-1] - window), len(p)), key=lambda i: (value[i], -i))
    while j:
        cuts.append(j - 1)
        j = back[j]
    return cuts[::-1]


def cut_places(documents: np.ndarray, sentences: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Places where a stream may be cut, in order, and their penalties: where documents end,
    the last of them the stream's end, where sentences end, and between places that are far
    apart, some inside of sentences."""
    places = np.concatenate([documents, sentences])
    cost = np.concatenate([np.zeros(len(documents)), np.full(len(sentences), AT_SENTENCE)])
    order = np.argsort(places, kind="stable")
    places, cost = places[order], cost[order]
    gaps = np.diff(places, prepend=0)
    step = max(1, window // STEPS)
    more = np.maximum(gaps - 1, 0) // step
    if more.any():
        nth = np.arange(int(more.sum())) - np.repeat(np.cumsum(more) - more, more) + 1
        inside = np.repeat(places - gaps, more) + nth * step
        places, cost = np.concatenate([places, inside]), np.concatenate([cost, np.full(len(inside), INSIDE)])
        order = np.argsort(places, kind="stable")
        places, cost = places[order], cost[order]
    return places, cost


class Packer:
    """Packs documents as they come; finished windows give pieces."""

    def __init__(self, window: int, first_id: int):
        self.window, self.next = window, first_id
        #: Row, ids, tokens done before, all tokens, places in ids where sentences end.
        self.docs: list[tuple[int, bytes, int, int, np.ndarray]] = []
        self.size = 0

    def add(self, row: int, ids: bytes, ends: np.ndarray, before: int = 0) -> None:
        """A document, or what comes after its first `before` tokens, with the places where
        sentences end. One right before the document's end isn't used."""
        n = len(ids) // 4
        self.docs.append((row, ids, before, before + n, ends[ends < n - 1]))
        self.size += n

    def flush(self, last: bool):
        """Pieces (row, start, length, crc, doc_tokens, sequence, offset, at_boundary) of the
        windows that are final; with `last`, of all. What is left is kept for the next run."""
        if not self.size:
            return []
        sizes = np.array([len(ids) // 4 for _, ids, *_ in self.docs])
        stops = np.cumsum(sizes)
        sentences = np.concatenate([own for *_, own in self.docs]) + np.repeat(stops - sizes, [len(own) for *_, own in self.docs])
        places, costs = cut_places(stops, sentences, self.window)
        cuts = best_cuts(places, costs, self.window, not last)
        ends = [int(places[c]) for c in cuts]
        cheap = {int(places[c]): bool(costs[c] <= AT_SENTENCE) for c in cuts}
        done = ends[-1] if ends else 0
        pieces = []
        at = d = 0
        begin = 0  # where the document d begins in the run
        for end in ends:
            offset = 0
            while at < end:
                row, ids, before, n, _ = self.docs[d]
                own = len(ids) // 4
                stop = min(end, begin + own)
                part = ids[4 * (at - begin) : 4 * (stop - begin)]
                pieces.append((row, before + at - begin, stop - at, crc32(part), n, self.next, offset, cheap[end]))
                offset += stop - at
                at = stop
                if at == begin + own:
                    begin += own
                    d += 1
            self.next += 1
        rest = self.docs[d:]
        if rest and at > begin:
            row, ids, before, n, own = rest[0]
            own = own[own > at - begin] - (at - begin)
            rest[0] = (row, ids[4 * (at - begin) :], before + at - begin, n, own)
        self.docs = rest
        self.size -= done
        return pieces


def pack(docs: DataFrame, key: str = "doc_id", window: int = WINDOW, tokenizer: str | None = None, group: int = GROUP) -> DataFrame:
    """The pieces of all documents: key and PIECE, in the order of the table's partitions.

    A text's tokens are its ids and then END. Null, empty and white-space texts have only
    END. Very long texts go through many windows, also over a partition's end. Repeated rows
    are packed as often as they occur, null keys stay null; other columns don't matter; no
    rows give no pieces. A sequence's id names its partition (from bit 33 on), or from bit 62
    on the group of partitions whose ends it packs, and its place there, so a task that runs
    again gives the same ids.
    """
    ship_code(docs.sparkSession)
    path = tokenizer or public_tokenizers.path("word_bpe_49k.json")
    kind = dict(docs.dtypes)[key]
    end = np.array([END], "<u4").tobytes()
    names = ["k", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "at_boundary", "ids", "ends"]
    none = (pa.binary(), pa.list_(pa.int32()))

    def told(pieces, keys, key_type):
        for low in range(0, len(pieces), 20000):
            columns = list(zip(*pieces[low : low + 20000]))
            got = pa.array([keys[r] for r in columns[0]], key_type)
            yield pa.RecordBatch.from_arrays([got, *(pa.array(c, pa.int64()) for c in columns[1:7]), pa.array(columns[7], pa.bool_()), *(pa.nulls(len(got), t) for t in none)], names)

    def run(batches):
        ids_of = held(path)
        first = TaskContext.get().partitionId() << 33
        packer = Packer(window, first)
        keys: list = []
        key_type = None
        for batch in batches:
            key_type = batch.schema.field(0).type
            for part, texts in runs(batch):
                for k, text in zip(part.column(0).to_pylist(), texts):
                    ids = b"".join(ids_of.words(text)) + end
                    keys.append(k)
                    packer.add(len(keys) - 1, ids, np.flatnonzero(ids_of.stops[np.frombuffer(ids, "<u4")]) + 1)
                    if packer.size >= RUN_TOKENS:
                        yield from told(packer.flush(False), keys, key_type)
                        keys = [keys[r] for r, *_ in packer.docs]
                        packer.docs = [(i, *d[1:]) for i, d in enumerate(packer.docs)]
        yield from told(packer.flush(False), keys, key_type)
        if packer.docs:
            rows, ids, before, whole, ends = zip(*packer.docs)
            n = len(rows)
            columns = [pa.array([keys[r] for r in rows], key_type), pa.array(before, pa.int64()), pa.array([len(x) // 4 for x in ids], pa.int64()), pa.array([0] * n, pa.int64()), pa.array(whole, pa.int64())]
            yield pa.RecordBatch.from_arrays([*columns, pa.array([first] * n, pa.int64()), pa.array(range(n), pa.int64()), pa.nulls(n, pa.bool_()), pa.array(ids, none[0]), pa.array(ends, none[1])], names)

    def again(batches):
        packer, now, keys, key_type = None, None, [], None
        for batch in batches:
            key_type = batch.schema.field("k").type
            for r in batch.to_pylist():
                if r["group"] != now:
                    if packer is not None:
                        yield from told(packer.flush(True), keys, key_type)
                    now, keys = r["group"], []
                    packer = Packer(window, 1 << 62 | now << 33)
                keys.append(r["k"])
                packer.add(len(keys) - 1, r["ids"], np.array(r["ends"], np.int64), r["start"])
        if packer is not None:
            yield from told(packer.flush(True), keys, key_type)

    shape = f"k {kind}, {PIECE}, ids binary, ends array<int>"
    packed = keep(docs.select(F.col(key).alias("k"), "text").mapInArrow(run, shape))
    rest = packed.where("ids is not null").withColumn("group", F.shiftright("sequence_id", 33).cast("long") / F.lit(group)).withColumn("group", F.floor("group"))
    rest = rest.repartition("group").sortWithinPartitions("group", "sequence_id", "offset").mapInArrow(again, shape)
    return packed.where("ids is null").unionByName(rest).drop("ids", "ends").withColumnRenamed("k", key)
