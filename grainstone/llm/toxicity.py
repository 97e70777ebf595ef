"""Toxicity by compression distance: two trained zstandard dictionaries and calibrated lengths.

zstandard's own trainer makes both dictionaries. The ordinary one learns from windows of
ordinary labelled rows. The trainer keeps what is most frequent in its samples, and that is
the same in toxic rows; so the toxic one learns only from words with a telling string: one
of STRING bytes that is in significantly more toxic than ordinary rows (a G test against
chance over all strings, with the rate at least LIFT times as high). Near copies among the
labelled rows count once.

A text is compared window by window: WORDS words in a row, from each word on. A window is
compressed with the ordinary dictionary and with the ordinary and toxic ones together; its
gain is the difference of the lengths. Both compressors have equally many bytes before the
window (the ordinary one repeats its end), so distances cost the same. The mean gain, the
shares of windows that gain more and the largest gains of windows apart go through a
logistic curve with a constant for each class of length, fitted on labelled rows kept out of
the dictionaries, in which both labels weigh the same.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..cluster import cut_lineage, ship_code
from .labelled import fit_logistic, logistic, remainder, sample
from .words import alnum_words, filter_rows, runs, space_words

#: Labelled rows of each class that the dictionaries and the curve are fitted on, at most.
SAMPLE = 4000
#: Words of a window, and bytes of the ordinary and (at most) the toxic dictionary.
WORDS, ORDINARY, TOXIC = 3, 112 << 10, 16 << 10
#: Gain of a window beside which the next ones are compared, too.
LOOK = 2
#: Windows of each ordinary row that its dictionary is trained on, at most, evenly spaced;
#: so many words for the toxic one, at most, in proportion to their counts.
WINDOWS_A_ROW, TOXIC_WORDS = 64, 200_000
#: Bytes of a telling string, and how much higher its rate in toxic rows is at least.
STRING, LIFT = 6, 4.0
#: Bounds of the classes of length, in windows.
LENGTHS = (64, 256, 1024)
_GAINS = (3, 5)
_GAP = b"  "
#: Begins every window and both dictionaries, so that each window has a match and is
#: compressed; words have none of these bytes.
_FRAME = b"#@%!~^|{}<>=+_&$"
#: zstandard doesn't find what is at the very end of a dictionary, and doesn't look for
#: matches in the last 16 bytes of what it compresses, so each window has bytes to spare.
_END = bytes(range(1, 10))
_TAIL = bytes(range(10, 26))


@dataclass
class Model:
    """ordinary, toxic: contents of the dictionaries; curve: coefficients of `features`
    less `centre`, over `scale`; base: the score without dictionaries."""

    ordinary: bytes = b""
    toxic: bytes = b""
    curve: np.ndarray = field(default_factory=lambda: np.zeros(0))
    centre: np.ndarray = field(default_factory=lambda: np.zeros(0))
    scale: np.ndarray = field(default_factory=lambda: np.zeros(0))
    base: float = 0.0

    def score(self, texts: list[bytes]) -> np.ndarray:
        """How likely each text is toxic."""
        if not len(self.curve):
            return np.full(len(texts), self.base)
        gains = held_gains(self.ordinary, self.toxic)
        x = np.array([features(gains.of(t)) for t in texts]).reshape(len(texts), -1)
        return logistic((x - self.centre) / self.scale, self.curve)


class Gains:
    """Bytes that the windows of a text save with the toxic dictionary."""

    def __init__(self, ordinary: bytes, toxic: bytes):
        how = zstandard.ZstdCompressionParameters(
            window_log=18, chain_log=17, hash_log=17, search_log=9, min_match=6, target_length=64, strategy=zstandard.STRATEGY_GREEDY, write_checksum=False, write_content_size=False, write_dict_id=False
        )

        def of(content: bytes):
            data = zstandard.ZstdCompressionDict(_FRAME + ordinary + content + _END, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            return zstandard.ZstdCompressor(dict_data=data, compression_params=how).compress

        same = (ordinary * (len(toxic) // max(len(ordinary), 1) + 1))[-len(toxic) :] if toxic else b""
        self.ordinary, self.toxic = of(same), of(toxic)

    def of(self, text: bytes) -> np.ndarray:
        own = windows(text)
        gains = np.zeros(len(own) + 1, np.int64)
        gains[:-1:2] = self._saved(own[::2])
        near = gains >= LOOK
        between = np.flatnonzero(near[:-2:2] | near[2::2]) * 2 + 1 if len(own) > 1 else np.zeros(0, np.int64)
        between = between[between < len(own)]
        gains[between] = self._saved([own[i] for i in between.tolist()])
        return gains[:-1]

    def _saved(self, own: list[bytes]) -> np.ndarray:
        ordinary, toxic = (np.fromiter(map(len, map(f, own)), np.int64, len(own)) for f in (self.ordinary, self.toxic))
        return ordinary - toxic


_HELD: dict[tuple[bytes, bytes], Gains] = {}


def held_gains(ordinary: bytes, toxic: bytes) -> Gains:
    """The worker's compressors for these dictionaries, kept between tasks; others go."""
    if (ordinary, toxic) not in _HELD:
        _HELD.clear()
        _HELD[ordinary, toxic] = Gains(ordinary, toxic)
    return _HELD[ordinary, toxic]


def framed(words: list[bytes]) -> bytes:
    return _GAP + _GAP.join(words) + _GAP


def windows(text: bytes) -> list[bytes]:
    """Every WORDS words in a row, framed; fewer words are one window, none are none."""
    words = alnum_words(text)
    if len(words) <= WORDS:
        return [_FRAME + framed(words) + _TAIL] if words else []
    start, end = _FRAME + _GAP, _GAP + _TAIL
    return [start + w + end for w in map(_GAP.join, zip(*(words[i:] for i in range(WORDS))))]


def features(gains: np.ndarray) -> list[float]:
    """Mean gain, roots of the shares of windows that gain _GAINS, the largest gains of
    three windows apart, and which class of length it is."""
    m = len(gains)
    lengths = [float(low < max(m, 1) <= high) for low, high in zip((0, *LENGTHS), (*LENGTHS, math.inf))]
    if not m:
        return [0.0] * (4 + len(_GAINS)) + lengths
    high = np.sort(gains)[::-1]
    tops = [float(high[WORDS * i]) if WORDS * i < m else 0.0 for i in range(3)]
    return [float(gains.mean()), *(math.sqrt(float((gains >= g).mean())) for g in _GAINS), *tops, *lengths]


def strings(data: bytes) -> np.ndarray:
    """The strings of STRING bytes in data, each as a number, with repeats."""
    a = np.frombuffer(data, np.uint8).astype(np.int64)
    n = max(len(a) - STRING + 1, 0)
    found = np.zeros(n, np.int64)
    for i in range(STRING):
        found = found << 8 | a[i : i + n]
    return found


def telling_words(text: bytes, telling: np.ndarray) -> list[bytes]:
    """The text's words, framed, that have a telling string; all, if there is none at all."""
    words = alnum_words(text)
    if not len(telling) or not words:
        return [framed([w]) for w in words]
    found = strings(framed(words))
    at = np.minimum(np.searchsorted(telling, found), len(telling) - 1)
    before = np.concatenate([[0], np.cumsum(telling[at] == found)])
    size = np.fromiter(map(len, words), np.int64, len(words))
    low = np.cumsum(size + len(_GAP)) - size - len(_GAP)
    high = np.maximum(low + size + 2 * len(_GAP) - STRING + 1, low)
    return [framed([words[i]]) for i in np.flatnonzero(before[high] > before[low]).tolist()]


def _copies(text: bytes, seed: int) -> int:
    """The least hash of a text's five-word shingles: near copies mostly have it in common."""
    words = space_words(text)
    least = min((xxhash.xxh64_intdigest(b" ".join(words[i : i + 5]), seed) for i in range(max(1, len(words) - 4))), default=0)
    return least - (1 << 64) if least >> 63 else least


def _chosen(docs: DataFrame, labels: DataFrame, usable, most: int, key: str) -> DataFrame:
    """(text, label, fold) of the labelled rows that the model is fitted on."""

    def told(batches):
        for batch in batches:
            for part, texts in runs(batch):
                yield pa.RecordBatch.from_arrays([*part.columns, *(pa.array([_copies(t, s) for t in texts], pa.int64()) for s in (1, 2))], [*part.schema.names, "a", "b"])

    kind = dict(docs.dtypes)[key]
    rows = sample(docs, labels, "toxic", usable, most, key).select(F.col(key).alias("k"), "text", "label")
    rows = cut_lineage(rows.mapInArrow(told, f"k {kind}, text string, label int, a long, b long"))
    order = F.xxhash64("k")
    one = rows.groupBy("label", "a").agg(F.min(F.struct(order.alias("h"), "k", "b")).alias("r")).select("label", "r.h", "r.k", "r.b")
    two = one.groupBy("label", "b").agg(F.min(F.struct("h", "k")).alias("r")).select("r.k").distinct()
    return rows.join(F.broadcast(two), "k").select("text", "label", F.pmod(F.xxhash64("k", F.lit("fold")), F.lit(3)).alias("fold"))


def _telling(learn: DataFrame) -> np.ndarray:
    """The telling strings, sorted."""

    def count(batches):
        for batch in batches:
            for part, texts in runs(batch):
                for label in (0, 1):
                    own = [np.unique(strings(framed(alnum_words(t)))) for t, x in zip(texts, part.column(1).to_pylist()) if x == label]
                    if own:
                        found, n = np.unique(np.concatenate(own), return_counts=True)
                        pair = (n, np.zeros_like(n)) if label else (np.zeros_like(n), n)
                        for i in range(0, len(found), 50000):
                            yield pa.RecordBatch.from_arrays([pa.array(x[i : i + 50000]) for x in (found, *pair)], ["s", "t", "o"])

    rows = {r.label: r["count"] for r in learn.groupBy("label").count().collect()}
    n1, n0 = rows.get(1, 0), rows.get(0, 0)
    if not n1 or not n0:
        return np.zeros(0, np.int64)
    counts = learn.select("text", "label").mapInArrow(count, "s long, t long, o long").groupBy("s").agg(F.sum("t").cast("double").alias("t"), F.sum("o").cast("double").alias("o"))
    seen = cut_lineage(counts.where("t > 1"))
    tested = seen.count()

    def term(x):
        return F.when(x > 0, x * F.log(x)).otherwise(F.lit(0.0))

    t, o = F.col("t"), F.col("o")
    half = term(t) + term(o) + term(n1 - t) + term(n0 - o) - term(t + o) - term(n1 + n0 - t - o)
    g = 2 * (half + F.lit((n1 + n0) * math.log(n1 + n0) - n1 * math.log(n1) - n0 * math.log(n0)))
    found = seen.where((g >= 2 * math.log(max(tested, 1)) + 2) & (t / n1 >= LIFT * (o + 0.5) / n0)).select("s").toArrow()
    return np.sort(found["s"].to_numpy())


def train(samples: list[bytes], most: int, segment: int, string: int) -> bytes:
    """What zstandard's trainer keeps of the samples; where they are too few to train on,
    the samples themselves, up to that size."""
    try:
        data = zstandard.train_dictionary(most + 512, samples, k=segment, d=string, level=3).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[-most:]
    return data[max(data.find(_GAP), 0) :][-most:]


def dictionaries(learn: DataFrame) -> tuple[bytes, bytes]:
    """The ordinary and the toxic dictionary; where no string is telling, the toxic one is
    trained on all words of toxic rows."""
    telling = _telling(learn)

    def toxic(batches):
        for batch in batches:
            for _, texts in runs(batch):
                own = [w for t in texts for w in telling_words(t, telling)]
                yield pa.RecordBatch.from_arrays([pa.array(own, pa.binary())], ["w"])

    def ordinary(batches):
        for batch in batches:
            for _, texts in runs(batch):
                for t in texts:
                    own = [w[len(_FRAME) : -len(_TAIL)] for w in windows(t)]
                    at = np.unique(np.linspace(0, len(own) - 1, min(len(own), WINDOWS_A_ROW)).astype(int)) if own else []
                    yield pa.RecordBatch.from_arrays([pa.array([own[i] for i in at], pa.binary())], ["w"])

    said = learn.where("label = 1").select("text").mapInArrow(toxic, "w binary").groupBy("w").count().orderBy("w").collect()
    total = sum(r["count"] for r in said)
    often = [(bytes(r.w), max(1, r["count"] * TOXIC_WORDS // max(total, TOXIC_WORDS))) for r in said]
    plain = learn.where("label = 0").select("text").mapInArrow(ordinary, "w binary").orderBy(F.xxhash64("w"), "w").toArrow()
    mixed = sorted((xxhash.xxh64_intdigest(w, i), w) for w, n in often for i in range(n))  # the trainer takes each part of the samples by itself
    return train(plain["w"].to_pylist(), ORDINARY, 24, 8), train([w for _, w in mixed], TOXIC, 12, 6)


def fit(docs: DataFrame, labels: DataFrame, usable, most: int = SAMPLE, key: str = "doc_id") -> Model:
    """The model from labels rows that are usable. Without rows of both classes it has no
    dictionaries, and its score is the share of toxic rows (0 without any)."""
    ship_code(docs.sparkSession)
    known = labels.where(usable & F.col("toxic").isin(0, 1))
    share = {r.toxic: r["count"] for r in known.groupBy("toxic").count().collect()}
    n1, n0 = share.get(1, 0), share.get(0, 0)
    model = Model(base=n1 / (n0 + n1) if n0 + n1 else 0.0)
    rows = cut_lineage(_chosen(docs, labels, usable, most, key))
    if {r.label for r in rows.select("label").distinct().collect()} != {0, 1}:
        return model
    model.ordinary, model.toxic = dictionaries(rows.where("fold > 0"))
    for own in (rows.where("fold = 0"), rows):
        table = own.select("text", "label").mapInArrow(_features_of(model.ordinary, model.toxic), "f array<double>, label int").toArrow().to_pydict()
        y = np.array(table["label"], float)
        if set(y) == {0.0, 1.0}:
            break
    x = np.array(table["f"])
    model.centre, model.scale = x.mean(0), np.maximum(x.std(0), 1e-3)
    weight = np.where(y == 1, 0.5 / y.mean(), 0.5 / (1 - y.mean()))
    model.curve = fit_logistic((x - model.centre) / model.scale, y, weight, ridge=1.0)
    return model


def _features_of(ordinary: bytes, toxic: bytes):
    def run(batches):
        gains = held_gains(ordinary, toxic)
        for batch in batches:
            for part, texts in runs(batch):
                yield pa.RecordBatch.from_arrays([pa.array([features(gains.of(t)) for t in texts], pa.list_(pa.float64())), part.column(1)], ["f", "label"])

    return run


def score(docs: DataFrame, model: Model, key: str = "doc_id", held_out=None) -> DataFrame:
    """(key, held_out, score, predicted) for each row of docs, over whole texts.

    Null, empty and wordless texts have no window and get the curve's value without gain.
    Very long texts are compared window by window to their end. Equal texts get equal
    scores; repeated rows each get theirs; null keys stay null; other columns, also of the
    names of the result, don't matter; no rows give no rows.
    """
    ship_code(docs.sparkSession)
    kind = dict(docs.dtypes)[key]
    held = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in batches:
            for part, texts in runs(batch):
                s = held.value.score(texts)
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(2), pa.array(s), pa.array((s >= 0.5).astype(np.int32))], ["k", "held_out", "score", "predicted"])

    rows = docs.select(F.col(key).alias("k"), "text", (F.lit(False) if held_out is None else held_out).alias("held_out"))
    return rows.mapInArrow(run, f"k {kind}, held_out boolean, score double, predicted int").withColumnRenamed("k", key)


def keep(docs: DataFrame, model: Model, value: int = 0) -> DataFrame:
    """The rows of docs, all columns, whose predicted label is `value`; as for `score`, null
    and empty texts are judged without gain, and each of repeated rows stays or goes alike."""
    ship_code(docs.sparkSession)
    held = docs.sparkSession.sparkContext.broadcast(model)
    return filter_rows(docs, lambda texts: (held.value.score(texts) >= 0.5) == bool(value))


def classify(docs: DataFrame, labels: DataFrame, mod: int = 5, out: int = 0, source: DataFrame | None = None) -> DataFrame:
    """Fit on labels whose key's remainder isn't `out`, and score all docs.

    source, docs if not given, is where the labelled texts are.
    """
    held = remainder("doc_id", mod) == out
    model = fit(docs if source is None else source, labels, remainder("doc_id", mod) != out)
    return score(docs, model, held_out=held)
