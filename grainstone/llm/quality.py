"""Quality by nearest neighbours among labelled latent-semantic vectors.

A text's terms are runs of one to three character classes: upper case, lower case, digit,
space, line end, or a punctuation mark, each with repeats taken as one, so that capitals,
tables and marks glued to words show in any language; and how much of it repeats itself.
Term frequencies, damped and weighted by rarity, are projected on the leading singular
vectors of a bounded sample of labelled rows. The labelled vectors are broadcast; each text
is compared with all of them in blocks and takes the labels of its nearest, weighted by
their cosines.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..cluster import cut_lineage, ship_code
from .labelled import remainder, sample
from .words import filter_rows, runs, space_words

#: Labelled rows of each class, at most, and the terms that most of them have, which the
#: model knows (there are fewer than 111,000 kinds in all). Their vectors, 2 * SAMPLE * DIMS
#: numbers, and a projection of TERMS * DIMS numbers are all that is broadcast.
SAMPLE = 3000
DIMS, TERMS, NEAREST, BLOCK = 48, 2048, 25, 256
_CLASSES = 48
_REPEAT = _CLASSES**3
#: Places after the class runs: repeats of the word before, words and lines seen before.
SPACE = _REPEAT + 3


def _class_table() -> np.ndarray:
    """0 is dropped; 1 space, 2 line end, 3 upper, 4 lower, 5 digit, 6 and on punctuation."""
    t = np.zeros(256, np.uint8)
    t[[9, 11, 12, 13, 32]] = 1
    t[10] = 2
    marks = 6
    for b in range(33, 127):
        c = chr(b)
        if c.isupper():
            t[b] = 3
        elif c.islower():
            t[b] = 4
        elif c.isdigit():
            t[b] = 5
        else:
            t[b] = marks
            marks += 1
    t[0x80:0x9F] = 3  # second bytes of Latin-1 capitals, then of small letters
    t[0x9F:0xC0] = 4
    return t


_TABLE = _class_table()


def term_counts(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Terms of a text, sorted, and their damped frequencies (of unit length; none if empty)."""
    c = _TABLE[np.frombuffer(text, np.uint8)].astype(np.int64)
    c = c[c > 0]
    if not len(c):
        return np.zeros(0, np.int64), np.zeros(0)
    c = c[np.concatenate([[True], c[1:] != c[:-1]])]
    two = c[:-1] * _CLASSES + c[1:]
    three = two[:-1] * _CLASSES + c[2:]
    terms, n = np.unique(np.concatenate([c, two, three]), return_counts=True)
    words = space_words(text)
    lines = text.split(b"\n")
    extra = [sum(map(bytes.__eq__, words, words[1:])), len(words) - len(set(words)), len(lines) - len(set(lines))]
    scale = [len(words), len(words) * 4, len(lines) * 2]
    value = np.sqrt(n / len(c))
    for i, (e, s) in enumerate(zip(extra, scale)):
        if e:
            terms, value = np.append(terms, _REPEAT + i), np.append(value, 2 * math.sqrt(e / s))
    return terms, value / np.linalg.norm(value)


@dataclass
class Model:
    """terms: those kept, sorted; project: terms x dims; vectors: labelled rows x dims."""

    terms: np.ndarray
    project: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray
    base: float

    def embed(self, texts: list[bytes]) -> np.ndarray:
        """Unit latent vectors; a text without known terms has the zero vector."""
        x = np.zeros((len(texts), len(self.terms)), np.float32)
        for i, t in enumerate(texts):
            terms, value = term_counts(t)
            if len(terms) and len(self.terms):
                at = np.minimum(np.searchsorted(self.terms, terms), len(self.terms) - 1)
                same = self.terms[at] == terms
                x[i, at[same]] = value[same]
        return unit(x @ self.project)

    def score(self, texts: list[bytes]) -> np.ndarray:
        """Share of label 1 among the nearest, weighted by cosine; `base` without neighbours.
        Of equally near ones at the last place, those first in the sample's order count."""
        if not len(self.labels):
            return np.full(len(texts), self.base)
        out = np.empty(len(texts))
        k = min(NEAREST, len(self.labels))
        for low in range(0, len(texts), BLOCK):
            cos = self.embed(texts[low : low + BLOCK]) @ self.vectors.T
            last = np.partition(cos, cos.shape[1] - k, axis=1)[:, [cos.shape[1] - k]]
            ties = cos == last
            first = np.cumsum(ties, axis=1) <= k - (cos > last).sum(1, keepdims=True)
            weight = np.where((cos > last) | (ties & first), np.maximum(cos, 0), 0).astype(float) ** 4
            total = weight.sum(1)
            voted = weight @ self.labels / np.maximum(total, 1e-12)
            out[low : low + BLOCK] = np.clip(np.where(total > 1e-9, voted, self.base), 0, 1)
        return out


def unit(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)


def fit(docs: DataFrame, labels: DataFrame, usable, most: int = SAMPLE, key: str = "doc_id") -> Model:
    """The model from labels rows that are usable; without any, every score is 0.5."""
    ship_code(docs.sparkSession)

    def features(batches):
        for batch in batches:
            for part, texts in runs(batch):
                got = [term_counts(t) for t in texts]
                yield pa.RecordBatch.from_arrays([pa.array([g[0] for g in got], pa.list_(pa.int64())), pa.array([g[1] for g in got], pa.list_(pa.float64())), part.column(1)], ["t", "v", "label"])

    chosen = sample(docs, labels, "quality", usable, most, key).orderBy(F.xxhash64(key), key).select("text", "label")
    rows = cut_lineage(chosen.mapInArrow(features, "t array<long>, v array<double>, label int")).toArrow().to_pydict()
    y = np.array(rows["label"], float)
    if not len(y):
        empty = np.zeros(0)
        return Model(empty, empty.reshape(0, 1), empty.reshape(0, 1), empty, 0.5)
    seen, df = np.unique(np.concatenate([np.asarray(t, np.int64) for t in rows["t"]] or [np.zeros(0, np.int64)]), return_counts=True)
    terms = np.sort(seen[np.argsort(-df, kind="stable")[:TERMS]])
    rarity = np.log((1 + len(y)) / (1 + df[np.searchsorted(seen, terms)])) + 1
    x = np.zeros((len(y), len(terms)), np.float32)
    for i, (t, v) in enumerate(zip(rows["t"], rows["v"])):
        at = np.minimum(np.searchsorted(terms, t), max(len(terms) - 1, 0))
        same = terms[at] == np.asarray(t, np.int64) if len(t) else np.zeros(0, bool)
        x[i, at[same]] = np.asarray(v)[same]
    x = unit(x * rarity.astype(np.float32))
    value, vector = np.linalg.eigh((x.T @ x).astype(float))
    project = (rarity[:, None] * vector[:, np.argsort(-value)[:DIMS]]).astype(np.float32)
    raw = np.zeros_like(x)
    np.divide(x, rarity.astype(np.float32), out=raw)
    return Model(terms, project, unit(raw @ project).astype(np.float32), y, float(y.mean()))


def score(docs: DataFrame, model: Model, key: str = "doc_id", held_out=None) -> DataFrame:
    """(key, held_out, score, predicted) for each row of docs, over whole texts.

    Null and empty texts have no terms and get the labelled rows' share of label 1. Very
    long texts count to their end. Equal texts get equal scores; repeated rows each get
    theirs; null keys stay null; other columns, also of the names of the result, don't
    matter; no rows give no rows.
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


def keep(docs: DataFrame, model: Model, value: int = 1) -> DataFrame:
    """The rows of docs, all columns, whose predicted label is `value`; null and empty texts
    have the labelled rows' share as score, and each of repeated rows stays or goes alike."""
    ship_code(docs.sparkSession)
    held = docs.sparkSession.sparkContext.broadcast(model)
    return filter_rows(docs, lambda texts: (held.value.score(texts) >= 0.5) == bool(value))


def classify(docs: DataFrame, labels: DataFrame, mod: int = 3, out: int = 1, source: DataFrame | None = None) -> DataFrame:
    """Fit on labels whose key's remainder isn't `out`, and score all docs.

    source, docs if not given, is where the labelled texts are.
    """
    held = remainder("doc_id", mod) == out
    model = fit(docs if source is None else source, labels, remainder("doc_id", mod) != out)
    return score(docs, model, held_out=held)
