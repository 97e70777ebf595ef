"""Licence scans: windows of whole texts compared with templates by Dice on word bigrams.

Texts are normalised to words of a-z, 0-9 and non-ASCII characters, without regard to lines.
The Dice coefficient of two multisets of bigrams is 2 * common / (a + b). Each run of as many
bigrams as a template has is compared with it; a text with fewer is compared as a whole.

Sizes prune first: common is at most min(a, b), so a text of a bigrams can only reach a
threshold t with templates of at most a * (2 - t) / t bigrams, and no window can have more
in common with a template than the whole text has. Only templates that get by slide. The
common bigrams of all windows come from one pass over the occurrences: one counts for the
windows that hold it and not already as many before it as the template has.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..cluster import ship_code
from .licence_texts import TEMPLATES
from .words import alnum_words, runs

THRESHOLD = 0.8
#: Slack for thresholds that aren't binary fractions.
SLACK = 1e-9


def bigrams(words: list[bytes]) -> Counter:
    return Counter(zip(words, words[1:]))


class Matcher:
    """Templates, their bigrams numbered."""

    def __init__(self, templates: dict[str, str], threshold: float):
        self.threshold = threshold
        found = [(name, bigrams(alnum_words(text.encode()))) for name, text in sorted(templates.items())]
        found = [(n, g) for n, g in found if g]
        self.names = [n for n, _ in found]
        self.size = np.array([g.total() for _, g in found], np.int64)
        self.least = min((threshold / (2 - threshold) * s for s in self.size.tolist()), default=float("inf"))
        self.ids: dict[tuple[bytes, bytes], int] = {}
        for _, g in found:
            for b in g:
                self.ids.setdefault(b, len(self.ids))
        self.count = np.zeros((len(found), len(self.ids)), np.int64)
        for i, (_, g) in enumerate(found):
            for b, n in g.items():
                self.count[i, self.ids[b]] = n
        self.first = frozenset(b[0] for b in self.ids)

    def spans(self, words: list[bytes]) -> list[tuple[str, float, int]]:
        """Templates that windows match: name, highest coefficient, and how many runs of
        neighbouring windows reach the threshold."""
        n = len(words) - 1
        if n < 1 or n < self.least - SLACK or self.first.isdisjoint(words):
            return []
        get = self.ids.get
        ids = np.fromiter((get(b, -1) for b in zip(words, words[1:])), np.int64, n)
        at = np.flatnonzero(ids >= 0)
        if len(at) * 2 < self.threshold * (self.least + 1) - SLACK:
            return []
        own, many = np.unique(ids[at], return_counts=True)
        common = np.minimum(self.count[:, own], many).sum(1)
        width = np.minimum(self.size, n)
        found = []
        for i in np.flatnonzero(2 * common >= self.threshold * (width + self.size) - SLACK).tolist():
            same = self.common(ids, at, self.count[i], int(width[i]), n)
            total = int(width[i]) + int(self.size[i])
            hit = 2 * same >= self.threshold * total - SLACK
            if hit.any():
                found.append((self.names[i], 2 * int(same.max()) / total, int(hit[0]) + int((hit[1:] & ~hit[:-1]).sum())))
        return found

    @staticmethod
    def common(ids: np.ndarray, at: np.ndarray, count: np.ndarray, width: int, n: int) -> np.ndarray:
        """For each window's start, how many bigrams it has in common with the template."""
        p = at[count[ids[at]] > 0]
        order = np.lexsort((p, ids[p]))
        p, own = p[order], ids[p][order]
        back = np.arange(len(p)) - count[own]  # the occurrence that must lie before the window
        same = back >= 0
        same[same] = own[back[same]] == own[same]
        before = np.where(same, p[np.maximum(back, 0)], -1)
        low = np.maximum(np.maximum(p - width, before) + 1, 0)
        high = np.minimum(p, n - width)
        live = low <= high
        delta = np.zeros(n - width + 2, np.int64)
        np.add.at(delta, low[live], 1)
        np.add.at(delta, high[live] + 1, -1)
        return np.cumsum(delta[:-1])

    def scan(self, text: bytes) -> tuple[int, str | None, float, str]:
        """Matching spans, best template, its coefficient, all templates."""
        found = self.spans(alnum_words(text))
        if not found:
            return 0, None, 0.0, ""
        best = min(found, key=lambda x: (-x[1], x[0]))
        return sum(x[2] for x in found), best[0], best[1], ",".join(sorted(x[0] for x in found))


def scan_licences(docs: DataFrame, key: str = "doc_id", templates: dict[str, str] | None = None, threshold: float = THRESHOLD) -> DataFrame:
    """One row per row of docs: key, n_matches, licence, dice, licences.

    n_matches counts the spans that match, a span being a run of neighbouring windows that
    reach the threshold with one template; licence is the template of the highest coefficient
    (of equals the first by name), licences all that match, sorted and joined by commas. Null,
    empty and wordless texts match nothing, as do texts and templates of fewer than two words.
    Very long texts are compared to their end. Repeated rows each get theirs, null keys stay
    null; other columns don't matter; no rows give no rows.
    """
    ship_code(docs.sparkSession)
    kind = dict(docs.dtypes)[key]
    matcher = Matcher(TEMPLATES if templates is None else templates, threshold)

    def run(batches):
        for batch in batches:
            for part, texts in runs(batch):
                columns = list(zip(*(matcher.scan(t) for t in texts)))
                kinds = (pa.int64(), pa.string(), pa.float64(), pa.string())
                yield pa.RecordBatch.from_arrays([part.column(0), *map(pa.array, columns, kinds)], ["k", "n_matches", "licence", "dice", "licences"])

    return docs.select(F.col(key).alias("k"), "text").mapInArrow(run, f"k {kind}, n_matches long, licence string, dice double, licences string").withColumnRenamed("k", key)
