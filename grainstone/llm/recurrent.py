"""Scores of texts by a gated recurrent language model, beside an add-one unigram base.

Counts. Tokens of all training documents are counted; the most frequent SPLIT words travel
with the model, any rarer one is joined to its count by a shuffle.

Model. The most frequent words, one token for all others and the end of text make the
vocabulary of a recurrent network in numpy. It has one gated layer (GRU); the output is
factored: first the word's class, by frequency, then the word in its class. A word that is
not in the vocabulary has, after its token, the share (c + 1) / (N' + V' + 1) among the
others, so every text has a probability.

Training. Each task trains a copy by Adagrad with backpropagation truncated to WINDOW
tokens, once over all tokens of all training documents. The state goes on from window to
window of a document; one of more than WINDOW * SEGMENT_WINDOWS tokens begins anew after as
many. Documents of like length, out of POOL, go side by side, and a window's steps only
count tokens that are there. Copies are averaged, weighted by their tokens, in two steps so
that no task gathers them all.

Scoring. Whole texts go through in windows with the state carried to the end of the text.
"""

from __future__ import annotations

import math
from collections import Counter
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..cluster import cut_lineage, ship_code
from .labelled import remainder
from .words import runs, space_words

CLASSES, IN_CLASS, HIDDEN = 32, 32, 16
VOCAB = CLASSES * IN_CLASS
SPLIT = 65536
WINDOW, SEGMENT_WINDOWS, BATCH, POOL = 32, 32, 256, 4096
RATE = 0.15
SCORE_BATCH, SCORE_WINDOW, SCORE_BYTES = 256, 64, 16 << 20
#: Words a counting task holds before it hands them on.
HELD_WORDS = 400_000
#: Stands for the end of a text in the counts; no word is empty.
END = b""
_NAMES = ("x", "u", "b", "cls", "cls_b", "out", "out_b")


class Network:
    """Weights x (VOCAB, 3H), u (H, 3H), b (3H), cls (H, CLASSES), out (VOCAB, H) and biases.

    Word i is in class i // IN_CLASS. Gates are in the order update, reset, candidate.
    """

    def __init__(self, frequencies: np.ndarray | None = None, hidden: int = HIDDEN, seed: int = 11):
        rng = np.random.default_rng(seed)
        f = np.full(VOCAB, 1.0) if frequencies is None else frequencies + 1e-3
        small = lambda *shape: (rng.standard_normal(shape) * 0.1).astype(np.float32)
        self.x, self.u, self.b = small(VOCAB, 3 * hidden), small(hidden, 3 * hidden), np.zeros(3 * hidden, np.float32)
        self.cls, self.out = small(hidden, CLASSES), small(VOCAB, hidden)
        by_class = f.reshape(CLASSES, IN_CLASS)
        self.cls_b = np.log(by_class.sum(1) / f.sum()).astype(np.float32)
        self.out_b = np.log(by_class / by_class.sum(1, keepdims=True)).astype(np.float32).ravel()

    def to_bytes(self) -> bytes:
        return np.concatenate([getattr(self, n).ravel() for n in _NAMES]).astype("<f4").tobytes()

    @classmethod
    def from_bytes(cls, data: bytes, hidden: int = HIDDEN) -> Network:
        net, flat, at = cls(hidden=hidden), np.frombuffer(data, "<f4"), 0
        for n in _NAMES:
            old = getattr(net, n)
            setattr(net, n, flat[at : at + old.size].reshape(old.shape).copy())
            at += old.size
        return net

    def steps(self, inputs: np.ndarray, h: np.ndarray, live: list[int], keep: bool = False):
        """States before each input's successor: inputs (T, B) run from state h; at step t
        only the first live[t] rows go on. Gives states (T, B, H), the last state, and what
        backpropagation needs."""
        H = self.u.shape[0]
        states = np.zeros((len(inputs), *h.shape), h.dtype)
        memory = []
        h = h.copy()
        pre = self.x[inputs] + self.b
        for t, k in enumerate(live):
            a, p = h[:k], pre[t, :k]
            hu = a @ self.u
            gates = p[:, : 2 * H] + hu[:, : 2 * H]
            np.negative(gates, out=gates)
            np.exp(gates, out=gates)
            gates += 1
            np.reciprocal(gates, out=gates)
            z, r = gates[:, :H], gates[:, H:]
            n = r * hu[:, 2 * H :]
            n += p[:, 2 * H :]
            np.tanh(n, out=n)
            new = a - n
            new *= z
            new += n
            if keep:
                memory.append((a.copy(), z, r, n, hu[:, 2 * H :]))
            h[:k] = new
            states[t, :k] = new
        return states, h, memory

    def log_probs(self, states: np.ndarray, targets: np.ndarray, grads: dict | None = None):
        """Natural log probability of each target after its state; (N, H), (N,).

        With grads, those of the mean loss on the output weights are put there, and the
        gradient on the states is given too.
        """
        n = len(targets)
        own = targets // IN_CLASS
        # States are within -1 and 1; while no exponent can overflow, none is shifted.
        top = np.abs(states).max(initial=1)
        shift = max(np.abs(self.cls).sum(0).max() * top + np.abs(self.cls_b).max(), np.abs(self.out).sum(1).max() * top + np.abs(self.out_b).max()) > 60
        logits = states @ self.cls + self.cls_b
        if shift:
            logits -= logits.max(1, keepdims=True)
        np.exp(logits, out=logits)
        total = logits.sum(1)
        rows = np.arange(n)
        result = np.log(logits[rows, own] / total)
        if grads is not None:
            d = logits / total[:, None]
            d[rows, own] -= 1
            d /= n
            grads["cls"], grads["cls_b"] = states.T @ d, d.sum(0)
            back = d @ self.cls.T
            grads["out"], grads["out_b"] = np.zeros_like(self.out), np.zeros_like(self.out_b)
        order = np.argsort(own.astype(np.uint8), kind="stable")  # small numbers are sorted by radix
        bounds = np.searchsorted(own[order], np.arange(CLASSES + 1))
        for c in range(CLASSES):
            at = order[bounds[c] : bounds[c + 1]]
            if not len(at):
                continue
            low = c * IN_CLASS
            block = self.out[low : low + IN_CLASS]
            s = states[at]
            q = s @ block.T + self.out_b[low : low + IN_CLASS]
            if shift:
                q -= q.max(1, keepdims=True)
            np.exp(q, out=q)
            sums = q.sum(1)
            word = targets[at] - low
            r = np.arange(len(at))
            result[at] += np.log(q[r, word] / sums)
            if grads is not None:
                q /= sums[:, None]
                q[r, word] -= 1
                q /= n
                grads["out"][low : low + IN_CLASS] = q.T @ s
                grads["out_b"][low : low + IN_CLASS] = q.sum(0)
                back[at] += q @ block
        return (result, back) if grads is not None else result

    def gradients(self, inputs: np.ndarray, targets: np.ndarray, h: np.ndarray, live: list[int] | None = None):
        """Mean loss, gradients and last state over one window (T, B), of which at step t the
        first live[t] rows count; all, if it isn't given."""
        T, B = inputs.shape
        H = self.u.shape[0]
        live = [B] * T if live is None else live
        mask = np.arange(B) < np.array(live)[:, None]
        states, last, memory = self.steps(inputs, h, live, keep=True)
        grads: dict[str, np.ndarray] = {}
        logs, own = self.log_probs(states[mask], targets[mask], grads)
        # Rows of all steps one after another, as in states[mask]; what a step's gradient is
        # multiplied by is known for all of them before the first.
        a, z, r, n, hn = (np.concatenate(x) for x in zip(*memory))
        rest = 1 - z
        by_n = rest * (1 - n * n)
        factors = np.stack([(a - n) * z * rest, by_n * hn * r * (1 - r), by_n * r], 1)
        ends = np.cumsum([0, *live])
        ds, dh = own, np.empty_like(factors)
        carry = np.zeros_like(h)
        for t in reversed(range(T)):
            k, at = live[t], slice(ends[t], ends[t + 1])
            d = ds[at]
            d += carry[:k]
            part = np.multiply(factors[at], d[:, None], out=dh[at])
            step = part.reshape(k, 3 * H) @ self.u.T
            step += d * z[at]
            carry[:k] = step
        dh = dh.reshape(-1, 3 * H)
        grads["u"] = a.T @ dh
        flat = np.concatenate([dh[:, : 2 * H], ds * by_n], 1)
        ids = inputs[mask]
        grads["b"] = flat.sum(0)
        order = np.argsort(ids.astype(np.int16), kind="stable")
        first = np.flatnonzero(np.diff(ids[order], prepend=-1))
        grads["x"] = np.zeros_like(self.x)
        grads["x"][ids[order][first]] = np.add.reduceat(flat[order], first, axis=0)
        return -logs.mean(), grads, last

    def train(self, texts: list[np.ndarray], start: int, memory: dict, window: int = WINDOW) -> float:
        """One pass over id sequences side by side, a step for each window; the state goes on
        from window to window. A step counts by the tokens in it. Gives the last loss."""
        texts = sorted(texts, key=len, reverse=True)
        size = np.array([len(t) for t in texts])
        h = np.zeros((len(texts), self.u.shape[0]), np.float32)
        loss = 0.0
        for s in range(0, int(size[0]), window):
            ids, live = _window(texts, size, s, window, start)
            rows = live[0]
            loss, grads, h[:rows] = self.gradients(ids[:-1], ids[1:], h[:rows], live)
            share = np.float32(sum(live) / (window * BATCH))
            for n in _NAMES:
                g = np.clip(grads[n], -1, 1) * share
                memory[n] = memory.get(n, 1e-4) + g * g
                getattr(self, n)[...] -= RATE * g / np.sqrt(memory[n])
        return loss

    def score(self, texts: list[np.ndarray], start: int, window: int = SCORE_WINDOW, batch: int = SCORE_BATCH) -> np.ndarray:
        """Log10 probability of each id sequence, read from the state after `start`."""
        out = np.zeros(len(texts))
        order = sorted(range(len(texts)), key=lambda i: -len(texts[i]))
        for low in range(0, len(order), batch):
            group = order[low : low + batch]
            size = np.array([len(texts[i]) for i in group])
            h = np.zeros((len(group), self.u.shape[0]), np.float32)
            for s in range(0, int(size[0]), window):
                ids, live = _window([texts[i] for i in group], size, s, window, start)
                rows, steps = live[0], len(live)
                states, last, _ = self.steps(ids[:-1], h[:rows], live)
                h[:rows] = last
                mask = np.arange(steps)[:, None] + s < size[None, :rows]
                logs = self.log_probs(states[mask], ids[1:][mask])
                totals = np.bincount(np.nonzero(mask)[1], logs, rows)
                for j in range(rows):
                    out[group[j]] += totals[j]
        return out / math.log(10)


def _window(texts: list[np.ndarray], size: np.ndarray, s: int, window: int, start: int) -> tuple[np.ndarray, list[int]]:
    """Ids (T + 1, B) from before place s on, of the texts that go on there, longest first,
    and how many of them each step has."""
    rows = int((size > s).sum())
    steps = int(min(window, size[0] - s))
    ids = np.full((steps + 1, rows), start, np.int64)
    skip = 1 - min(s, 1)
    for j in range(rows):
        part = texts[j][max(s - 1, 0) : s + steps]
        ids[skip : skip + len(part), j] = part
    return ids, np.searchsorted(-size[:rows], -(s + np.arange(steps)), "left").tolist()


@dataclass
class Lexicon:
    """Frequent words with their training counts, the first of which are the vocabulary."""

    counts: dict[bytes, int]
    ids: dict[bytes, int]
    other: int
    end: int
    tokens: int
    types: int
    other_tokens: int
    other_types: int

    def encode(self, words: list[bytes]) -> np.ndarray:
        ids = np.fromiter(map(self.ids.get, words, repeat(self.other)), np.int64, len(words))
        return np.append(ids, self.end)


def count_words(docs: DataFrame) -> DataFrame:
    """(w, n) over all texts: words, and END once for each text."""
    schema = pa.schema([("w", pa.binary()), ("n", pa.int64())])

    def run(batches):
        held: Counter = Counter()

        def told():
            keys = list(held)
            for low in range(0, len(keys), 50000):
                part = keys[low : low + 50000]
                yield pa.RecordBatch.from_arrays([pa.array(part, pa.binary()), pa.array([held[w] for w in part], pa.int64())], schema=schema)
            held.clear()

        for batch in batches:
            for _, texts in runs(batch):
                for t in texts:
                    held.update(space_words(t))
                held[END] += len(texts)
                if len(held) > HELD_WORDS:
                    yield from told()
        yield from told()

    return docs.select("text").mapInArrow(run, "w binary, n long").groupBy("w").agg(F.sum("n").alias("n"))


def lexicon(counts: DataFrame) -> Lexicon:
    """From the word counts. Without any, the lexicon is empty.

    The frequent words are those above a count, the least for which SPLIT hold them all."""
    total = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("w")).first()
    words = counts.where(F.col("w") != F.lit(b""))
    # How many words have each count: a table of few rows, as counts n differ at most
    # sqrt(2 * tokens) times.
    room, least = SPLIT, 0
    for r in words.groupBy("n").agg(F.count(F.lit(1)).alias("many")).orderBy(F.desc("n")).toLocalIterator():
        if r.many > room:
            least = r.n
            break
        room -= r.many
    top = [(bytes(r.w), r.n) for r in words.where(F.col("n") > least).collect()]
    top.sort(key=lambda x: (-x[1], x[0]))
    ends = next((r.n for r in counts.where(F.col("w") == F.lit(b"")).collect()), 0)
    kept = top[: VOCAB - 2]
    other_n = total[0] - ends - sum(n for _, n in kept)
    ranked = sorted([(n, w) for w, n in kept] + [(other_n, None), (ends, END)], key=lambda x: -x[0])
    ids = {w: i for i, (_, w) in enumerate(ranked)}
    other, end = ids.pop(None), ids.pop(END)
    return Lexicon(dict(top), ids, other, end, total[0], total[1], other_n, total[1] - bool(ends) - len(kept))


def frequencies(lex: Lexicon) -> np.ndarray:
    f = np.zeros(VOCAB)
    for w, i in lex.ids.items():
        f[i] = lex.counts[w]
    f[lex.other] = lex.other_tokens
    f[lex.end] = max(lex.tokens - lex.other_tokens - f.sum() + f[lex.other], 0)
    return f


def segments_of(ids: np.ndarray) -> list[np.ndarray]:
    """A document's segments of WINDOW * SEGMENT_WINDOWS tokens; the last may be shorter."""
    size = WINDOW * SEGMENT_WINDOWS
    return [ids[low : low + size] for low in range(0, len(ids), size)]


def train(docs: DataFrame, lex: Lexicon) -> Network:
    """The averaged network after one pass over the training documents."""
    sc = docs.sparkSession.sparkContext
    held = sc.broadcast(lex)
    first = Network(frequencies(lex))
    begin = sc.broadcast(first.to_bytes())
    schema = pa.schema([("part", pa.int64()), ("weight", pa.float64()), ("net", pa.binary())])

    def step(net: Network, memory: dict, waiting: list[np.ndarray]) -> int:
        """Train on segments, those of like length together, and count their tokens."""
        waiting = sorted(waiting, key=len, reverse=True)
        groups = range(0, len(waiting), BATCH)
        for low in np.random.default_rng(len(waiting)).permutation(groups).tolist():
            net.train(waiting[low : low + BATCH], held.value.end, memory)
        return sum(map(len, waiting))

    def fit(batches):
        lexi, net, memory = held.value, Network.from_bytes(begin.value), {}
        waiting, seen = [], 0
        for batch in batches:
            for _, texts in runs(batch):
                for t in texts:
                    waiting += segments_of(lexi.encode(space_words(t)))
                if len(waiting) >= POOL:
                    seen += step(net, memory, waiting)
                    waiting = []
        if waiting:
            seen += step(net, memory, waiting)
        if seen:
            yield pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId()]), pa.array([float(seen)]), pa.array([net.to_bytes()], pa.binary())], schema=schema)

    def mean(batches):
        total, weight = None, 0.0
        for batch in batches:
            for w, data in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                part = np.frombuffer(data, "<f4").astype(float) * w
                total = part if total is None else total + part
                weight += w
        if weight:
            yield pa.RecordBatch.from_arrays([pa.array([0]), pa.array([weight]), pa.array([(total / weight).astype("<f4").tobytes()], pa.binary())], schema=schema)

    kind = "part long, weight double, net binary"
    copies = docs.select("text").mapInArrow(fit, kind)
    groups = max(1, math.isqrt(copies.rdd.getNumPartitions()))
    parts = copies.repartition(groups, F.col("part") % groups).mapInArrow(mean, kind).collect()
    if not parts:
        return first
    weight = sum(r.weight for r in parts)
    flat = sum(np.frombuffer(r.net, "<f4").astype(float) * (r.weight / weight) for r in parts)
    return Network.from_bytes(flat.astype("<f4").tobytes())


def score(docs: DataFrame, key: str = "doc_id", mod: int = 7, out: int = 2) -> DataFrame:
    """key, held_out, n_tokens, n_known, train_tokens, base_score, score for each row of docs.

    Learns from the rows whose key's remainder isn't `out`. Null and empty texts are only an
    end. Very long texts are scored in windows to their end. Repeated rows each get their scores; other columns don't matter; without training
    rows the counts are 0 and the network is the one it starts with; no rows give no rows.
    """
    ship_code(docs.sparkSession)
    kind = dict(docs.dtypes)[key]
    rows = docs.select(F.col(key).alias("k"), "text", (remainder(key, mod) == out).alias("held_out"))
    learn = rows.where(~F.col("held_out"))
    counts = cut_lineage(count_words(learn))
    lex = lexicon(counts)
    net = train(learn, lex)
    sc = docs.sparkSession.sparkContext
    held, data = sc.broadcast(lex), sc.broadcast(net.to_bytes())

    def run(batches):
        lexi, model = held.value, Network.from_bytes(data.value)
        part, n = TaskContext.get().partitionId() << 33, 0
        # By place among the frequent words, of which the last stands for all rare ones:
        # log10(c + 1), the vocabulary id, and the log again where that is the one of others.
        place = {w: i for i, w in enumerate(lexi.counts)}
        rare_at = len(place)
        logs = np.array([*(math.log10(c + 1) for c in lexi.counts.values()), 0.0])
        ids = np.array([*(lexi.ids.get(w, lexi.other) for w in lexi.counts), lexi.other])
        outer = np.where(ids == lexi.other, logs, 0.0)
        end_log = math.log10(frequencies(lexi)[lexi.end] + 1)
        for batch in batches:
            for own, texts in runs(batch, most=SCORE_BYTES):
                encoded, sizes, frequent, others, known, rare = [], [], [], [], [], []
                for t in texts:
                    words = space_words(t)
                    at = np.fromiter(map(place.get, words, repeat(rare_at)), np.int64, len(words))
                    own_ids = ids[at]
                    encoded.append(np.append(own_ids, lexi.end))
                    sizes.append(len(words) + 1)
                    missed = [words[i] for i in np.flatnonzero(at == rare_at).tolist()]
                    frequent.append(float(logs[at].sum()) + end_log)
                    others.append((float(outer[at].sum()), int((own_ids == lexi.other).sum())))
                    known.append(len(words) - len(missed))
                    rare.append(missed)
                s = model.score(encoded, lexi.end)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(range(part + n, part + n + len(texts)), pa.int64()),
                        own.column(0),
                        own.column(2),
                        pa.array(sizes, pa.int64()),
                        pa.array(known, pa.int64()),
                        pa.array(frequent, pa.float64()),
                        pa.array([o for o, _ in others], pa.float64()),
                        pa.array([m for _, m in others], pa.int64()),
                        pa.array(s, pa.float64()),
                        pa.array(rare, pa.list_(pa.binary())),
                    ],
                    ["rid", "k", "held_out", "n_tokens", "known", "frequent", "outside", "n_outside", "net", "rare"],
                )
                n += len(texts)

    told = cut_lineage(rows.mapInArrow(run, f"rid long, k {kind}, held_out boolean, n_tokens long, known long, frequent double, outside double, n_outside long, net double, rare array<binary>"))
    words = told.select("rid", F.explode("rare").alias("w"))
    seen = words.join(counts, "w").groupBy("rid").agg(F.sum(F.log10(F.col("n") + F.lit(1.0))).alias("rare_log"), F.count(F.lit(1)).alias("rare_known"))
    scale = math.log10(lex.tokens + lex.types + 1)
    other_scale = math.log10(lex.other_tokens + lex.other_types + 1)
    rare_log = F.coalesce("rare_log", F.lit(0.0))
    ends = int(lex.tokens > 0)
    return told.drop("rare").join(seen, "rid", "left").select(
        F.col("k").alias(key),
        "held_out",
        "n_tokens",
        (F.col("known") + F.coalesce("rare_known", F.lit(0)) + F.lit(ends)).cast("long").alias("n_known"),
        F.lit(lex.tokens).cast("long").alias("train_tokens"),
        (F.col("frequent") + rare_log - F.col("n_tokens") * F.lit(scale)).alias("base_score"),
        (F.col("net") + F.col("outside") + rare_log - F.col("n_outside") * F.lit(other_scale)).alias("score"),
    )
