import math
import random
from collections import Counter
from zlib import crc32

import numpy as np

from grainstone.llm import recurrent as R

from .fixtures import DOCS, docs


def tiny():
    net = R.Network(np.random.default_rng(0).random(R.VOCAB), hidden=5)
    for n in R._NAMES:
        setattr(net, n, getattr(net, n).astype(float))
    return net


def test_gradients_equal_differences():
    net, rng = tiny(), np.random.default_rng(3)
    ids = rng.integers(0, R.VOCAB, (4, 3))
    h = rng.standard_normal((3, 5))
    loss, grads, _ = net.gradients(ids[:-1], ids[1:], h)
    for name in R._NAMES:
        w, g = getattr(net, name), grads[name]
        for at in np.argsort(-np.abs(g), axis=None)[[0, 1, 2, 7]]:
            at = np.unravel_index(at, w.shape)
            old = w[at]
            w[at] = old + 1e-5
            up = net.gradients(ids[:-1], ids[1:], h)[0]
            w[at] = old - 1e-5
            down = net.gradients(ids[:-1], ids[1:], h)[0]
            w[at] = old
            assert abs((up - down) / 2e-5 - g[at]) < 1e-6, name


def test_gradients_of_windows_that_texts_end_in():
    net, rng = tiny(), np.random.default_rng(5)
    ids, live = rng.integers(0, R.VOCAB, (5, 4)), [4, 3, 3, 1]
    h = rng.standard_normal((4, 5))
    loss, grads, last = net.gradients(ids[:-1], ids[1:], h, live)
    each = []
    for j in range(4):
        n = sum(k > j for k in live)
        each.append((n, *net.gradients(ids[:n, j : j + 1], ids[1 : n + 1, j : j + 1], h[j : j + 1])))
    assert np.isclose(loss, sum(n * x for n, x, _, _ in each) / sum(live))
    for name in R._NAMES:
        assert np.allclose(grads[name], sum(n * g[name] for n, _, g, _ in each) / sum(live))
    assert np.allclose(last, np.concatenate([x[3] for x in each]))


def brute_log10(net, ids, start):
    """A text's log10 probability, a number at a time."""
    H, total, before = net.u.shape[0], 0.0, start
    h = [0.0] * H
    sigmoid = lambda v: 1 / (1 + math.exp(-v))
    for w in [int(i) for i in ids]:
        p = [float(net.x[before, j] + net.b[j]) for j in range(3 * H)]
        hu = [sum(h[i] * float(net.u[i, j]) for i in range(H)) for j in range(3 * H)]
        z = [sigmoid(p[j] + hu[j]) for j in range(H)]
        r = [sigmoid(p[H + j] + hu[H + j]) for j in range(H)]
        n = [math.tanh(p[2 * H + j] + r[j] * hu[2 * H + j]) for j in range(H)]
        h = [n[j] + z[j] * (h[j] - n[j]) for j in range(H)]
        classes = [math.exp(sum(h[i] * float(net.cls[i, c]) for i in range(H)) + float(net.cls_b[c])) for c in range(R.CLASSES)]
        c = w // R.IN_CLASS
        words = [math.exp(sum(h[i] * float(net.out[k, i]) for i in range(H)) + float(net.out_b[k])) for k in range(c * R.IN_CLASS, (c + 1) * R.IN_CLASS)]
        total += math.log10(classes[c] / sum(classes)) + math.log10(words[w % R.IN_CLASS] / sum(words))
        before = w
    return total


def test_scores_equal_brute_force():
    net, rng = tiny(), np.random.default_rng(6)
    texts = [rng.integers(0, R.VOCAB, n) for n in (1, 3, 70, 200)]
    for got, ids in zip(net.score(texts, 9, window=64), texts):
        assert math.isclose(got, brute_log10(net, ids, 9), rel_tol=1e-5)


def test_probabilities_sum_to_one_and_windows_do_not_matter():
    net = tiny()
    s = np.random.default_rng(1).standard_normal((1, 5))
    assert abs(np.exp(net.log_probs(np.repeat(s, R.VOCAB, 0), np.arange(R.VOCAB))).sum() - 1) < 1e-9
    rng = np.random.default_rng(2)
    texts = [rng.integers(0, R.VOCAB, n) for n in (1, 70, 3, 200, 1, 64, 65, 128)]
    whole = net.score(texts, 0, window=1000, batch=50)
    for window, batch in ((1, 3), (7, 2), (64, 8)):
        assert np.allclose(net.score(texts, 0, window, batch), whole, rtol=1e-4, atol=1e-4)


def test_large_weights_are_shifted():
    net = tiny()
    net.out *= 2000
    net.cls *= 2000
    s = np.random.default_rng(1).standard_normal((1, 5))
    logs = net.log_probs(np.repeat(s, R.VOCAB, 0), np.arange(R.VOCAB))
    assert not np.isnan(logs).any() and abs(np.exp(logs).sum() - 1) < 1e-9


def test_training_lowers_the_loss():
    rng = np.random.default_rng(4)
    chain = rng.integers(0, 40, 40)
    net, memory = R.Network(), {}
    seqs = []
    for _ in range(256):
        x = [int(rng.integers(0, 40))]
        for _ in range(R.WINDOW * 2):
            x.append(int(chain[x[-1]]) if rng.random() < 0.9 else int(rng.integers(0, 40)))
        seqs.append(x)
    losses = [net.train([np.array(x[1:]) for x in seqs], 0, memory) for _ in range(25)]
    assert losses[-1] < losses[0] - 1.5


def test_base_equals_brute_force(spark, monkeypatch):
    rng = random.Random(9)
    vocab = [f"w{i}" for i in range(1500)]
    texts = [" ".join(rng.choice(vocab[: rng.choice([20, 1500])]) for _ in range(rng.randint(0, 80))) for _ in range(120)]
    texts += [None, "", " \t", "UNSEEN Wörter w1 W1\vx", texts[0], texts[0]]
    monkeypatch.setattr(R, "SPLIT", 1100)
    df = docs(spark, texts).selectExpr("*", "1 as k", "2 as n", "3 as w")
    got = sorted(R.score(df).collect(), key=lambda r: r.doc_id)
    words = [[w for w in "".join(c.lower() if "A" <= c <= "Z" else " " if c in "\t\n\v\f\r" else c for c in t or "").split(" ") if w] + [""] for t in texts]
    held = [crc32(str(i).encode()) % 7 == 2 for i in range(len(texts))]
    c = Counter(w for ws, h in zip(words, held) if not h for w in ws)
    n, v = sum(c.values()), len(c)
    for r, ws, h in zip(got, words, held):
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (h, len(ws), sum(c[w] > 0 for w in ws), n)
        assert abs(r.base_score - sum(math.log10((c[w] + 1) / (n + v + 1)) for w in ws)) < 1e-6
        assert r.score < 0
    assert math.isclose(got[-1].score, got[-2].score, rel_tol=1e-6)


def test_scores_beat_the_base_on_held_out_texts(spark):
    """Words that mostly follow one another, which counts don't show."""
    rng = random.Random(3)
    after = {i: [rng.randrange(60) for _ in range(3)] for i in range(60)}

    def text():
        w = [rng.randrange(60)]
        for _ in range(rng.randint(30, 250)):
            w.append(rng.choice(after[w[-1]]) if rng.random() < 0.95 else rng.randrange(60))
        return " ".join(f"w{i}" for i in w)

    found = [r for r in R.score(docs(spark, [text() for _ in range(3000)]).repartition(2)).collect() if r.held_out]
    assert len(found) > 300
    assert sum(r.score for r in found) > 0.97 * sum(r.base_score for r in found)
    assert sum(r.score > r.base_score for r in found) > 0.95 * len(found)


def test_a_very_long_text(spark):
    rng = random.Random(4)
    long = " ".join(rng.choice(["ein", "zwei", "drei", "vier"]) for _ in range(60000))
    got = sorted(R.score(docs(spark, [long, "ein zwei", long])).collect(), key=lambda r: r.doc_id)
    assert got[0].n_tokens == 60001 and math.isclose(got[0].score, got[2].score, rel_tol=1e-6) and got[0].score < got[1].score


def test_no_rows(spark):
    assert R.score(spark.createDataFrame([], DOCS)).count() == 0
