import math
import random
import re
from zlib import crc32

import numpy as np
import pytest
import zstandard

from grainstone.llm import quality, toxicity
from grainstone.llm.labelled import remainder

from .fixtures import DOCS


def text(rng, n):
    syllables = ["ka", "lo", "mi", "te", "ru", "san", "vel", "dor", "in", "ash"]
    return " ".join("".join(rng.choice(syllables) for _ in range(rng.randint(1, 4))) for _ in range(n))


@pytest.fixture(scope="module")
def corpus(spark):
    rng = random.Random(4)
    rows, labels = [], []
    for i in range(700):
        t, good, toxic = text(rng, rng.randint(20, 90)), int(rng.random() < 0.75), int(rng.random() < 0.3)
        if toxic:
            w = t.split()
            for _ in range(3):
                w.insert(rng.randrange(len(w)), rng.choice(["grobnik", "blathergit", "zwurm"]))
            t = " ".join(w)
        if not good:
            t = " ".join(w.upper() + "!!" for w in t.split())
        rows.append((i, t))
        labels.append((i, good, toxic))
    rows += [(5000, None), (5001, ""), (5002, " \n "), (5003, text(rng, 60000)), (None, "kalo mite"), (5004, "kalo"), (5004, "kalo")]
    labels += [(None, 1, 0), (5000, None, None), (5005, 0, 1), (3, 1, 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as label", "'x' as k", "0.5d as score", "2 as held_out").cache()
    return docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int").selectExpr("*", "'x' as text").cache(), {r[0]: r for r in labels[:700]}


@pytest.mark.parametrize("module, column, mod, out", [(quality, 1, 3, 1), (toxicity, 2, 5, 0)])
def test_held_out_accuracy_and_odd_rows(corpus, module, column, mod, out):
    docs, labels, truth = corpus
    rows = module.classify(docs, labels).collect()
    assert len(rows) == docs.count()
    for r in rows:
        assert r.held_out == (crc32(("" if r.doc_id is None else str(r.doc_id)).encode()) % mod == out)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5)
    held = [r for r in rows if r.held_out and r.doc_id is not None and r.doc_id < 700]
    assert len(held) > 80
    assert sum(r.predicted == truth[r.doc_id][column] for r in held) / len(held) > 0.95
    assert len({r.score for r in rows if r.doc_id in (5000, 5001)}) == 1


@pytest.mark.parametrize("module", [quality, toxicity])
def test_without_labels_or_documents(spark, corpus, module):
    docs, labels, _ = corpus
    none = labels.where("false")
    assert {r.score for r in module.classify(docs.limit(5), none).collect()} == {0.5 if module is quality else 0.0}
    assert module.classify(spark.createDataFrame([], DOCS), labels, source=docs).count() == 0
    one = labels.where("toxic = 0 and quality = 1")
    assert module.classify(docs.limit(3), one, source=docs).count() == 3


def brute_toxicity(model, text):
    """The score of a text, by the compressors themselves, one window at a time."""
    how = zstandard.ZstdCompressionParameters(
        window_log=18, chain_log=17, hash_log=17, search_log=9, min_match=6, target_length=64, strategy=zstandard.STRATEGY_GREEDY, write_checksum=False, write_content_size=False, write_dict_id=False
    )
    frame, end = b"#@%!~^|{}<>=+_&$", bytes(range(1, 10))
    repeat = model.ordinary
    while len(repeat) < len(model.toxic):
        repeat += model.ordinary

    def length(data, last):
        held = zstandard.ZstdCompressionDict(frame + model.ordinary + last + end, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        return len(zstandard.ZstdCompressor(dict_data=held, compression_params=how).compress(data))

    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text))
    count = max(len(words) - 2, 1) if words else 0
    gains = []
    for i in range(count):
        window = frame + b"  " + "  ".join(words[i : i + 3]).encode() + b"  " + bytes(range(10, 26))
        gains.append(length(window, repeat[len(repeat) - len(model.toxic) :]) - length(window, model.toxic))
    even = [g if i % 2 == 0 else 0 for i, g in enumerate(gains)]
    gains = [g if i % 2 == 0 or max(even[i - 1 : i + 2]) >= 2 else 0 for i, g in enumerate(gains)]
    high = sorted(gains, reverse=True)
    x = [sum(gains) / count if count else 0.0]
    x += [(sum(g >= k for g in gains) / count) ** 0.5 if count else 0.0 for k in (3, 5)]
    x += [float(high[k]) if k < count else 0.0 for k in (0, 3, 6)]
    x += [float(count <= 64), float(64 < count <= 256), float(256 < count <= 1024), float(count > 1024)]
    z = model.curve[0] + sum(c * (v - m) / s for c, v, m, s in zip(model.curve[1:], x, model.centre, model.scale))
    return 1 / (1 + math.exp(-z))


def test_toxicity_against_brute_force(corpus):
    docs, labels, _ = corpus
    model = toxicity.fit(docs, labels, remainder("doc_id", 5) != 0)
    assert b"grobnik" in model.toxic and b"grobnik" not in model.ordinary
    got = {(r.doc_id, r.text): r.score for r in toxicity.score(docs, model).join(docs.select("doc_id", "text"), "doc_id").where("doc_id < 40 or doc_id in (5000, 5001, 5002, 5004)").collect()}
    assert len(got) == 44
    for (_, text), score in got.items():
        assert score == pytest.approx(brute_toxicity(model, text or ""), abs=1e-9)


def test_telling_words():
    rng = random.Random(2)
    for _ in range(200):
        words = ["".join(rng.choice("abcé") for _ in range(rng.randint(1, 6))) for _ in range(rng.randint(0, 20))]
        known = rng.sample(words, min(len(words), 2))
        telling = np.unique(np.concatenate([np.zeros(0, np.int64), *(toxicity.strings(toxicity.framed([w.encode()]))[-1:] for w in known)]))
        own = [toxicity.framed([w.encode()]) for w in words]
        want = [w for w in own if not len(telling) or set(toxicity.strings(w).tolist()) & set(telling.tolist())]
        assert toxicity.telling_words(" ".join(words).encode(), telling) == want


def test_toxicity_in_a_small_language(spark):
    """Words with accents, that few rows have, are learnt beside those that many have."""
    rng = random.Random(8)
    rows, labels = [], []
    for i in range(900):
        toxic, other = i % 3 == 0, i % 15 < 3
        t = text(rng, 60)
        if other:
            t = t.replace("a", "é").replace("o", "ü")
        w = t.split()
        for _ in range(4 * toxic):
            w.insert(rng.randrange(len(w)), rng.choice(["réeuxlo", "ßtérkä"] if other else ["blathergit", "zwurmen"]))
        rows.append((i, " ".join(w)))
        labels.append((i, 1, int(toxic)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = toxicity.classify(docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).where("held_out").collect()
    for other in (False, True):
        own = [r for r in found if (r.doc_id % 15 < 3) == other]
        assert sum(r.predicted == (r.doc_id % 3 == 0) for r in own) >= 0.95 * len(own) > 20


def brute_quality(model, text):
    """The vote of all labelled vectors, sorted by cosine, then place."""
    terms, value = quality.term_counts(text.encode())
    x = np.zeros(len(model.terms))
    for t, v in zip(terms, value):
        x[model.terms == t] = v
    y = x @ model.project.astype(float)
    y = y / max(np.linalg.norm(y), 1e-12)
    cos = [float(sum(a * b for a, b in zip(y, v.astype(float)))) for v in model.vectors]
    near = sorted(range(len(cos)), key=lambda i: (-cos[i], i))[: quality.NEAREST]
    weight = [max(cos[i], 0.0) ** 4 for i in near]
    return sum(w * model.labels[i] for w, i in zip(weight, near)) / sum(weight) if sum(weight) > 1e-9 else model.base


def test_quality_against_brute_force(corpus):
    docs, labels, _ = corpus
    model = quality.fit(docs, labels, remainder("doc_id", 3) != 1)
    got = quality.score(docs, model).join(docs.select("doc_id", "text"), "doc_id").where("doc_id < 30 or doc_id in (5000, 5001)").collect()
    assert len(got) == 32
    for r in got:
        assert r.score == pytest.approx(brute_quality(model, r.text or ""), abs=2e-3)
