import random
from collections import defaultdict
from zlib import crc32

import numpy as np
import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from grainstone.llm import packing, tokens

from .fixtures import DOCS, docs

PATH = public_tokenizers.path("word_bpe_49k.json")
WHOLE = Tokenizer.from_file(PATH)
OWN = tokens.WordIds(PATH)


def ids(text):
    return WHOLE.encode(text, add_special_tokens=False).ids


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.one_of(st.sampled_from("aZ éÉßñ'st.!,<|>0９１\n\t\x0b\x1c\x85\xa0́ΣςK中😀½²ªİi̇"), st.characters()), max_size=40))
def test_ids_equal_the_tokenizer(text):
    try:
        text.encode()
    except UnicodeEncodeError:
        return
    assert np.frombuffer(b"".join(OWN.words(text.encode())), "<u4").tolist() == ids(text)


def test_special_tokens_in_texts():
    for text in ("a <|endoftext|> b", "<|ENDOFTEXT|>", "x<|startoftext|>y don't WE'LL ÀÉ²"):
        assert np.frombuffer(b"".join(OWN.words(text.encode())), "<u4").tolist() == ids(text)


def test_cuts_equal_brute_force():
    rng = random.Random(2)
    for _ in range(60):
        gaps = [rng.randint(1, 8) for _ in range(12)]
        p, c = np.cumsum(gaps), np.array([rng.choice([0, 1, 3]) for _ in gaps], float)
        best = [0.0] + [1e9] * len(p)
        q = [0, *p.tolist()]
        for j in range(1, len(q)):
            best[j] = min(best[i] + 10 - (q[j] - q[i]) + c[j - 1] for i in range(j) if q[j] - q[i] <= 10)
        cuts = packing.best_cuts(p, c, 10)
        ends = [0, *(int(p[i]) for i in cuts)]
        assert all(0 < b - a <= 10 for a, b in zip(ends, ends[1:])) and ends[-1] == p[-1]
        assert abs(sum(10 - (b - a) for a, b in zip(ends, ends[1:])) + sum(c[i] for i in cuts) - best[-1]) < 1e-9
        cuts = packing.best_cuts(p, c, 10, True)
        ends = [0, *(int(p[i]) for i in cuts)]
        assert all(0 < b - a <= 10 for a, b in zip(ends, ends[1:])) and p[-1] - ends[-1] <= 10
        cost = sum(10 - (b - a) for a, b in zip(ends, ends[1:])) + sum(c[i] for i in cuts)
        assert abs(cost - min(best[j] for j in range(len(q)) if p[-1] - q[j] <= 10)) < 1e-9


def check(rows, texts, window):
    want = [ids(t or "") + [2] for t in texts]
    by_doc, by_seq = defaultdict(list), defaultdict(list)
    for r in rows:
        w = want[r.doc_id]
        assert r.doc_tokens == len(w) and r.length > 0
        assert r.ids_crc32 == crc32(np.array(w[r.start : r.start + r.length], "<u4").tobytes())
        by_doc[r.doc_id].append((r.start, r.length))
        by_seq[r.sequence_id].append((r.offset, r.length))
    for i, w in enumerate(want):
        at = 0
        for s, n in sorted(by_doc[i]):
            assert s == at
            at += n
        assert at == len(w)
    for spans in by_seq.values():
        at = 0
        for s, n in sorted(spans):
            assert s == at
            at += n
        assert at <= window
    return sum(map(len, want)) / (len(by_seq) * window)


def test_pieces_cover_everything(spark, monkeypatch):
    rng = random.Random(7)
    word = lambda: "".join(rng.choice("abcdeéß") for _ in range(rng.randint(1, 7)))
    texts = [" ".join(word() + rng.choice(["", "", "", ".", ","]) for _ in range(rng.choice([1, 5, 40, 300]))) for _ in range(150)]
    texts += [None, "", " \n\t ", "x" * 9000, " ".join(word() for _ in range(4000)), ".", texts[0], texts[0]]
    df = docs(spark, texts).selectExpr("*", "1 as k", "2 as start", "3 as length").coalesce(1)
    assert check(packing.pack(df, window=256).collect(), texts, 256) > 0.97
    assert check(packing.pack(df).collect(), texts, 4096) > 0.8
    for parts in (60, 400):  # fewer rows than partitions, too
        assert check(packing.pack(df.repartition(parts), window=256).collect(), texts, 256) > 0.97
    assert check(packing.pack(df.repartition(60), window=256, group=8).collect(), texts, 256) > 0.9
    assert packing.pack(spark.createDataFrame([], DOCS)).count() == 0


def test_runs_join(monkeypatch):
    monkeypatch.setattr(packing, "RUN_TOKENS", 100)
    packer, got = packing.Packer(64, 0), []
    rng = random.Random(1)
    sizes = [rng.randint(1, 150) for _ in range(40)]
    for i, n in enumerate(sizes):
        packer.add(i, b"\x01\0\0\0" * n, np.array(sorted(rng.sample(range(1, n + 1), n // 20)), np.int64))
        if packer.size >= 100:
            got += packer.flush(False)
    got += packer.flush(True)
    for i, n in enumerate(sizes):
        spans = sorted((p[1], p[2]) for p in got if p[0] == i)
        assert sum(x for _, x in spans) == n and [s for s, _ in spans] == [sum(x for _, x in spans[:k]) for k in range(len(spans))]
        assert all(p[4] == n for p in got if p[0] == i)


def test_cut_places():
    places, cost = packing.cut_places(np.array([5, 300, 1000]), np.array([100, 200, 600]), 4096)
    want = {5: 0, 300: 0, 1000: 0, 100: 2, 200: 2, 600: 2}
    for a, b in ((5, 100), (100, 200), (200, 300), (300, 600), (600, 1000)):
        want |= {x: 24 for x in range(a + 64, b, 64)}
    assert dict(zip(places.tolist(), cost.tolist())) == want and places.tolist() == sorted(want)
