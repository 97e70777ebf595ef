import random

import numpy as np
import xxhash

from grainstone.llm import simhash
from grainstone.llm.components import components

from .fixtures import DOCS, docs


def fingerprint(text):
    w = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\v\f\r":
        w = w.replace(c, " ")
    w = [x for x in w.split(" ") if x]
    s = [" ".join(w[i : i + 4]) for i in range(len(w) - 3)] if len(w) >= 4 else [" ".join(w)] * bool(w)
    h = [xxhash.xxh64_intdigest(x.encode(), 42) for x in s]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h)) if h else 0


def closure(points, radius):
    label = list(range(len(points)))
    for i, a in enumerate(points):
        for j in range(i):
            if (a ^ points[j]).bit_count() <= radius:
                old, new = max(label[i], label[j]), min(label[i], label[j])
                label = [new if x == old else x for x in label]
    return label


def test_forest_equals_brute_force():
    rng = random.Random(1)
    base = [rng.getrandbits(64) for _ in range(30)]
    points = sorted({b ^ sum(1 << rng.randrange(64) for _ in range(rng.randrange(5))) for b in base for _ in range(40)})
    x = np.array(points, np.uint64)
    label = list(range(len(x)))
    for a, b in simhash.forest(x, 4):
        assert label[b] == b
        label[a] = b
    assert label == closure(points, 4)


def test_forest_of_equally_distant_points():
    x = np.unique(np.array([3 << (2 * i) for i in range(32)] + [(1 << a) | (1 << b) for a in range(64) for b in range(a)], np.uint64))
    assert len(x) > simhash._LEAF
    assert len({*range(len(x))} - {a for a, _ in simhash.forest(x, 4)}) == 1


def test_edges_with_rings_and_more_blocks(spark):
    rng = random.Random(2)
    base = [rng.getrandbits(64) for _ in range(20)]
    points = sorted({b ^ sum(1 << rng.randrange(64) for _ in range(rng.randrange(6))) for b in base for _ in range(15)})
    df = spark.createDataFrame([(simhash._signed(p),) for p in points], "fp long")
    want = {simhash._signed(p): simhash._signed(points[q]) for p, q in zip(points, closure(points, 4))}
    for most, aim in ((1 << 20, 1 << 20), (4, 1 << 20), (3, 0.0)):
        got = {r.node: r.component for r in components(simhash.edges_within(df, most=most, aim=aim)).collect()}
        groups = {}
        for p, c in want.items():
            groups.setdefault(c, set()).add(p)
        for g in groups.values():
            assert {got.get(p, p) for p in g} == {min(g)}


def test_query_equals_brute_force(spark):
    rng = random.Random(5)
    words = [f"w{i}" for i in range(200)]
    long = [rng.choice(words) for _ in range(400)]
    texts = [None, "", " \n", "one two", "ONE  two", " ".join(long), " ".join(long[:-1]), " ".join([*long[:200], "zz", *long[201:]]), " ".join(rng.choice(words) for _ in range(50)), " ".join(long).upper(), "É a b c d", "é a b c d"]
    df = docs(spark, texts, 100).selectExpr("*", "1 as fp", "2 as component_id", "3 as least")
    fps = [fingerprint(t) for t in texts]
    label = closure(fps, 4)
    want = [(100 + i, simhash._signed(f), 100 + label[i]) for i, f in enumerate(fps)]
    assert sorted(map(tuple, simhash.near_duplicates(df).collect())) == want
    assert simhash.near_duplicates(spark.createDataFrame([], DOCS)).count() == 0


def test_chain_and_hub_components(spark):
    edges = [(i, i + 1) for i in range(60)] + [(1000, 1000 + i) for i in range(1, 300)] + [(5, 5), (None, 3), (2001, 2000), (2001, 2000)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert all(got[i] == 0 for i in range(61)) and all(got[1000 + i] == 1000 for i in range(300)) and got[2001] == 2000


def test_dense_balls_are_linked_without_all_their_pairs():
    rng = np.random.default_rng(5)
    centres = rng.integers(0, 1 << 63, 6, dtype=np.uint64)
    x = []
    for c in centres:
        for _ in range(700):
            v = c
            for b in rng.choice(64, rng.integers(0, 6), replace=False):
                v = v ^ (np.uint64(1) << np.uint64(b))
            x.append(v)
    x = np.unique(np.array(x, np.uint64))
    compared = sum(len(i) for i, _ in simhash._links(x, 4))
    want = list(range(len(x)))

    def root(i):
        while want[i] != i:
            i = want[i]
        return i

    for i in range(len(x)):
        for j in np.flatnonzero(np.bitwise_count(x ^ x[i]) <= 4).tolist():
            a, b = root(i), root(j)
            want[max(a, b)] = min(a, b)
    got = dict(simhash.forest(x, 4))
    assert [got.get(i, i) for i in range(len(x))] == [root(i) for i in range(len(x))]
    assert compared < len(x) ** 2 / 12
