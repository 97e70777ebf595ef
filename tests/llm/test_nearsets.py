import random

import corpus_pipeline
import numpy as np
from grainstone.llm import components, nearsets, simhash

from .fixtures import DOCS, docs


def shingles(text):
    w = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").split()
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} - {()}


def closure(texts):
    sets = [shingles(t) for t in texts]
    label = list(range(len(sets)))
    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if 10 * len(a & b) >= 8 * len(a | b):
                old, new = max(label[i], label[j]), min(label[i], label[j])
                label = [new if x == old else x for x in label]
    return label


def near_copies(rng, n):
    """Texts in groups of copies with some words changed, and all with a common line."""
    words = [f"w{i}" for i in range(3000)]
    texts = [None, "", " \n", "one two", "ONE  two", "a b c d", "a b c d e", "a b c d e f g h", "a b c d e f g h i"]
    for _ in range(n):
        base = [rng.choice(words) for _ in range(rng.randint(60, 300))]
        texts.append(" ".join(base))
        for _ in range(rng.randint(0, 4)):
            own = list(base)
            for _ in range(rng.randint(1, max(1, len(own) // 40))):
                own[rng.randrange(len(own))] = rng.choice(words)
            texts.append(" ".join(own))
    texts += [t + " the same line stands in every text of this kind" for t in texts[9:30]]
    return texts


def test_stage_leaves_no_pair_of_near_copies(spark, tmp_path):
    texts = near_copies(random.Random(3), 60)
    docs(spark, texts, 100).repartition(5).write.parquet(f"{tmp_path}/d")
    table = spark.read.parquet(f"{tmp_path}/d")
    want = {100 + i for i, x in enumerate(closure(texts)) if i == x}
    assert {r.doc_id for r in corpus_pipeline.drop_near_duplicates(spark, table, "").collect()} == want
    assert len(want) < simhash.near_duplicates(table).select("component_id").distinct().count()


def test_stars_then_pairs_equal_brute_force(spark, monkeypatch, tmp_path):
    rng = random.Random(4)
    words = [f"w{i}" for i in range(3000)]
    base = [rng.choice(words) for _ in range(150)]
    texts = [" ".join(base[:k] + ["x", str(i)] + base[k + 2 :]) for i in range(40) for k in [rng.randrange(148)]]
    texts += [" ".join([*base[: 75 + i], *(rng.choice(words) for _ in range(75 - i))]) for i in range(0, 75, 5)]
    docs(spark, texts).write.parquet(f"{tmp_path}/d")
    table = spark.read.parquet(f"{tmp_path}/d")
    want = {i for i, x in enumerate(closure(texts)) if i == x}
    for pairs, rounds in ((4, 12), (0, 1)):
        monkeypatch.setattr(nearsets, "_PAIRS_A_ROW", pairs)
        monkeypatch.setattr(nearsets, "_ROUNDS", rounds)
        assert {r.doc_id for r in nearsets.representatives(table).collect()} == want
    assert nearsets.representatives(spark.createDataFrame([], DOCS)).count() == 0


def test_portions_equal_the_whole(spark, monkeypatch, tmp_path):
    """Sets are compared in portions once the pairs send more than the sets hold."""
    texts = near_copies(random.Random(5), 30)
    docs(spark, texts).write.parquet(f"{tmp_path}/d")
    table = spark.read.parquet(f"{tmp_path}/d")
    want = {i for i, x in enumerate(closure(texts)) if i == x}
    asked = []
    real = nearsets._portions
    monkeypatch.setattr(nearsets, "_portions", lambda *a: asked.append(real(*a)) or max(3, asked[-1]))
    for rows in (nearsets._BROADCAST_ROWS, 0):
        monkeypatch.setattr(nearsets, "_BROADCAST_ROWS", rows)
        assert {r.doc_id for r in nearsets.representatives(table).collect()} == want
    assert set(asked) == {1}
    assert real(100, 10, 1 << 23) == 10 and real(0, 0, 0) == 1 and real(40, 10, 1 << 20) == 1


def test_a_pair_counts_only_by_the_smaller_sets_first_shingles(spark):
    """Of ten shingles two can be the first shared one with a larger set, three with a smaller."""
    text = " ".join(f"w{i}" for i in range(14))
    rows = nearsets._prefixes(spark.createDataFrame([(text,)], "text string"), 5, 0.8, spark.sparkContext.broadcast(np.zeros(1 << nearsets._CELL_BITS)))
    assert [r.n for r in rows.collect()] == [10, 10, -10]
    pairs = spark.createDataFrame([(10, 10), (10, -10), (-10, 10), (10, -11), (-10, 11), (11, -10), (-11, 10), (-10, -11), (10, 13)], "n long, m long")
    got = [tuple(r) for r in pairs.where(nearsets._near(0.8)).collect()]
    assert got == [(10, 10), (10, -11), (-11, 10)]


def test_few_edges_are_solved_without_rounds(spark, monkeypatch):
    """The same components as by stars, of chains, loops, repeated edges and nulls."""
    rng = random.Random(6)
    edges = [(i, i + 1) for i in range(40)] + [(100, 100), (7, 3), (3, 7), (None, 5), (5, None)]
    edges += [(rng.randrange(1000, 1400), rng.randrange(1000, 1400)) for _ in range(250)]
    table = spark.createDataFrame(edges, "a long, b long")
    asked = []
    star = components._large_star
    monkeypatch.setattr(components, "_large_star", lambda e: asked.append(1) or star(e))
    few = {tuple(r) for r in components.components(table).collect()}
    assert not asked and len({n for n, _ in few}) == len(few)
    assert components.components(table.limit(0)).count() == 0
    monkeypatch.setattr(components, "FEW", 0)
    assert {tuple(r) for r in components.components(table).collect()} == few and asked


def test_stars_end_when_they_link_nothing(spark, monkeypatch, tmp_path):
    """Texts that share a bucket, but too few shingles, aren't taken through all turns."""
    shared = " ".join(f"s{i}" for i in range(40))
    texts = [f"{shared} " + " ".join(f"u{i}x{j}" for j in range(4 + 4 * (i % 2))) for i in range(20)]
    docs(spark, texts).write.parquet(f"{tmp_path}/d")
    monkeypatch.setattr(nearsets, "_PAIRS_A_ROW", 0)
    turns = []
    real = nearsets._possible
    monkeypatch.setattr(nearsets, "_possible", lambda *a: turns.append(1) or real(*a))
    want = {i for i, x in enumerate(closure(texts)) if i == x}
    assert {r.doc_id for r in nearsets.representatives(spark.read.parquet(f"{tmp_path}/d")).collect()} == want
    assert len(want) == 11 and 0 < len(turns) <= 3


def test_similar_sets_share_a_key_by_parts():
    """The furthest that sets of the similarity lie apart; unrelated ones with a passage in
    common share few keys, where prefixes would share the passage."""
    rng = np.random.default_rng(7)
    parts = nearsets.Parts(0.8)
    fresh = lambda n: np.unique(rng.integers(0, 1 << 64, n, np.uint64))
    for n in [*range(17, 60), *(int(rng.integers(60, 2000)) for _ in range(300))]:
        for gone in (0, n // 10, n // 5):
            own = fresh(n)
            more = 0
            while 10 * (len(own) - gone) >= 8 * (len(own) + more + 1):
                more += 1
            other = np.union1d(rng.permutation(own)[gone:], fresh(more))
            if len(other) > nearsets._SHORT and gone + more:
                assert len(np.intersect1d(parts.keys(own), parts.keys(other)))
    passage = fresh(20)
    keys = [parts.keys(np.union1d(passage, fresh(100))) for _ in range(200)]
    _, counts = np.unique(np.concatenate(keys), return_counts=True)
    assert len(keys[0]) < 100 and (counts * (counts - 1) / 2).sum() < 200 * 199 / 2
    few = np.array([k for k in range(1 << 16) if k % 7 == 0][:40], np.uint64)
    assert len(np.intersect1d(parts.keys(few), parts.keys(few[4:])))


def test_what_stars_leave_is_compared_by_blocks(spark, monkeypatch):
    """Only pairs that can be similar become rows, however large the bucket; blocks and batches change nothing."""
    rng = np.random.default_rng(8)
    base = rng.integers(0, 1 << 63, 16)
    rows = []
    for i in range(60):
        flips = np.zeros(1024, np.uint8)
        flips[rng.permutation(1024)[: int(rng.integers(0, 14))]] = 1
        rows.append((1 if i < 50 else 2, i, int(rng.choice([100, 100, 90, -100, 70])), i % 25, (base ^ np.packbits(flips).view(np.int64)).tolist()))
    rows.append((3, 100, 100, 100, base.tolist()))
    apart = lambda a, b: sum(((x ^ y) & (1 << 64) - 1).bit_count() for x, y in zip(a[4], b[4]))

    def passes(a, b):
        n, m = abs(a[2]), abs(b[2])
        plain = (a[2] > 0 if n <= m else True) and (b[2] > 0 if m <= n else True)
        return a[0] == b[0] and a[3] != b[3] and min(n, m) >= 0.8 * max(n, m) and plain and apart(a, b) <= 0.2 / 1.8 * (n + m)

    want = {(b[1], a[1]) for i, b in enumerate(rows) for a in rows[:i] if passes(a, b)}
    counts = {s: sum(r[0] == s for r in rows) for s in (1, 2, 3)}
    buckets = spark.createDataFrame([(r[0], r[1], r[2], r[3], float(counts[r[0]])) for r in rows], "s long, node long, n long, label long, rows double")
    nodes = spark.createDataFrame([(r[1], r[4]) for r in rows], "node long, bits array<long>")
    assert 0 < len(want) < 1225
    for block, batch in ((4096, 10000), (7, 10000), (4096, 3), (7, 2), (1, 10000)):
        monkeypatch.setattr(nearsets, "_BLOCK", block)
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
        try:
            got = [tuple(r) for r in nearsets._within(buckets, nodes, 0.8).collect()]
        finally:
            spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
        assert set(got) == want and len(got) == len(want)


def test_texts_are_not_sent_to_find_those_that_stay(spark, monkeypatch, tmp_path):
    docs(spark, ["a b c", "d e f", "a b c"]).write.parquet(f"{tmp_path}/d")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        kept = nearsets.representatives(spark.read.parquet(f"{tmp_path}/d"))
        assert "BroadcastHashJoin" in kept._jdf.queryExecution().executedPlan().toString()
        assert sorted(r.doc_id for r in kept.collect()) == [0, 1]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
