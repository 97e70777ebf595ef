import random

import corpus_pipeline
from grainstone.llm import decontam, nearsets, quality, toxicity
from grainstone.llm.labelled import remainder

from . import test_decontam, test_packing, test_simhash
from .fixtures import DOCS


def test_stages_equal_brute_force(spark, tmp_path):
    rng = random.Random(8)
    syllables = ["ka", "lo", "mi", "te", "ru", "san", "vel", "dor", "in", "ash"]
    line = lambda n: " ".join("".join(rng.choice(syllables) for _ in range(rng.randint(1, 4))) for _ in range(n))
    items = [(i, line(15)) for i in range(5)]
    texts, labels = [], []
    for i in range(400):
        good, toxic = int(rng.random() < 0.8), int(rng.random() < 0.2)
        w = line(rng.randint(15, 60)).split()
        if toxic:
            for _ in range(3):
                w.insert(rng.randrange(len(w)), rng.choice(["grobnik", "blathergit", "zwurm"]))
        t = " ".join(w)
        labels.append((i, good, toxic))
        texts.append(t if good else " ".join(x.upper() + "!!" for x in w))
    texts[50:60] = [texts[40]] * 10
    texts[60] = texts[41] + " " + items[2][1]
    texts += [None, "", items[0][1], texts[41]]
    labels = [x for x in labels if not 40 <= x[0] <= 60]
    rows = [(i, t, "en", "s", len(t or "")) for i, t in enumerate(texts)]
    d = str(tmp_path)
    spark.createDataFrame(rows, DOCS).repartition(3).write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{d}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{d}/benchmark.parquet")
    docs, lab = spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/labels.parquet")

    left = dict(enumerate(texts))
    m = quality.fit(docs, lab, remainder("doc_id", 3) != 1)
    left = {i: t for i, t in left.items() if m.score([(t or "").encode()])[0] >= 0.5}
    assert 300 < len(left) < 400
    m = toxicity.fit(docs, lab, remainder("doc_id", 5) != 0)
    left = {i: t for i, t in left.items() if m.score([(t or "").encode()])[0] < 0.5}
    assert 200 < len(left) < 330
    ids = sorted(left)
    label = test_simhash.closure([test_simhash.fingerprint(left[i]) for i in ids], 4)
    left = {i: left[i] for n, i in enumerate(ids) if label[n] == n}
    hit = test_decontam.brute(list(left.values()), items)
    left = {i: t for (i, t), h in zip(left.items(), hit) if not h[-1]}

    out = corpus_pipeline.run(spark, d).collect()
    assert {r.doc_id for r in out} == set(left)
    for r in out:
        want = test_packing.ids(left[r.doc_id] or "") + [2]
        assert r.doc_tokens == len(want)
    assert sum(r.length for r in out) == sum(len(test_packing.ids(t or "")) + 1 for t in left.values())


def test_filters_keep_clashing_columns_and_nulls(spark):
    df = spark.createDataFrame([(1, "a b c d e", 5), (1, "a b c d e", 6), (None, "q r s t u v", 7), (2, None, 8)], "doc_id long, text string, fp int").repartition(1)
    assert sorted(r.fp for r in nearsets.representatives(df).collect()) in ([5, 7, 8], [6, 7, 8])
    bench = spark.createDataFrame([(1, "s t u")], "item_id long, text string")
    assert sorted(r.fp for r in decontam.clean(df, bench).collect()) == [5, 6, 8]
    assert nearsets.representatives(df.where("false")).count() == 0


def tables(spark, d, documents, labels, items):
    spark.createDataFrame(documents, DOCS + ", extra string").write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{d}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{d}/benchmark.parquet")


def test_empty_tables(spark, tmp_path):
    rows = [(i, t, "en", "s", 0, "x") for i, t in enumerate(["a few words only", None, "", "a few words only", "x " * 30000])]
    for n, (documents, labels, items) in enumerate([([], [], []), (rows, [], []), (rows, [(0, 1, 0), (7, None, None)], [(None, None), (1, "")])]):
        d = f"{tmp_path}/{n}"
        tables(spark, d, documents, labels, items)
        out = corpus_pipeline.run(spark, d).collect()
        # Without labels a document counts as good and clean; of equal texts one stays.
        assert {r.doc_id for r in out} == ({0, 1, 4} if documents else set())
