import hashlib
import random
import re

from grainstone.llm import decontam

from .fixtures import DOCS, docs

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(texts, items, window=10):
    out = []
    for t in texts:
        w, hit, found = words(t), set(), set()
        for item, b in items:
            v = words(b)
            n = min(window, len(v))
            for s in range(len(v) - n + 1 if v else 0):
                for p in range(len(w) - n + 1):
                    if w[p : p + n] == v[s : s + n]:
                        hit.update(range(p, p + n))
                        found.add(str(item) if item is not None else "")
        out.append((len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)))
    return out


def case():
    rng = random.Random(3)
    vocab = ["the", "of", "and", "Über", "x1", "zeta", "kilo", "émile", "a", "b"]
    line = lambda n: " ".join(rng.choice(vocab) for _ in range(n))
    items = [(1, line(30)), (2, line(10)), (11, "Only, THREE-words"), (3, "solo"), (4, ""), (5, None), (6, "--"), (7, "a " * 40), (8, line(12)), (None, line(11)), (2, line(10))]
    texts = [line(60) for _ in range(10)]
    texts += [None, "", "!!", "a a a a", "a " * 25, "solo SOLO", "only three words; only three WORDS", items[0][1].upper(), "pre " + items[1][1] + " post", items[8][1][:-1], items[7][1] * 3, "\x00" + items[0][1] + "\x00", "b " * 3000 + items[8][1]]
    return texts, items


def test_equals_brute_force_whole_and_in_parts(spark):
    texts, items = case()
    bench = spark.createDataFrame([(i, t, 0, 0) for i, t in items], "item_id long, text string, k int, n int")
    df = docs(spark, texts).selectExpr("*", "1 as k", "2 as n_words", "3 as digest")
    want = brute(texts, items)
    for part in (1 << 20, 120):
        got = sorted(map(tuple, decontam.contamination(df, bench, part_bytes=part).collect()))
        assert [g[1:] for g in got] == want


def test_empty_tables_and_repeated_rows(spark):
    none = spark.createDataFrame([], "item_id long, text string")
    df = docs(spark, ["one two", "one two"]).withColumn("doc_id", __import__("pyspark").sql.functions.lit(1))
    assert [tuple(r)[1:4] for r in decontam.contamination(df, none).collect()] == [(2, 0, 0)] * 2
    bench = spark.createDataFrame([(1, "two")], "item_id long, text string")
    assert [tuple(r)[1:4] for r in decontam.contamination(df, bench).collect()] == [(2, 1, 1)] * 2
    assert decontam.contamination(spark.createDataFrame([], DOCS), bench).count() == 0
