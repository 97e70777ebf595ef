import re
import textwrap
from collections import Counter

from grainstone.llm import licences

from .fixtures import DOCS, docs


def words(t):
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", re.sub("[A-Z]", lambda m: m[0].lower(), t))


def brute(text, templates, threshold):
    w = words(text or "")
    own = list(zip(w, w[1:]))
    spans, found = 0, []
    for name, t in templates.items():
        b = Counter(zip(words(t), words(t)[1:]))
        size = sum(b.values())
        if not size or not own:
            continue
        dice = []
        for i in range(max(len(own) - size, 0) + 1):
            a = Counter(own[i : i + size])
            dice.append(2 * sum((a & b).values()) / (sum(a.values()) + size))
        hit = [d >= threshold - 1e-12 for d in dice]
        spans += sum(h and not (i and hit[i - 1]) for i, h in enumerate(hit))
        if any(hit):
            found.append((name, max(dice)))
    best = min(found, key=lambda x: (-x[1], x[0]), default=(None, 0.0))
    return spans, best[0], best[1], ",".join(sorted(n for n, _ in found))


def test_equals_brute_force(spark):
    t = {n: x for n, x in licences.TEMPLATES.items() if len(x) < 700}
    texts = [None, "", "\n\n", "one", *t.values(), *(f"before\n{x.upper()}\nafter it all" for x in t.values()), *(x.replace(" ", " extra ", 1) for x in t.values())]
    texts += ["\n".join(t.values()), t["MIT-grant"].replace(", ", ",\n"), "All rights rights reserved.", "All rights reserved. " * 3, "ALL-RIGHTS\treserved", "w " * 3000, "same line", "same line"]
    texts += [" ".join(words(x)[: len(words(x)) * k // 10]) for x in t.values() for k in (5, 7, 8, 9)]
    df = docs(spark, texts).selectExpr("*", "1 as k", "2 as dice")
    for templates, threshold in ((t, 0.8), (t, 0.4), ({"x": "same line", "one": "one", "": "", "twice": "a b a b a b c"}, 0.8), ({}, 0.8)):
        got = sorted(licences.scan_licences(df, templates=templates, threshold=threshold).collect(), key=lambda r: r.doc_id)
        assert [tuple(r)[1:] for r in got] == [brute(x, templates, threshold) for x in texts]
    assert licences.scan_licences(spark.createDataFrame([], DOCS)).count() == 0


def wrapped(text, width):
    return "\n".join(textwrap.wrap(" ".join(text.split()), width))


def test_licences_inside_longer_texts(spark):
    """Notices wrapped over lines, in longer lines, behind comment signs, far into a text."""
    t = licences.TEMPLATES
    mit = "MIT License\n\nCopyright (c) 2020 someone\n\n" + wrapped(t["MIT"], 78)
    apache = "# Copyright 2021 the authors\n#\n" + "\n".join("# " + x for x in wrapped(t["Apache-2.0"], 74).split("\n")) + "\n\nimport os\n" + "x = 1\n" * 200
    gpl = "word " * 20000 + "/*\n" + "\n".join(" * " + x for x in wrapped(t["GPL-3.0-or-later"], 60).split("\n")) + "\n */" + " more" * 5000
    line = "Copyright 2020 the authors. Released under the MIT License. See the file for details."
    changed = t["BSD-3-Clause"].replace("COPYRIGHT HOLDERS AND CONTRIBUTORS", "REGENTS AND CONTRIBUTORS").replace("the copyright holder", "the University")
    got = {r.doc_id: r for r in licences.scan_licences(docs(spark, [mit, apache, gpl, line, changed, "a text about the terms of use of the software in the house"])).collect()}
    assert got[0].licence == "MIT" and got[0].dice == 1 and "MIT" in got[0].licences.split(",")
    assert got[1].licence.startswith("Apache-2.0") and "Apache-2.0" in got[1].licences.split(",")
    assert got[2].licence == "GPL-3.0-or-later" and got[2].dice == 1
    assert got[3].licence == "MIT-notice" and got[3].n_matches == 1
    assert "BSD-3-Clause" in got[4].licences.split(",") and got[4].licence == "BSD-grant"
    assert got[5].n_matches == 0
