import math
import random
from collections import Counter

from pyspark.sql import functions as F

from maskmetrics.llm.licenses import (
    FILE_LEVEL, LINE_LEVEL, SPLIT, TEMPLATES, _may_reach, _terms, template_weights, with_licences)


def _cosines(text):
    rows, idf, unknown = template_weights(TEMPLATES)
    c = Counter(_terms(text))
    length = math.sqrt(sum((n * idf.get(t, unknown)) ** 2 for t, n in c.items()))
    out = Counter()
    for i, _, t, w in rows:
        out[i] += c[t] * idf[t] * w / length if length else 0
    return {i: round(v, 6) for i, v in out.items()}


def _best(text, level):
    found = sorted((-v, i) for i, v in _cosines(text).items() if v >= level)
    return (TEMPLATES[found[0][1]][0], -found[0][0]) if found else None


def test_few_texts_pass_the_bound_and_none_is_lost(spark):
    rng = random.Random(1)
    texts = [t for _, t in TEMPLATES] + ["the of and to in is by any", "", "word " * 40]
    words = sorted({w for _, t in TEMPLATES for w in t.split()}) + ["other", "plain"] * 20
    texts += [" ".join(rng.choice(words) for _ in range(rng.randint(1, 12))) for _ in range(300)]
    texts += [TEMPLATES[0][1] + " word" * 3 + " %d" % i + " filler w%d" % i * 60 for i in range(5, 9)]
    rows, idf, unknown = template_weights(TEMPLATES)
    df = spark.createDataFrame([(i, t.lower()) for i, t in enumerate(texts)], "i int, t string")
    passed = {r["i"] for r in df.where(_may_reach(F.split("t", SPLIT), rows, FILE_LEVEL)).collect()}
    closer = {r["i"] for r in df.where(_may_reach(F.split("t", SPLIT), rows, FILE_LEVEL, idf, unknown)).collect()}
    assert closer <= passed
    reached = {i for i, t in enumerate(texts) if max(_cosines(t).values(), default=0) >= FILE_LEVEL}
    assert reached <= closer and len(TEMPLATES) not in passed and len(TEMPLATES) + 2 not in passed


def test_notices_files_and_inheritance(spark):
    files = {
        "a/LICENSE": TEMPLATES[4][1], "a/x.py": "import this", "a/b/c/y.py": "x = 1\ny = alpha + beta * gamma - delta\n" * 4 + "# Released under the MIT License.\n", "a/b/c/z": "zero",
        "a/b/COPYING": TEMPLATES[6][1], "top": "nothing", "a/b/d/e/f": None, "abc/x": "other", "q/one": "Licensed under CC BY-NC 4.0.",
        "q/two": "mit license license", "q/r": "plain\r\n", "q/r/s": "", "deep/v": "word " * 500 + "\nLicensed under the Apache License, Version 2.0."}
    rows = [(p, t, "old", 1) for p, t in files.items()] + [("a/x.py", "import this", "old", 2), (None, TEMPLATES[0][1], "n", 3)]
    df = spark.createDataFrame(rows, "path string, text string, licence string, row int")
    got = with_licences(df).collect()
    assert len(got) == len(rows) and sorted(got[0].asDict()) == ["cosine", "evidence", "licence", "licence_path", "path", "row", "text"]
    lines = {p: max((b for line in (t or "").split("\n") if (b := _best(line, LINE_LEVEL))), key=lambda b: b[1], default=None) for p, t in files.items()}
    whole = {p: _best(t or "", FILE_LEVEL) for p, t in files.items()}
    for r in got:
        if r["path"] is None:
            assert (r["licence"], r["evidence"], r["licence_path"]) == ("MIT", "header", None)
            continue
        own = (*lines[r["path"]], "header") if lines[r["path"]] else (*whole[r["path"]], "file") if whole[r["path"]] else None
        if own:
            assert (r["licence"], r["cosine"], r["evidence"], r["licence_path"]) == (*own, r["path"])
            continue
        want, folder = (None, None), r["path"].rpartition("/")[0]
        while want == (None, None):
            here = sorted((-v[1], p) for p, v in whole.items() if v and p.rpartition("/")[0] == folder)
            if here:
                want = (whole[here[0][1]][0], here[0][1])
            if not folder:
                break
            folder = folder.rpartition("/")[0]
        assert (r["licence"], r["licence_path"]) == want, r
        assert r["evidence"] == ("inherited" if want[0] else None)
    assert {r["path"]: r["licence"] for r in got}["a/b/c/z"] == "GPL-3.0"


def test_empty_and_native(spark):
    df = spark.createDataFrame([], "path string, text string")
    assert with_licences(df).count() == 0
    found = with_licences(spark.createDataFrame([("a", "b")], "path string, text string"))
    assert not any(w in found._jdf.queryExecution().executedPlan().toString() for w in ("Python", "Arrow", "Pandas"))
    assert [r["licence"] for r in found.collect()] == [None]
