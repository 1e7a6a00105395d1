import random
import re

import numpy as np

from maskmetrics.llm.decontamination import contamination, winnow, without_contaminated

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def _words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def _plain(text, items, size=10):
    words, hit, names = _words(text), set(), set()
    for name, item in items:
        w = _words(item)
        n = min(size, len(w))
        have = {tuple(w[i:i + n]) for i in range(len(w) - n + 1)} if w else set()
        for i in range(len(words) - n + 1 if n else 0):
            if tuple(words[i:i + n]) in have:
                hit.update(range(i, i + n))
                names.add(str(name))
    return len(words), len(hit), sorted(names)


def _case():
    rng = random.Random(2)
    vocabulary = ["The", "of", "é", "x1", "naïve", "To", "漢字", "b", "cat", "a_b"]

    def some(n):
        return " ".join(rng.choice(vocabulary) + rng.choice(["", "", ",", "!\n"]) for _ in range(n))
    items = [(i, some(rng.choice([0, 1, 3, 9, 10, 11, 14, 40]))) for i in range(12)]
    items = [(i, t) for i, t in items if len(_words(t)) not in (1,)] + [(50, None), (51, ""), (52, items[3][1])]
    docs = [(0, None), (1, ""), (2, "cat"), (3, items[-1][1])]
    for i in range(4, 90):
        _, item = rng.choice(items)
        w = (item or "").split()
        cut = rng.randint(0, max(0, len(w) - 8))
        docs.append((i % 80, " ".join([some(rng.randint(0, 30)), *w[cut:cut + rng.randint(5, 30)], some(rng.randint(0, 30))])))
    return docs, items


def test_windows_against_plain_python(spark):
    docs, items = _case()
    df = spark.createDataFrame([(i, t, 9, "r") for i, t in docs], "doc_id long, text string, n_hit int, row string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = contamination(df, bench).collect()
    assert got[0].asDict().keys() == {"doc_id", "text", "row", "n_words", "n_hit", "n_items", "items"}
    want = sorted((i, *_plain(t, items)) for i, t in docs)
    assert sorted((r["doc_id"], r["n_words"], r["n_hit"], r["items"]) for r in got) == want
    assert all(r["n_items"] == len(r["items"]) for r in got) and any(r["n_hit"] for r in got)
    clean = without_contaminated(df, bench)
    assert sorted(r["doc_id"] for r in clean.collect()) == sorted(i for i, _, n, _ in want if not n)
    assert clean.columns == df.columns


def test_empty_sides(spark):
    docs = spark.createDataFrame([(None, "a b c")], "doc_id long, text string")
    none = spark.createDataFrame([], "item_id long, text string")
    assert [(r["n_words"], r["n_hit"], r["items"]) for r in contamination(docs, none).collect()] == [(3, 0, [])]
    assert contamination(docs.where("false"), none).count() == 0


def test_every_long_shared_run_keeps_a_common_gram():
    rng = np.random.default_rng(0)
    shared = rng.integers(0, 4, 10).astype(np.uint64)
    for _ in range(200):
        sides = [np.concatenate([rng.integers(0, 4, rng.integers(0, 20)).astype(np.uint64), shared,
                                 rng.integers(0, 4, rng.integers(0, 20)).astype(np.uint64)]) for _ in range(2)]
        a, b = (set(winnow(s, np.array([len(s)]), 5, 6)[1].tolist()) for s in sides)
        assert a & b


def test_long_place_lists_are_not_broadcast(spark):
    from maskmetrics.llm.decontamination import _asked_size

    def asked(n):
        return spark.range(2).selectExpr("cast(id as string) as row", f"transform(sequence(1, {n}), i -> struct(i as at, 0 as back, 10 as width)) as places")
    assert _asked_size(asked(5)).bounded and _asked_size(asked(5)).chars == 400
    assert not _asked_size(asked(400_000)).bounded
