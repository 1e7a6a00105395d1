"""Names in broken layouts, against a search of every stretch with the full edit distance."""

import random
import re

import pytest

from maskmetrics.functions.matcher import fold
from maskmetrics.functions.skeleton import Hashes, neighbourhood, skeletons, stretches, written
from maskmetrics.operators import broken_names
from maskmetrics.operators.broken_names import LEAST, LEAST_MISSPELT, MORE_PIECES, find_broken, mask_broken
import numpy as np


def _distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def _pieces(text):
    return [m.span() for m in re.finditer(r"[^\W\d_]+|\d+", text)]


def _skeleton(text):
    return "".join(c for c in fold(text) if c.isalnum())


def _brute(text, entries):
    """All finds without regard to overlaps: {(start, end): (edits, ordinal, alias)}."""
    spans, out = _pieces(text), {}
    most = max(len(_pieces(v)) for v, _, _ in entries) + MORE_PIECES
    for i in range(len(spans)):
        for j in range(i, min(len(spans), i + most)):
            if j > i and spans[j][0] - spans[j - 1][1] > 3:
                break
            a, b = spans[i][0], spans[j][1]
            own = _skeleton(text[a:b])
            for value, alias, ordinal in entries:
                name = _skeleton(value)
                d = _distance(own, name)
                digits = [c for c in own if c.isdigit()] == [c for c in name if c.isdigit()]
                if len(name) >= LEAST and (d == 0 or (d == 1 and digits and len(name) >= LEAST_MISSPELT)):
                    out[a, b] = min(out.get((a, b), (9,)), (d, ordinal, alias))
    kept = []
    for (a, b), (d, _, alias) in sorted(out.items(), key=lambda x: (x[1][0], x[0][0] - x[0][1], x[0][0])):
        if all(b <= x or y <= a for x, y, _, _ in kept):
            kept.append((a, b, alias, d))
    return sorted(kept)


def test_random_layouts(spark, registry_of, monkeypatch):
    monkeypatch.setattr(broken_names, "SLICE", 300)
    rng = random.Random(5)
    names = ["Acme Holding", "Börse Süd", "Anna van der Berg", "Node 0042 East", "Abc", "abcde", "acme holdings", "Acme Holdong"]
    registry = registry_of(client=names)
    entries = [(r["value"], r["alias"], r["ordinal"]) for r in registry.df.collect()]

    def broken(name):
        out = []
        for c in name:
            out.append(c.upper() if rng.random() < 0.2 else c)
            if rng.random() < 0.1:
                out.append(rng.choice(["-\n", "_", ".", "    ", "x", "7", "-"]))
        if rng.random() < 0.4:
            del out[rng.randrange(len(out))]
        return "".join(out)
    texts = [" ".join(rng.choice([broken(rng.choice(names)), rng.choice(["to", "Acme", "a", "12", "srv"])]) + rng.choice([" ", "\n", ": ", ""]) for _ in range(rng.randint(0, 6)))
             for _ in range(150)]
    texts += [None, "", "x " * 1_500 + "ACME-HOLDING", "acme holding", "acme holding", "node0042east", "node 0043 east", "😀 acme\nholding 😀"]
    df = spark.createDataFrame(list(enumerate(texts)), "id long, t string").withColumnRenamed("id", "_key2")
    got = {r["_key2"]: r for r in find_broken(df, "t", registry).collect()}
    for i, text in enumerate(texts):
        spans = [(s["start"], s["end"], s["alias"], s["edits"]) for s in got[i]["broken"]]
        assert spans == (_brute(text, entries) if text else []), text
        assert all(text[s["start"]:s["end"]] == s["text"] for s in got[i]["broken"])
    masked = {r["_key2"]: r["t"] for r in mask_broken(df, "t", registry).collect()}
    for i, text in enumerate(texts):
        want = text
        for a, b, alias, _ in reversed(_brute(text, entries) if text else []):
            want = want[:a] + alias + want[b:]
        assert masked[i] == want


def test_abbreviated_names_are_not_misspelt(spark, registry_of):
    registry = registry_of(contact=["Johann Sebastian Bachmann", "Clara Wieckhof"])
    rows = ["mail jsbachmann@x.org", "J. S. Bachmann", "jsbachmamn", "C-Wieckhof said", "Bachmann", None]
    df = spark.createDataFrame(list(enumerate(rows)), "id long, t string")
    got = {r["id"]: [s["text"] for s in r["f"]] for r in find_broken(df, "t", registry, "f", abbreviated=True).collect()}
    assert got == {0: ["jsbachmann"], 1: ["J. S. Bachmann"], 2: [], 3: ["C-Wieckhof"], 4: [], 5: []}
    assert all(not r["f"] for r in find_broken(df, "t", registry, "f").collect())


def test_empty_sides(spark, registry_of):
    df = spark.createDataFrame([(1, "acme holding", 7)], "id long, t string, key int")
    nothing = registry_of(client=[])
    assert find_broken(df, "t", nothing).collect()[0]["broken"] == []
    short = registry_of(client=["Abc"])
    assert find_broken(df, "t", short).collect()[0]["broken"] == []
    some = registry_of(client=["Acme Holding"])
    assert find_broken(df.limit(0), "t", some).count() == 0
    assert find_broken(df, "t", some.disabled()).collect()[0]["broken"] == []
    assert find_broken(df, "t", some).columns == ["id", "t", "key", "broken"]


def test_stretches_one_edit_apart_share_a_key():
    rng = random.Random(2)
    for _ in range(200):
        a = "".join(rng.choice("abc") for _ in range(rng.randint(2, 9)))
        i = rng.randrange(len(a))
        b = rng.choice([a[:i] + a[i + 1:], a[:i] + rng.choice("abc") + a[i + 1:], a[:i] + rng.choice("abc") + a[i:]])
        if not b:
            continue
        s = skeletons([a, b])
        start, end = s.starts, s.ends
        which, keys = neighbourhood(s, start, end, 1)
        assert set(keys[which == 0]) & set(keys[which == 1])
        assert written(s, start, end) == [a, b]
    h = Hashes(skeletons(["abcXabd"]).chars)
    one = np.array([0]), np.array([2])
    assert h.whole(*one) == h.whole(np.array([4]), np.array([6])) != h.whole(np.array([1]), np.array([3]))


def test_stretches_end_with_their_text():
    s = skeletons(["ab cd", "ef", "", "gh    ij"])
    sizes = np.ones(12, np.bool_)
    owner, start, end = stretches(s, 3, sizes)
    assert sorted(zip(owner.tolist(), written(s, start, end))) == [(0, "ab"), (0, "abcd"), (0, "cd"), (1, "ef"), (3, "gh"), (3, "ij")]


def test_stretches_that_share_no_half_with_a_name_are_not_joined(spark, registry_of):
    """Only what may be a name, or one edit away from one, leaves the search; every such stretch does."""
    rng = random.Random(5)
    names = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(8, 14))) for _ in range(60)] + ["quirk"]
    index = broken_names.deletion_index(registry_of(client=names))
    near = []
    for name in names[:40]:
        at, letter = rng.randrange(len(name)), rng.choice("mnop")
        near.append(rng.choice([name, name[:at] + name[at + 1:], name[:at] + letter + name[at + 1:], name[:at] + letter + name[at:]]))
    far = [name[:2] + "zz" + name[4:-2] + "yy" for name in names[:60]]
    texts = spark.createDataFrame([(w.encode(), w) for w in near + far + ["quirk", "quark"]], "text_key binary, text string")
    held = {r["skeleton"] for r in broken_names._stretches_of(texts, index).select("skeleton").collect()}
    assert set(near) | {"quirk"} <= held
    table = broken_names.half_table(index)
    s = skeletons(far)
    start, end = s.starts, s.ends
    passed = broken_names.shares_half(s, start, end, LEAST_MISSPELT, lambda h: broken_names.may_be_in(table, h) & broken_names.may_be_in(table, h >> np.uint64(32)))
    assert passed.sum() < 5
