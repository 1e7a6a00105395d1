"""Spelling variants against a comparison of all words, and the registered query against plain Python."""

import random
import re
import zlib
from collections import Counter

import pytest

from maskmetrics.llm import spelling
from maskmetrics.llm.queries import QUERIES
from maskmetrics.llm.spelling import BEGIN, END, frequent_grams, most_affected, near_pairs, spelling_forms, variable_grams, word_counts


def _near(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    short, long = sorted((a, b), key=len)
    return any(long[:i] + long[i + 1:] == short for i in range(len(long)))


def _forms(counts, length=6, least=5, factor=5):
    words = {w: n for w, n in counts.items() if len(w) >= length and n >= least}
    near = {w: [v for v in words if _near(w, v)] for w in words}
    form = {}
    for w, some in near.items():
        best = min(some, key=lambda v: (-words[v], v), default=None)
        if best is not None and words[best] >= factor * words[w]:
            form[w] = best

    def root(w):
        while w in form:
            w = form[w]
        return w
    return {(w, n, len(near[w]), form.get(w), words[form[w]] if w in form else None, root(w)) for w, n in words.items()}


def _words(rng, n):
    stems = ["".join(rng.choice("abeé") for _ in range(rng.randint(4, 9))) for _ in range(n)]
    out = set(stems)
    for w in stems:
        for _ in range(rng.randint(0, 3)):
            i = rng.randrange(len(w) + 1)
            out.add(rng.choice([w[:i] + w[i + 1:], w[:i] + rng.choice("abeé") + w[i:], w[:i] + rng.choice("abeé") + w[i + 1:]]))
    return sorted(out)


@pytest.mark.parametrize("bar,most", [(32, 200_000), (1, 200_000), (1, 20), (4, 10)])
def test_pairs_and_forms_of_random_words(spark, monkeypatch, bar, most):
    monkeypatch.setattr(spelling, "FREQUENT", bar)
    monkeypatch.setattr(spelling, "MOST_FREQUENT", most)
    rng = random.Random(bar + most)
    counts = {w: rng.choice([1, 4, 5, 6, 25, 30, 150, 900]) for w in _words(rng, 120)}
    df = spark.createDataFrame([(w, n, "x") for w, n in counts.items()], "word string, n long, gram string")
    got = {(r["word"], r["n"], r["n_near"], r["form"], r["form_n"], r["root"]) for r in spelling_forms(df).collect()}
    assert got == _forms(counts)


def test_every_gram_is_found_from_its_own_characters():
    rng = random.Random(1)
    frequent = {"".join(rng.choice("ab") for _ in range(n)) for n in (2, 2, 3, 3) for _ in range(4)} | {BEGIN + "a", "a" + END}
    for _ in range(300):
        a = "".join(rng.choice("ab") for _ in range(rng.randint(4, 9)))
        i = rng.randrange(len(a))
        b = rng.choice([a[:i] + a[i + 1:], a[:i] + "c" + a[i + 1:], a[:i] + "c" + a[i:]])
        one, two = Counter(g for _, g in variable_grams(a, frequent)), Counter(g for _, g in variable_grams(b, frequent))
        for word, grams in ((a, one), (b, two)):
            assert sum((one & two).values()) >= sum(grams.values()) - most_affected(variable_grams(word, frequent))


def test_bar_follows_the_bound(spark, monkeypatch):
    df = spark.createDataFrame([(f"word{i:04d}",) for i in range(600)], "word string")
    many = frequent_grams(df, 1)
    monkeypatch.setattr(spelling, "MOST_FREQUENT", 8)
    few = frequent_grams(df, 1)
    assert few < many and len(few) <= 8


def test_long_chains_end_at_their_root(spark):
    words = {"aaaaaaaa"[:8 - i] + "b" * i + "cc": 5 * 5 ** i for i in range(9)}
    got = spelling_forms(spark.createDataFrame(list(words.items()), "word string, n long")).collect()
    assert {r["root"] for r in got} == {"bbbbbbbbcc"} and sum(r["form"] is None for r in got) == 1


def test_edge_cases(spark):
    empty = spark.createDataFrame([], "word string, n long")
    assert spelling_forms(empty).count() == 0 and near_pairs(empty).count() == 0
    ties = spark.createDataFrame([("wordss", 5), ("wordsa", 50), ("wordsb", 50), ("x" * 5_000, 9), ("x" * 5_001, 45), ("short", 99), ("rareword", 4)], "word string, n long")
    got = {r["word"]: (r["form"], r["n_near"]) for r in spelling_forms(ties).collect()}
    assert got == {"wordss": ("wordsa", 2), "wordsa": (None, 2), "wordsb": (None, 2), "x" * 5_000: ("x" * 5_001, 1), "x" * 5_001: (None, 1)}
    runs = spark.createDataFrame([("a",), (None,), ("a",), ("b",)], "word string")
    assert {tuple(r) for r in word_counts(runs).collect()} == {("a", 2), ("b", 1)}
    with pytest.raises(ValueError):
        spelling_forms(empty, least_length=3)


def test_registered_query(spark, tmp_path):
    rng = random.Random(8)
    pool = ["".join(rng.choice("abcdeéßÿ×") for _ in range(rng.randint(5, 8))) for _ in range(40)]
    rows = [(i, " ".join(rng.choice(pool) if rng.random() < 0.9 else rng.choice(pool).upper() + "-x1" for _ in range(rng.randint(0, 200)))) for i in range(120)]
    rows += [(None, "abcdef abcdef"), (500, None), (501, ""), (501, "abcdef " * 20)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    counts = Counter()
    lower = str.maketrans({c: c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"})
    for key, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(lower)
            h = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
            counts[run[:h % len(run)] + run[h % len(run) + 1:] if h % 199 == 0 else run] += 1
    got = {(r["word"], r["n"], r["n_near"], r["form"], r["form_n"], r["root"]) for r in QUERIES["op13_spelling_forms"](spark, str(tmp_path)).collect()}
    assert got == _forms(counts)
