"""Periodic runs against a search by all periods, Lyndon arrays against their definition, the query against plain Python."""

import hashlib
import random
import re
import zlib

import pytest

from maskmetrics.llm.periodic import all_runs, lyndon_lengths, text_runs, with_runs
from maskmetrics.llm.queries import QUERIES


def _runs(x, least):
    n, out = len(x), set()
    for p in range(1, n // 2 + 1):
        i = 0
        while i + p < n:
            j = i
            while j + p < n and x[j] == x[j + p]:
                j += 1
            if j + p - i >= max(least, 2 * p):
                w = x[i:j + p]
                if not any(w[q:] == w[:-q] for q in range(1, p)):
                    out.add((i, len(w), p))
            i = max(j, i + 1)
    return sorted(out, key=lambda r: (r[0], r[2]))


def _collapsed(x, runs):
    out = set()
    for s, n, p in runs:
        out |= set(range(s + p, s + n))
    return " ".join(w for i, w in enumerate(x) if i not in out)


def _lyndon(s):
    out = []
    for i in range(len(s)):
        out.append(max(j - i for j in range(i + 1, len(s) + 1) if all(s[i:j] < s[k:j] for k in range(i + 1, j))))
    return out


def test_lyndon_lengths():
    rng = random.Random(1)
    for _ in range(1500):
        s = [rng.randrange(rng.choice([1, 2, 3, 6])) for _ in range(rng.randint(0, 16))]
        assert lyndon_lengths(s) == _lyndon(s)
    fibonacci = "a", "b"
    for _ in range(20):
        fibonacci = fibonacci[1], fibonacci[1] + fibonacci[0]
    assert max(lyndon_lengths([ord(c) for c in fibonacci[1]])) > 1000
    assert lyndon_lengths(list(range(5_000))) == list(range(5_000, 0, -1))
    assert lyndon_lengths([1] * 5_000) == [1] * 5_000


@pytest.mark.parametrize("least", [2, 3, 12])
def test_runs_of_random_texts(least):
    rng = random.Random(least)
    for _ in range(300):
        texts = []
        for _ in range(rng.randint(0, 4)):
            x = []
            while len(x) < rng.randint(0, 70):
                x += [rng.choice("abcd"[:rng.choice([1, 2, 4])]) for _ in range(rng.randint(1, 7))] * rng.randint(1, 5)
            texts.append(x)
        found, kept = text_runs([" ".join(x).encode() for x in texts], least)
        for x, runs, short in zip(texts, found, kept):
            assert [tuple(r) for r in runs.tolist()] == _runs(x, least)
            assert short.decode() == _collapsed(x, _runs(x, least))


def test_parts_are_told_apart():
    part, start, length, period = all_runs([[1, 2, 1, 2, 1], [], [2, 1, 2, 1]], 2)
    assert sorted(zip(part.tolist(), start.tolist(), length.tolist(), period.tolist())) == [(0, 0, 5, 2), (2, 0, 4, 2)]
    assert [len(a) for a in all_runs([[], []], 2)] == [0] * 4


def test_edge_cases(spark):
    long = " ".join("w%d" % (i % 13) for i in range(60_000)) + " end"
    rows = [(1, None, 7), (2, "", 7), (3, " \t\n", 7), (4, "a " * 12, 7), (4, "a " * 12, 7), (5, "a " * 11, 7), (6, long, 7),
            (7, "é x é x " * 6, None), (8, "A a " * 6, 1), (9, "A a A A a a A a A A A a", 1), (10, "x\x0by\x0c" * 8 + "\x85", 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, runs int").withColumnRenamed("runs", "collapsed")
    got = with_runs(df, found="found").collect()
    assert len(got) == len(rows) and got[0].asDict().keys() == {"doc_id", "text", "found", "collapsed"}
    for r in got:
        words = re.findall("[^\x20\x09-\x0d]+", r["text"] or "")
        runs = [(0, 60_000, 13)] if r["doc_id"] == 6 else _runs(words, 12)
        assert [tuple(x) for x in r["found"]] == runs
        assert r["collapsed"] == _collapsed(words, runs)
    assert with_runs(df.limit(0)).count() == 0
    with pytest.raises(ValueError):
        with_runs(df, least=1)


def test_registered_query(spark, tmp_path):
    rng = random.Random(21)
    rows = [(i, "\n ".join(rng.choice(["a", "bb", "é", "A", "d."]) for _ in range(rng.choice([0, 1, 13, 40, 200])))) for i in range(150)] + [(900, None), (901, " "), (None, "q r " * 9)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    got = {r["doc_id"]: tuple(r)[1:] for r in QUERIES["op11_word_runs"](spark, str(tmp_path)).collect()}
    for key, text in rows:
        x = re.findall("[^\x20\x09-\x0d]+", text or "")
        n = len(x)
        h = zlib.crc32(("" if key is None else str(key)).encode())
        if h % 10 == 0 and n:
            a = h // 10 % n
            p = 1 + (n - a) // (3 + h // 10 % 8)
            x = [x[i] if i < a else x[a + (i - a) % p] for i in range(n)]
        runs = _runs(x, 12)
        best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=(None,) * 3)
        want = (len(runs), *best, 1000 * best[1] // best[2] if runs else None, hashlib.sha256("".join("%d,%d,%d\n" % r for r in runs).encode()).hexdigest(),
                hashlib.sha256(_collapsed(x, runs).encode()).hexdigest())
        assert got[key] == want
