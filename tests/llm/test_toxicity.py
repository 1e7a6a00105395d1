import itertools
import random
import zlib

import numpy as np

from maskmetrics.llm.toxicity import fit, held_out_key, maximal_segments, surprise, with_toxicity


def _all_maximal(scores):
    """Maximal segments by their recursive definition: the best one, then both sides."""
    best = None
    for a, b in itertools.combinations(range(len(scores) + 1), 2):
        s = sum(scores[a:b])
        if s > 1e-9 and (best is None or s > best[2] + 1e-9 or (abs(s - best[2]) <= 1e-9 and b - a < best[1] - best[0])):
            best = (a, b, s)
    if best is None:
        return []
    left = _all_maximal(scores[:best[0]])
    right = [(a + best[1], b + best[1], s) for a, b, s in _all_maximal(scores[best[1]:])]
    return left + [best] + right


def test_segments_against_their_definition():
    rng = random.Random(1)
    for _ in range(300):
        n, drift = rng.randint(1, 25), -rng.choice([0.13, 0.7, 2.1])
        scores = [rng.uniform(0.1, 3) if rng.random() < 0.35 else drift for _ in range(n)]
        at = [i for i, s in enumerate(scores) if s > 0]
        got = maximal_segments(at, [scores[i] for i in at], drift)
        assert [(a, b) for a, b, _ in got] == [(a, b) for a, b, _ in _all_maximal(scores)]
    long = maximal_segments(list(range(0, 400_000, 2)), [1.0] * 200_000, -1.5)
    assert len(long) == 200_000


def test_surprise_grows_with_score_and_falls_with_length():
    assert surprise(0, 10, 1) == 0 and surprise(5, 10, 1) > surprise(4, 10, 1) > surprise(4, 1000, 1) >= 0
    assert abs(surprise(60, 100, 1) - surprise(59.9999, 100, 1)) < 1e-3


def _corpus(n=600):
    rng = random.Random(4)
    plain = ["word%d" % i for i in range(300)]
    rows, labels = [], []
    for i in range(n):
        w = [rng.choice(plain) for _ in range(rng.randint(20, 120))]
        toxic = rng.random() < 0.2
        for _ in range(rng.randint(2, 5) if toxic else 0):
            w.insert(rng.randrange(len(w)), rng.choice(["grobbler", "Grobbled!", "snerk", "VLUMP"]))
        rows.append((i, " ".join(w)))
        labels.append((i, int(toxic)))
    return rows, labels


def test_held_out_rows_are_told(spark):
    rows, labels = _corpus()
    copies = [(1000 + i, "one mild text that is copied often and marked by mistake") for i in range(150)]
    df = spark.createDataFrame([(i, t, "s", 1.0) for i, t in rows + copies + [(5000, None), (5001, ""), (5001, "")]],
                               "doc_id long, text string, passages string, score double")
    marks = spark.createDataFrame(labels + [(i, 1) for i, _ in copies] + [(3, None), (None, 1), (4, 0), (4, 1)],
                                  "doc_id long, toxic int")
    scored = with_toxicity(df, fit(df, marks, held_out=held_out_key()))
    assert sorted(scored.columns) == ["doc_id", "passages", "score", "text"]
    got = {r["doc_id"]: r for r in scored.collect()}
    known = dict(labels)
    for i, t in rows:
        if zlib.crc32(str(i).encode()) % 5 == 0:
            assert (got[i]["score"] >= 0.5) == bool(known[i]), (got[i], t)
            for p in got[i]["passages"]:
                assert 0 <= p["start"] < p["end"] <= len(t.split())
    assert got[5000]["score"] == got[5001]["score"] < 0.5 and got[5000]["passages"] == []
    # A hundred and fifty copies have one vote.
    others = with_toxicity(spark.createDataFrame([(1, "mild text that is new")], "doc_id long, text string"),
                           fit(df, marks, held_out=held_out_key())).first()
    assert others["score"] < 0.5


def test_without_labels_or_rows(spark):
    df = spark.createDataFrame([(1, "a b c"), (None, None)], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert [r["score"] for r in with_toxicity(df, fit(df, none)).collect()] == [0.5, 0.5]
    one = spark.createDataFrame([(1, 0)], "doc_id long, toxic int")
    assert all(r["score"] <= 0.5 for r in with_toxicity(df, fit(df, one)).collect())
    assert with_toxicity(df.where("false"), fit(df.where("false"), none)).count() == 0


def test_stems_are_cut_in_bytes():
    from maskmetrics.llm.toxicity import word_and_stem_hashes
    words, stems, counts = word_and_stem_hashes([b"Lowei lowest", b"", b"low LOW"])
    assert counts.tolist() == [2, 0, 2] and stems[0] == stems[1] and words[0] != words[1] and stems[2] == stems[3] != stems[0]
    assert len(np.unique(words)) == 3
