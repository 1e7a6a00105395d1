"""The name tagger: best chains against all chains, marks, and held-out names."""

import random
from itertools import product
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pytest

from maskmetrics.functions import tagger as G
from maskmetrics.operators import names as names_module
from maskmetrics.operators.names import _unmarked, learn_names, marked_texts
from maskmetrics.operators.pii import PluginDetector, detect_pii


def test_best_chain_is_the_best_of_all():
    rng = np.random.default_rng(3)
    weights = np.zeros((G.BUCKETS + G.TAGS, G.TAGS))
    weights[G.BUCKETS:] = rng.normal(size=(G.TAGS, G.TAGS))
    sizes = np.array([3, 1, 0, 4])
    scores = rng.normal(size=(8, G.TAGS))
    got = G.best_tags(weights, scores, sizes)
    at = 0
    for n in sizes:
        def worth(chain):
            before = (0, *chain)
            return sum(weights[G.BUCKETS + a, b] + scores[at + i, b] for i, (a, b) in enumerate(zip(before, chain)))
        if n:
            assert tuple(got[at:at + n]) == max(product(range(G.TAGS), repeat=int(n)), key=worth)
        at += n


def test_names_do_not_cross_sentences_and_need_a_begin():
    tags = np.array([1, 2, 2, 0, 2, 3, 4, 3])
    assert G.names_of(tags, np.array([2, 6])) == [(0, 2, 0), (5, 7, 1), (7, 8, 1)]


def test_sentences():
    text = "Mail J. Smith now. Call Anna.\nOut"
    spans = G.tokens_of(text)
    assert [text[spans[a][0]:spans[b - 1][1]] for a, b in G.sentences_of(text, spans)] == ["Mail J. Smith now.", "Call Anna.", "Out"]
    long = "a " * 450
    assert [b - a for a, b in G.sentences_of(long, G.tokens_of(long))] == [200, 200, 50]
    assert G.sentences_of("", []) == []


def test_features_stay_in_their_sentence():
    words = G.Words()
    one, two = ["The", "cat", "sat"], ["Ann", "Lee"]
    both = G.features(words.parts(one + two), np.array([3, 2]))
    assert (both[:3] == G.features(words.parts(one), np.array([3]))).all()
    assert (both[3:] == G.features(words.parts(two), np.array([2]))).all()


def test_steps_separate_what_can_be_separated():
    words, trainer = G.Words(), G.Perceptron(G.start_weights())
    parts = words.parts("Ann met Bob at Acme Corp in Paris".split())
    gold = np.array([1, 0, 1, 0, 3, 4, 0, 5])
    found = G.features(parts, np.array([8]))
    for _ in range(20):
        trainer.learn(found, gold, np.array([8]))
    assert (G.best_tags(trainer.mean(), G.emissions(trainer.mean(), found), np.array([8])) == gold).all()


@pytest.mark.parametrize("plan", ["small", "medium", "large"])
def test_marks_surround_known_names(spark, plan):
    names = spark.createDataFrame([("Ann Lee", "PERSON"), ("Acme", "ORGANIZATION"), ("acme ", "LOCATION"), ("x", "DATE_TIME"), (" ", "NRP")],
                                  "value string, entity_type string")
    rows = spark.createDataFrame([(1, "ann lee of ACME, not Acmes, x"), (2, None), (3, "")], "id long, t string")
    got = {r["id"]: r["t"] for r in marked_texts(rows, "t", names, plan).collect()}
    assert _unmarked(got[1]) == ("Ann Lee of Acme, not Acmes, x", [(0, 7, 0), (11, 15, 1)])
    assert got[2] is None and got[3] == ""


def _notes(n, seed):
    rng = random.Random(seed)

    def word():
        return "".join(rng.choice("bdfgklmnprst") + rng.choice("aeiou") for _ in range(rng.randint(2, 3))).capitalize()
    rows, names = [], []
    for i in range(n):
        person, org = f"{word()} {word()}", word() + rng.choice([" Group", " Holding"])
        said = rng.choice(["Call with {p} of {o} today.", "Then {o} wrote to {p} again.", "Engineer {p} left for {o} at noon."])
        rows.append((i, "Some words stand here. Nothing else. " + said.format(p=person, o=org), person, org))
        names += [(person, "PERSON"), (org, "ORGANIZATION")]
    return rows, names


def test_held_out_names_are_found(spark):
    train, names = _notes(300, 1)
    tagger = learn_names(spark.createDataFrame(train, "id long, t string, p string, o string"), "t",
                         spark.createDataFrame(names, "value string, entity_type string"))
    held, _ = _notes(80, 2)
    df = spark.createDataFrame([*held, (900, None, None, None), (901, "", None, None), (902, "no names in here at all", None, None)],
                               "id long, t string, p string, o string")
    got = detect_pii(df, "t", plugin=tagger.detector()).collect()
    hits = sum({(s["entity_type"], s["text"]) for s in r["spans"]} == {("PERSON", r["p"]), ("ORGANIZATION", r["o"])} for r in got if r["p"])
    assert hits >= 76
    assert all(r["spans"] in ([], None) for r in got if r["id"] >= 900)
    assert tagger.detector().state() == "active" and isinstance(tagger.detector(), PluginDetector)
    long = "words go on " * 20_000 + ". " + held[0][1]
    assert {s[2] for s in tagger.find([long])[0]} == {"PERSON", "ORGANIZATION"}


def test_texts_are_tagged_together(monkeypatch):
    weights = np.random.default_rng(5).normal(size=(G.BUCKETS + G.TAGS, G.TAGS)).astype(np.float32)
    texts = [n[1] for n in _notes(60, 4)[0]] + ["", "no capital\n\nAnn Lee of Acme\r\n\u00c0 Paris \u00c9mile", "A"]
    tagger = names_module.NameTagger(SimpleNamespace(value=weights), 1.0, 1)
    calls = []
    monkeypatch.setattr(names_module, "best_tags", lambda *a: calls.append(1) or G.best_tags(*a))
    together = tagger.find(texts)
    assert len(calls) == 1
    assert together == [tagger.find([t])[0] for t in texts] and sum(map(len, together)) > 60


def test_texts_are_read_once_for_all_rounds():
    texts = ["Nothing. Call with \ue010Ann Lee\ue001 of \ue011Acme\ue001 today.\nsmall letters only\nThen \ue011Acme\ue001 wrote. It ended.", None, "no name"]
    words = G.Words()
    wanted = [(G.features(p, np.array([len(p)])), tags) for p, tags in names_module._gold(texts[0], words)]
    parsed = list(names_module._parsed([pa.RecordBatch.from_arrays([pa.array(texts)], names=["text"])]))
    got = list(names_module._sentences(parsed[0]))
    assert len(parsed) == 1 and len(got) == len(wanted) == 2
    assert all((f == g).all() and (t == u).all() for (f, t), (g, u) in zip(got, wanted))
    assert [t.tolist() for _, t in wanted] == [[0, 0, 1, 2, 0, 3, 0, 0], [0, 3, 0, 0]]


def test_all_texts_take_part(spark, monkeypatch):
    rows = [(f"Call with Ann Lee about case {i}.",) for i in range(10)] + [(f"Nobody We Know wrote case {i}.",) for i in range(60)]
    names = spark.createDataFrame([("Ann Lee", "PERSON")], "value string, entity_type string")
    read = []
    monkeypatch.setattr(names_module, "_round", lambda sample, weights: read.append(sample.count()) or (weights, 1.0))
    tagger = learn_names(spark.createDataFrame(rows, "t string"), "t", names)
    assert tagger.texts == 70 and read == [70] * names_module.ROUNDS


def test_nothing_known_nothing_found(spark):
    empty = spark.createDataFrame([], "value string, entity_type string")
    rows, _ = _notes(20, 3)
    tagger = learn_names(spark.createDataFrame(rows, "id long, t string, p string, o string"), "t", empty)
    assert tagger.find([rows[0][1]]) == [[]]
    none = learn_names(spark.createDataFrame([], "t string"), "t", empty)
    assert none.texts == 0 and none.find(["Call with Ann Lee."]) == [[]]
