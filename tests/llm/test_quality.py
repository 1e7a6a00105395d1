import random
import re
from collections import Counter

from pyspark.sql import functions as F

from maskmetrics.llm.quality import COUNTS, learn_rules, with_counts, with_verdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def _plain(text):
    text = text or ""
    words = WORD.findall(text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    windows = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    often = Counter(windows)
    covered = {i + j for i, w in enumerate(windows) if often[w] > 1 for j in range(3)}
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dup, len(covered)


def test_counts_against_plain_python(spark):
    rng = random.Random(2)
    pool = ["a", "b", "the", "é漢", "#x", "<b>", "\x1c", "A&B", "🙂", "\xa0"]
    texts = [None, "", " \n\t", "a", "a b c", "a b c a b c", "x\nx\n x\n\nx\n\n", "a a a a a", "\x0ba\x0cb\rc"]
    texts += ["".join(rng.choice(pool) + rng.choice([" ", " ", "\n", "\t", "  "]) for _ in range(rng.randint(0, 80))) for _ in range(300)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: tuple(r["counts"][c] for c in COUNTS) for r in with_counts(df).collect()}
    for i, text in enumerate(texts):
        assert got[i] == _plain(text), repr(text)


def _corpus():
    rng = random.Random(3)
    rows, labels = [], []
    for i in range(1200):
        words = ["w%d" % rng.randrange(5000) for _ in range(rng.randint(60, 200))]
        kind = rng.choice(["good"] * 7 + ["shout", "marks"])
        if kind == "shout":
            words = [w.upper() + "!!" for w in words]
        if kind == "marks":
            words = [w + rng.choice(["###", "$$$"]) for w in words]
        rows.append((i, " ".join(words)))
        labels.append((i, int((kind == "good") != (rng.random() < 0.04)), kind))
    return rows, labels


def test_rules_tell_what_they_were_not_shown(spark):
    rows, labels = _corpus()
    # Many copies of one good text, marked bad: one vote, so no rule is made of them.
    copies = [(5000 + i, rows[0][1] + " copy%d" % i) for i in range(200)]
    df = spark.createDataFrame([(i, t, "k", 3) for i, t in rows + copies], "doc_id long, text string, kept string, counts int")
    known = [(i, q) for i, q, _ in labels if i < 800] + [(i, 0) for i, _ in copies] + [(2, None), (None, 0)]
    rules = learn_rules(df, spark.createDataFrame(known, "doc_id long, quality int"))
    assert 1 <= len(rules) <= 6 and all(1 <= len(r.tests) <= 3 and r.precision >= 0.75 for r in rules)
    scored = with_verdict(df, rules)
    assert sorted(scored.columns) == ["base_failed", "counts", "doc_id", "kept", "rule", "text"]
    kept = {r["doc_id"]: r["kept"] for r in scored.select("doc_id", "kept").collect()}
    good = [kept[i] for i, _, kind in labels if i >= 800 and kind == "good"]
    bad = [kept[i] for i, _, kind in labels if i >= 800 and kind != "good"]
    assert sum(good) >= 0.98 * len(good) and sum(bad) <= 0.05 * len(bad)
    plan = scored._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Arrow", "Pandas"))


def test_base_and_nothing_to_learn(spark):
    df = spark.createDataFrame([(1, "a " * 49), (2, " ".join(map(str, range(50)))), (3, "a b c " * 60), (4, None), (4, None)],
                               "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert learn_rules(df, none) == []
    got = with_verdict(df, []).orderBy("doc_id").select("base_failed", "kept").collect()
    assert [tuple(r) for r in got] == [(True, False), (False, True), (True, False), (True, False), (True, False)]
    assert learn_rules(df, spark.createDataFrame([(2, 1)], "doc_id long, quality int")) == []
    assert with_verdict(df.where(F.lit(False)), []).count() == 0
