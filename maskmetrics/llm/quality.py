"""Quality rules: an ordered list of threshold conjunctions, learned with DataFrame functions only."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from maskmetrics.llm.common import BLANKS, labelled_keys
from maskmetrics.session import settle

# Labelled rows that are learned from, at most; cuts tried per measure; size of a rule list.
MOST_LABELS = 200_000
CUTS = 32
MOST_RULES = 12
MOST_TESTS = 3
# A rule must be right this often on rows it was not grown on, and hold this share of the bad rows.
LEAST_PRECISION = 0.75
LEAST_SHARE = 0.005

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
MEASURES = ("words", "word_length", "symbols_per_word", "dup_lines_per_line", "repeats_per_word", "capitals_per_char",
            "calls_per_word", "digits_per_char")


def with_counts(df: DataFrame, text: str = "text") -> DataFrame:
    """Add a struct ``counts`` of whole-text counts; all columns of ``df`` stay as they are.

    Words are runs of characters other than the six ASCII blanks. word_chars: code points in
    words. n_symbols: characters of ``#*$%&|<>``. n_dup_lines: lines with a word that equal an
    earlier line. n_repeat_words: words in three-word windows that occur twice or more in the
    text (windows are compared by a 64-bit hash of their words). A null text counts as empty,
    and an empty one has zero of everything.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    # Words, windows and sorted windows are columns of their own: each is made once per row.
    step = df.select(F.struct("*").alias("row"), body.alias("body"))
    step = step.withColumn("words", F.array_remove(F.split("body", f"[{BLANKS}]+"), ""))
    step = step.withColumn("lines", F.filter(F.split("body", "\n"), lambda x: x.rlike(f"[^{BLANKS}]")))
    three = F.transform(F.slice("words", 1, F.greatest(F.size("words") - 2, F.lit(0))),
                        lambda w, i: F.xxhash64(w, F.get("words", i + 1), F.get("words", i + 2)))
    step = step.withColumn("grams", three)
    step = step.withColumn("sorted", F.when(
        F.size(F.array_distinct("grams")) < F.size("grams"),
        F.sort_array(F.transform("grams", lambda g, i: F.struct(g.alias("g"), i.alias("i"))))))
    again = F.filter("sorted", lambda x, i: (x["g"] == F.get("sorted", i + 1)["g"]) | (x["g"] == F.get("sorted", i - 1)["g"]))
    step = step.withColumn("again", again)
    covered = F.size(F.array_distinct(F.flatten(F.transform("again", lambda x: F.array(x["i"], x["i"] + 1, x["i"] + 2)))))
    # Exploded from a list of one: a filter on the counts then stays above this step. Pushed
    # below, it would make every count anew for each place that names it.
    return step.select("row.*", F.explode(F.array(F.struct(
        F.size("words").cast("long").alias("n_words"),
        F.char_length(F.array_join("words", "")).cast("long").alias("word_chars"),
        F.regexp_count("body", F.lit("[#*$%&|<>]")).cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.when(F.col("sorted").isNull(), F.lit(0)).otherwise(covered).cast("long").alias("n_repeat_words"),
        F.size("lines").cast("long").alias("n_lines"),
        F.regexp_count("body", F.lit(r"\p{Lu}")).cast("long").alias("n_capitals"),
        F.regexp_count("body", F.lit("[!?]")).cast("long").alias("n_calls"),
        F.regexp_count("body", F.lit("[0-9]")).cast("long").alias("n_digits"),
        F.coalesce(F.array_min("grams"), F.lit(0)).alias("least_gram"),
        F.coalesce(F.array_max("grams"), F.lit(0)).alias("last_gram")))).alias("counts"))


def measures() -> dict[str, Column]:
    """What rules test, from ``counts``; a share of nothing is 0."""
    def share(a: str, b: str) -> Column:
        return F.coalesce(F.col(f"counts.{a}") / F.nullif(F.col(f"counts.{b}"), F.lit(0)), F.lit(0.0))

    return dict(zip(MEASURES, (
        F.col("counts.n_words").cast("double"), share("word_chars", "n_words"), share("n_symbols", "n_words"),
        share("n_dup_lines", "n_lines"), share("n_repeat_words", "n_words"), share("n_capitals", "word_chars"),
        share("n_calls", "n_words"), share("n_digits", "word_chars"))))


@dataclass(frozen=True)
class Test:
    measure: str
    at_least: bool
    cut: float

    def column(self) -> Column:
        value = measures()[self.measure]
        return value >= self.cut if self.at_least else value < self.cut

    def __str__(self) -> str:
        return f"{self.measure} {'>=' if self.at_least else '<'} {self.cut:.6g}"


@dataclass(frozen=True)
class Rule:
    tests: tuple[Test, ...]
    precision: float

    def column(self) -> Column:
        return reduce(Column.__and__, (t.column() for t in self.tests))

    def __str__(self) -> str:
        return " and ".join(map(str, self.tests))


def base_failed() -> Column:
    """Fewer than 50 words, or over half of them in repeated windows."""
    return (F.col("counts.n_words") < 50) | (100 * F.col("counts.n_repeat_words") > 50 * F.col("counts.n_words"))


def with_verdict(df: DataFrame, rules: Sequence[Rule], text: str = "text") -> DataFrame:
    """Add ``counts``, ``base_failed``, ``rule`` (the first rule that holds, or null) and ``kept``.

    One row out per row in; columns of these names are replaced, all others kept.
    """
    new = ("counts", "base_failed", "rule", "kept")
    counted = with_counts(df.select(*(c for c in df.columns if c not in new[1:])).drop("counts"), text)
    first = F.lit(None).cast("string")
    for rule in reversed(rules):
        first = F.when(rule.column(), F.lit(str(rule))).otherwise(first)
    return counted.withColumn("base_failed", base_failed()).withColumn("rule", first).withColumn(
        "kept", ~F.col("base_failed") & F.col("rule").isNull())


def _cell_table(df: DataFrame, labels: DataFrame, key: str, text: str, label: str) -> tuple[DataFrame, dict[str, list[float]]]:
    """Labelled rows as counts per cell of cut measures, and the cuts of each measure.

    Rows that share the least or the last three-word window are likely copies; they share one
    vote and one side of the split into rows to grow and rows to prune on.
    """
    chosen = settle(labelled_keys(labels, key, label, None, MOST_LABELS), "labels")
    # At most MOST_LABELS keys.
    rows = df.select(F.col(key).alias("key"), text).join(F.broadcast(chosen), "key")
    # What the base counts reject needs no rule.
    stats = settle(with_counts(rows, text).where(~base_failed()).select(
        (F.col("label") == 0).alias("bad"), "counts.least_gram", "counts.last_gram",
        *(m.alias(name) for name, m in measures().items())), "measures")
    firsts, lasts = (stats.groupBy(c).agg(F.count("*").alias(f"{c}_n")) for c in ("least_gram", "last_gram"))
    stats = stats.join(firsts, "least_gram").join(lasts, "last_gram").withColumn(
        "vote", 1 / F.least("least_gram_n", "last_gram_n"))
    places = [i / CUTS for i in range(1, CUTS)]
    asked = stats.agg(*(F.percentile_approx(m, places, 10_000).alias(m) for m in MEASURES)).first()
    cuts = {m: sorted(set(asked[m] or ())) for m in MEASURES}
    # Values above zero may be rare: then the least of them is a cut too.
    above = stats.agg(*(F.min(F.when(F.col(m) > 0, F.col(m))).alias(m) for m in MEASURES)).first()
    for m in MEASURES:
        if above[m] is not None:
            cuts[m] = sorted({*cuts[m], above[m]})

    def cell(m: str) -> Column:
        out = F.lit(0)
        for i, cut in enumerate(cuts[m]):
            out = F.when(F.col(m) >= cut, F.lit(i + 1)).otherwise(out)
        return out

    cells = stats.select("bad", "vote", (F.pmod("least_gram", F.lit(3)) == 0).alias("prune"), *(cell(m).alias(m) for m in MEASURES))
    return settle(cells.groupBy("bad", "prune", *MEASURES).agg(F.sum("vote").alias("n")), "cells"), cuts


def learn_rules(df: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text",
                label: str = "quality") -> list[Rule]:
    """Rules for rows with label 0 that the base counts keep; [] where nothing can be learned.

    One rule after the other is grown on two thirds of the labelled rows: of all measures and
    cuts the test with the highest information gain is added while it helps. The rule is then
    pruned on the other third: it keeps the leading tests that are right most clearly there.
    A rule that is right in LEAST_PRECISION of its rows joins the list, and the rows it covers
    leave; the first that is not ends the list. Each step is one aggregation of the cell
    counts; only sums per measure and cut reach the driver.
    """
    cells, cuts = _cell_table(df, labels, key, text, label)
    stacked = F.explode(F.array(*(F.struct(F.lit(m).alias("measure"), F.col(m).alias("cell")) for m in MEASURES)))

    def holds(tests: Sequence[tuple[str, bool, int]]) -> Column:
        return reduce(Column.__and__, ((F.col(m) >= i if up else F.col(m) < i) for m, up, i in tests), F.lit(True))

    def totals(rows: DataFrame) -> tuple[float, float]:
        got = rows.agg(F.sum(F.when(F.col("bad"), F.col("n"))).alias("bad"), F.sum(F.when(~F.col("bad"), F.col("n"))).alias("good")).first()
        return got["bad"] or 0.0, got["good"] or 0.0

    def best_test(rows: DataFrame, bad: float, good: float, least: float) -> tuple[tuple[str, bool, int], float, float] | None:
        sums = rows.select("bad", "n", stacked.alias("at")).groupBy("at.measure", "at.cell", "bad").agg(F.sum("n").alias("n"))
        held: dict[str, dict[tuple[int, bool], float]] = {}
        for r in sums.collect():
            held.setdefault(r["measure"], {})[r["cell"], r["bad"]] = r["n"]
        best, gain = None, 1e-6
        for m in MEASURES:
            below = [0.0, 0.0]
            for i in range(1, len(cuts[m]) + 1):
                below[0] += held.get(m, {}).get((i - 1, True), 0.0)
                below[1] += held.get(m, {}).get((i - 1, False), 0.0)
                for up, (p, n) in ((True, (bad - below[0], good - below[1])), (False, tuple(below))):
                    if p < least or p <= 0:
                        continue
                    new = p * (math.log2(p / (p + max(n, 0.0))) - math.log2(bad / (bad + good)))
                    if new > gain + 1e-9:
                        best, gain = ((m, up, i), p, max(n, 0.0)), new
        return best

    rules: list[Rule] = []
    rest = cells
    everything = totals(cells)[0]
    for _ in range(MOST_RULES):
        grow, prune = rest.where("not prune"), rest.where("prune")
        bad, good = totals(grow)
        tests: list[tuple[str, bool, int]] = []
        while len(tests) < MOST_TESTS and bad > 0 and good > 0.01 * bad:
            found = best_test(grow.where(holds(tests)), bad, good, max(2.0, LEAST_SHARE * everything))
            if not found or (tests and found[1] / (found[1] + found[2]) < bad / (bad + good) + 0.01):
                break
            tests.append(found[0])
            bad, good = found[1], found[2]
        judged = []
        for n in range(1, len(tests) + 1):
            p, q = totals(prune.where(holds(tests[:n])))
            judged.append(((p - q) / (p + q + 1), (p + 0.5) / (p + q + 1), p, n))
        if not judged:
            break
        _, precision, p, n = max(judged, key=lambda j: (j[0], -j[3]))
        if precision < LEAST_PRECISION or p < 1:
            break
        rules.append(Rule(tuple(Test(m, up, cuts[m][i - 1]) for m, up, i in tests[:n]), precision))
        rest = rest.where(~holds(tests[:n]))
    return rules
