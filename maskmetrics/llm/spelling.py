"""Words that differ by one character: near pairs by variable-length grams, and the form each word goes back to."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from maskmetrics.operators.lookup import salted_join
from maskmetrics.session import settle, ship

# Marks at both ends of a word, so that its ends stand in as many grams as its middle.
BEGIN, END = "\u0002", "\u0003"
# Grams have 2 to 4 code points. One edit touches at most 4 of the n + 1 grams of a word of n.
SHORTEST, LONGEST = 2, 4
# A gram in more places than this is made longer; doubled until the frequent grams number at most MOST_FREQUENT,
# which every task holds. Any bar gives the same pairs.
FREQUENT = 32
MOST_FREQUENT = 200_000
# Forms at least double n with each step, so a chain in 64-bit counts has less than 2^6 steps.
DOUBLINGS = 6


def _gram_counts(words: DataFrame) -> DataFrame:
    """(gram, n): in how many places of all words each gram of SHORTEST to LONGEST - 1 stands."""
    padded = words.select(F.concat(F.lit(BEGIN), "word", F.lit(END)).alias("w"))
    size = F.char_length("w")
    some = F.flatten(F.transform(F.sequence(F.lit(1), size - (SHORTEST - 1)), lambda p: F.transform(
        F.sequence(F.lit(SHORTEST), F.least(F.lit(LONGEST - 1), size - p + 1)), lambda q: F.substring(F.col("w"), p, q))))
    return padded.select(F.explode(some).alias("gram")).groupBy("gram").agg(F.count("*").alias("n"))


def frequent_grams(words: DataFrame, bar: int = FREQUENT) -> set[str]:
    """The grams that are made longer, at most MOST_FREQUENT: those in more than ``bar`` places, or a doubled bar."""
    counts = settle(_gram_counts(words).where(F.col("n") > bar), "grams")
    steps = counts.groupBy(F.floor(F.log2((F.col("n") - 1) / bar)).cast("int").alias("step")).agg(F.count("*").alias("n"))
    sizes = {r["step"]: r["n"] for r in steps.collect()}
    step = 0
    while sum(n for s, n in sizes.items() if s >= step) > MOST_FREQUENT:
        step += 1
    return set(counts.where(F.col("n") > bar * 2 ** step).select("gram").toArrow().column("gram").to_pylist())


def variable_grams(word: str, frequent: set[str]) -> list[tuple[int, str]]:
    """The gram of each place of the marked word: the shortest that is not frequent, LONGEST at most."""
    marked = BEGIN + word + END
    found = []
    for p in range(len(marked) - SHORTEST + 1):
        end = p + SHORTEST
        while end - p < LONGEST and end < len(marked) and marked[p:end] in frequent:
            end += 1
        found.append((p, marked[p:end]))
    return found


def most_affected(grams: list[tuple[int, str]]) -> int:
    """How many grams one edit can change at most: those that stand over one place.

    A gram is found from its own characters alone, so an edit leaves alone all grams that end
    before it or begin after it.
    """
    over = [0] * (max((p + len(g) for p, g in grams), default=0) + 1)
    for p, gram in grams:
        over[p] += 1
        over[p + len(gram)] -= 1
    most = now = 0
    for step in over:
        now += step
        most = max(most, now)
    return most


def _decomposed(words: DataFrame, frequent: set[str]) -> DataFrame:
    """(word, n, gram, place, opened): all grams of each word, and how many of its lists must be opened."""
    shared = words.sparkSession.sparkContext.broadcast(frequent)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in batches:
            rows, grams, places, opened = [], [], [], []
            for i, word in enumerate(batch.column(0).to_pylist()):
                found = variable_grams(word, known)
                rows += [i] * len(found)
                grams += [g for _, g in found]
                places += [p for p, _ in found]
                opened += [most_affected(found) + 1] * len(found)
            at = pa.array(rows, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(at), batch.column(1).take(at), pa.array(grams, pa.string()), pa.array(places, pa.int32()),
                 pa.array(opened, pa.int32())], names=["word", "n", "gram", "place", "opened"])

    return words.select("word", "n").mapInArrow(run, "word string, n long, gram string, place int, opened int")


def near_pairs(words: DataFrame) -> DataFrame:
    """(a, a_n, b, b_n), a < b: all pairs of ``words`` (word, n; distinct, LONGEST code points or more) one edit apart.

    Each place of a word has one gram of a dictionary in which frequent grams are replaced by
    longer ones. One edit changes at most ``most_affected`` grams of a word; all others stand in
    both words. So if the grams of each word are ranked by the length of their lists, rarest first, two near words
    share one of the first ``most_affected`` + 1 of both: only those lists are opened. A gram that
    the edit leaves alone lies wholly before or behind it, so the words also agree from their
    begin up to the end of the gram, or from the begin of the gram to their end: lists are cut by
    that context, and by length: a word meets those of its own length and one less. Each met pair
    is verified by its edit distance.
    """
    ship(words.sparkSession)
    held = settle(_decomposed(words, frequent_grams(words)), "word-grams")
    lists = held.groupBy("gram").agg(F.count("*").alias("list"))
    ranked = salted_join(held, lists, ["gram"], F.struct("word", "place"), "inner").groupBy("word", "n", "opened").agg(
        F.array_sort(F.collect_list(F.struct("list", "gram", "place"))).alias("grams"))
    marked = F.concat(F.lit(BEGIN), "word", F.lit(END))
    contexts = F.flatten(F.transform(F.slice("grams", F.lit(1), F.col("opened")), lambda g: F.array(
        F.concat(F.lit("<"), F.substring(marked, F.lit(1), g["place"] + F.char_length(g["gram"]))),
        F.concat(F.lit(">"), F.substring(marked, g["place"] + 1, F.char_length(marked))))))
    keyed = settle(ranked.select("word", "n", F.explode(F.array_distinct(contexts)).alias("context")), "word-contexts")
    shared = keyed.groupBy("context").agg(F.count("*").alias("m")).where("m > 1").select("context")
    open_ = keyed.join(shared, "context").withColumn("size", F.char_length("word"))
    long = open_.select("context", "size", F.col("word").alias("x"), F.col("n").alias("x_n"))
    short = open_.select("context", F.explode(F.array("size", F.col("size") + 1)).alias("size"),
                         F.col("word").alias("y"), F.col("n").alias("y_n"), F.col("size").alias("y_size"))
    met = long.join(short, ["context", "size"]).where(
        ((F.col("size") > F.col("y_size")) | (F.col("x") < F.col("y"))) & (F.levenshtein("x", "y", 1) == 1))
    first, second = F.struct(F.col("x").alias("w"), F.col("x_n").alias("n")), F.struct(F.col("y").alias("w"), F.col("y_n").alias("n"))
    pair = met.select(F.least(first, second).alias("p"), F.greatest(first, second).alias("q"))
    return pair.select(F.col("p.w").alias("a"), F.col("p.n").alias("a_n"), F.col("q.w").alias("b"), F.col("q.n").alias("b_n")).distinct()


def word_counts(runs: DataFrame, word: str = "word") -> DataFrame:
    """(word, n) over all rows of ``runs``; null words are left out."""
    return runs.where(F.col(word).isNotNull()).groupBy(F.col(word).alias("word")).agg(F.count("*").alias("n"))


def spelling_forms(counts: DataFrame, least_length: int = 6, least_count: int = 5, factor: int = 5) -> DataFrame:
    """(word, n, n_near, form, form_n, root) for every word of ``counts`` (word, n; distinct words).

    Only words of ``least_length`` code points and ``least_count`` occurrences take part. ``form`` is the most
    frequent near word (one edit apart; ties: the smallest in code-point order) if it occurs ``factor`` times as often or
    more, else null; ``root`` is where the forms lead from a word, itself if it has none. Further
    columns of ``counts`` are left out; an empty table gives an empty result.
    """
    if least_length < LONGEST or factor < 2 or least_count < 1:
        raise ValueError("words need as many code points as the longest gram, a count, and forms that occur twice as often")
    chosen = counts.select("word", F.col("n").cast("long").alias("n")).where((F.char_length("word") >= least_length) & (F.col("n") >= least_count))
    words = settle(chosen, "spelled-words")
    pairs = settle(near_pairs(words), "near-words")
    both = pairs.select(F.col("a").alias("word"), F.struct((-F.col("b_n")).alias("less"), F.col("b").alias("form")).alias("near")).unionByName(
        pairs.select(F.col("b").alias("word"), F.struct((-F.col("a_n")).alias("less"), F.col("a").alias("form")).alias("near")))
    best = both.groupBy("word").agg(F.count("*").alias("n_near"), F.min("near").alias("near"))
    known = words.join(best, "word", "left")
    good = -F.col("near.less") >= factor * F.col("n")
    formed = settle(known.select(
        "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(good, F.col("near.form")).alias("form"),
        F.when(good, -F.col("near.less")).alias("form_n")), "word-forms")
    led = formed.where("form is not null").select("word", F.col("form").alias("root"))
    for _ in range(DOUBLINGS):
        step = led.select(F.col("word").alias("root"), F.col("root").alias("next"))
        led = settle(salted_join(led, step, ["root"], F.col("word")).select("word", F.coalesce("next", "root").alias("root")), "word-roots")
    return formed.join(led, "word", "left").select("word", "n", "n_near", "form", "form_n", F.coalesce("root", "word").alias("root"))
