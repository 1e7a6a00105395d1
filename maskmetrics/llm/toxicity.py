"""Toxic passages: maximal scoring segments of word log-odds, judged by extreme-value odds."""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from maskmetrics.llm.common import byte_texts, key_remainder, labelled_keys, sent_with_text, text_slices
from maskmetrics.llm.words import ALPHANUMERIC, hashed_words, mix, runs
from maskmetrics.operators.lookup import salted_join
from maskmetrics.session import settle, ship

# Bounds of what is learned: labelled rows, and words with a weight.
MOST_LABELS = 200_000
MOST_WEIGHTS = 50_000
STEM = 4
SKETCHES = 5
PLACES = 20
# A word that opens with a stem is told from the stem itself.
_STEM_SALT = np.uint64(0x5851F42D4C957F2D)


def word_and_stem_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of all words, of their first ``STEM`` bytes, and the number of words per text."""
    words, counts = hashed_words(texts, ALPHANUMERIC)
    flat = np.frombuffer(b"\n".join(t.translate(ALPHANUMERIC) for t in texts) + b"\n" * (STEM + 1), np.uint8)
    inside = (flat != 32) & (flat != 10)
    starts = np.flatnonzero(np.diff(inside.view(np.int8), prepend=np.int8(0)) == 1)
    stem, open_ = np.zeros(len(starts), np.uint64), np.ones(len(starts), np.bool_)
    for i in range(STEM):
        open_ &= inside[starts + i]
        stem = (stem << np.uint64(8)) | np.where(open_, flat[starts + i], 0).astype(np.uint64)
    return words, mix(stem ^ _STEM_SALT), counts


@dataclass(frozen=True)
class Model:
    """Weights of the words and stems that tell, and what turns segment scores into odds."""

    hashes: np.ndarray
    weights: np.ndarray
    drift: float
    decay: float
    offset: float = 0.0
    slope: float = 0.0

    def token_weights(self, hashes: np.ndarray, places: np.ndarray) -> np.ndarray:
        """The weight of each hash; 0 for those without one."""
        out = np.zeros(len(hashes))
        if len(self.hashes):
            near = np.flatnonzero(places[(hashes >> np.uint64(64 - PLACES)).astype(np.int64)])
            at = np.minimum(np.searchsorted(self.hashes, hashes[near]), len(self.hashes) - 1)
            out[near] = np.where(self.hashes[at] == hashes[near], self.weights[at], 0.0)
        return out

    def places(self) -> np.ndarray:
        places = np.zeros(1 << PLACES, np.bool_)
        places[(self.hashes >> np.uint64(64 - PLACES)).astype(np.int64)] = True
        return places


def maximal_segments(at: list[int], weights: list[float], drift: float) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (start, end, score) in linear time.

    Place ``at[i]`` scores ``weights[i]`` > 0, every place between scores ``drift`` < 0. A
    segment is kept if no longer one around it and no part of it scores more. Each candidate
    knows the last one that begins lower, so every candidate is passed over once.
    """
    found: list[list] = []  # start, end, sum before, sum after, last one that begins lower
    total, last = 0.0, -1
    for place, weight in zip(at, weights):
        total += drift * (place - last - 1)
        start, before, after = place, total, total + weight
        total, last = after, place
        lower = len(found) - 1
        while True:
            while lower >= 0 and found[lower][2] >= before:
                lower = found[lower][4]
            if lower < 0 or found[lower][3] >= after:
                found.append([start, place + 1, before, after, lower])
                break
            start, before = found[lower][0], found[lower][2]
            below = found[lower][4]
            del found[lower:]
            lower = below
    return [(f[0], f[1], f[3] - f[2]) for f in found]


def surprise(score: float, words: int, decay: float) -> float:
    """-log of the odds that clean text of so many words has a segment of this score or more."""
    if score <= 0 or not words:
        return 0.0
    expected = words * math.exp(-decay * score)
    return -math.log(-math.expm1(-expected)) if expected > 1e-12 else decay * score - math.log(words)


_SCORED = T.StructType([
    T.StructField("surprise", T.DoubleType(), False),
    T.StructField("passages", T.ArrayType(T.StructType([
        T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType()), T.StructField("score", T.DoubleType())])))])
_PASSAGES = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64())]))


def with_passages(df: DataFrame, model: Model, text: str = "text", significance: float = 0.05) -> DataFrame:
    """Add ``surprise`` of the best segment and ``passages``: all significant ones, in words."""
    spark = df.sparkSession
    ship(spark)
    shared = spark.sparkContext.broadcast(model)
    kept = [c for c in df.columns if c not in ("surprise", "passages")]
    sent, at_text = sent_with_text(df, kept, text)
    least = -math.log(significance)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        places = model.places()
        for batch in text_slices(batches, at_text):
            words, stems, counts = word_and_stem_hashes(byte_texts(batch.column(at_text)))
            weights = np.maximum(model.token_weights(words, places), model.token_weights(stems, places))
            at = np.flatnonzero(weights > 0)
            first = np.cumsum(counts) - counts
            cuts = np.searchsorted(at, np.append(first, len(words)))
            odds, passages = np.zeros(len(counts)), [[] for _ in range(len(counts))]
            for i in np.flatnonzero(np.diff(cuts)):
                some = at[cuts[i]:cuts[i + 1]]
                found = maximal_segments((some - first[i]).tolist(), weights[some].tolist(), model.drift)
                judged = [(surprise(s, int(counts[i]), model.decay), a, b, s) for a, b, s in found]
                odds[i] = max(j[0] for j in judged)
                passages[i] = [{"start": a, "end": b, "score": s} for j, a, b, s in judged if j >= least]
            yield pa.RecordBatch.from_arrays([*batch.columns[:len(kept)], pa.array(odds), pa.array(passages, _PASSAGES)],
                                             names=[*kept, "surprise", "passages"])

    schema = T.StructType([*df.select(*kept).schema.fields, *_SCORED.fields])
    return sent.mapInArrow(run, schema)


def _sketches(rows: DataFrame) -> DataFrame:
    """(key, toxic, sketch): least hashes of three-word runs, alike in texts that are alike."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches, 2):
            words, counts = hashed_words(byte_texts(batch.column(2)), ALPHANUMERIC)
            first = np.cumsum(counts) - counts
            three = np.concatenate([runs(words, 3), words[-2:]]) if len(words) > 2 else words
            some = np.flatnonzero(counts)
            columns = []
            for i in range(SKETCHES):
                least = np.zeros(len(counts), np.int64)
                if len(some):
                    least[some] = np.minimum.reduceat(mix(three ^ np.uint64(7919 * i + 1)), first[some]).view(np.int64)
                columns.append(pa.array(least))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *columns],
                                             names=["key", "toxic", *(f"s{i}" for i in range(SKETCHES))])

    return rows.mapInArrow(run, "key long, toxic int, " + ", ".join(f"s{i} long" for i in range(SKETCHES)))


def _weighted(rows: DataFrame) -> DataFrame:
    """(key, toxic, share): alike texts share the weight of one, so copies do not vote."""
    sketched = settle(_sketches(rows), "sketches")
    alike = sketched.select("key", F.posexplode(F.array(*(f"s{i}" for i in range(SKETCHES)))).alias("i", "s"))
    sizes = alike.groupBy("i", "s").agg(F.count("*").alias("n"))
    middle = F.sort_array(F.collect_list("n"))[SKETCHES // 2]
    # At most SKETCHES sizes per row of the bounded labelled set.
    per_key = salted_join(alike, sizes, ["i", "s"], F.col("key"), "inner").groupBy("key").agg(middle.alias("n"))
    return settle(sketched.select("key", "toxic").distinct().join(per_key, "key")
                  .select("key", "toxic", (1 / F.col("n")).alias("share")), "weighted")


def _word_sums(rows: DataFrame) -> DataFrame:
    """(hash, toxic, clean): the summed shares of the labelled texts that hold a word or stem."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches, 2):
            words, stems, counts = word_and_stem_hashes(byte_texts(batch.column(2)))
            owner = np.repeat(np.arange(len(counts)), counts)
            toxic, share = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            hashes, code = np.unique(np.concatenate([words, stems]), return_inverse=True)
            pairs = np.unique(code.astype(np.int64) * len(counts) + np.concatenate([owner, owner]))
            code, owner = pairs // max(1, len(counts)), pairs % max(1, len(counts))
            sums = [np.bincount(code, weights=share[owner] * (toxic[owner] == t), minlength=len(hashes)) for t in (1, 0)]
            yield pa.RecordBatch.from_arrays([pa.array(hashes.view(np.int64)), *map(pa.array, sums)],
                                             names=["hash", "toxic", "clean"])

    return rows.mapInArrow(run, "hash long, toxic double, clean double").groupBy("hash").agg(
        F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))


def _logistic(x: np.ndarray, toxic: np.ndarray, clean: np.ndarray, ridge: float = 1e-2) -> tuple[float, float]:
    """Offset and slope of the odds of a label, from counts per value; Newton steps, slope >= 0."""
    beta = np.zeros(2)
    design = np.stack([np.ones_like(x), x], axis=1)
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(design @ beta, -30, 30)))
        slope = design.T @ (toxic - (toxic + clean) * p) - ridge * beta
        bend = (design * ((toxic + clean) * p * (1 - p))[:, None]).T @ design + ridge * np.eye(2)
        step = np.linalg.solve(bend, slope)
        beta = beta + np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-9:
            break
    return float(beta[0]), float(max(beta[1], 0.0))


def fit(df: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic",
        held_out: Column | None = None, prior: float = 0.05) -> Model:
    """Learn a model from the labelled texts that ``held_out``, a test of the key, leaves.

    At most MOST_LABELS labelled keys are used; keys with two labels are not. A word counts
    once per text; alike texts share one vote. The weight of a word is its log-odds between
    toxic and clean texts with a Dirichlet prior of ``prior`` of the corpus, shaped as the
    corpus; only words and stems whose likelihood ratio stands out of as many trials as there
    are words get one. All other words score the small negative log-odds of an unmarked word.
    The decay of the extreme-value law solves E exp(decay * score) = 1 on clean text.
    Without labels of both kinds nothing gets a weight.
    """
    chosen = settle(labelled_keys(labels, key, label, held_out, MOST_LABELS).select("key", F.col("label").alias("toxic")), "labels")
    ship(df.sparkSession)

    def texts(names: DataFrame, *columns: str) -> DataFrame:
        # At most MOST_LABELS keys.
        return df.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text")).join(
            F.broadcast(names.withColumn("key", F.col("key").cast("long"))), "key").select(*columns, "text")

    weighted = _weighted(texts(chosen, "key", "toxic"))
    sums = settle(_word_sums(texts(weighted, "toxic", "share")), "word-sums")
    total = sums.agg(F.sum("toxic").alias("t"), F.sum("clean").alias("c"), F.count("*").alias("n")).first()
    t, c, n = total["t"] or 0.0, total["c"] or 0.0, total["n"]
    empty = Model(np.zeros(0, np.uint64), np.zeros(0), -0.01, 1.0)
    if t > 0 and c > 0:
        share = t / (t + c)
        both = F.col("toxic") + F.col("clean")
        ratio = 2 * sum(F.when(F.col(k) > 0, F.col(k) * F.log(F.col(k) / (both * s))).otherwise(0.0)
                        for k, s in (("toxic", share), ("clean", 1 - share)))
        bar = (math.sqrt(2 * math.log(max(n, 2))) + 1) ** 2
        room, alpha = prior * (t + c), both * prior
        odds = (F.log((F.col("toxic") + alpha) / (t + room - F.col("toxic") - alpha))
                - F.log((F.col("clean") + alpha) / (c + room - F.col("clean") - alpha)))
        told = (sums.where((F.col("toxic") > both * share) & (ratio > bar)).select("hash", odds.alias("weight"), "toxic", "clean", ratio.alias("ratio"))
                .where("weight > 0").orderBy(F.desc("ratio"), "hash").limit(MOST_WEIGHTS).toArrow())
        if told.num_rows:
            hashes = told.column("hash").to_numpy().view(np.uint64)
            weights = told.column("weight").to_numpy()
            order = np.argsort(hashes)
            # Shares of marked words among all words of toxic and of clean texts.
            ft = min(0.5, (told.column("toxic").to_numpy().sum() + 0.5) / (t + 1))
            fc = min(ft / 2, (told.column("clean").to_numpy().sum() + 0.5) / (c + 1))
            drift = math.log((1 - ft) / (1 - fc))
            empty = Model(hashes[order], weights[order], drift, _decay(fc, float(weights.mean()), drift))
    found = with_passages(texts(weighted, "toxic", "share"), empty)
    bins = found.groupBy((F.least(F.col("surprise"), F.lit(50.0)) * 4).cast("int").alias("bin"), "toxic").agg(
        F.sum("share").alias("n")).toArrow().to_pylist()
    values = sorted({b["bin"] for b in bins})
    counts = np.zeros((2, len(values)))
    for b in bins:
        counts[b["toxic"], values.index(b["bin"])] += b["n"]
    offset, slope = _logistic((np.array(values) + 0.5 * (np.array(values) > 0)) / 4, counts[1], counts[0]) if bins else (0.0, 0.0)
    return Model(empty.hashes, empty.weights, empty.drift, empty.decay, offset, slope)


def _decay(share: float, weight: float, drift: float) -> float:
    """The positive root of share * e^(r * weight) + (1 - share) * e^(r * drift) = 1."""
    low, high = 1e-9, 50.0
    for _ in range(200):
        middle = (low + high) / 2
        value = share * math.exp(min(700.0, middle * weight)) + (1 - share) * math.exp(middle * drift)
        low, high = (middle, high) if value < 1 else (low, middle)
    return max(low, 1e-3)


def with_toxicity(df: DataFrame, model: Model, text: str = "text", score: str = "score") -> DataFrame:
    """Add ``score`` (0 to 1: the odds of the label) and ``passages`` (start, end, score in words).

    Null, empty and unmarked texts get the odds of a text without a marked word and no
    passage. One row out per row in; other columns are carried along, those with the new
    names are replaced. An empty table gives an empty result.
    """
    found = with_passages(df, model, text)
    odds = 1 / (1 + F.exp(-(model.offset + model.slope * F.least(F.col("surprise"), F.lit(50.0)))))
    return found.withColumn(score, odds).drop("surprise")


def held_out_key(key: str = "doc_id", folds: int = 5) -> Column:
    return key_remainder(key, folds) == 0
