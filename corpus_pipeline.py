"""From raw documents to token ids: five stages, each written as Parquet and read again.

Quality rules and toxicity drop the rows that they reject, near-duplicate groups keep one row,
documents that hold a benchmark window go, and what is left is encoded. Every stage works on
all that the stage before it kept, with the parameters of the operator's own query. A stage takes
its labels and benchmark items from the tables in ``sf_dir``.
"""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from maskmetrics.llm.bpe import encode_texts
from maskmetrics.llm.common import table
from maskmetrics.llm.decontamination import without_contaminated
from maskmetrics.llm.quality import learn_rules, with_verdict
from maskmetrics.llm.simhash import keep_one
from maskmetrics.llm.toxicity import fit, held_out_key, with_toxicity
from maskmetrics.session import scratch_root

# The decisions need learned rules, segments, hashes and merges: SQL cannot say them. The tests
# compare the stages with brute-force versions instead.
ORACLE_SQL = None


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The rows that neither the base counts nor a learned rule rejects."""
    rules = learn_rules(docs, table(spark, sf_dir, "labels"))
    return with_verdict(docs, rules).where("kept").select(*docs.columns)


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The rows whose odds of a toxic label are below one half."""
    model = fit(docs, table(spark, sf_dir, "labels"), held_out=held_out_key())
    return with_toxicity(docs, model, score="_odds").where("_odds < 0.5").select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of linked fingerprints (three words, 2 bits): that with the smallest doc_id."""
    return keep_one(docs, width=3, distance=2)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The rows without a ten-word window of a benchmark item."""
    return without_contaminated(docs, table(spark, sf_dir, "benchmark"))


def byte_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids (little-endian unsigned 32-bit) of each kept text, and that they decode to it."""
    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    coded = encode_texts(docs.select("doc_id", "lang", "source", "text"), ranks, public_tokenizers.PATTERN, decoded="decoded")
    return coded.select(
        "doc_id", "lang", "source", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), "ids",
        (F.col("decoded") == F.coalesce(F.col("text"), F.lit("")).cast("binary")).alias("round_trip"))


STAGES = [("quality", quality), ("toxicity", toxicity), ("near_duplicates", near_duplicates),
          ("decontamination", decontamination), ("byte_bpe", byte_bpe)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`; what each stage returns lies in the shared folder."""
    docs = table(spark, sf_dir, "documents")
    root = f"{scratch_root(spark).rstrip('/')}/maskmetrics/corpus-{uuid.uuid4().hex}"
    for number, (name, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{root}/{number}-{name}")
        docs = spark.read.parquet(f"{root}/{number}-{name}")
    return docs
