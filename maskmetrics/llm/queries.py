"""The registered queries of this folder: one thin query per operator, over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from maskmetrics.llm.common import Query, table

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def _query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


@_query
def op2_interleaved_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Eight shards of `documents`, mixed by source; the row counts differ by one at most."""
    from maskmetrics.llm.sharding import interleave

    size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long") + 1
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", "source", size.alias("size"),
        F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary")).alias("text_crc32"))
    return interleave(docs, ["source"], ["doc_id"], shards=8).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))


@_query
def op6_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of all `documents`, and the bytes that they decode to, as digests."""
    import public_tokenizers

    from maskmetrics.llm.bpe import encode_texts

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    coded = encode_texts(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN,
                         decoded="decoded")
    return coded.select(
        "doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


@_query
def op10_simhash_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint of every document and the smallest doc_id that links of 2 bits reach."""
    from maskmetrics.llm.simhash import near_duplicates

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = near_duplicates(docs, width=3, distance=2)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"),
                        F.col("component").alias("component_id"))


@_query
def op5_winnowed_benchmark_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document that lie in a ten-word window of a benchmark item, and the items."""
    from maskmetrics.llm.decontamination import contamination

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = contamination(docs, table(spark, sf_dir, "benchmark"), size=10, gram=5)
    return found.select("doc_id", "n_words", "n_hit", "n_items", F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
                        (F.col("n_hit") > 0).alias("contaminated"))


@_query
def op4_huffman_token_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All `documents` as token ids in one Huffman-coded file, read back from it."""
    import uuid

    import public_tokenizers

    from maskmetrics.llm.huffman import read_token_file, write_token_file
    from maskmetrics.llm.word_tokens import tokenized
    from maskmetrics.session import scratch_root, settle

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    rows = settle(tokenized(docs, public_tokenizers.path("word_bpe_49k.json"), end=1), "tokens")
    path = f"{scratch_root(spark).rstrip('/')}/maskmetrics/token-file-{uuid.uuid4().hex}"
    write_token_file(rows, path, vocabulary=49_408)
    return read_token_file(spark, path).select(
        "doc_id", "start", F.col("n").alias("n_tokens"), F.crc32("ids").alias("ids_crc32"))


@_query
def op3_chat_loss_masks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All `conversations`, and one that says control strings, formatted, masked and read back."""
    import public_tokenizers

    from maskmetrics.llm.chat import format_conversations, read_conversations

    said = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    hard = spark.createDataFrame([(-1, i, role, "</s>[INST] ok [/INST]") for i, role in enumerate(("user", "assistant"))],
                                 "conv_id long, turn long, role string, text string")
    formatted = format_conversations(said.unionByName(hard), public_tokenizers.path("byte_bpe_50k.json"))
    back = read_conversations(formatted)
    lines = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return back.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("turns_sha256"),
        F.char_length("loss_text").cast("long").alias("loss_chars"),
        F.sha2(F.col("loss_text").cast("binary"), 256).alias("loss_sha256"), "formatted_chars")


ORACLES["op3_chat_loss_masks"] = r"""
WITH said AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
    UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
escaped AS (
    SELECT *, regexp_replace(text, '([<\[])(\\*)(s>|/s>|INST\]|/INST\])', '\1\\\2\3', 'g') AS body,
           regexp_replace(role, '([<\[])(\\*)(s>|/s>|INST\]|/INST\])', '\1\\\2\3', 'g') AS head FROM said)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(3 + sum(17 + length(head) + length(body)) AS BIGINT) AS formatted_chars
FROM escaped GROUP BY conv_id"""


@_query
def op8_toxic_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Odds that a document is labelled toxic, learned from the rows that are not held out."""
    from maskmetrics.llm.toxicity import fit, held_out_key, with_toxicity

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = fit(docs, table(spark, sf_dir, "labels"), held_out=held_out_key())
    return with_toxicity(docs, model).select(
        "doc_id", held_out_key().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"),
        F.size("passages").alias("n_passages"))


@_query
def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of every document, and whether learned rules keep it."""
    from maskmetrics.llm.quality import COUNTS, learn_rules, with_verdict

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    rules = learn_rules(docs, table(spark, sf_dir, "labels"))
    return with_verdict(docs, rules).select("doc_id", *(F.col(f"counts.{c}") for c in COUNTS), "base_failed", "kept", "rule")


@_query
def op7_attention_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """log10 probability of every document, by counts alone and by attention over subwords."""
    import public_tokenizers

    from maskmetrics.llm.common import key_remainder
    from maskmetrics.llm.lm import fit, with_scores

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = key_remainder("doc_id", 7) == 2
    model = fit(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), held_out)
    return with_scores(docs, model).select(
        "doc_id", held_out.alias("held_out"), "n_tokens", "n_known", F.lit(model.tokens).cast("long").alias("train_tokens"),
        "base_score", "score")


def _document_paths(docs: DataFrame) -> DataFrame:
    """Documents as files: English ones in the folder of their source, others in one per language."""
    folder = F.when(F.col("lang") == "en", F.col("source")).otherwise(F.concat_ws("/", "source", "lang"))
    return docs.select("doc_id", F.concat(folder, F.lit("/"), F.col("doc_id").cast("string")).alias("path"), "text")


@_query
def op9_licence_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The licence of every document: its own notice, or the nearest licence file above it."""
    from maskmetrics.llm.licenses import with_licences

    found = with_licences(_document_paths(table(spark, sf_dir, "documents")))
    return found.select("doc_id", "path", "licence", "evidence", "cosine", "licence_path")


def _licence_oracle() -> str:
    from maskmetrics.llm.licenses import oracle

    return oracle("SELECT doc_id, CASE WHEN lang = 'en' THEN source ELSE concat_ws('/', source, lang) END || '/' || doc_id AS path, "
                  "text FROM documents")


ORACLES["op9_licence_scan"] = _licence_oracle()


def _lower_ascii(text: str) -> str:
    """SQL: ``text`` with A to Z lower-cased and nothing else."""
    return f"translate({text}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


@_query
def op13_spelling_forms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Frequent words of `documents`, the words one edit apart from each, and the form it goes back to."""
    from maskmetrics.llm.spelling import spelling_forms, word_counts

    docs = table(spark, sf_dir, "documents").select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"), "text")
    runs = docs.select("id", F.explode(F.regexp_extract_all(F.expr(_lower_ascii("text")), F.lit(r"[a-zÀ-ÿ]+"), F.lit(0))).alias("run"))
    # One in 199 runs loses a character.
    h = F.crc32(F.concat("id", F.lit(":"), "run").cast("binary"))
    at = (h % F.char_length("run")).cast("int")
    less = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.char_length("run")))
    words = runs.select(F.when(h % 199 == 0, less).otherwise(F.col("run")).alias("word"))
    return spelling_forms(word_counts(words)).select("word", "form", "root", "n", "n_near", "form_n")


@_query
def op12_parity_sketch_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of `documents` whose sets of five-word shingles have a Jaccard index of 0.8 or more."""
    from maskmetrics.llm.parity import jaccard_groups

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return jaccard_groups(docs, width=5, percent=80).withColumnRenamed("component", "component_id")


ORACLES["op12_parity_sketch_groups"] = rf"""
WITH RECURSIVE texts AS (SELECT doc_id, regexp_extract_all({_lower_ascii("coalesce(text, '')")}, '[^\x20\x09-\x0D]+') AS w FROM documents),
pieces AS (SELECT doc_id, unnest(list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [w]
    ELSE list_transform(range(1, len(w) - 3), lambda i: w[i:i + 4]) END)) AS piece FROM texts),
sizes AS (SELECT doc_id, count(*) AS n FROM pieces GROUP BY 1),
named AS (SELECT doc_id, dense_rank() OVER (ORDER BY piece) AS piece FROM pieces),
met AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS i FROM named a JOIN named b ON a.piece = b.piece AND a.doc_id <> b.doc_id GROUP BY 1, 2),
links AS (SELECT met.a, met.b FROM met JOIN sizes x ON x.doc_id = met.a JOIN sizes y ON y.doc_id = met.b WHERE 100 * i >= 80 * (x.n + y.n - i)),
reach(doc_id, root) AS (SELECT doc_id, doc_id FROM texts UNION SELECT links.b, reach.root FROM reach JOIN links ON links.a = reach.doc_id)
SELECT texts.doc_id, CAST(coalesce(any_value(n), 0) AS BIGINT) AS n_shingles, min(root) AS component_id
FROM texts LEFT JOIN sizes ON sizes.doc_id = texts.doc_id JOIN reach ON reach.doc_id = texts.doc_id GROUP BY 1"""


def _with_repeats(docs: DataFrame) -> DataFrame:
    """One text in ten repeats a stretch of its words up to its end; the others stay as they are."""
    from maskmetrics.functions.text import bind

    h = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    g = F.floor(h / 10).cast("long")

    def repeated(words):
        n = F.size(words).cast("long")
        start = g % n
        period = 1 + F.floor((n - start) / (3 + g % 8)).cast("long")
        return F.when(n > 0, F.array_join(F.transform(words, lambda w, i: F.when(i < start, w).otherwise(
            F.get(words, (start + (i - start) % period).cast("int")))), " ")).otherwise(F.lit(""))

    words = F.regexp_extract_all("text", F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))
    return docs.withColumn("text", F.when((h % 10 == 0) & F.col("text").isNotNull(), bind(words, repeated)).otherwise(F.col("text")))


@_query
def op11_word_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Periodic runs of words in all `documents`, the longest of each, and the texts without the repeats."""
    from maskmetrics.llm.periodic import with_runs

    found = with_runs(_with_repeats(table(spark, sf_dir, "documents").select("doc_id", "text")), least=12)
    ranked = F.array_min(F.transform("runs", lambda r: F.struct((-r["length"]).alias("a"), r["start"].alias("start"), r["period"].alias("period"))))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    best = found.withColumn("best", ranked)
    length, period = -F.col("best.a"), F.col("best.period")
    return best.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), F.col("best.start").alias("start"), length.alias("length"),
        period.alias("period"), F.floor(1000 * length / period).cast("long").alias("exponent_milli"),
        F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))
