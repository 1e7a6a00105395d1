"""Masking a stream: each batch first teaches the dictionary, then is written masked."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery

from maskmetrics.operators.lookup import Size, measure
from maskmetrics.operators.masking import mask_table
from maskmetrics.operators.ordering import dense_index
from maskmetrics.operators.pii import TokenTable, detect_pii, explode_spans, replace_spans, value_key
from maskmetrics.operators.registry import Registry, extended, new_entries
from maskmetrics.session import settle
from maskmetrics.streaming.delta_log import DeltaLog


TOKEN_SCHEMA = "alias string, value string, entity_type string, n long, norm string, sightings long"
REGISTRY_SCHEMA = "category string, norm string, alias string, value string, ordinal long"
SIZE_SCHEMA = "rows long, chars long"


@dataclass
class StreamMasker:
    """State of a masked stream: what each batch adds to dictionary and tokens.

    Batch ``b`` writes only its new entries, under ``batch_id=b``, before its rows, and reads
    those of the batches before it, of which a ``DeltaLog`` makes few segments. Replaying a batch
    after a failure overwrites its own folders with the same content, so every batch takes
    effect once, and the state is as large as what was learned.
    """

    registry: Registry
    target: str
    names: Sequence[tuple[str, str]] = ()          # (column, category) of new names
    pii_column: str | None = None
    key: str | None = None                         # orders rows for token numbering

    def _log(self, name: str, schema: str) -> DeltaLog:
        return DeltaLog(self.target, name, schema)

    def _learn(self, spark, rows: DataFrame, batch: int) -> Registry:
        """The dictionary with the names of this batch, which are written."""
        entries, sizes = self._log("registry", REGISTRY_SCHEMA), self._log("sizes", SIZE_SCHEMA)
        # One row per batch: the sizes are carried along instead of measured anew.
        grown = sizes.before(spark, batch).agg(F.sum("rows"), F.sum("chars")).first()
        size = Size(self.registry.size.rows + (grown[0] or 0), self.registry.size.chars + (grown[1] or 0))
        known = self.registry.df.unionByName(entries.before(spark, batch))
        first = registry = replace(self.registry, df=known, size=size)
        added = spark.createDataFrame([], REGISTRY_SCHEMA)
        for column, category in self.names:
            new = new_entries(registry, rows, column, category)
            registry = extended(registry, new)
            added = added.unionByName(new.df)
        fresh = registry.size.rows - size.rows
        learned = entries.add(batch, added, fresh)
        sizes.add(batch, spark.createDataFrame([(fresh, registry.size.chars - size.chars)], SIZE_SCHEMA), 1)
        return replace(first, df=self.registry.df.unionByName(learned), size=registry.size)

    def _more_tokens(self, known: DataFrame, detected: DataFrame) -> tuple[DataFrame, int]:
        """Only the tokens of values seen for the first time, numbered after those of their type; and how many."""
        first = explode_spans(detected, F.col(self.key).alias("doc")).select(
            value_key(F.col("s.text")).alias("norm"), "s.entity_type", "s.text", "doc",
            (-F.col("s.start")).alias("back")).groupBy("norm").agg(
            F.min(F.struct("doc", "back", "entity_type", "text")).alias("f"), F.count("*").alias("sightings"))
        fresh = first.join(known.select("norm"), "norm", "left_anti").select(
            "norm", "sightings", "f.doc", "f.back", F.col("f.entity_type").alias("entity_type"),
            F.col("f.text").alias("value"))
        numbered = dense_index(fresh, ["entity_type"], ["doc", "back", "norm"], "i")
        # One row per entity type: a handful.
        used = known.groupBy("entity_type").agg(F.max("n").alias("used"))
        n = F.coalesce("used", F.lit(0)) + F.col("i") + 1
        added = numbered.df.join(F.broadcast(used), "entity_type", "left").withColumn("n", n.cast("long"))
        alias = F.concat(F.lit("<"), "entity_type", F.lit("_"), F.col("n").cast("string"), F.lit(">"))
        return added.select(alias.alias("alias"), "value", "entity_type", "n", "norm", "sightings"), numbered.rows

    def process(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        rows = settle(batch, "batch")
        registry = self._learn(spark, rows, batch_id)
        masked = mask_table(rows, registry)
        if self.pii_column is not None:
            detected = settle(detect_pii(masked, self.pii_column), "detected")
            log = self._log("tokens", TOKEN_SCHEMA)
            tokens = log.add(batch_id, *self._more_tokens(log.before(spark, batch_id), detected))
            masked = replace_spans(detected, self.pii_column, TokenTable(tokens, measure(tokens, "alias", "value")))
        masked.write.mode("overwrite").parquet(f"{self.target}/rows/batch_id={batch_id}")

    def start(self, stream: DataFrame, checkpoint: str, **trigger) -> StreamingQuery:
        writer = stream.writeStream.foreachBatch(self.process).option("checkpointLocation", checkpoint)
        return writer.trigger(**(trigger or {"availableNow": True})).start()


def mask_stream(stream: DataFrame, registry: Registry, target: str, checkpoint: str,
                names: Sequence[tuple[str, str]] = (), pii_column: str | None = None,
                key: str | None = None, **trigger) -> StreamingQuery:
    """Write a stream masked to ``target``/rows, with its dictionary and tokens beside it."""
    if pii_column is not None and key is None:
        raise ValueError("token numbering needs a key column that orders the rows")
    return StreamMasker(registry, target, names, pii_column, key).start(stream, checkpoint, **trigger)
