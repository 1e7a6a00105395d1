"""What the batches of a stream add, kept in levels: many small deltas become few large ones."""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

# So many segments of one level become one of the next.
FAN = 8
ROWS_PER_FILE = 1_000_000


@dataclass(frozen=True)
class Segment:
    """The entries of the batches ``first`` to ``last``."""

    level: int
    first: int
    last: int
    rows: int


@dataclass(frozen=True)
class DeltaLog:
    """Entries of a stream's state, added batch by batch under ``root``/``name``.

    Every batch writes its own entries, merges the last ``fan`` segments of a level as long as there are so many,
    and then writes a manifest: the segments that hold the entries of all batches up to its own, at most
    ``fan`` - 1 of each level. An entry is so written once per level, and a batch reads few segments, however
    many batches were before it.

    All that a batch does follows from the manifest of the batch before, so a batch that is run again, after a
    failure at any point, writes the same and takes effect once. Segments that a merge has replaced stay
    until the batch after it has begun: by then no run of the merging batch needs them any more.
    """

    root: str
    name: str
    schema: str
    fan: int = FAN

    def path(self, s: Segment) -> str:
        return f"{self.root}/{self.name}/batch_id={s.first}" if s.level == 0 else f"{self.root}/merged/{self.name}/{s.first}-{s.last}"

    def _manifest(self, batch: int) -> str:
        return f"{self.root}/manifest/{self.name}/{batch}.json"

    @staticmethod
    def _file(spark: SparkSession, path: str):
        target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        return target, target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def segments(self, spark: SparkSession, batch: int) -> list[Segment]:
        """The segments of all batches before ``batch``, oldest first."""
        if batch == 0:
            return []
        target, store = self._file(spark, self._manifest(batch - 1))
        stream = store.open(target)
        try:
            text = spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        return [Segment(*s) for s in json.loads(text)]

    def _write_manifest(self, spark: SparkSession, batch: int, segments: list[Segment]) -> None:
        target, store = self._file(spark, self._manifest(batch))
        # Whole or not at all: written beside its place, then moved there.
        beside, _ = self._file(spark, self._manifest(batch) + ".new")
        stream = store.create(beside, True)
        stream.write(bytearray(json.dumps([[s.level, s.first, s.last, s.rows] for s in segments]).encode()))
        stream.close()
        store.delete(target, False)
        store.rename(beside, target)

    def _read(self, spark: SparkSession, segments: list[Segment]) -> DataFrame:
        held = [s for s in segments if s.rows]
        if not held:
            return spark.createDataFrame([], self.schema)
        return spark.read.schema(self.schema).parquet(*(self.path(s) for s in held))

    def before(self, spark: SparkSession, batch: int) -> DataFrame:
        """The entries of all batches before ``batch``."""
        return self._read(spark, self.segments(spark, batch))

    def rows_before(self, spark: SparkSession, batch: int) -> int:
        return sum(s.rows for s in self.segments(spark, batch))

    def add(self, batch: int, added: DataFrame, rows: int) -> DataFrame:
        """Write the ``rows`` entries that ``batch`` adds, merge what is due, and return the entries of all batches."""
        spark = added.sparkSession
        known = self.segments(spark, batch)
        self._drop_replaced(spark, batch, known)
        segments = [*known, Segment(0, batch, batch, rows)]
        if rows:
            self._write(added, segments[-1])
        while len(segments) >= self.fan and len({s.level for s in segments[-self.fan:]}) == 1:
            some = segments[-self.fan:]
            merged = Segment(some[0].level + 1, some[0].first, some[-1].last, sum(s.rows for s in some))
            if merged.rows:
                self._write(self._read(spark, some), merged)
            segments[-self.fan:] = [merged]
        self._write_manifest(spark, batch, segments)
        return self._read(spark, segments)

    def _write(self, df: DataFrame, segment: Segment) -> None:
        df.coalesce(-(-segment.rows // ROWS_PER_FILE)).write.mode("overwrite").parquet(self.path(segment))

    def _drop_replaced(self, spark: SparkSession, batch: int, known: list[Segment]) -> None:
        """Remove what the batch before has merged, and the manifest that still named it."""
        if batch < 2:
            return
        target, store = self._file(spark, self._manifest(batch - 2))
        if not store.exists(target):
            return
        own = Segment(0, batch - 1, batch - 1, 0)
        for s in [*self.segments(spark, batch - 1), own]:
            if not any((s.level, s.first, s.last) == (k.level, k.first, k.last) for k in known):
                gone, _ = self._file(spark, self.path(s))
                store.delete(gone, True)
        # Merges of one batch may replace each other.
        last = known[-1]
        for level in range(1, last.level):
            first = batch - self.fan ** level
            gone, _ = self._file(spark, self.path(Segment(level, first, batch - 1, 0)))
            store.delete(gone, True)
        store.delete(target, False)
