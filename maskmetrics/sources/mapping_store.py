"""Mappings saved per session: two Parquet tables partitioned by session and save, and a log of the saves that are whole."""

from __future__ import annotations

import json
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

MAPPING_SCHEMA = "alias string, value string, source string, created timestamp, session_id string"
STATS_SCHEMA = ("registry_entities long, detections long, degraded boolean, "
                "created timestamp, session_id string")


def new_session() -> str:
    return str(uuid.uuid4())


class MappingStore:
    """Each save writes new folders of both tables and then one numbered file of the log, which is made once or not at all.

    Readers see the last save of each session that the log names. So a save that ended halfway is not seen, a
    session that is replaced shows its old mapping until the new one is whole, and mapping and stats
    always belong to the same save. Saves at the same time get different numbers; of one session the later number counts.
    """

    def __init__(self, spark: SparkSession, path: str, retention_days: int = 90):
        self.spark = spark
        self.path = path.rstrip("/")
        self.retention_days = retention_days

    # --- writing ---

    def save(self, mapping: DataFrame, stats: DataFrame, session_id: str,
             created: Column | None = None) -> None:
        """Write (or replace) the mapping and the stats row of one session."""
        created = F.current_timestamp() if created is None else created
        named = [df.withColumn("created", created).withColumn("session_id", F.lit(session_id)) for df in (mapping, stats)]
        self.save_all(*named)

    def save_all(self, mapping: DataFrame, stats: DataFrame) -> None:
        """Write many sessions at once; both frames carry session_id and created."""
        self.commit(self.write(mapping, stats))

    def write(self, mapping: DataFrame, stats: DataFrame) -> str:
        """The first half of a save: the data, which nobody sees yet. Returns its name."""
        if "source" not in mapping.columns:
            mapping = mapping.withColumn("source", F.lit("registry"))
        save = uuid.uuid4().hex
        for name, df, columns in (
                ("mapping", mapping, ("alias", "value", "source")),
                ("stats", stats, ("registry_entities", "detections", "degraded"))):
            df.select(*columns, "created", "session_id", F.lit(save).alias("save")).write.mode("append") \
                .partitionBy("session_id", "save").parquet(f"{self.path}/{name}")
        return save

    def commit(self, save: str) -> int:
        """The second half: the next free number of the log, taken by making its file."""
        folder, store = self._file(f"{self.path}/log")
        number = 0
        if store.exists(folder):
            names = [s.getPath().getName() for s in store.listStatus(folder)]
            number = max((int(n.split(".")[0]) for n in names if n[0].isdigit()), default=-1) + 1
        while True:
            target, _ = self._file(f"{self.path}/log/{number:012d}.json")
            try:
                stream = store.create(target, False)
            except Py4JJavaError:
                if not store.exists(target):
                    raise
                number += 1  # another save was first
                continue
            stream.write(bytearray(json.dumps({"n": number, "save": save}).encode()))
            stream.close()
            return number

    def _file(self, path: str):
        target = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        return target, target.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    # --- reading ---

    def _read(self, table: str, schema: str) -> DataFrame:
        try:
            return self.spark.read.schema(f"{schema}, save string").parquet(f"{self.path}/{table}")
        except AnalysisException:
            return self.spark.createDataFrame([], f"{schema}, save string")

    def _committed(self) -> DataFrame:
        """(n, save) of all saves that are whole."""
        try:
            return self.spark.read.schema("n long, save string").json(f"{self.path}/log").where("save IS NOT NULL")
        except AnalysisException:
            return self.spark.createDataFrame([], "n long, save string")

    def _visible(self) -> DataFrame:
        """The stats of the last whole save of each session, with the name of the save."""
        stats = self._read("stats", STATS_SCHEMA).join(self._committed(), "save")
        last = stats.groupBy("session_id").agg(F.max(F.struct("n", "save")).alias("last"))
        return stats.join(last.select("session_id", F.col("last.save").alias("save")), ["session_id", "save"])

    def mappings(self) -> DataFrame:
        seen = self._visible().select("session_id", "save").distinct()
        return self._read("mapping", MAPPING_SCHEMA).join(seen, ["session_id", "save"], "left_semi").drop("save")

    def stats(self) -> DataFrame:
        return self._visible().select("registry_entities", "detections", "degraded", "created", "session_id")

    def load(self, session_id: str) -> DataFrame:
        """The mapping of one session; reads only its partition."""
        row = self._visible().where(F.col("session_id") == session_id).select("save").first()
        if row is None:
            raise FileNotFoundError(f"No mapping found for session {session_id}")
        return self._read("mapping", MAPPING_SCHEMA).where(
            (F.col("session_id") == session_id) & (F.col("save") == row["save"])).drop("save")

    def latest_session(self) -> str | None:
        row = self.stats().agg(
            F.max_by("session_id", F.struct("created", "session_id")).alias("s")).first()
        return row["s"]

    def load_latest(self) -> DataFrame | None:
        session = self.latest_session()
        return None if session is None else self.load(session)

    # --- removing ---

    def expired(self, current: str | None, now: Column | None = None) -> DataFrame:
        """Sessions past the retention time; one without a time stamp is kept."""
        now = F.current_timestamp() if now is None else now
        limit = now - F.expr(f"make_dt_interval({max(self.retention_days, 0)})")
        old = self.stats().where(F.col("created") < limit)
        if current is not None:
            old = old.where(F.col("session_id") != current)
        if self.retention_days < 0:
            old = old.where(F.lit(False))
        return old.select("session_id").distinct()

    def _delete(self, table: str, **partition: str) -> None:
        escaped = self.spark.sparkContext._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName
        target, store = self._file("/".join([self.path, table, *(f"{k}={escaped(v)}" for k, v in partition.items())]))
        store.delete(target, True)

    def expire(self, current: str | None, now: Column | None = None) -> int:
        """Drop the partitions of expired sessions; returns how many went.

        The stats go first: without them a session is not seen, also if the rest is not reached.
        """
        dropped = 0
        for row in self.expired(current, now).toLocalIterator():
            for table in ("stats", "mapping"):
                self._delete(table, session_id=row["session_id"])
            dropped += 1
        return dropped

    def vacuum(self, before: Column) -> int:
        """Drop what nobody sees: saves that ended halfway or were replaced, if made before ``before``; returns how many.

        A save without a time stamp is kept, and one that is still being written must be younger.
        """
        seen = self._visible().select("session_id", "save").distinct()
        dropped = 0
        for table, schema in (("mapping", MAPPING_SCHEMA), ("stats", STATS_SCHEMA)):
            data = self._read(table, schema).groupBy("session_id", "save").agg(F.max("created").alias("created"))
            for row in data.join(seen, ["session_id", "save"], "left_anti").where(F.col("created") < before).toLocalIterator():
                self._delete(table, session_id=row["session_id"], save=row["save"])
                dropped += table == "mapping"
        return dropped


def mapping_from_json(df: DataFrame, column: str) -> DataFrame:
    """(alias, value) from JSON texts, either flat or under a "mappings" key."""
    wrapped = F.from_json(F.get_json_object(column, "$.mappings"), "map<string,string>")
    flat = F.from_json(F.col(column), "map<string,string>")
    entries = F.when(F.get_json_object(column, "$.mappings").isNotNull(), wrapped).otherwise(flat)
    return df.select(F.explode(entries).alias("alias", "value"))
