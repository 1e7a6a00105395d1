"""Saves of mappings: whole or not seen, replaced at once, removed in order."""

import pytest
from pyspark.sql import functions as F

from maskmetrics.sources.mapping_store import MappingStore

DAY = "2026-01-01"


def _time(day):
    return F.lit(day).cast("timestamp")


def _frames(spark, value, sessions=("s",), day=DAY):
    named = spark.createDataFrame([(s,) for s in sessions], "session_id string").withColumn("created", _time(day))
    mapping = named.withColumn("alias", F.lit("Client_A")).withColumn("value", F.lit(value))
    return mapping, named.selectExpr("1L AS registry_entities", "0L AS detections", "false AS degraded", "created", "session_id")


def _values(df):
    return sorted(r["value"] for r in df.collect())


def test_a_torn_save_is_not_seen(spark, tmp_path, monkeypatch):
    store = MappingStore(spark, str(tmp_path))
    store.save_all(*_frames(spark, "old", ["s", "t: 1/2%"]))
    # Ended between its two tables, and before the log.
    mapping, stats = _frames(spark, "torn", ["s", "new"], "2027-01-01")
    with pytest.raises(Exception):
        store.write(mapping, stats.drop("degraded"))
    store.write(mapping, stats)
    assert store.latest_session() == "t: 1/2%" and _values(store.load("s")) == ["old"] and _values(store.load("t: 1/2%")) == ["old"]
    assert sorted(r["session_id"] for r in store.stats().collect()) == ["s", "t: 1/2%"] == sorted(r["session_id"] for r in store.mappings().collect())
    with pytest.raises(FileNotFoundError):
        store.load("new")
    # The log file was made and not written.
    (tmp_path / "log" / "000000000001.json").touch()
    store.save_all(*_frames(spark, "whole"))
    assert (tmp_path / "log" / "000000000002.json").exists()
    assert _values(store.load("s")) == ["whole"] and _values(store.mappings()) == ["old", "whole"]
    assert store.vacuum(_time("2026-06-01")) == 1  # the replaced save; the torn ones are younger
    assert store.vacuum(_time("2028-01-01")) == 4
    assert _values(store.mappings()) == ["old", "whole"] and store.stats().count() == 2
    assert store.expire("s", _time("2030-01-01")) == 1
    assert [r["session_id"] for r in store.stats().collect()] == ["s"] and _values(store.mappings()) == ["whole"]


def test_saves_at_the_same_time_get_their_own_numbers(spark, tmp_path, monkeypatch):
    store = MappingStore(spark, str(tmp_path))
    one, two = (store.write(*_frames(spark, v)) for v in ("one", "two"))
    real = store._file

    class Blind:
        """A store that does not yet list what another writer has made."""

        def __init__(self, inner):
            self._inner = inner

        def listStatus(self, folder):
            return []

        def __getattr__(self, name):
            return getattr(self._inner, name)
    assert store.commit(one) == 0
    monkeypatch.setattr(store, "_file", lambda path: (real(path)[0], Blind(real(path)[1])))
    assert store.commit(two) == 1
    monkeypatch.undo()
    assert _values(store.load("s")) == ["two"]


def test_an_empty_store(spark, tmp_path):
    store = MappingStore(spark, str(tmp_path / "none"))
    assert store.load_latest() is None and store.mappings().count() == 0 and store.vacuum(_time(DAY)) == 0 and store.expire(None) == 0
    mapping, stats = _frames(spark, "x")
    store.save(mapping.drop("session_id", "created").limit(0), stats.drop("session_id", "created"), "empty")
    assert store.load("empty").count() == 0 and store.latest_session() == "empty"
