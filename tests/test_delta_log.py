"""The levelled log of a stream's state: bounded reads, and batches that are run again."""

from pathlib import Path

import pytest

from maskmetrics.streaming.delta_log import DeltaLog, Segment


def _rows(spark, batch, n):
    return spark.range(n).selectExpr(f"CAST({batch} AS INT) AS b", "id AS i").coalesce(2)


def _read(log, spark, batch):
    return sorted(tuple(r) for r in log.before(spark, batch).collect())


def test_reads_stay_few_and_whole(spark, tmp_path):
    log, want = DeltaLog(str(tmp_path), "s", "b int, i long", fan=3), []
    for batch in range(31):
        n = (batch * 7) % 4
        log.add(batch, _rows(spark, batch, n), n)
        want += [(batch, i) for i in range(n)]
        segments = log.segments(spark, batch + 1)
        assert len(segments) <= 2 * 4 and [s.first for s in segments][1:] == [s.last + 1 for s in segments][:-1]
        if batch in (8, 9, 26, 30):
            assert _read(log, spark, batch + 1) == sorted(want)
    assert log.rows_before(spark, 31) == len(want)
    # Only what the last two manifests name is still there.
    named = {Path(log.path(s)).name for k in (30, 31) for s in log.segments(spark, k)} | {"batch_id=30"}
    there = {p.name for p in [*(tmp_path / "s").iterdir(), *(tmp_path / "merged" / "s").iterdir()]}
    assert there <= named
    assert sorted(p.name for p in (tmp_path / "manifest" / "s").glob("*.json")) == ["29.json", "30.json"]


@pytest.mark.parametrize("last", [7, 8])
def test_a_batch_that_runs_again_takes_effect_once(spark, tmp_path, monkeypatch, last):
    log = DeltaLog(str(tmp_path), "s", "b int, i long", fan=3)
    for batch in range(last):
        log.add(batch, _rows(spark, batch, 2), 2)
    want = [(b, i) for b in range(last + 1) for i in range(2)]
    # Failures before the manifest, and after it.
    with monkeypatch.context() as m:
        m.setattr(DeltaLog, "_write_manifest", lambda *_: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            log.add(last, _rows(spark, last, 2), 2)
    for _ in range(2):
        log.add(last, _rows(spark, last, 2), 2)
        assert _read(log, spark, last + 1) == want
    log.add(last + 1, _rows(spark, last + 1, 1), 1)
    log.add(last + 1, _rows(spark, last + 1, 1), 1)
    assert _read(log, spark, last + 2) == [*want, (last + 1, 0)]


def test_empty_batches(spark, tmp_path):
    log = DeltaLog(str(tmp_path), "s", "b int, i long", fan=2)
    for batch in range(5):
        assert log.add(batch, _rows(spark, batch, 0), 0).count() == 0
    assert log.segments(spark, 0) == [] and log.segments(spark, 5) == [Segment(2, 0, 3, 0), Segment(0, 4, 4, 0)]
    assert log.add(5, _rows(spark, 5, 1), 1).count() == 1
