"""Session helpers: shipping the package, and tables written to cut a plan in two."""

from __future__ import annotations

import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: str = "8", partitions: int = 8, app: str = "maskmetrics") -> SparkSession:
    """A session for tests and benches; on a cluster pass your own."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Make this package importable in the Python workers, once per application."""
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    package = Path(__file__).resolve().parent
    target = Path(tempfile.mkdtemp(prefix="maskmetrics-ship-"))
    shutil.copytree(package, target / "src" / package.name,
                    ignore=shutil.ignore_patterns("__pycache__"))
    archive = shutil.make_archive(str(target / "maskmetrics"), "zip", target / "src")
    spark.sparkContext.addPyFile(archive)
    _shipped.add(app)


_local_roots: dict[str, str] = {}


def scratch_root(spark: SparkSession) -> str:
    """The shared folder named by the session; a local one only where none is named."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    app = spark.sparkContext.applicationId
    if app not in _local_roots:
        _local_roots[app] = tempfile.mkdtemp(prefix="maskmetrics-scratch-")
    return _local_roots[app]


# Whether the shuffle files of a query go with its end; else they stay until the driver happens to collect its garbage.
_DROP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def _shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of what is run in here are dropped behind it, where this version of Spark can."""
    before = spark.conf.get(_DROP, None) if spark.conf.isModifiable(_DROP) else None
    if before is None:
        yield
        return
    spark.conf.set(_DROP, "true")
    try:
        yield
    finally:
        spark.conf.set(_DROP, before)


def settle(df: DataFrame, label: str = "table", codec: str | None = None) -> DataFrame:
    """Write ``df`` to the shared folder and read it back; ``codec`` is that of Parquet, for tables of whole texts.

    The result no longer depends on how ``df`` is recomputed, survives the loss of
    executors, and carries real size statistics for the planner. The table goes when the
    driver ends in an orderly way.
    """
    spark = df.sparkSession
    path = f"{scratch_root(spark).rstrip('/')}/maskmetrics/{label}-{uuid.uuid4().hex}"
    with _shuffles_dropped(spark):
        df.write.parquet(path, compression=codec)
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(folder)
    return spark.read.schema(df.schema).parquet(path)


def spread_small(df: DataFrame) -> DataFrame:
    """Spread a small input over the cores before work that is heavy per row.

    One small file is one task, however many cores wait. The planner's own estimates of the
    tables that are read decide, so no file is listed; an estimate of a join would be a
    product. From one default split per core on, the input is left as it is.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    size = sum(int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size()))
    split = 128 * 1024 * 1024
    return df.repartition(cores) if 0 < size < cores * split else df
