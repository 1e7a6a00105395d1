"""Distinct counts that are kept: one small sketch per group, merged later without the facts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

# 2^12 registers: at most 4 KB a sketch, a standard error of about 1.6 %.
PRECISION = 12
SKETCH = "sketch"


def distinct_sketches(fact: DataFrame, by: Sequence[str | Column], value: str, precision: int = PRECISION) -> DataFrame:
    """(by.., sketch): a mergeable sketch of the distinct values of each group; null values count for nothing."""
    return fact.groupBy(*by).agg(F.hll_sketch_agg(F.col(value).cast("string"), precision).alias(SKETCH))


def distinct_over(sketches: DataFrame, by: Sequence[str | Column], out: str = "distinct") -> DataFrame:
    """(by.., out): about how many distinct values all sketches of a group hold together.

    A value that several of them hold counts once. Only sketches are read and shuffled, whatever the
    number of facts behind them; sketches of one value must be of one precision.
    """
    return sketches.groupBy(*by).agg(F.hll_sketch_estimate(F.hll_union_agg(SKETCH)).alias(out))


def error_bound(precision: int = PRECISION, sigmas: float = 3.0) -> float:
    """The relative error that an estimate does not pass, but for a few in a thousand at three sigmas."""
    return sigmas * 1.04 / 2 ** (precision / 2)


class SketchStore:
    """Sketches under ``path``, one folder per ``part`` (a month, say), which is replaced as a whole when its facts change."""

    def __init__(self, spark: SparkSession, path: str, part: str):
        self.spark, self.path, self.part = spark, path.rstrip("/"), part

    def save(self, sketches: DataFrame) -> None:
        """Write the parts that ``sketches`` holds; other parts stay."""
        sketches.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(self.part).parquet(self.path)

    def load(self) -> DataFrame | None:
        """All sketches, or None where nothing was saved; a filter on ``part`` reads only its folders."""
        try:
            return self.spark.read.parquet(self.path)
        except AnalysisException:
            return None
