"""Kept sketches of distinct values: merged within their error bound, replaced part by part."""

from pyspark.sql import functions as F

from maskmetrics.operators.distinct import SketchStore, distinct_over, distinct_sketches, error_bound


def test_unions_stay_within_the_bound(spark, tmp_path):
    facts = spark.range(60_000).select((F.col("id") % 3).alias("part"), (F.col("id") % 5).alias("g"), (F.col("id") * 7 % 41_003).alias("v"))
    facts = facts.unionByName(spark.sql("SELECT 1L AS part, 9L AS g, CAST(NULL AS BIGINT) AS v"))
    store = SketchStore(spark, str(tmp_path / "s"), "part")
    assert store.load() is None
    store.save(distinct_sketches(facts, ["part", "g"], "v"))
    exact = facts.groupBy("g").agg(F.count_distinct("v").alias("exact"))
    for r in distinct_over(store.load(), ["g"]).join(exact, "g").collect():
        assert abs(r["distinct"] - r["exact"]) <= max(1, error_bound() * r["exact"])
    whole = distinct_over(store.load(), []).first()["distinct"]
    assert abs(whole - 41_003) <= error_bound() * 41_003
    # One part again, with fewer values: the other parts stay.
    store.save(distinct_sketches(spark.createDataFrame([(1, 0, 5), (1, 0, 5)], "part long, g long, v long"), ["part", "g"], "v"))
    assert {r["part"]: r["distinct"] for r in distinct_over(store.load(), ["part"]).collect()}[1] == 1
    assert store.load().select("part").distinct().count() == 3


def test_empty_facts(spark):
    empty = spark.createDataFrame([], "g int, v string")
    assert distinct_sketches(empty, ["g"], "v").count() == 0
    assert distinct_over(distinct_sketches(empty, ["g"], "v"), ["g"]).count() == 0
