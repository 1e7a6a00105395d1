from collections import Counter

from pyspark.sql import functions as F

from maskmetrics.llm.sharding import interleave


def _mix(rows):
    return Counter((r["shard"], r["source"]) for r in rows)


def test_counts_slots_and_mixture(spark):
    df = spark.range(1003).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "hot").otherwise(
        F.concat(F.lit("s"), (F.col("id") % 7).cast("string"))).alias("source"))
    rows = interleave(df, ["source"], ["doc_id"], 8).collect()
    assert sorted(r["doc_id"] for r in rows) == list(range(1003))
    per = Counter(r["shard"] for r in rows)
    assert set(per) == set(range(8)) and max(per.values()) - min(per.values()) <= 1
    for shard, n in per.items():
        assert sorted(r["slot"] for r in rows if r["shard"] == shard) == list(range(n))
    total, mix = Counter(r["source"] for r in rows), _mix(rows)
    for source, n in total.items():
        assert all(abs(mix[shard, source] - n / 8) <= 1.5 for shard in per)


def test_same_order_as_plain_python(spark):
    import hashlib
    import json

    df = spark.range(300).select(F.col("id").alias("doc_id"), (F.col("id") % 4 == 0).cast("string").alias("source"))
    got = {r["doc_id"]: (r["shard"], r["slot"]) for r in interleave(df, ["source"], ["doc_id"], 8, seed=3).collect()}
    groups = {}
    for i in range(300):
        dice = hashlib.md5(("3\x1f" + json.dumps({"doc_id": i}, separators=(",", ":"))).encode()).hexdigest()
        groups.setdefault(i % 4 == 0, []).append((dice, i))
    order = sorted(((2 * r + 1) / (2 * len(g)), dice, i) for g in groups.values()
                   for r, (dice, i) in enumerate(sorted(g)))
    places = Counter()
    for p, (_, _, i) in enumerate(order):
        shard = p * 8 // 300
        assert got[i] == (shard, places[shard])
        places[shard] += 1


def test_empty_null_repeated_and_clashing(spark):
    schema = "doc_id long, source string, shard string, row int, bucket int"
    assert interleave(spark.createDataFrame([], schema), ["source"], ["doc_id"]).collect() == []
    data = [(1, None, "x", 1, 1)] * 5 + [(None, "a", "y", 2, 2)] * 4 + [(2, "", "z", None, None)]
    rows = interleave(spark.createDataFrame(data, schema), ["source"], ["doc_id"], 3).collect()
    assert len(rows) == 10 and sorted(Counter(r["shard"] for r in rows).values()) == [3, 3, 4]
    assert rows[0].asDict().keys() == {"doc_id", "source", "row", "bucket", "shard", "slot"}
