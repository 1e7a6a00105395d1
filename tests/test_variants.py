"""VARIANT columns: strings at any depth are masked, types and keys stay."""

import json
import random

import pytest
from pyspark.sql import functions as F

from maskmetrics.functions import variants as V
from maskmetrics.operators.masking import mask_nested, mask_table


def _random_value(rng, depth=0):
    kind = rng.randrange(9 if depth < 4 else 6)
    if kind < 2:
        return rng.choice(["", "acme", "x acme y", "é" * rng.randint(0, 40), "acme " * rng.randint(10, 30), "long " * 60])
    if kind == 2:
        return rng.choice([None, True, False])
    if kind == 3:
        return rng.choice([0, -1, 127, 128, 40_000, -3_000_000_000, 10**15])
    if kind == 4:
        return rng.choice([0.5, 1e300, -2.25])
    if kind == 5:
        return "acme"
    if kind == 6:
        return {rng.choice("abcdefgh") * rng.randint(1, 3): _random_value(rng, depth + 1) for _ in range(rng.randint(0, 6))}
    return [_random_value(rng, depth + 1) for _ in range(rng.choice([0, 1, 3, 300 if depth == 0 else 2]))]


def _masked(value):
    if isinstance(value, str):
        return value.replace("acme", "Client_A")
    if isinstance(value, dict):
        return {k: _masked(v) for k, v in value.items()}
    return [_masked(v) for v in value] if isinstance(value, list) else value


@pytest.mark.parametrize("plan", ["small", "medium", "large"])
def test_all_plans(spark, registry_of, plan):
    rng = random.Random(7)
    values = [_random_value(rng) for _ in range(60)] + [{"acme": "acme", "n": None}, "acme", {}, []]
    rows = [(i, json.dumps(v)) for i, v in enumerate(values)] + [(900, None)]
    df = spark.createDataFrame(rows, "id long, j string").select(
        "id", F.parse_json("j").alias("v"), F.lit("acme!").alias("t"), F.struct(F.parse_json("j").alias("in"), F.lit("by acme").alias("by")).alias("s"),
        F.array(F.parse_json("j"), F.parse_json(F.lit('"acme"'))).alias("many"), F.create_map(F.lit("acme"), F.parse_json("j")).alias("m"))
    done = mask_table(df, registry_of(client=["acme"]), plan)
    assert done.schema.simpleString() == df.schema.simpleString()
    got = done.select("id", F.to_json("v").alias("v"), "t", F.to_json("s.in").alias("inside"), "s.by", F.transform("many", lambda x: F.to_json(x)).alias("many"),
                      F.to_json(F.element_at("m", "acme")).alias("m"))
    for r in got.collect():
        assert r["t"] == "Client_A!" and r["by"] == "by Client_A"
        if r["id"] == 900:
            assert r["v"] is None and r["inside"] is None and r["many"] == [None, '"Client_A"']
            continue
        want = _masked(values[r["id"]])
        for text in (r["v"], r["inside"], r["many"][0], r["m"]):
            assert json.loads(text) == want
        assert r["many"][1] == '"Client_A"'


def test_types_stay(spark, registry_of):
    df = spark.sql("""SELECT to_variant_object(named_struct('d', DATE'2024-02-29', 't', TIMESTAMP'2024-02-29 01:02:03', 'n', TIMESTAMP_NTZ'2024-02-29 01:02:03',
        'c', CAST(1.50 AS DECIMAL(5,2)), 'k', CAST(1.5 AS DECIMAL(15,2)), 'h', CAST(12345678901234567890.5 AS DECIMAL(38,2)), 'f', CAST(1.5 AS FLOAT),
        'b', X'0102', 'i', CAST(5 AS TINYINT), 'l', 3000000000L, 'z', true, 's', 'at acme')) AS v""")
    done = mask_nested(df, "v", registry_of(client=["acme"]))
    before, after = (x.select(F.schema_of_variant("v").alias("k"), F.to_json("v").alias("j")).first() for x in (df, done))
    assert before["k"] == after["k"] and before["j"].replace("at acme", "at Client_A") == after["j"]


def test_without_names_nothing_changes(spark, registry_of):
    df = spark.sql("SELECT parse_json('{\"a\": [1, \"x\"]}') AS v, 1 AS id")
    same = mask_table(df, registry_of(client=["acme"])).collect()[0]["v"]
    assert bytes(same.value) == bytes(df.collect()[0]["v"].value)
    assert mask_table(df.limit(0), registry_of(client=["acme"])).count() == 0
    assert mask_table(df, registry_of(client=["x"]).disabled()).schema == df.schema


def test_unknown_types_are_not_guessed():
    with pytest.raises(ValueError):
        V.with_strings(bytes([40 << 2]), iter([]))


def test_a_value_whose_strings_stay_keeps_its_bytes():
    # An array of one object with wider offsets than it needs, as a writer may choose them.
    inside = bytes([V.OBJECT | 1 << 2, 1, 0]) + (0).to_bytes(2, "little") + (5).to_bytes(2, "little") + V._string("acme")
    data = bytes([V.ARRAY, 2, 0, len(inside), len(inside) + 3]) + inside + V._string("by")
    assert list(V.strings_of(data)) == ["acme", "by"]
    assert V.with_strings(data, iter(["acme", "by"])) == data
    changed = V.with_strings(data, iter(["acme", "it"]))
    assert list(V.strings_of(changed)) == ["acme", "it"] and inside in changed
