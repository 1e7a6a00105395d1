import pytest
from pyspark.sql import functions as F

from maskmetrics.functions.text import default_alias, normalize
from maskmetrics.operators.lookup import Size, salted_join
from maskmetrics.operators.ordering import dense_index, running, running_dense_rank, running_rank, running_sum
from maskmetrics.operators.registry import (
    SensitiveColumn, alias_value, build_registry, category_counts, match_order, register_dynamic, registry_stats,
    sample_values, self_test, unalias_value)
from dataclasses import replace


def mapping(registry):
    return {r["value"]: r["alias"] for r in registry.df.collect()}


def test_aliases_per_category(registry_of):
    r = registry_of(client=["Beta Inc", "Acme Corp"], resource=["Jan de Vries"])
    assert mapping(r) == {"Acme Corp": "Client_A", "Beta Inc": "Client_B", "Jan de Vries": "Resource_1"}
    assert r.size == Size(3, len("Beta IncAcme CorpJan de Vries")) and not r.degraded


def test_one_value_in_two_columns_and_categories(spark):
    df = spark.createDataFrame([("Acme Corp", "ACME corp ", "Zed", 5), (" ", None, "acme corp", 6)],
                               "a string, b string, c string, n int")
    spec = [SensitiveColumn("client", "t", "a"), SensitiveColumn("client", "t", "b"),
            SensitiveColumn("project", "t", "c"), SensitiveColumn("project", "t", "n")]
    assert mapping(build_registry(spark, spec, {"t": df})) == {"Acme Corp": "Client_A", "Zed": "Project_1"}


def test_default_alias(spark):
    rows = [("client", 0), ("client", 25), ("client", 26), ("project", 0), ("project", 2), ("sub Unit", 1)]
    df = spark.createDataFrame(rows, "c string, i long").select(default_alias("c", "i").alias("a"))
    assert [r["a"] for r in df.collect()] == [
        "Client_A", "Client_Z", "Client_27", "Project_1", "Project_3", "Sub unit_2"]


def test_normalize_strips_and_composes(spark):
    df = spark.createDataFrame([("  JOSÉ\n",), ("acme",), (None,)], "s string").select(normalize("s").alias("n"))
    assert [r["n"] for r in df.collect()] == ["josé", "acme", None]


def test_failed_column_degrades(spark):
    df = spark.createDataFrame([("Acme",)], "a string")
    r = build_registry(spark, [SensitiveColumn("client", "t", "a"), SensitiveColumn("client", "t", "gone"),
                               SensitiveColumn("client", "no_such_table", "x")], {"t": df})
    assert r.degraded and len(r.warnings) == 2 and mapping(r) == {"Acme": "Client_A"}
    assert registry_stats(r).first()["degraded"]
    nothing = build_registry(spark, [SensitiveColumn("client", "no_such_table", "x")])
    assert nothing.degraded and nothing.df.count() == 0


def test_category_is_one_word(spark):
    with pytest.raises(ValueError):
        build_registry(spark, [SensitiveColumn("key account", "t", "a")], {})


def test_lookup_both_ways_and_switch(spark, registry_of):
    r = registry_of(client=["Acme Corp", "Beta Inc"])
    df = spark.createDataFrame([("acme corp",), ("ACME CORP",), ("Other",), (None,)], "n string")
    large = replace(r, size=Size(10**9, 10**9))
    for registry in (r, large):
        masked = alias_value(df, "n", registry)
        assert sorted(map(str, (x["n"] for x in masked.collect()))) == ["Client_A", "Client_A", "None", "Other"]
        back = unalias_value(masked, "n", registry)
        assert sorted(map(str, (x["n"] for x in back.collect()))) == ["Acme Corp", "Acme Corp", "None", "Other"]
    assert alias_value(df, "n", r.disabled()) is df


def test_dynamic_values_append(spark, registry_of):
    r = registry_of(client=["Acme"], contact=["a@x"])
    names = spark.createDataFrame([("ACME ",), ("Zed",), ("Bob",), (" ",)], "n string")
    grown = register_dynamic(register_dynamic(r, names, "n", "contact"), names, "n", "workspace")
    assert mapping(grown) == {"Acme": "Client_A", "a@x": "Contact_1", "Bob": "Contact_2", "Zed": "Contact_3"}
    assert grown.size.rows == 4
    assert [x["ordinal"] for x in grown.df.orderBy("ordinal").collect()] == [0, 1, 2, 3]
    assert {x["category"]: x["entities"] for x in category_counts(grown).collect()} == {"client": 1, "contact": 3}


def test_match_order_is_longest_first(registry_of):
    r = registry_of(client=["Acme", "Acme Corp", "Beta"])
    assert [x["value"] for x in match_order(r).collect()] == ["Acme Corp", "Acme", "Beta"]


def test_self_test(spark):
    df = spark.createDataFrame([(f"N{i}",) for i in range(9)] + [("N1",)], "n string")
    assert [x["value"] for x in sample_values(df, "n").collect()] == ["N0", "N1", "N2"]
    ok, shown = self_test(df, "client", "n")
    assert ok and shown.count() == 3
    assert not self_test(df.where("n = ''"), "client", "n")[0]


@pytest.mark.parametrize("partitions", [1, 3, 17])
def test_dense_index_does_not_depend_on_partitions(spark, partitions):
    rows = [(i % 3, f"v{i * 7919 % 1000:04d}") for i in range(1000)]
    df = spark.createDataFrame(rows, "g int, v string").repartition(partitions)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        got = dense_index(df, ["g"], ["v"], measure="v")
        assert (got.rows, got.chars) == (1000, 5000)
        found = [(r["g"], r["v"], r["idx"], r["ordinal"]) for r in got.df.collect()]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    expected, position = [], 0
    for g in range(3):
        for i, v in enumerate(sorted(v for h, v in rows if h == g)):
            expected.append((g, v, i, position))
            position += 1
    assert sorted(found) == sorted(expected)


def test_running_windows_on_a_hot_group(spark):
    rows = [("hot" if i % 3 else "cold", i * 37 % 50, 1) for i in range(900)]
    df = spark.createDataFrame(rows, "g string, v int, one int")
    got = running(df, ["g"], F.desc("v"), total=running_sum("one"), rank=running_rank(), dense=running_dense_rank("v"))
    for g, v, _, total, rank, dense in got.collect():
        group = [x for h, x, _ in rows if h == g]
        assert total == sum(x >= v for x in group)
        assert rank == 1 + sum(x > v for x in group)
        assert dense == 1 + len({x for x in group if x > v})
    assert got.count() == 900


def test_copies_of_a_dictionary_are_never_broadcast(spark):
    """The planner sees a small file and would build all copies on the driver."""
    rows = spark.range(50).select((F.col("id") % 5).alias("k"), "id")
    dictionary = spark.range(5).select(F.col("id").alias("k"), (F.col("id") * 10).alias("v"))
    joined = salted_join(rows, dictionary, ["k"], F.col("id"), "inner")
    assert "Broadcast" not in joined._jdf.queryExecution().executedPlan().toString()
    assert sorted(map(tuple, joined.select("id", "v").collect())) == [(i, i % 5 * 10) for i in range(50)]
