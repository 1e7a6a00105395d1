import sys
from pathlib import Path

from maskmetrics.streaming.mask_stream import StreamMasker, mask_stream

SMALL = "/root/testdata/sf0.001"


def test_stream_learns_names_and_tokens(spark, registry_of, tmp_path):
    source, target = str(tmp_path / "in"), str(tmp_path / "out")
    first = spark.createDataFrame([(1, "Acme", "Acme wrote b@x.com"), (2, "Zed", "about acme")], "id int, who string, t string")
    first.coalesce(1).write.parquet(source + "/1")
    r = registry_of(client=["Acme"])
    stream = spark.readStream.schema(first.schema).option("recursiveFileLookup", True).parquet(source)

    def run():
        mask_stream(stream, r, target, str(tmp_path / "check"), [("who", "client")], "t", "id").awaitTermination()

    run()
    spark.createDataFrame([(3, "Beta", "a@x.com, b@x.com, Zed and Beta")], first.schema).coalesce(1).write.parquet(source + "/2")
    run()
    rows = {x["id"]: (x["who"], x["t"]) for x in spark.read.parquet(target + "/rows").collect()}
    assert rows == {1: ("Client_A", "Client_A wrote <EMAIL_ADDRESS_1>"), 2: ("Client_B", "about Client_A"),
                    3: ("Client_C", "<EMAIL_ADDRESS_2>, <EMAIL_ADDRESS_1>, Client_B and Client_C")}
    # A replayed batch changes nothing.
    again = StreamMasker(r, target, [("who", "client")], "t", "id")
    again.process(spark.createDataFrame([(3, "Beta", "a@x.com, b@x.com, Zed and Beta")], first.schema), 1)
    assert {x["id"]: (x["who"], x["t"]) for x in spark.read.parquet(target + "/rows").collect()} == rows
    # Each batch keeps only what it learned: Zed, then Beta.
    learned = spark.read.parquet(target + "/registry").select("batch_id", "value").collect()
    assert sorted(map(tuple, learned)) == [(0, "Zed"), (1, "Beta")]


def test_entry_and_registered_queries(spark):
    sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
    import __spark_entry__ as e
    queries, oracles = e.queries(), e.oracle_sql()
    assert set(oracles) <= set(queries) and len(queries) > 130
    rows = e.entry(spark).orderBy("rank").collect()
    assert [r["rank"] for r in rows] == list(range(1, 16))
    assert all(r["name"].startswith("Client_") for r in rows)


def test_filters_and_columns_reach_the_scan(spark):
    from maskmetrics.plans import load_queries
    queries, _ = load_queries()
    plan = queries["filtered_ticket_metrics"](spark, SMALL)._jdf.queryExecution().toString()
    assert "EqualTo(o_orderpriority,1-URGENT)" in plan and "1-URGENT), GreaterTh" in plan
    plan = queries["revenue_billing_kpis"](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<l_quantity:double,l_extendedprice:double,l_discount:double>" in plan and "Join" not in plan
    plan = queries["client_project_report"](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "l_extendedprice" not in plan
