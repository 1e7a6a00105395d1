import random

import pytest
from pyspark.sql import functions as F

from maskmetrics.operators.restoring import (
    filter_and_mask, filter_by_alias, restore_counts, restore_html, restore_text, rewrite_alias_literals,
    without_categories)
from maskmetrics.sources.mapping_store import MappingStore, mapping_from_json, new_session
from maskmetrics.sources.reports import read_reports, restore_files, write_verification

PLANS = ("broadcast", "join")

CASES = [
    ({"Client_A": "Acme", "Resource_1": "Jan"}, "Client_A ticket assigned to Resource_1", "Acme ticket assigned to Jan"),
    ({"Client": "Short", "Client_Alpha": "Long Name"}, "Client_Alpha and Client", "Long Name and Short"),
    ({"<ORGANIZATION_62>": "Org"}, "ORGANIZATION_621 stays, ORGANIZATION_62 restores.", "ORGANIZATION_621 stays, Org restores."),
    ({"<PERSON_1>": "Jan"}, "<PERSON_1> met <PERSON_2>", "Jan met <PERSON_2>"),
    ({"Client_A": "Client_B", "Client_B": "Zed"}, "Client_A Client_B", "Client_B Zed"),
    ({"Client_A": "Acme"}, "Client_AB", "Client_AB"),
    ({"Client_A": "Acme", "Resource_1": "Jan"}, "_Client_A_ and QBR_Client_A.html, Client_A's x Client_A_2026, Resource_1a Resource_12",
     "_Acme_ and QBR_Acme.html, Acme's x Acme_2026, Jana Resource_12"),
    ({"Client": "Short", "Client_A": "Acme", "Client_Alpha": "Long", "x.y": "Dot"}, "Client_AlphaClient_A Client x.y xzy", "LongAcme Short Dot xzy"),
]


def mapping_frame(spark, mapping):
    return spark.createDataFrame(list(mapping.items()), "alias string, value string")


@pytest.mark.parametrize("mapping, text, expected", CASES)
def test_restore_text(spark, mapping, text, expected):
    df = spark.createDataFrame([(1, text), (2, None), (3, "")], "id int, t string")
    for plan in PLANS:
        got = restore_text(df, "t", mapping_frame(spark, mapping), plan=plan).orderBy("id").collect()
        assert [r["t"] for r in got] == [expected, None, ""], plan


def test_restore_html_escapes_values(spark):
    mapping = mapping_frame(spark, {"Client_A": "Tom & Jerry", "<PERSON_1>": "<b>\"O'Neil\"</b>"})
    df = spark.createDataFrame([("<p>Client_A</p> &lt;PERSON_1&gt; <PERSON_1>",)], "html string")
    safe = "&lt;b&gt;&quot;O&#x27;Neil&quot;&lt;/b&gt;"
    for plan in PLANS:
        assert restore_html(df, "html", mapping, plan).first()["html"] == f"<p>Tom &amp; Jerry</p> {safe} {safe}"
    assert restore_counts(df, "html", mapping).first()["restored"] == 3


def test_selective_restore(spark):
    mapping = without_categories(mapping_frame(spark, {"Client_A": "Acme", "Resource_1": "Jan"}), ["Resource_"])
    df = spark.createDataFrame([("Client_A Resource_1",)], "t string")
    assert restore_text(df, "t", mapping).first()["t"] == "Acme Resource_1"


QUERIES = [
    ('T[n] = "Client_A"', 'T[n] = "Acme ""BV"""', 1),
    ("Client_A = 1", "Client_A = 1", 0),
    ('T[n] = "Client_Z"', 'T[n] = "Client_Z"', 0),
    ('T[n] = "<PERSON_1>"', 'T[n] = "Jan"', 1),
    ('"Client_A" || "Resource_1" && "<PERSON_1>"', '"Acme ""BV""" || "Piet" && "Jan"', 3),
    ('"a ""Client_A"" b" Client_A', '"a ""Acme ""BV"""" b" Client_A', 1),
    ('"Item_1 Partner_2"', '"Weekly Zed"', 2),
    (None, None, 0),
]


def test_rewrite_alias_literals(spark):
    mapping = mapping_frame(spark, {"Client_A": 'Acme "BV"', "<PERSON_1>": "Jan", "Resource_1": "Piet", "Item_1": "Weekly",
                                    "Partner_2": "Zed"})
    df = spark.createDataFrame([(i, q) for i, (q, _, _) in enumerate(QUERIES)], "id int, query string")
    for plan in PLANS:
        got = rewrite_alias_literals(df, "query", mapping, ["partner"], plan=plan).orderBy("id").collect()
        assert [(r["rewritten"], r["n"]) for r in got] == [(q, n) for _, q, n in QUERIES], plan


def test_filter_by_alias_round_trip(spark, registry_of):
    r = registry_of(client=["Acme Corp", "Beta"])
    df = spark.createDataFrame([("ACME corp", 1), ("beta", 2), ("Other", 3)], "n string, v int")
    assert [x["v"] for x in filter_by_alias(df, "n", ["Client_A"], r).collect()] == [1]
    assert [tuple(x) for x in filter_and_mask(df, "n", ["Client_B"], r).collect()] == [("Client_B", 2)]
    assert [x["v"] for x in filter_by_alias(df, "n", ["other"], r).collect()] == [3]


def test_mapping_store(spark, tmp_path):
    store = MappingStore(spark, str(tmp_path / "store"), retention_days=0)
    assert store.load_latest() is None
    stats = spark.createDataFrame([(2, 0, False)], "registry_entities long, detections long, degraded boolean")
    a, b = new_session(), new_session()
    mapping = mapping_frame(spark, {"Client_A": "Acme", "Client_B": "Beta"})
    store.save(mapping, stats, a, F.lit("2026-01-01 10:00:00").cast("timestamp"))
    store.save(mapping.limit(1), stats, b, F.lit("2026-01-02 10:00:00").cast("timestamp"))
    assert {r["alias"]: r["value"] for r in store.load(a).collect()} == {"Client_A": "Acme", "Client_B": "Beta"}
    assert store.latest_session() == b
    assert "PartitionFilters: [isnotnull(session_id" in store.load(a)._jdf.queryExecution().toString()
    never = MappingStore(spark, store.path, retention_days=-1)
    assert never.expire(None) == 0
    assert store.expire(b) == 1 and store.load(b).count() == 1
    with pytest.raises(FileNotFoundError):
        store.load(a)


def test_session_without_time_stamp_is_kept(spark, tmp_path):
    store = MappingStore(spark, str(tmp_path / "store"), retention_days=1)
    stats = spark.createDataFrame([(2, 0, False)], "registry_entities long, detections long, degraded boolean")
    store.save(mapping_frame(spark, {"Client_A": "Acme"}), stats, "s", F.lit(None).cast("timestamp"))
    assert store.expire(None) == 0 and store.load("s").count() == 1


def test_mapping_from_json(spark):
    df = spark.createDataFrame([('{"mappings": {"Client_A": "Acme"}, "created": "x"}',), ('{"Client_B": "Beta"}',)], "j string")
    assert {r["alias"]: r["value"] for r in mapping_from_json(df, "j").collect()} == {"Client_A": "Acme", "Client_B": "Beta"}


def test_report_files(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.html").write_text("<p>Client_A\nsecond line</p>", encoding="utf-8")
    assert read_reports(spark, str(tmp_path / "in")).count() == 1
    restore_files(spark, str(tmp_path / "in"), mapping_frame(spark, {"Client_A": "A & B"}), str(tmp_path / "out"))
    assert spark.read.parquet(str(tmp_path / "out")).first()["html"] == "<p>A &amp; B\nsecond line</p>"
    results = spark.createDataFrame([("PASS",), ("FAIL",), ("ERROR",)], "status string")
    write_verification(results, str(tmp_path / "json"))
    assert spark.read.json(str(tmp_path / "json" / "totals")).first().asDict() == {"total": 3, "passed": 1, "failed": 2}


def test_mask_and_restore_give_the_text_back(spark, registry_of):
    from maskmetrics.operators.masking import mask_text
    r = registry_of(client=["Acme Corp", "Beta"], resource=["Jan"])
    df = spark.createDataFrame([("Jan of Acme Corp met Beta; x",), ("none",)], "t string")
    masked = mask_text(df, "t", r)
    assert masked.where(F.col("t").contains("Acme")).isEmpty()
    assert restore_text(masked, "t", r.df.select("alias", "value")).collect() == df.collect()


def test_a_mapping_of_many_odd_aliases_restores_as_a_small_one(spark):
    few = {"Client_A": "Acme", "Resource_1": "Jan", "north star": "Polaris", "x.y-z": "Dot", "x.y": "Dos", "Client_Alpha": "Long", "ab": "AB"}
    texts = ["_Client_A_ QBR_Client_A.html Resource_12", "the north stars, ax.y-zb x.yab", "Client_AlphaResource_1x", "xzy Nothing"]
    want = ["_Acme_ QBR_Acme.html Resource_12", "the Polariss, aDotb DosAB", "LongJanx", "xzy Nothing"]
    many = few | {f"odd alias-{i}!": f"value {i}" for i in range(1_500)} | {f"stem{i}_1": f"s{i}" for i in range(1_200)}
    df = spark.createDataFrame(list(enumerate([*texts, "zodd alias-1499!z odd alias-14! xstem1199_1"])), "id int, t string")
    for plan in PLANS:
        assert [r["t"] for r in restore_text(df, "t", mapping_frame(spark, few), plan=plan).orderBy("id").collect()][:4] == want
        got = [r["t"] for r in restore_text(df, "t", mapping_frame(spark, many), plan=plan).orderBy("id").collect()]
        assert got == [*want, "zvalue 1499z value 14 xs1199"]
        assert [r["t"] for r in restore_html(df, "t", mapping_frame(spark, many), plan=plan).orderBy("id").collect()] == got


@pytest.mark.parametrize("most", [(0, 10_000), (0, 0)])
def test_looked_up_aliases_restore_as_listed_ones(spark, monkeypatch, most):
    from maskmetrics.operators import restoring
    rng = random.Random(11)
    names = ["Client_A", "Client_12", "Client_1", "Client_Alpha", "Client_", "AB", "AB_1-X", "<PERSON_1>", "<PERSON_2>", "north star", "north", "x.y", "(a|b)*",
             "A_B_1", "A_C", "é_1", "é", "_", "stem_1x", "stem_7", "em_", "a&b", "long alias " * 9, "😀", "😀😀_3"]
    mapping = {n: f"«{i}»" for i, n in enumerate(names)}
    pieces = [*names, "Client_13", "Client_B", "PERSON_1", "PERSON_9", "stem_12", "1", "x", " ", "-", "&lt;PERSON_2&gt;", "AB_12", "Cli", "A_B_", "long alias "]
    texts = ["".join(rng.choice(pieces) for _ in range(rng.randint(0, 9))) for _ in range(250)] + [None, "", "x" * 50_000 + "north star", "AB", "AB"]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, t string")
    frame = mapping_frame(spark, mapping)
    want = {html: {r["id"]: r["t"] for r in restore_text(df, "t", frame, html=html).collect()} for html in (False, True)}
    counts = {r["id"]: r["restored"] for r in restore_counts(df, "t", frame).collect()}
    monkeypatch.setattr(restoring, "MOST_LISTED", most[0])
    monkeypatch.setattr(restoring, "MOST_STEMS", most[1])
    for html in (False, True):
        assert {r["id"]: r["t"] for r in restore_text(df, "t", frame, html=html).collect()} == want[html]
    assert {r["id"]: r["restored"] for r in restore_counts(df, "t", frame).collect()} == counts
    assert restore_text(df, "t", frame).columns == ["id", "t"]
    assert restore_text(df.limit(0), "t", frame).count() == 0
    assert restore_text(df, "t", frame.limit(0)).count() == len(texts)


def test_strings_in_texts_against_a_scan(spark):
    from maskmetrics.operators.odd_aliases import held_strings
    rng = random.Random(4)
    strings = {"".join(rng.choice("abc ") for _ in range(rng.randint(1, 9))) for _ in range(300)}
    texts = ["".join(rng.choice("abc d") for _ in range(rng.randint(0, 60))) for _ in range(80)]
    df = spark.createDataFrame([*enumerate(texts), (900, None)], "text_key int, text string")
    known = spark.createDataFrame([(s, [str(len(s))]) for s in strings], "string string, labels array<string>")
    got = {r["text_key"]: {(x["string"], *x["labels"]) for x in r["found"]} for r in held_strings(df, known).collect()}
    want = {i: {(s, str(len(s))) for s in strings if s in t} for i, t in enumerate(texts)}
    assert got == {i: f for i, f in want.items() if f}


def test_joined_values_move_no_digest_of_the_words(spark):
    mapping = spark.createDataFrame([("Client_A", "Acme"), ("Client_B", "Zed")], "alias string, value string")
    df = spark.createDataFrame([(1, "Client_A, Client_B, Client_A"), (2, "Client_A, Client_B, Client_A"), (3, "none"), (4, "Client_C"), (5, None)], "id int, text string")
    restored = restore_text(df, "text", mapping, plan="join")
    assert "sha2(" not in restored._jdf.queryExecution().optimizedPlan().toString()
    assert dict(map(tuple, restored.collect())) == {1: "Acme, Zed, Acme", 2: "Acme, Zed, Acme", 3: "none", 4: "Client_C", 5: None}


def test_texts_of_foreign_aliases_take_no_part_in_the_join(spark):
    mapping = spark.createDataFrame([(f"Client_{i}", f"Acme \"{i}\"") for i in range(27, 60)], "alias string, value string")
    texts = [(i, f'F("Client_{i}") && Client_{i} = "Client_27 or Client_{i}"') for i in range(50, 400)] + [(1, "none"), (2, '"Client_999"'), (3, None)]
    df = spark.createDataFrame(texts, "id int, text string")
    by_plan = {p: rewrite_alias_literals(df, "text", mapping, plan=p) for p in ("join", "broadcast")}
    assert "Union" in by_plan["join"]._jdf.queryExecution().optimizedPlan().toString()
    got = {p: sorted(map(tuple, r.collect())) for p, r in by_plan.items()}
    assert got["join"] == got["broadcast"] and len(got["join"]) == len(texts)
    foreign = spark.createDataFrame([(2, '"Client_999"')], "id int, text string")
    assert rewrite_alias_literals(foreign, "text", mapping, plan="join").first()["rewritten"] == '"Client_999"'


def test_verification_is_worked_out_once_for_both_outputs(spark, tmp_path):
    seen = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def status(i):
        seen.add(1)
        return "PASS" if i else "FAIL"

    write_verification(spark.range(4).select(status("id").alias("status")), str(tmp_path / "json"))
    assert seen.value == 4
    assert spark.read.json(str(tmp_path / "json" / "totals")).first().asDict() == {"total": 4, "passed": 3, "failed": 1}


def test_strings_with_common_grams_have_keys_of_their_own(spark):
    from maskmetrics.operators.odd_aliases import gram_index
    strings = spark.range(3_000).select(F.concat(F.lit("desk-"), F.col("id").cast("string"), F.lit("#")).alias("string"))
    shared = gram_index(strings).groupBy("gram").count().agg(F.max("count")).first()[0]
    assert shared == 1


def test_no_plan_holds_the_table_of_a_large_mapping(spark, monkeypatch):
    from maskmetrics.operators import lookup
    seen = []
    monkeypatch.setattr(lookup, "settle", lambda df, label, *a: seen.append((label, df._jdf.queryExecution().optimizedPlan().toString())) or df)
    mapping = spark.range(27, 20_000).select(F.concat(F.lit("Client_"), F.col("id").cast("string")).alias("alias"), F.concat(F.lit("Acme "), F.col("id").cast("string")).alias("value"))
    df = spark.createDataFrame([(1, "Client_27, Client_19999 and Client_27"), (2, "none"), (3, None), (4, "Client_20000")], "id int, text string")
    restored = restore_text(df, "text", mapping, plan="join")
    assert "wanted" in dict(seen) and max(len(plan) for _, plan in seen) < 20_000
    monkeypatch.undo()
    assert dict(map(tuple, restored.collect())) == {1: "Acme 27, Acme 19999 and Acme 27", 2: "none", 3: None, 4: "Client_20000"}
