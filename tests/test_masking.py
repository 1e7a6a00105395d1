import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from maskmetrics.operators import masking
from maskmetrics.functions.matcher import Matcher
from maskmetrics.operators.masking import _rewrite_array, holds_text, mask_json, mask_nested, mask_plan, mask_table, mask_text

PLANS = ("small", "medium", "large")

CASES = [
    (["IT"], "quality items in the IT backlog", "quality items in the Client_A backlog"),
    (["May"], "Maybe May will confirm in May.", "Maybe Client_A will confirm in Client_A."),
    (["Acme Corp"], "Report for Acme Corp's Q3 (ACME corp).", "Report for Client_A's Q3 (Client_A)."),
    (["Acme B.V."], "Invoice sent to Acme B.V. yesterday", "Invoice sent to Client_A yesterday"),
    (["Acme Corp", "Acme Corp BV"], "Invoice for Acme Corp BV was sent", "Invoice for Client_B was sent"),
    (["B C D", "A B"], "A B C D", "A Client_B"),
    (["b", "+d"], "b+d", "Client_BClient_A"),
    (["José"], "josé and JOSÉ, not joséx or 9josé", "Client_A and Client_A, not joséx or 9josé"),
    (["***"], "a *** b ****", "a Client_A b Client_A*"),
    (["Client"], "client CLIENT Client_A", "Client_A Client_A Client_A"),
    (["a.b", "x(y"], "a.b axb x(y", "Client_A axb Client_B"),
]


@pytest.mark.parametrize("values, text, expected", CASES)
def test_text_cases_in_all_plans(spark, registry_of, values, text, expected):
    r = registry_of(client=values)
    df = spark.createDataFrame([(1, text), (2, None), (3, "")], "id int, t string")
    # The joined plan runs over many such texts at once below.
    for plan in PLANS if values == ["***"] else PLANS[:2]:
        assert [x["t"] for x in mask_text(df, "t", r, plan).orderBy("id").collect()] == [expected, None, ""], plan


def test_noncharacters_in_text_are_kept(spark, registry_of):
    r = registry_of(client=["Acme", "Beta"])
    df = spark.createDataFrame([("﷐ Acme ﷑ beta",)], "t string")
    for plan in PLANS:
        assert mask_text(df, "t", r, plan).first()["t"] == "﷐ Client_A ﷑ Client_B"


def test_plans_agree_with_brute_force(spark, registry_of):
    """Random texts over few words, against the rule stated directly."""
    rng = random.Random(5)
    words = ["ab", "Cd", "e", "f+", "+g", "h.i", "É"]
    values = sorted({" ".join(rng.choices(words, k=rng.randint(1, 3))) for _ in range(18)})
    r = registry_of(client=values)
    entries = [(x["value"], x["alias"], x["ordinal"]) for x in r.df.collect()]
    texts = [rng.choice(["", "-", "x"]).join(rng.choice([" ", "", "  "]) + w for w in rng.choices(words, k=8))
             for _ in range(300)]

    def expected(text):
        spans = []
        for value, alias, ordinal in entries:
            guard = (r"(?<!\w)" if re.match(r"\w", value) else "") + re.escape(value) + (r"(?!\w)" if re.search(r"\w$", value) else "")
            at = 0
            while (m := re.compile(guard, re.I).search(text, at)):
                spans.append((-len(value), ordinal, m.start(), m.end(), alias))
                at = m.end()
        kept = []
        for s in sorted(spans):
            if all(s[3] <= k[2] or k[3] <= s[2] for k in kept):
                kept.append(s)
        for s in sorted(kept, key=lambda s: -s[2]):
            text = text[:s[2]] + s[4] + text[s[3]:]
        return text

    df = spark.createDataFrame(list(enumerate(texts)), "id int, t string")
    want = [expected(t) for t in texts]
    for plan in PLANS:
        assert [x["t"] for x in mask_text(df, "t", r, plan).orderBy("id").collect()] == want, plan


def test_nested_values_change_keys_and_numbers_do_not(spark, registry_of):
    r = registry_of(client=["Acme Corp"])
    schema = ("id int, results array<struct<tables: array<struct<rows: array<struct<name:string, value:long>>>>>>, "
              "tags map<string, array<string>>, n double, flag boolean")
    df = spark.createDataFrame([
        (1, [([([("Acme Corp", 42), (None, None)],)],)], {"Acme Corp": ["acme corp!", None]}, 1.5, True),
        (2, None, None, None, None), (3, [], {}, 0.0, False)], schema)
    for plan in PLANS:
        one, two, three = mask_table(df, r, plan).orderBy("id").collect()
        assert one["results"][0]["tables"][0]["rows"][0].asDict() == {"name": "Client_A", "value": 42}
        assert one["results"][0]["tables"][0]["rows"][1].asDict() == {"name": None, "value": None}
        assert one["tags"] == {"Acme Corp": ["Client_A!", None]} and one["n"] == 1.5 and one["flag"] is True
        assert two["results"] is None and two["tags"] is None
        assert three["results"] == [] and three["tags"] == {}
        assert mask_nested(df, "results", r, plan).schema == df.schema


def test_plan_choice_switch_and_empty_dictionary(spark, registry_of):
    few, many = registry_of(client=["a"]), registry_of(client=[f"name {i}" for i in range(40)])
    assert (mask_plan(few), mask_plan(many)) == ("small", "medium")
    df = spark.createDataFrame([("a",)], "t string")
    assert mask_table(df, few.disabled()) is df
    assert mask_table(df, registry_of(client=[])) is df
    assert not holds_text(spark.createDataFrame([(1,)], "n int").schema)


def test_large_plan_with_one_text_in_most_rows(spark, registry_of):
    r = registry_of(client=[f"Name {i}" for i in range(60)])
    hot = spark.range(3000).select("id", F.when(F.col("id") % 3 > 0, "to Name 7 and name 59").otherwise(
        F.concat(F.lit("x Name "), (F.col("id") % 100).cast("string"))).alias("t"))
    a = {x["id"]: x["t"] for x in mask_text(hot, "t", r, "large").collect()}
    b = {x["id"]: x["t"] for x in mask_text(hot, "t", r, "medium").collect()}
    assert a == b and len(a) == 3000


def test_matcher_keeps_positions_of_odd_characters():
    assert Matcher([("istanbul", "C", 0)]).replace("İx ISTANBUL") == "İx C"


def test_json_values_change_and_keys_do_not(spark, registry_of):
    r = registry_of(client=["Acme \"X\"", "k"])
    text = '{"k" : ["acme \\"x\\"", 1.50, null, {"a": "k\\n: k"}], "k:": "é\\u0041"}'
    df = spark.createDataFrame([(1, text), (2, None), (3, "[]"), (4, "no json")], "id int, j string")
    for plan in PLANS:
        got = [x["j"] for x in mask_json(df, "j", r, plan).orderBy("id").collect()]
        assert got == ['{"k" : ["Client_A", 1.50, null, {"a": "Client_B\\n: Client_B"}], "k:": "é\\u0041"}', None, "[]", "no json"], plan


def test_large_plan_moves_no_digest_of_a_text(spark, registry_of):
    """Texts and runs meet by their hashes; digests and words would be most of what is written."""
    registry = registry_of(client=["Acme Corp", "Zed"])
    df = spark.createDataFrame([(1, "by Acme Corp"), (2, "zed and ACME corp"), (3, "nobody"), (4, None)], "id int, text string")
    masked = mask_text(df, "text", registry, "large")
    written = re.findall(r"Relation \[([^\]]*)\]", masked._jdf.queryExecution().optimizedPlan().toString())
    assert any("_runs#" in w for w in written) and not any("_key#" in w for w in written)
    assert dict(map(tuple, masked.collect())) == {1: "by Client_A", 2: "Client_B and Client_A", 3: "nobody", 4: None}


def test_entries_of_other_texts_change_nothing(spark, registry_of, monkeypatch):
    """With one hash for all texts and runs every text gets every entry, and says the same."""
    registry = registry_of(client=["Acme Corp", "Zed", "Acme"])
    df = spark.createDataFrame([(1, "by Acme Corp"), (2, "zed and ACME corp"), (3, "acme")], "id int, text string")
    one = F.lit(7).cast("long")
    monkeypatch.setattr(masking.F, "xxhash64", lambda *c: one)
    monkeypatch.setattr(masking, "key_filter", lambda *a: lambda c: F.lit(True))
    masked = mask_text(df, "text", registry, "large").collect()
    assert dict(map(tuple, masked)) == {1: "by Client_B", 2: "Client_C and Client_B", 3: "Client_A"}


def test_every_leaf_knows_its_row():
    kind = pa.struct([("t", pa.string()), ("many", pa.list_(pa.struct([("s", pa.string()), ("n", pa.int64())]))), ("m", pa.map_(pa.string(), pa.list_(pa.string())))])
    rows = [{"t": "skipped", "many": None, "m": None}, None, {"t": "a", "many": [{"s": "b", "n": 1}, None, {"s": None, "n": 2}], "m": [("k", ["c", "d"]), ("l", None)]},
            {"t": None, "many": [], "m": []}, {"t": "e", "many": None, "m": None}, {"t": "f", "many": [{"s": "g", "n": 3}], "m": [("k", ["h"])]}]

    def named(strings, owner):
        return pa.array([None if s is None else f"{s}{i}" for s, i in zip(strings.to_pylist(), owner.tolist())], strings.type)

    got = _rewrite_array(pa.array(rows, kind).slice(1), named, np.arange(5)).to_pylist()
    assert got == [None, {"t": "a1", "many": [{"s": "b1", "n": 1}, None, {"s": None, "n": 2}], "m": [("k", ["c1", "d1"]), ("l", None)]},
                   {"t": None, "many": [], "m": []}, {"t": "e3", "many": None, "m": None}, {"t": "f4", "many": [{"s": "g4", "n": 3}], "m": [("k", ["h4"])]}]


def test_runs_found_by_a_broadcast_table_are_those_found_in_the_plan(spark, registry_of, monkeypatch):
    rng = random.Random(5)
    values = ["Acme Corp", "Acme", "B C D", "A B", "+++", "\u00c9 x", "new york city", "york"] + [f"Name {i}" for i in range(40)]
    registry = registry_of(client=values)
    pieces = [*values, "x", "ACME", "'s", "a", "e\u0301 X", "\n", "+", "b"]
    texts = ["".join(rng.choice(pieces) + rng.choice(" -") for _ in range(rng.randint(0, 12))) for _ in range(200)] + [None, ""]
    df = spark.createDataFrame([(i, [t, texts[-i - 1], None]) for i, t in enumerate(texts)], "id int, many array<string>")
    want = sorted(map(str, mask_nested(df, "many", registry, "large").collect()))
    tables = []
    monkeypatch.setattr(masking, "MOST_IN_PLAN", 0)
    monkeypatch.setattr(masking, "key_filter", lambda *a: tables.append(a))
    assert sorted(map(str, mask_nested(df, "many", registry, "large").collect())) == want
    assert tables == []
