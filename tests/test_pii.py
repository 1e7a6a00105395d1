import random
import re

import regex

from pyspark.sql import functions as F

from maskmetrics.functions.pii_rules import PATTERN_DETECTORS, is_false_positive, luhn_valid, iban_valid
from maskmetrics.operators.pii import (
    PluginDetector, anonymize, assign_tokens, detect_pii, pass2_state, pii_summary, replace_spans)

SCREENED = [
    ("0f8fad5b-d9cb-469f-a165-70867728950e", "ORGANIZATION", True), ("ba67bb89", "ORGANIZATION", True),
    ("218", "PERSON", True), ("2026-01-21", "PERSON", True), ("2026-01-21T10:30:00", "PERSON", True),
    ("0612345678", "PHONE_NUMBER", False), ("4111111111111111", "CREDIT_CARD", False),
    ("DIVIDE", "ORGANIZATION", True), ("Hours", "ORGANIZATION", True), ("Ratio", "PERSON", True), ("COUNTX", "PERSON", True),
    ("P1-Kritisch", "PERSON", True), ("P4-Laag", "PERSON", True), ("P5-x", "PERSON", False), ("  ", "PERSON", True),
    ("John Smith", "PERSON", False), ("Wu-Jackson Holding", "ORGANIZATION", False), ("Project Phoenix", "PERSON", False),
    ("12345678", "PHONE_NUMBER", False), (" May ", "PERSON", True),
]


def test_false_positives(spark):
    df = spark.createDataFrame([(i, t, k) for i, (t, k, _) in enumerate(SCREENED)], "i int, t string, k string")
    got = df.select("i", is_false_positive("t", "k").alias("f")).orderBy("i").collect()
    assert [r["f"] for r in got] == [f for _, _, f in SCREENED]


def test_checksums(spark):
    df = spark.createDataFrame([("4111 1111 1111 1111", "NL91ABNA0417164300"), ("4111 1111 1111 1112", "NL92ABNA0417164300"),
                                ("5500-0055-5555-5559", "GB82WEST12345698765432")], "c string, i string")
    got = df.select(luhn_valid(F.col("c")), iban_valid(F.col("i"))).collect()
    assert [tuple(r) for r in got] == [(True, True), (False, False), (True, True)]


TEXT = ("😀 mail a@b.com or A@B.com, ssn 123-45-6789, iban NL91ABNA0417164300 card 4111 1111 1111 1111 bad 4111 1111 1111 1112 "
        "ip 10.0.0.1 +1 (663) 555-6869 0612345678 www.q.nl https://x.org/p?q=a@b.com Client_A")


def test_spans_count_code_points(spark):
    df = spark.createDataFrame([(1, TEXT), (2, None), (3, "nothing here")], "id int, t string")
    one, two, three = (r["spans"] for r in detect_pii(df, "t").orderBy("id").collect())
    assert two == [] and three == []
    assert all(TEXT[s["start"]:s["end"]] == s["text"] for s in one)
    assert [s["entity_type"] for s in one] == [
        "EMAIL_ADDRESS", "EMAIL_ADDRESS", "US_SSN", "IBAN_CODE", "CREDIT_CARD", "IP_ADDRESS", "PHONE_NUMBER",
        "PHONE_NUMBER", "URL", "EMAIL_ADDRESS"]


def test_spans_agree_with_python_on_random_texts(spark):
    rng = random.Random(3)
    pieces = ["a@b.co", "10.2.3.4", "x", " ", "é", "😀", "www.a.b", "123-45-6789", "0612345678", ",", "4111111111111111"]
    texts = [" ".join("".join(rng.choices(pieces, k=2)) for _ in range(12)) for _ in range(200)]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, t string")
    for detector in PATTERN_DETECTORS:
        if detector.valid is not None or detector.context or detector.entity_type == "IP_ADDRESS":
            continue
        got = {r["id"]: [(s["start"], s["end"]) for s in r["spans"]] for r in detect_pii(df, "t", [detector]).collect()}
        for i, t in enumerate(texts):
            # Java's word boundary sees letters of any script, like Python's.
            assert got[i] == [m.span() for m in regex.finditer(detector.pattern, t)], (detector.entity_type, t)


def test_tokens_are_shared_and_numbered_from_the_right(spark):
    df = spark.createDataFrame([(1, "x@a.com y@a.com"), (2, "Y@A.com 10.0.0.1 z@a.com")], "id int, t string")
    detected = detect_pii(df, "t")
    table = assign_tokens(detected, "id")
    assert {r["alias"]: (r["value"], r["sightings"]) for r in table.df.collect()} == {
        "<EMAIL_ADDRESS_1>": ("y@a.com", 2), "<EMAIL_ADDRESS_2>": ("x@a.com", 1), "<EMAIL_ADDRESS_3>": ("z@a.com", 1),
        "<IP_ADDRESS_1>": ("10.0.0.1", 1)}
    for plan in ("broadcast", "join"):
        assert [r["t"] for r in replace_spans(detected, "t", table, plan=plan).orderBy("id").collect()] == [
            "<EMAIL_ADDRESS_2> <EMAIL_ADDRESS_1>", "<EMAIL_ADDRESS_1> <IP_ADDRESS_1> <EMAIL_ADDRESS_3>"]
    counts = {r["entity_type"]: (r["detections"], r["distinct_values"]) for r in pii_summary(detected).collect()}
    assert counts == {"EMAIL_ADDRESS": (4, 3), "IP_ADDRESS": (1, 1)}


def test_types_replace_the_default(spark):
    df = spark.createDataFrame([(1, "a@b.com 10.0.0.1")], "id int, t string")
    assert [s["entity_type"] for s in detect_pii(df, "t", types=["IP_ADDRESS"]).first()["spans"]] == ["IP_ADDRESS"]


def test_plugin_detector_states(spark, registry_of):
    def find(texts):
        return [[(m.start(), m.end(), kind, 0.9) for kind, p in (("PERSON", "John Smith|May|Client_A"), ("DATE_TIME", r"\d{4}-\d\d-\d\d"))
                 for m in re.finditer(p, t)] + [(0, 1, "PERSON", 0.2)] for t in texts]

    plugin = PluginDetector("Names", find)
    df = spark.createDataFrame([(1, "Acme: John Smith in May 2026-01-02")], "id int, t string")
    done = anonymize(df, "t", "id", registry_of(client=["Acme"]), plugin=plugin)
    assert done.df.first()["t"] == "Client_A: <PERSON_1> in May 2026-01-02"
    assert {r["alias"]: r["source"] for r in done.mapping.collect()} == {"Client_A": "registry", "<PERSON_1>": "detection"}
    assert plugin.state() == "active" and pass2_state(True, plugin) == "active"
    broken = PluginDetector("Broken", lambda texts: 1 / 0)
    assert detect_pii(df, "t", plugin=broken).collect()[0]["spans"] == []
    assert broken.state() == "failed" and "failed" in broken.status_line()
    assert PluginDetector("Missing", None).state() == "not_installed"
    assert PluginDetector("Off", find, enabled=False).state() == "disabled"
    assert pass2_state(False) == "disabled" and pass2_state(True) == "active"


def test_anonymize_switches(spark, registry_of):
    df = spark.createDataFrame([(1, "Acme a@b.com")], "id int, t string")
    r = registry_of(client=["Acme"])
    assert anonymize(df, "t", "id", r).df.first()["t"] == "Client_A <EMAIL_ADDRESS_1>"
    assert anonymize(df, "t", "id", r, pass2=False).df.first()["t"] == "Client_A a@b.com"
    assert anonymize(df, "t", "id", r.disabled()).df.first()["t"] == "Acme a@b.com"


def test_one_unreadable_text_loses_only_its_own_spans(spark):
    def find(texts):
        if any("bad" in t for t in texts):
            raise ValueError("cannot read")
        return [[(0, 4, "PERSON", 0.9)] for _ in texts]

    df = spark.createDataFrame([(1, "Jane went"), (2, "bad a@b.example"), (3, "Jill left")], "id int, t string").coalesce(1)
    plugin = PluginDetector("names", find)
    got = detect_pii(df, "t", plugin=plugin, errors="error").orderBy("id").collect()
    assert [[s["text"] for s in r["spans"]] for r in got] == [["Jane"], ["a@b.example"], ["Jill"]]
    assert [r["error"] for r in got] == [None, "ValueError: cannot read", None]
    assert plugin.state() == "failed" and "cannot read" in plugin.status_line()


FOUND = [("NL91 ABNA 0417 1643 00", "IBAN_CODE"), ("+31 6 12345678", "PHONE_NUMBER"), ("06-12345678", "PHONE_NUMBER"),
         ("2001:db8::ff00:42:8329", "IP_ADDRESS"), ("josé@x.nl", "EMAIL_ADDRESS"), ("FX1234563", "MEDICAL_LICENSE"),
         ("1:2:3:4:5:6:7:8", "IP_ADDRESS")]


def test_further_shapes(spark):
    df = spark.createDataFrame([(i, f"at {t}, then") for i, (t, _) in enumerate(FOUND)] + [(90, "NL92 ABNA 0417 1643 00 FX1234564 12:30:45 a::")],
                               "id int, t string")
    got = {r["id"]: [(s["text"], s["entity_type"]) for s in r["spans"]] for r in detect_pii(df, "t").collect()}
    assert [got[i] for i in range(len(FOUND))] == [[f] for f in FOUND] and got[90] == []


def test_very_many_values_in_one_text(spark):
    n = 5000
    text = " é ".join(f"u{i}@mail.example" for i in range(n))
    df = spark.createDataFrame([(1, text)], "id long, t string")
    found = detect_pii(df, "t")
    spans = found.first()["spans"]
    assert len(spans) == n and all(text[s["start"]:s["end"]] == s["text"] for s in spans)
    done = replace_spans(found, "t", assign_tokens(found, "id")).first()["t"]
    assert done == " é ".join(f"<EMAIL_ADDRESS_{n - i}>" for i in range(n))


def test_wallet_addresses_need_their_checksum(spark):
    from maskmetrics.functions.pii_rules import base58_hex, crypto_valid
    good = ["1A1zP1eP5QGefi2DMPTfTL5SLmv7DivfNa", "1BvBMSEYstWetqTFn5Au4m4GFg7xJaNVN2", "3J98t1WpEZ73CNmQviecrnyiWrnqRhWNLy", "1111111111111111111114oLvT2",
            "bc1qw508d6qejxtdg4y5r3zarvary0c5xw7kv8f3t4", "BC1QW508D6QEJXTDG4Y5R3ZARVARY0C5XW7KV8F3T4",
            "bc1p0xlxvlhemja6c4dqv22uapctqupfhlxm9h8z3k2e72q4k9hcz7vqzk5jj0"]
    bad = ["1A1zP1eP5QGefi2DMPTfTL5SLmv7DivfNb", "11A1zP1eP5QGefi2DMPTfTL5SLmv7DivfNa", "A1zP1eP5QGefi2DMPTfTL5SLmv7DivfNa", "3J98t1WpEZ73CNmQviecrnyiWrnqRhWNLz",
           "bc1qw508d6qejxtdg4y5r3zarvary0c5xw7kv8f3t5", "bc1QW508D6QEJXTDG4Y5R3ZARVARY0C5XW7KV8F3T4", "bc1p0xlxvlhemja6c4dqv22uapctqupfhlxm9h8z3k2e72q4k9hcz7vqzk5jj2"]
    df = spark.createDataFrame([(a, i < len(good)) for i, a in enumerate(good + bad)], "a string, ok boolean")
    assert df.where(crypto_valid(F.col("a")) != F.col("ok")).collect() == []
    digits = "123456789ABCDEFGHJKLMNPQRSTUVWXYZabcdefghijkmnopqrstuvwxyz"
    for r in df.where("a LIKE '1%' OR a LIKE '3%'").select("a", base58_hex(F.col("a")).alias("h")).collect():
        value = 0
        for c in r["a"]:
            value = value * 58 + digits.index(c)
        assert int(r["h"], 16) == value and len(r["h"]) == 54
    text = "old 1A1zP1eP5QGefi2DMPTfTL5SLmv7DivfNa, bc1qw508d6qejxtdg4y5r3zarvary0c5xw7kv8f3t4 and 1A1zP1eP5QGefi2DMPTfTL5SLmv7DivfNb."
    spans = detect_pii(spark.createDataFrame([(text,)], "t string"), "t").first()["spans"]
    assert [(s["entity_type"], s["text"]) for s in spans] == [("CRYPTO", good[0]), ("CRYPTO", good[4])]


def test_weak_patterns_pass_with_their_context_only(spark):
    cases = {
        "Bank account: 12345678": [("US_BANK_NUMBER", "12345678")], "BANK 123456789012345678": [], "12345678 is the account": [],
        "my bank, as I said to you all, 12345678": [], "accounts 12345678, 23456789": [("US_BANK_NUMBER", "12345678"), ("US_BANK_NUMBER", "23456789")],
        "accountant 12345678": [], "passport X12345678 ok": [("US_PASSPORT", "X12345678")], "passport 123456789": [], "X12345678": [],
        # Shapes that are never personal stay out even in context: hexadecimal ids and plain numbers.
        "passport A12345678": [], "driving licence no. Y1234567": [("US_DRIVER_LICENSE", "Y1234567")], "driver 1234567YZ": [("US_DRIVER_LICENSE", "1234567YZ")],
        "permit Y123": [], "": [], "account " + "x" * 200 + " 12345678": []}
    df = spark.createDataFrame([(i, t) for i, t in enumerate(cases)] + [(900, None)], "id int, t string")
    got = {r["id"]: [(s["entity_type"], s["text"]) for s in r["spans"] or ()] for r in detect_pii(df, "t").collect()}
    assert got == {i: want for i, want in enumerate(cases.values())} | {900: []}
    long = "account 12345678 " * 3_000
    spans = detect_pii(spark.createDataFrame([(long,)], "t string"), "t").first()["spans"]
    assert len(spans) == 3_000 and spans[-1]["end"] == len(long) - 1
    assert all(not r["spans"] for r in detect_pii(df, "t", threshold=0.8).collect())


def test_base58_numbers_by_chunks(spark):
    from maskmetrics.functions.pii_rules import BASE58, BASE58_CHUNK, base58_hex
    # A limb times the weight of a chunk, and what is carried, fit in a long.
    assert 58 ** BASE58_CHUNK << 24 < 1 << 62
    texts = ["1" * n for n in (1, 6, 30)] + [(BASE58[::-1] + BASE58)[:n] for n in range(1, 37)]

    def number(text):
        value = 0
        for ch in text:
            value = value * 58 + BASE58.index(ch)
        return f"{value:054X}"

    got = spark.createDataFrame([(t,) for t in texts], "t string").select("t", base58_hex(F.col("t")).alias("h")).collect()
    assert all(r["h"] == number(r["t"]) for r in got) and len(got) == len(texts)
