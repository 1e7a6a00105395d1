import base64
import random
import tracemalloc

import numpy as np
import pytest

from maskmetrics.llm import simhash, toxicity, words
from maskmetrics.llm.bpe import Merger, TextDecoder, TextEncoder, encode_texts, read_ranks

tokenizers = pytest.importorskip("public_tokenizers")
RANKS = tokenizers.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def reference():
    import tiktoken
    with open(RANKS, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def merger():
    return Merger(read_ranks(RANKS))


def _texts():
    rng = random.Random(5)
    alphabets = ["ab cd", "the of and ", " \n\t\r\x0b\x1c\x85\xa0 x'", "éèçß ñó, .", "0123 45٣", "漢字かな 한글", "🙂👍🏽 ‍",
                 "'s't're'LL I'm", "́è ", "<|endoftext|> ", "\x00\x01 ퟿", "AaBbZz!?*$%#  "]
    for _ in range(1500):
        letters = "".join(rng.sample(alphabets, rng.randint(1, 3)))
        yield "".join(rng.choice(letters) for _ in range(rng.randint(0, 40)))
    yield from ("", " ", "  ", "a", "\n\n a", "a \n\n  b", "x" * 700, "ab" * 3000, " " * 900 + "z", "é" * 1000, "the " * 400,
                "".join(rng.choice("abcdefgh") for _ in range(5000)))


def test_ids_are_those_of_the_public_library(merger, reference):
    texts = list(_texts())
    encoder = TextEncoder(merger, tokenizers.PATTERN)
    for at in range(0, len(texts), 200):
        some = texts[at:at + 200]
        ids, counts = encoder.encode([t.encode() for t in some])
        parts = np.split(ids, np.cumsum(counts)[:-1])
        for text, got in zip(some, parts):
            assert got.tolist() == reference.encode_ordinary(text), repr(text)
        assert TextDecoder(merger.tokens).decode(ids, counts) == [t.encode() for t in some]


def test_forgetting_pieces_changes_nothing(merger):
    small, large = TextEncoder(merger, tokenizers.PATTERN), TextEncoder(merger, tokenizers.PATTERN)
    small._spaced._limit = small._first._limit = 3
    for text in _texts():
        a, b = small.encode([text.encode()]), large.encode([text.encode()])
        assert a[0].tolist() == b[0].tolist() and a[1].tolist() == b[1].tolist()


def test_rows_null_empty_and_clashing(spark, reference):
    schema = "doc_id long, text string, ids string, __text2 int"
    rows = [(1, "the of", "x", 1), (1, "the of", "x", 1), (2, None, None, None), (None, "", "y", 2)]
    got = encode_texts(spark.createDataFrame(rows, schema), RANKS, tokenizers.PATTERN, decoded="back").collect()
    assert len(got) == 4 and got[0].asDict().keys() == {"doc_id", "text", "__text2", "ids", "back"}
    for r in got:
        ids = np.frombuffer(bytes(r["ids"]), "<u4").tolist()
        assert ids == reference.encode_ordinary(r["text"] or "") and bytes(r["back"]) == (r["text"] or "").encode()
    assert encode_texts(spark.createDataFrame([], schema), RANKS, tokenizers.PATTERN).count() == 0


def test_matrices_of_many_new_pieces_stay_small(merger):
    rng = random.Random(8)
    pieces = list({bytes(rng.choices(b"abcdefghijklmnopqrstuvwxyz", k=rng.randint(17, 32))) for _ in range(60_000)})
    tracemalloc.start()
    merger.encode(pieces)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 60 << 20


def test_hash_powers_are_no_larger_than_asked():
    powers = words._Powers()
    up, down = powers.upto((1 << 21) + 2)
    assert len(up) == len(down) == (1 << 21) + 2 and len(powers.up) < (1 << 21) + (1 << 17)
    assert int(up[-1]) * int(down[-1]) % (1 << 64) == 1


@pytest.mark.parametrize("add", [
    lambda df: encode_texts(df, RANKS, tokenizers.PATTERN), lambda df: simhash.with_fingerprints(df),
    lambda df: toxicity.with_passages(df, toxicity.Model(np.zeros(0, np.uint64), np.zeros(0), -0.01, 1.0))])
def test_a_text_that_is_carried_along_goes_to_python_once(spark, add):
    rows = [(1, "one two", "x"), (2, None, "y"), (2, "", "x"), (2, "", "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    out, other = add(df), add(df.select("text", "lang", "doc_id"))
    sent = out._jdf.queryExecution().analyzed().children().apply(0).output()
    assert [sent.apply(i).name() for i in range(sent.size())] == df.columns
    assert sorted(((r["doc_id"], r["text"], r["lang"]) for r in out.collect()), key=str) == sorted(rows, key=str)
    assert sorted((r.asDict() for r in out.collect()), key=str) == sorted(({c: r[c] for c in out.columns} for r in other.collect()), key=str)
