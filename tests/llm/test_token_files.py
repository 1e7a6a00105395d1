import heapq
import random
import zlib

import numpy as np
import pytest

from maskmetrics.llm import huffman
from maskmetrics.llm.huffman import Code, code_lengths, read_token_file, write_token_file
from maskmetrics.llm.word_tokens import ChunkTokenizer, tokenized

public = pytest.importorskip("public_tokenizers")
WORDS = public.path("word_bpe_49k.json")


def _best(counts):
    heap = [(c, 0) for c in counts if c]
    heapq.heapify(heap)
    cost = 0
    while len(heap) > 1:
        a, b = heapq.heappop(heap), heapq.heappop(heap)
        cost += a[0] + b[0]
        heapq.heappush(heap, (a[0] + b[0], 0))
    return cost


def test_lengths_are_best_and_limited():
    rng = random.Random(3)
    for n in (2, 3, 10, 200, 3000):
        counts = np.array([int(rng.paretovariate(0.8)) for _ in range(n)])
        counts[0] = 0 if n > 2 else counts[0]
        lengths = code_lengths(counts, 30).astype(np.int64)
        assert (lengths * counts).sum() == _best(counts.tolist())
        limited = code_lengths(counts, 12).astype(np.int64)
        assert limited.max() <= 12 and abs((0.5 ** limited[limited > 0]).sum() - 1) < 1e-9
        assert ((limited > 0) == (counts > 0)).all()
    fib = np.array([1, 1, 2, 3, 5, 8, 13, 21, 34, 55])
    assert code_lengths(fib, 4).max() == 4
    assert code_lengths(np.array([0, 7, 0])).tolist() == [0, 1, 0]
    assert code_lengths(np.zeros(3, np.int64)).tolist() == [0, 0, 0]


@pytest.mark.parametrize("n", [1, 255, 256, 257, 5000])
def test_round_trip_of_a_block(n):
    rng = np.random.default_rng(n)
    ids = np.minimum(rng.zipf(1.3, n), 49_000).astype(np.int64)
    code = Code.of(code_lengths(np.bincount(ids, minlength=49_408)))
    bits, marks = code.encode(ids)
    counts = np.minimum(huffman.STEP, n - huffman.STEP * np.arange(len(marks)))
    assert code.decode(np.frombuffer(bits, np.uint8), marks, counts).tolist() == ids.tolist()
    last = len(marks) - 1
    assert code.decode(np.frombuffer(bits, np.uint8), marks[last:], counts[last:]).tolist() == ids[huffman.STEP * last:].tolist()


def _texts():
    rng = random.Random(9)
    pool = ["the of and ", "ABC xyz", "'s't DON'T I'll ", "éèÇ Ñß İI ς Σ", "ÀÖØßÿ÷×ªº µ", "a1b22.é!!", "###", "'é", "0123 ", "漢字 한글", "🙂 ‍👍🏽", "   \x1c\x85", "\t\n\x0b", "́̇̊", "a.b, c| ..",
            "<|endoftext|> <|startoftext|>", "\x00\x01", "<|EndOfText|>", "ÀÉÍßÿ***", "word!!&&", "mita$$$"]
    for _ in range(800):
        letters = "".join(rng.sample(pool, rng.randint(1, 3)))
        yield "".join(rng.choice(letters) for _ in range(rng.randint(0, 40)))
    yield from ("", " ", "<|endoftext|>", "hello <|endoftext|> world", "a<|startoftext|>b<|ENDOFTEXT|>", "Ciónasta,### größe&&& ÀÍÑ!! straße", "x" + "#" * 3000, "x" * 3000, "Ab" * 900, "word. word, WORD! a|b", "don't've", "H\u0331ello H\u0331 The", "." * 300)


def test_ids_are_those_of_the_whole_text():
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(WORDS)
    ours = ChunkTokenizer(open(WORDS, encoding="utf-8").read())
    texts = list(_texts())
    ids, counts = ours.encode([t.encode() for t in texts])
    for text, got in zip(texts, np.split(ids, np.cumsum(counts)[:-1])):
        assert got.tolist() == whole.encode(text, add_special_tokens=False).ids, repr(text)


def test_file_of_rows(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(huffman, "BLOCK_IDS", 300)
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(WORDS)
    rng = random.Random(4)
    rows = [(i * 7 % 101, "the quick brown fox " * rng.randint(0, 90)) for i in range(101)]
    rows += [(3, "again"), (3, "again"), (5, None), (None, ""), (102, "z" * 4000)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    write_token_file(tokenized(df, WORDS, 1), str(tmp_path / "f"), 49_408)
    got = sorted((r.asDict() for r in read_token_file(spark, str(tmp_path / "f")).collect()), key=lambda r: r["start"])
    assert [-1 if r["doc_id"] is None else r["doc_id"] for r in got] == sorted(-1 if k is None else k for k, _ in rows)
    start = 0
    for r in got:
        assert r["start"] == start and len(r["ids"]) == 4 * r["n"]
        start += r["n"]
    want = sorted((k or -1, zlib.crc32(np.array(whole.encode(t or "", add_special_tokens=False).ids + [1], "<u4").tobytes()))
                  for k, t in rows)
    assert sorted((r["doc_id"] or -1, zlib.crc32(bytes(r["ids"]))) for r in got) == want


def test_empty_file(spark, tmp_path):
    write_token_file(tokenized(spark.createDataFrame([], "doc_id long, text string"), WORDS, 1), str(tmp_path / "e"), 49_408)
    assert read_token_file(spark, str(tmp_path / "e")).count() == 0
