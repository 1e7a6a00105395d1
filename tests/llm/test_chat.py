import random

import numpy as np
import pytest

from maskmetrics.llm.chat import escape, format_conversations, open_tokenizer, parse, read_conversations, render, unescape

public = pytest.importorskip("public_tokenizers")
FILE = public.path("byte_bpe_50k.json")


def _texts():
    rng = random.Random(6)
    pool = ["[INST]", "[/INST]", "<s>", "</s>", "\\", "[", "<", "INST]", "/", "s>", " ", "\n", "é", "漢", "🙂", "word ", "<|endoftext|>", "  "]
    return ["".join(rng.choice(pool) for _ in range(rng.randint(0, 12))) for _ in range(600)]


def test_escape_is_reversible_and_hides_control_strings():
    for text in _texts():
        hidden = escape(text)
        assert unescape(hidden) == text and not any(c in hidden for c in ("[INST]", "[/INST]", "<s>", "</s>"))
    texts = _texts()
    turns = list(zip(texts[::2], texts[1::2]))
    formatted, spans = render(turns)
    assert parse(formatted) == turns
    assert [unescape(formatted[a:b]) for a, b in spans] == [t for _, t in turns]


def test_masks_cover_the_learned_texts_exactly(spark):
    rng = random.Random(8)
    texts = _texts()
    rows = [(i % 60, i // 60, rng.choice(["user", "assistant", "assistant", "[INST]", None]), text, "x")
            for i, text in enumerate(texts)]
    rows += [(70, 0, "assistant", None, "x"), (71, 0, "user", "only", "x"), (None, 2, "assistant", "b", "y"),
             (None, None, "user", "a", "y"), (72, 1, "assistant", "same", "z"), (72, 1, "assistant", "same", "z"),
             (73, 0, "assistant", "long " * 5000, "x")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, ids string")
    formatted = format_conversations(df, FILE)
    held = {r["conv_id"]: r for r in formatted.collect()}
    back = {r["conv_id"]: r for r in read_conversations(formatted).collect()}
    want = {}
    for conv, turn, role, text, _ in rows:
        want.setdefault(conv, []).append((-1 if turn is None else turn, role or "", text or ""))
    assert set(back) == set(want) == set(held)
    tokenizer = open_tokenizer(open(FILE, encoding="utf-8").read())
    for conv, turns in want.items():
        turns.sort()
        assert [(t["role"], t["text"]) for t in back[conv]["turns"]] == [t[1:] for t in turns]
        learned = [t for _, role, t in turns if role == "assistant"]
        assert back[conv]["loss_text"] == "".join(learned)
        ids, mask = np.frombuffer(held[conv]["ids"], "<u4"), np.frombuffer(held[conv]["mask"], np.uint8)
        assert len(ids) == len(mask) and tokenizer.decode(ids[mask > 0].tolist()) == "".join(map(escape, learned))


def test_empty_table(spark):
    none = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert read_conversations(format_conversations(none, FILE)).count() == 0
