"""Conversations as one training text each, with a loss mask aligned by character offsets."""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from maskmetrics.session import ship

# The template: TURN role BODY text END, for every turn. A control string starts with a
# bracket and holds none after it, so none can arise where a text meets the template.
START, TURN, BODY, END = "<s>", "[INST]", "[/INST]", "</s>"
_TAIL = r"(s>|/s>|INST\]|/INST\])"
_ESCAPE = re.compile(r"([<\[])(\\*)" + _TAIL)
_UNESCAPE = re.compile(r"([<\[])\\(\\*)" + _TAIL)
_ONE = re.compile(re.escape(TURN) + "(.*?)" + re.escape(BODY) + "(.*?)" + re.escape(END), re.DOTALL)


def escape(text: str) -> str:
    """Put a backslash behind the bracket of each control string, one more where some are."""
    return _ESCAPE.sub(r"\1\\\2\3", text)


def unescape(text: str) -> str:
    return _UNESCAPE.sub(r"\1\2\3", text)


def render(turns: list[tuple[str, str]]) -> tuple[str, list[tuple[int, int]]]:
    """The whole conversation and the character span of each turn's text."""
    parts, spans, at = [START], [], len(START)
    for role, text in turns:
        head, body = TURN + escape(role) + BODY, escape(text)
        spans.append((at + len(head), at + len(head) + len(body)))
        parts += [head, body, END]
        at += len(head) + len(body) + len(END)
    return "".join(parts), spans


def parse(formatted: str) -> list[tuple[str, str]]:
    """The turns (role, text) of a rendered conversation."""
    return [(unescape(m[1]), unescape(m[2])) for m in _ONE.finditer(formatted)]


def tokens_under(starts: np.ndarray, ends: np.ndarray, spans: list[tuple[int, int]]) -> np.ndarray:
    """Which tokens share a character with a span; both lists in order, found by binary search."""
    mask = np.zeros(len(starts), np.bool_)
    for start, end in spans:
        if start < end:
            mask[np.searchsorted(ends, start, side="right"):np.searchsorted(starts, end, side="left")] = True
    return mask


def _merged(starts: np.ndarray, ends: np.ndarray, mask: np.ndarray) -> list[dict]:
    """The characters of masked tokens as runs; runs of neighbouring turns stay apart."""
    runs: list[dict] = []
    last = -2
    for i in np.flatnonzero(mask).tolist():
        if i == last + 1:
            runs[-1]["end"] = max(runs[-1]["end"], int(ends[i]))
        else:
            runs.append({"start": int(starts[i]), "end": int(ends[i])})
        last = i
    return runs


def open_tokenizer(definition: str):
    """A byte-level tokenizer that keeps the control strings whole and counts every character."""
    from tokenizers import AddedToken, Tokenizer, processors

    tokenizer = Tokenizer.from_str(definition)
    tokenizer.encode_special_tokens = True  # strings of special tokens are ordinary text
    tokenizer.add_tokens([AddedToken(c, normalized=False, special=False) for c in (START, TURN, BODY, END)])
    tokenizer.post_processor = processors.ByteLevel(trim_offsets=False)
    return tokenizer


_workers: dict[str, object] = {}


def format_conversations(df: DataFrame, tokenizer: str, key: str = "conv_id", turn: str = "turn", role: str = "role",
                         text: str = "text", learn: str = "assistant") -> DataFrame:
    """One row per conversation: formatted text, token ids, loss mask, and the loss spans.

    Returns ``key``, ``formatted``, ``ids`` (little-endian unsigned 32-bit), ``mask`` (a byte
    per id), ``loss`` (the runs of characters under the mask). A conversation is rendered
    whole and encoded once with offsets; control strings are tokens of their own, so the
    tokens of a text cover exactly its characters. The mask holds the tokens that meet the
    text of a turn whose role is ``learn``.

    Turns are ordered by turn number, a null one first, then by role and text; repeated rows
    are repeated turns. Null roles and texts count as empty; rows with a null key are one
    conversation. Other columns of ``df`` are not read. An empty table gives an empty result.
    A conversation is one row of the result, so its turns meet in one task.
    """
    spark = df.sparkSession
    ship(spark)
    with open(tokenizer, encoding="utf-8") as file:
        shared = spark.sparkContext.broadcast(file.read())
    name = uuid.uuid4().hex

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # the task has one core
        if name not in _workers:
            _workers.clear()
            _workers[name] = open_tokenizer(shared.value)
        for whole in batches:
            for at in range(0, whole.num_rows, 256):
                batch = whole.slice(at, 256)
                turns = [[(t["role"], t["text"]) for t in some] for some in batch.column(1).to_pylist()]
                drawn = [render(some) for some in turns]
                columns: dict[str, list] = {"ids": [], "mask": [], "loss": []}
                encoded = _workers[name].encode_batch([d[0] for d in drawn], add_special_tokens=False)
                for some, (_, spans), tokens in zip(turns, drawn, encoded):
                    offsets = np.array(tokens.offsets, np.int64).reshape(-1, 2)
                    wanted = [span for span, (who, _) in zip(spans, some) if who == learn]
                    mask = tokens_under(offsets[:, 0], offsets[:, 1], wanted)
                    columns["ids"].append(np.array(tokens.ids, "<u4").tobytes())
                    columns["mask"].append(mask.astype(np.uint8).tobytes())
                    columns["loss"].append(_merged(offsets[:, 0], offsets[:, 1], mask))
                spans_type = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array([d[0] for d in drawn], pa.string()), pa.array(columns["ids"], pa.binary()),
                     pa.array(columns["mask"], pa.binary()), pa.array(columns["loss"], spans_type)],
                    names=[key, "formatted", "ids", "mask", "loss"])

    said = F.struct(F.col(turn).alias("turn"), F.coalesce(role, F.lit("")).alias("role"),
                    F.coalesce(text, F.lit("")).alias("text"))
    grouped = df.groupBy(key).agg(F.array_sort(F.collect_list(said)).alias("turns")).select(
        key, F.transform("turns", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text"))).alias("turns"))
    kind = df.schema[key].dataType.simpleString()
    return grouped.mapInArrow(run, f"`{key}` {kind}, formatted string, ids binary, mask binary, "
                                   "loss array<struct<start:int,end:int>>")


def read_conversations(formatted: DataFrame, key: str = "conv_id") -> DataFrame:
    """(``key``, turns, loss_text, formatted_chars), read back from formatted conversations alone.

    ``turns`` are the original roles and texts; ``loss_text`` is all text under the loss mask,
    unescaped run by run, nothing between.
    """
    ship(formatted.sparkSession)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, loss = batch.column(1).to_pylist(), batch.column(2).to_pylist()
            turns = [[{"role": r, "text": t} for r, t in parse(text)] for text in texts]
            under = ["".join(unescape(text[s["start"]:s["end"]]) for s in spans) for text, spans in zip(texts, loss)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(turns, pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())]))),
                 pa.array(under, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                names=[key, "turns", "loss_text", "formatted_chars"])

    kind = formatted.schema[key].dataType.simpleString()
    return formatted.select(key, "formatted", "loss").mapInArrow(
        run, f"`{key}` {kind}, turns array<struct<role:string,text:string>>, loss_text string, formatted_chars long")
