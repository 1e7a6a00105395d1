"""Ids of whole texts by a tokenizer file of the tokenizers library, each distinct chunk once."""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from maskmetrics.llm.common import byte_texts, text_slices
from maskmetrics.llm.huffman import pack
from maskmetrics.llm.pieces import PieceIds
from maskmetrics.session import ship

# Letters of ASCII and Latin-1, then marks that form one piece of their own; no apostrophe, which may begin an
# ending, and no "<", which may begin a special token.
SIMPLE = re.compile(r"([A-Za-zÀ-ÖØ-öø-ÿ]+)([!-&(-/:;=-@\[-`{-~]*)")


def _byte_letters() -> dict[int, str]:
    """The character that stands for each byte in the vocabulary: printable ones for themselves, the others from 256 on."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(own)]
    return {b: chr(b) for b in own} | {b: chr(256 + i) for i, b in enumerate(others)}


class ChunkTokenizer:
    """Encodes runs between ASCII blanks; for tokenizers whose rules never look over a blank.

    Its normalizer may compose, lower-case and unify white space, its splitter drops white
    space and its letters are bytes. A plain word is only lower-cased and not split, so it goes to the model of the
    library at once; the marks behind it are a piece of their own. Strings of special tokens get their
    ids, as in a plain call of the library.
    """

    def __init__(self, definition: str):
        from tokenizers import Tokenizer

        self._whole = Tokenizer.from_str(definition)
        self._model = self._whole.model
        letters = _byte_letters()
        # A letter of Latin-1 is two bytes.
        self._written = {c: "".join(letters[b] for b in chr(c).encode()) for c in range(128, 256)}
        self._marks: dict[str, list[int]] = {"": []}
        self._pieces = PieceIds(self._encode)

    def _ids(self, text: str) -> list[int]:
        return self._whole.encode(text, add_special_tokens=False).ids

    def _ids_of_marks(self, marks: str) -> list[int]:
        found = self._marks.get(marks)
        if found is None:
            found = self._ids(marks)
            if len(marks) < 8:  # few different ones; longer runs are not remembered
                self._marks[marks] = found
        return found

    def _encode(self, chunks: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        found: list[list[int] | None] = []
        hard: list[int] = []
        texts = [c.decode() for c in chunks]
        for text in texts:
            plain = SIMPLE.fullmatch(text)
            if plain:
                word = plain[1].lower()
                if not word.isascii():
                    word = word.translate(self._written)
                found.append([t.id for t in self._model.tokenize(word)] + self._ids_of_marks(plain[2]))
            else:
                hard.append(len(found))
                found.append(None)
        for i, encoding in zip(hard, self._whole.encode_batch_fast([texts[i] for i in hard], add_special_tokens=False)):
            found[i] = encoding.ids
        sizes = np.fromiter(map(len, found), np.int64, len(found))
        return np.fromiter((i for ids in found for i in ids), np.int32, int(sizes.sum())), sizes

    def encode(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, one after the other, and how many each text has."""
        chunks: list[bytes] = []
        counts = np.zeros(len(texts), np.int64)
        for i, text in enumerate(texts):
            # In a text of ASCII alone nothing is composed: lower-casing it first changes no id, but
            # might make a special token, which is told apart by case.
            some = (text.lower() if text.isascii() and b"<|" not in text else text).split()
            counts[i] = len(some)
            chunks += some
        ids, sizes = self._pieces.look_up(chunks)
        owner = np.repeat(np.arange(len(texts)), counts)
        return ids, np.bincount(owner, weights=sizes, minlength=len(texts)).astype(np.int64)


_workers: dict[str, ChunkTokenizer] = {}


def tokenized(df: DataFrame, tokenizer: str, end: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(``key``, n, packed): all ids of each whole text and the id ``end``, packed for a token file.

    A null text counts as empty: its only id is ``end``. One row out per row in.
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
            _workers[name] = ChunkTokenizer(shared.value)
        for batch in text_slices(batches, 1):
            ids, counts = _workers[name].encode(byte_texts(batch.column(1)))
            rows = np.split(ids, np.cumsum(counts)[:-1])
            last = np.array([end], np.int32)
            packed = [pack(np.concatenate([row, last])) for row in rows]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(counts + 1), pa.array(packed, pa.binary())],
                                             names=[key, "n", "packed"])

    kind = df.schema[key].dataType.simpleString()
    return df.select(F.col(key), F.col(text)).mapInArrow(run, f"`{key}` {kind}, n long, packed binary")
