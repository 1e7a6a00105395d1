"""Finding dictionary values in one text; the helper that runs inside Python tasks.

Spark decides which rows and which dictionary entries meet (see operators.masking);
this module only resolves the overlaps inside a single text.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterable
from functools import lru_cache

_WORD = re.compile(r"\w+")


@lru_cache(maxsize=None)
def fold_char(c: str) -> str:
    """Simple case folding of one character: the lower form of its upper form.

    The rule of case-insensitive regexes, in Java and in Python. It never looks at
    neighbours and never changes the number of characters.
    """
    if c == "\u0130":
        return "i"
    up = c.upper() if len(c.upper()) == 1 else c
    low = up.lower()
    return low if len(low) == 1 else c


def fold(text: str) -> str:
    """Case folding that keeps every character position."""
    return text.lower() if text.isascii() else "".join(map(fold_char, text))


@lru_cache(maxsize=1)
def unlike_lower() -> tuple[str, str]:
    """The characters that ``fold`` maps otherwise than lower-casing a text, and their images.

    With these translated first, lower-casing a text in the JVM is ``fold``. The capital
    sigma is among them because its lower form depends on its place in a word.
    """
    odd = [c for c in map(chr, range(128, 0x30000)) if not 0xD800 <= ord(c) < 0xE000 and fold_char(c) != c.lower()]
    odd = list(dict.fromkeys([*odd, "\u03a3", "\u03c2"]))
    return "".join(odd), "".join(map(fold_char, odd))


class Matcher:
    """Entries are (value, alias, ordinal); longer values win, then lower ordinals."""

    def __init__(self, entries: Iterable[tuple[str, str, int]]):
        self._by_words: dict[tuple[str, ...], list] = {}
        self._lengths: dict[str, set[int]] = {}
        self._wordless: list = []
        for value, alias, ordinal in entries:
            rank = (-len(value), ordinal)
            spellings = (value,) if value.isascii() else {
                value, unicodedata.normalize("NFC", value), unicodedata.normalize("NFD", value)}
            for spelling in spellings:
                low = fold(spelling)
                words = list(_WORD.finditer(low))
                if not words:
                    self._wordless.append((low, alias, rank))
                    continue
                key = tuple(w.group() for w in words)
                self._by_words.setdefault(key, []).append((low, words[0].start(), alias, rank))
                self._lengths.setdefault(key[0], set()).add(len(key))

    def spans(self, text: str) -> list[tuple]:
        """All places where a value stands on word boundaries: (rank, start, end, alias)."""
        low = fold(text)
        found = []
        lengths = self._lengths
        words = _WORD.findall(low)
        first = [i for i, word in enumerate(words) if word in lengths]
        if first:
            starts = [m.start() for m in _WORD.finditer(low)]
            for i in first:
                for n in lengths[words[i]]:
                    for form, lead, alias, rank in self._by_words.get(tuple(words[i:i + n]), ()):
                        begin = starts[i] - lead
                        if begin >= 0 and low.startswith(form, begin):
                            found.append((rank, begin, begin + len(form), alias))
        for form, alias, rank in self._wordless:
            begin = low.find(form)
            while begin >= 0:
                found.append((rank, begin, begin + len(form), alias))
                begin = low.find(form, begin + len(form))
        return found

    def replace(self, text: str | None) -> str | None:
        """``text`` with every known value replaced, longest value first."""
        if not text:
            return text
        found = self.spans(text)
        if not found:
            return text
        kept = sorted(s[1:] for s in found)
        if any(a[1] > b[0] for a, b in zip(kept, kept[1:])):
            kept = _without_overlaps(found, len(text))
        out, at = [], 0
        for begin, end, alias in kept:
            out += (text[at:begin], alias)
            at = end
        return "".join(out) + text[at:]


def _without_overlaps(found: list[tuple], length: int) -> list[tuple]:
    """Spans by rank, each kept where no kept one stands yet."""
    taken = bytearray(length)
    kept = []
    for _, begin, end, alias in sorted(found):
        if not any(taken[begin:end]):
            taken[begin:end] = b"\x01" * (end - begin)
            kept.append((begin, end, alias))
    return sorted(kept)


def shared_matcher(broadcast) -> Matcher:
    """The matcher of a broadcast dictionary, built once per worker process."""
    built = getattr(broadcast, "_matcher", None)
    if built is None:
        built = Matcher(broadcast.value)
        broadcast._matcher = built
    return built
