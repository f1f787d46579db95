"""Encode whole texts with a tokenizer file of the tokenizers library, each distinct piece of text once.

A byte-pair tokenizer never merges across the pieces its pre-tokenizer cuts, so the ids
of a text are those of its pieces, one after the other. Texts are first cut at white
space into units, of which most are known already; an unknown unit is cut into pieces,
and the library is asked for the ids of unknown pieces only. Both memories are bounded.
``test_tokens.py`` holds the ids against the library's for whole texts.
"""

from __future__ import annotations

import json
import re
from array import array
from codecs import charmap_decode
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import regex
from tokenizers import Tokenizer

KNOWN = 250_000
SEGMENT = 1 << 17

# The patterns of the two pre-tokenizers, as their files and library state them.
BYTE_LEVEL = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
WORD_LEVEL = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"

# White space of the patterns above. Python's own also holds the controls 1c to 1f.
_SPACE = r"\t-\r \x85\xa0  -     　"
_UNIT = re.compile(rf" ?[^{_SPACE}]+|[{_SPACE}]+(?![^{_SPACE}])|[{_SPACE}]+")
_WORD = re.compile(rf"[^{_SPACE}]+")
#: Where a text holds one of these, a space may stand between other white space.
_UNEVEN = ("  ", " \n", " \t", " \r", " \x0b", " \x0c", *"\x85\xa0\u1680\u2028\u2029\u202f\u205f\u3000", *map(chr, range(0x2000, 0x200B)))
#: Begins the key of a unit without a space before it; no text holds half a surrogate pair.
_BARE = "\ud800"
_CONTROL = re.compile("[\x1c-\x1f]")
# Printable bytes stand for themselves, the others, in order, for the letters from 256 on.
_SHOWN = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
_BYTES = {b: 256 + i for i, b in enumerate(b for b in range(256) if b not in set(_SHOWN))}
_LETTERS = "".join(chr(_BYTES.get(b, b)) for b in range(256))
_SIGNS = frozenset(",.;:!?|")
_LATIN = "\u0250"
_CUT = re.compile(rf"[^{_SPACE}](?= [^{_SPACE}])")


class Encoder:
    """Ids of texts as little-endian unsigned 32-bit integers, without special tokens, ``end`` after each text."""

    def __init__(self, path: str, end: int | None = None, known: int = KNOWN) -> None:
        self._tokenizer = Tokenizer.from_file(path)
        self._tokenizer.encode_special_tokens = True  # their strings in a text are ordinary text
        self._tokenize = self._tokenizer.model.tokenize
        with open(path, encoding="utf-8") as file:
            kind = json.load(file)
        cutter = kind["pre_tokenizer"]["type"]
        if kind.get("normalizer") is None and cutter == "ByteLevel":
            self._words, pattern = False, BYTE_LEVEL
        elif cutter == "Sequence" and kind["model"].get("end_of_word_suffix"):
            self._words, pattern = True, WORD_LEVEL
        else:
            raise ValueError(f"{path}: neither a byte-level nor a word-level BPE file")
        self._find = regex.compile(pattern).findall
        self._most = known
        self._units: dict[str, bytes] = {}
        self._older: dict[str, bytes] = {}
        self._pieces: dict[str, bytes] = {}
        self._end = b"" if end is None else np.array(end, "<u4").tobytes()

    def _cut(self, text: str) -> list[str]:
        """Keys of units whose ids do not depend on what stands around them.

        On the byte level most units begin with a space, which their key leaves out; the
        others' keys begin with a mark.
        """
        if self._words:
            return _WORD.findall(text) if _CONTROL.search(text) else text.split()
        if any(map(text.__contains__, _UNEVEN)):
            return [unit[1:] if unit[0] == " " else _BARE + unit for unit in _UNIT.findall(text)]
        units = text.split(" ")
        units[0] = _BARE + units[0]
        return units

    def _learn(self, units: set[str]) -> None:
        if len(self._pieces) > self._most:
            self._pieces = {}
        older, pieces, lower, known = self._older, self._pieces, self._words, self._units
        for key in units:
            if (ids := older.get(key)) is not None:
                known[key] = ids
                continue
            unit = key if lower else key[1:] if key[:1] == _BARE else " " + key
            if not (unit.isascii() or max(unit) < _LATIN):
                # What is a letter depends on the Unicode version; of other scripts the library sees the whole unit.
                parts = (unit,)
            else:
                text = unit.lower() if lower else unit
                word = text[1:] if text[:1] == " " else text
                if word.isalpha():
                    if (ids := pieces.get(text)) is None:
                        ids = pieces[text] = self._merged(text)
                    known[key] = ids
                    continue
                if word[:-1].isalpha() and word[-1] in _SIGNS:  # not an empty one
                    parts = (text[:-1], text[-1])
                else:
                    parts = self._find(text)
            found = []
            for piece in parts:
                if (ids := pieces.get(piece)) is None:
                    ids = pieces[piece] = self._merged(piece)
                found.append(ids)
            known[key] = b"".join(found)

    def _merged(self, piece: str) -> bytes:
        if not (piece.isascii() or max(piece) < _LATIN):
            return np.array(self._tokenizer.encode(piece, add_special_tokens=False).ids, "<u4").tobytes()
        # The model sees bytes as the letters that byte-level files give them.
        shown = charmap_decode(piece.encode(), "strict", _LETTERS)[0]
        return array("I", [t.id for t in self._tokenize(shown)]).tobytes()

    def _segments(self, text: str) -> Iterator[str]:
        at = 0
        while len(text) - at > SEGMENT and (cut := _CUT.search(text, at + SEGMENT)):
            yield text[at : cut.end()]
            at = cut.end()
        yield text[at:] if at else text

    def encode(self, text: str | None) -> bytes:
        return next(self.encode_all([text]))

    def encode_all(self, texts: list[str | None]) -> Iterator[bytes]:
        """Ids of each text; a null text has none but the end."""
        waiting: list[list[str]] = []
        size = 0
        for text in texts:
            if len(text or "") > SEGMENT:
                yield from self._encoded(waiting)
                waiting, size = [], 0
                yield b"".join(b"".join(self._ids([self._cut(s)])) for s in self._segments(text)) + self._end
                continue
            waiting.append(self._cut(text or ""))
            size += len(text or "")
            if size > SEGMENT:
                yield from self._encoded(waiting)
                waiting, size = [], 0
        yield from self._encoded(waiting)

    def _ids(self, cut: list[list[str]]) -> Iterator[bytes]:
        used = set(chain.from_iterable(cut))
        if new := used - self._units.keys():
            if len(self._units) + len(new) > self._most:
                # Full: begin anew, and take over from the old what still comes up.
                self._units, self._older, new = {}, self._units, used
            self._learn(new)
        of = self._units.__getitem__
        for units in cut:
            yield b"".join(map(of, units))

    def _encoded(self, cut: list[list[str]]) -> Iterator[bytes]:
        for ids in self._ids(cut):
            yield ids + self._end


@lru_cache(maxsize=1)
def encoder(path: str, end: int | None = None, known: int = KNOWN) -> Encoder:
    """One for all tasks of a worker process, so that each does not learn the same words again."""
    return Encoder(path, end, known)
