"""Sparse features of a whole text: distinct feature numbers below ``SIZE``."""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Callable
from itertools import groupby

import numpy as np

SIZE = 1 << 18
PREFIX = 5
KNOWN_WORDS = 200_000
_WORD = re.compile(r"\w+")
_SHAPE = [(re.compile(r"[^\W\d_]*[a-zß-öø-ÿ][^\W\d_]*"), "a"), (re.compile(r"[^\W\d_]+"), "A"), (re.compile(r"\d+"), "0")]


def number(name: str) -> int:
    return zlib.crc32(name.encode("utf-8", "surrogatepass")) % SIZE


def remembered(make: Callable[[str], object], bound: int = KNOWN_WORDS) -> Callable[[str], object]:
    """``make`` with its results kept for at most ``bound`` arguments at a time."""
    known: dict[str, object] = {}

    def get(word: str) -> object:
        found = known.get(word)
        if found is None:
            if len(known) >= bound:
                known.clear()
            found = known[word] = make(word)
        return found

    return get


def word_features(word: str) -> tuple[int, ...]:
    """A lower-case word, and its first letters: stems of compounds."""
    if len(word) <= PREFIX:
        return (number(word),)
    return number(word), number("^" + word[:PREFIX])


def vocabulary(text: str, of_word: Callable[[str], tuple[int, ...]]) -> np.ndarray:
    """Words and word beginnings that occur in the text."""
    found = {n for word in set(_WORD.findall(text.lower())) for n in of_word(word)}
    return np.array(sorted(found), np.int32)


def shape(token: str) -> str:
    """What a token looks like: letters, capitals, digits and signs, runs of each as one."""
    for pattern, sign in _SHAPE:
        token = pattern.sub(sign, token)
    return token[:8]


def _step(share: float) -> int:
    """Shares in steps that are finer near zero and one."""
    return int(np.searchsorted([0.005, 0.02, 0.05, 0.1, 0.2, 0.35, 0.5, 0.65, 0.8, 0.9, 0.95, 0.98], share))


def appearance(text: str, of_token: Callable[[str], str]) -> np.ndarray:
    """Layout and wording of the text: token shapes and their shares, repetition, lengths, signs."""
    tokens = text.split()
    counts, shapes = Counter(tokens), Counter()
    for token, count in counts.items():
        shapes[of_token(token)] += count
    runs = [sum(1 for _ in same) for _, same in groupby(tokens)]
    n, lines = max(1, len(tokens)), [x for x in text.splitlines() if x.strip()]
    letters = sum(c * len(k) for k, c in shapes.items() if "a" in k or "A" in k)
    signs = sum(c for k, c in shapes.items() if re.search(r"[^aA0.,]", k))
    marks = {
        "tokens": int(np.log2(n)),
        "distinct": _step(len(counts) / n),
        "again": _step(1 - len(runs) / n),
        "run": int(np.log2(max(runs, default=1))),
        "lines": _step(len(set(lines)) / max(1, len(lines))),
        "line": int(np.log2(max(1, len(text) // max(1, len(lines))))),
        "length": min(30, len(text) // n),
        "letters": _step(letters / max(1, sum(c * len(k) for k, c in shapes.items()))),
        "signs": _step(signs / n),
    }
    names = [f"{k}={v}" for k, v in marks.items()]
    for kind, count in shapes.items():
        names.append(f"shape {kind}")
        if count > 1:
            names.append(f"share {kind}={_step(count / n)}")
    return np.array(sorted({number(x) for x in names}), np.int32)
