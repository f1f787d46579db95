"""Repeatable pseudo-random values drawn from a row's identity.

``rand()`` and ``randstr()`` draw from a per-partition stream, so a task that is
run again after an executor is lost may write other values than the ones already
shipped. Here each value depends only on (seed, row id, slot): any task, on any
executor and under any partitioning, makes the same row again.

A sha-256 digest has 64 hex digits and serves two slots. Within its 32 digits a
slot uses 1-4 to decide whether the value is NULL, 5-8 to choose from a pool and
9-32 as text, so the three decisions are independent of each other.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from string import ascii_lowercase, ascii_uppercase
from string import digits as digits_0_to_9

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.functions.sql import sql_text

ALPHABET = ascii_uppercase + ascii_lowercase + digits_0_to_9
TEXT_LENGTH = 16


def digests(row_id: Column, slots: int, seed: int = 0) -> Column:
    """Array of digests with room for ``slots`` draws.

    The row's prefix is repeated as an array element rather than written inside
    the lambda, where it would be built again for every digest.
    """
    blocks = max((slots + 1) // 2, 1)
    prefix = F.concat(F.lit(f"{seed}#"), row_id.cast("string"), F.lit("#"))
    numbers = F.array(*[F.lit(str(block)) for block in range(blocks)])
    return F.zip_with(
        F.array_repeat(prefix, blocks),
        numbers,
        lambda head, number: F.sha2(F.concat(head, number), 256),
    )


@dataclass(frozen=True)
class Draw:
    """One slot of the digest array in column ``drawn``.

    The values are given as SQL text. A record has over a hundred of them, and
    handing them to Spark as one parsed expression takes milliseconds where
    building each from column objects takes seconds.
    """

    drawn: str
    slot: int

    def _bytes(self, first: int, length: int) -> str:
        # Digits are single bytes; a substring of text would walk to its start character by character.
        start = 32 * (self.slot % 2) + first
        return f"substring(cast({self.drawn}[{self.slot // 2}] AS binary), {start}, {length})"

    def _digits(self, first: int, length: int) -> str:
        return f"cast({self._bytes(first, length)} AS string)"

    def text(self) -> str:
        """16 characters of 0-9, a-f."""
        return self._digits(9, TEXT_LENGTH)

    def mixed_text(self) -> str:
        """16 characters of A-Z, a-z, 0-9, each as likely as any other.

        Base64, with its two other symbols replaced by characters that the slot's
        other digits choose from the 62 (four digits choose two, evenly to one in a thousand).
        Two replacements: ``translate`` would build a dictionary for every text.
        """
        number = f"cast(conv({self._digits(5, 4)}, 16, 10) AS int)"
        plus, slash = (
            f"cast(substring(X'{ALPHABET.encode().hex()}', {n} % 62 + 1, 1) AS string)" for n in (number, f"{number} div 62")
        )
        return f"replace(replace(base64(unhex({self._digits(9, 24)})), '+', {plus}), '/', {slash})"

    def pick(self, pool: Sequence[str]) -> str:
        """Uniform choice from a pool."""
        items = ", ".join(sql_text(item) for item in pool)
        index = f"cast(conv({self._digits(5, 4)}, 16, 10) AS int) % {len(pool)}"
        return f"element_at(array({items}), {index} + 1)"

    def or_null(self, value: str, percent: int) -> str:
        """``value``, replaced by NULL for the given percentage of draws."""
        threshold = null_threshold(percent)
        if threshold is None:
            return "cast(NULL AS string)"
        return f"CASE WHEN {self._bytes(1, 4)} >= X'{threshold.encode().hex()}' THEN {value} END"


def null_threshold(percent: int) -> str | None:
    """Four hex digits under which a draw becomes NULL; None means always NULL."""
    if not 0 <= percent <= 100:
        raise ValueError(f"percent must be within 0..100, got {percent}")
    return None if percent == 100 else f"{65536 * percent // 100:04x}"
