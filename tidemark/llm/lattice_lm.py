"""Language-model score of a text: likelihood summed over all segmentations into subwords.

The vocabulary of a public sentencepiece file is the unigram model's: a text is a string of
pieces drawn one by one, a word begins with the mark of white space, and one end piece
closes the text. Pieces never cross words, so a text's probability is a product over words,
and each word's is the sum over every way of cutting it into pieces, worked out by a
forward recursion on logarithms. Characters that are no piece are spelled by byte pieces.

The file's scores are ranks of merges. They give the first weights (by Zipf's law); from
there expectation maximisation fits the weights to the words of the training documents,
``ROUNDS`` times, over each distinct word once. A round gathers one number per piece. Then
the likelihood of each distinct word of all documents is worked out once. Short words are
done together in arrays of chances; long ones, and those whose likelihood all but vanishes,
one by one on logarithms, with a few numbers a character.

Beside it stands the base score of a smoothed unigram model of words. Its counts grow with
the corpus. Counts and likelihoods of words that make up more than one in ``FREQUENT`` of
all tokens, which can be no more than ``FREQUENT`` words, are sent to the tasks; those of
all others are joined.
"""

from __future__ import annotations

import math
from array import array
from collections import Counter
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import text_rows, written
from tidemark.llm.pu_text import fold

ROUNDS = 2
FREQUENT = 100_000
FREQUENT_BYTES = 64
SMOOTH = 0.1
PIECE_SMOOTH = 0.01
SHORT = 24  # characters, with the mark
VANISHED = 1e-250  # below it, likelihoods are worked out on logarithms
COUNTED = 200_000
MARK = "▁"
_SPELLED = "￿"
_LOG10 = math.log(10)
_STEP = np.uint64(0x9E3779B97F4A7C15)


def _longer(hashed: np.ndarray, codes: np.ndarray) -> np.ndarray:
    """Hashes of texts from those of the texts without their last character."""
    hashed = (hashed + codes + np.uint64(1)) * _STEP
    return hashed ^ (hashed >> np.uint64(31))


def _hash(text: str) -> np.uint64:
    hashed = np.zeros(1, np.uint64)
    for char in text:
        hashed = _longer(hashed, np.array([ord(char)], np.uint64))
    return hashed[0]


class Vocabulary:
    """Pieces by text; byte pieces and the end have the last 257 numbers."""

    def __init__(self, pieces: list[str], scores: list[float]) -> None:
        self.number = {piece: i for i, piece in enumerate(pieces)}
        #: Every beginning of a piece; -1 if it is none itself.
        self.prefix = {piece[:n]: -1 for piece in pieces for n in range(1, len(piece))} | self.number
        self.bytes = len(pieces)
        self.end = len(pieces) + 256
        rank = np.empty(len(pieces))
        rank[np.argsort(-np.array(scores), kind="stable")] = np.arange(len(pieces))
        weights = np.concatenate((1 / (rank + 2.7), np.full(257, 1 / (len(pieces) + 2.7))))
        self.first = weights / weights.sum()
        hashed = np.array([_hash(text) for text in self.prefix], np.uint64)
        order = np.argsort(hashed)
        #: Hashes of all beginnings, sorted, and their numbers.
        self.keys, self.numbers = hashed[order], np.fromiter(self.prefix.values(), np.int64, len(order))[order]
        if (self.keys[1:] == self.keys[:-1]).any():
            raise ValueError("two beginnings of pieces have one hash")

    @classmethod
    def load(cls, path: str) -> Vocabulary:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        usual = [
            i for i in range(model.get_piece_size()) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))
        ]
        return cls([model.id_to_piece(i) for i in usual], [model.get_score(i) for i in usual])


def marked(word: bytes) -> str:
    """The word as text after the mark of white space; marks inside it are spelled."""
    return MARK + word.decode("utf-8", "replace").replace(MARK, _SPELLED)


def spelling(char: str, vocabulary: Vocabulary) -> tuple[int, ...]:
    """The byte pieces of a character that is no piece."""
    return tuple(vocabulary.bytes + b for b in (MARK if char == _SPELLED else char).encode("utf-8", "surrogatepass"))


def pieces_at(text: str, start: int, vocabulary: Vocabulary) -> Iterator[tuple[int, tuple[int, ...]]]:
    """(stop, numbers) of every piece that begins at ``start``; several numbers spell one character."""
    get, stop = vocabulary.prefix.get, start + 1
    number = get(text[start])
    if number is None or number < 0:
        yield stop, spelling(text[start], vocabulary)
    while number is not None:
        if number >= 0:
            yield stop, (number,)
        stop += 1
        if stop > len(text):
            break
        number = get(text[start:stop])


def _log_add(x: float, y: float) -> float:
    low, high = (x, y) if x < y else (y, x)
    return high if low == -math.inf else high + math.log1p(math.exp(low - high))


def forward(text: str, vocabulary: Vocabulary, weight: list[float]) -> array:
    """Logarithm of the summed likelihood of each beginning of a marked word, one number a character."""
    alpha = array("d", [-math.inf]) * (len(text) + 1)
    alpha[0] = 0.0
    for start in range(len(text)):
        for stop, numbers in pieces_at(text, start, vocabulary):
            alpha[stop] = _log_add(alpha[stop], alpha[start] + sum(weight[i] for i in numbers))
    return alpha


def expected(text: str, vocabulary: Vocabulary, weight: list[float]) -> Iterator[tuple[int, float]]:
    """Expected number of times each piece is used in a marked word, over all segmentations.

    On logarithms, for a word of any length: pieces are looked up again on the way back.
    """
    alpha = forward(text, vocabulary, weight)
    beta = array("d", [-math.inf]) * (len(text) + 1)
    beta[-1] = 0.0
    for start in range(len(text) - 1, -1, -1):
        for stop, numbers in pieces_at(text, start, vocabulary):
            after = beta[stop] + sum(weight[i] for i in numbers)
            beta[start] = _log_add(beta[start], after)
            part = math.exp(alpha[start] + after - alpha[-1])
            for number in numbers:
                yield number, part


class Lattices:
    """The pieces in many short marked words, as arrays: word, start, stop and number, by stop.

    The substrings of all words are looked up together, one character longer each time, as
    long as they begin a piece. Numbers below zero are spelled characters.
    """

    def __init__(self, texts: list[str], vocabulary: Vocabulary) -> None:
        self.vocabulary = vocabulary
        self.sizes = np.fromiter(map(len, texts), np.int64, len(texts))
        codes = np.zeros((len(texts), int(self.sizes.max(initial=0)) + 1), np.uint64)
        inside = np.arange(codes.shape[1]) < self.sizes[:, None]
        codes[inside] = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), "<u4")
        self.odd = np.empty(0, np.uint64)
        keys, numbers = vocabulary.keys, vocabulary.numbers
        word, start = (x.astype(np.int64) for x in np.nonzero(inside))
        hashed, found, length = _longer(np.zeros(len(word), np.uint64), codes[word, start]), [], 1
        while len(word):
            at = np.minimum(np.searchsorted(keys, hashed), len(keys) - 1)
            begins = keys[at] == hashed
            number = np.where(begins, numbers[at], -1)
            if length == 1:
                lost = np.flatnonzero(number < 0)
                self.odd, kind = np.unique(codes[word[lost], start[lost]], return_inverse=True)
                found.append((word[lost], start[lost], start[lost] + 1, -1 - kind))
            whole = np.flatnonzero(number >= 0)
            found.append((word[whole], start[whole], start[whole] + length, number[whole]))
            on = np.flatnonzero(begins & (start + length < self.sizes[word]))
            word, start = word[on], start[on]
            hashed = _longer(hashed[on], codes[word, start + length])
            length += 1
        columns = [np.concatenate(x) for x in zip(*found, strict=True)] if found else [np.empty(0, np.int64)] * 4
        order = np.argsort(columns[2], kind="stable")
        self.word, self.start, self.stop, self.number = (x[order] for x in columns)
        self.spelled = [spelling(chr(int(c)), vocabulary) for c in self.odd]
        self.steps = np.searchsorted(self.stop, np.arange(int(self.sizes.max(initial=0)) + 2))

    def _chances(self, chance: np.ndarray) -> np.ndarray:
        spelled = np.array([math.prod(chance[i] for i in x) for x in self.spelled] or [0.0])
        return np.where(self.number >= 0, chance[np.maximum(self.number, 0)], spelled[np.maximum(-1 - self.number, 0)])

    def forward(self, chance: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The summed likelihood of each beginning of each word, and the chance of each piece."""
        p, count = self._chances(chance), len(self.sizes)
        alpha = np.zeros((count, len(self.steps)))
        alpha[:, 0] = 1.0
        for stop in range(1, len(self.steps) - 1):
            here = slice(self.steps[stop], self.steps[stop + 1])
            word = self.word[here]
            alpha[:, stop] = np.bincount(word, alpha[word, self.start[here]] * p[here], count)
        return alpha, p

    def totals(self, alpha: np.ndarray) -> np.ndarray:
        return alpha[np.arange(len(self.sizes)), self.sizes]

    def expect(self, chance: np.ndarray, times: np.ndarray, sums: np.ndarray) -> np.ndarray:
        """Add to ``sums`` what ``times`` of each word use of each piece; returns the words that all but vanish, left out."""
        alpha, p = self.forward(chance)
        totals = self.totals(alpha)
        fine = totals >= VANISHED
        share = np.where(fine, times / np.where(fine, totals, 1.0), 0.0)
        beta = np.zeros_like(alpha)
        beta[np.arange(len(self.sizes)), self.sizes] = 1.0
        part = np.empty(len(p))
        for stop in range(len(self.steps) - 2, 0, -1):
            here = slice(self.steps[stop], self.steps[stop + 1])
            word, start = self.word[here], self.start[here]
            after = beta[word, stop] * p[here]
            np.add.at(beta, (word, start), after)
            part[here] = alpha[word, start] * after * share[word]
        usual = self.number >= 0
        sums += np.bincount(self.number[usual], part[usual], len(sums))
        for kind, used in enumerate(np.bincount(-1 - self.number[~usual], part[~usual], len(self.spelled))):
            for number in self.spelled[kind]:
                sums[number] += used
        return np.flatnonzero(~fine)


@dataclass(frozen=True)
class Model:
    weights: np.ndarray
    total: int
    distinct: int
    ends: int
    frequent: dict[bytes, tuple[int, float]]


def held_out(id_col: str) -> Column:
    return fold(id_col, 10) == 0


def word_counts(rows: DataFrame) -> DataFrame:
    """(word binary, n, m) over all ``text``: times in ``learned`` rows and in all; counted in tasks before the shuffle."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: tuple[Counter[bytes], Counter[bytes]] = Counter(), Counter()
        for batch, texts in text_rows(batches):
            for learned, text in zip(batch.column(0).to_pylist(), texts, strict=True):
                counts[learned].update(text.lower().split())
                if len(counts[learned]) > COUNTED:
                    yield _counted(counts[learned], learned)
                    counts[learned].clear()
        for learned, own in enumerate(counts):
            if own:
                yield _counted(own, learned)

    found = rows.select("learned", "text").mapInArrow(run, "word binary, n long, m long")
    return found.groupBy("word").agg(F.sum("n").alias("n"), F.sum("m").alias("m"))


def _counted(counts: Counter, learned: int) -> pa.RecordBatch:
    times = np.fromiter(counts.values(), np.int64, len(counts))
    return pa.RecordBatch.from_arrays(
        [pa.array(list(counts), pa.binary()), pa.array(times * int(learned)), pa.array(times)], names=["word", "n", "m"]
    )


def _short_and_long(words: list[bytes]) -> tuple[np.ndarray, list[str], list[tuple[int, str]]]:
    """Places and texts of the short words, and (place, text) of the long ones."""
    texts = [marked(word) for word in words]
    short = np.fromiter((len(x) <= SHORT for x in texts), bool, len(texts))
    return np.flatnonzero(short), [x for x in texts if len(x) <= SHORT], [(i, x) for i, x in enumerate(texts) if len(x) > SHORT]


def fit(
    counts: DataFrame, ends: int, vocabulary: Callable[[], Vocabulary], rounds: int = ROUNDS
) -> np.ndarray:
    """Logarithms of the piece weights after ``rounds`` of expectation maximisation over ``counts`` (word, n)."""
    known = vocabulary()
    weights = np.log(known.first)
    for _ in range(rounds):
        current = counts.sparkSession.sparkContext.broadcast(weights)

        def run(batches: Iterable[pa.RecordBatch], current=current) -> Iterator[pa.RecordBatch]:
            pieces, weight, chance = vocabulary(), current.value.tolist(), np.exp(current.value)
            sums = np.zeros(len(weight))
            for batch in batches:
                times = batch.column(1).to_numpy(zero_copy_only=False).astype(np.float64)
                places, texts, rest = _short_and_long(batch.column(0).to_pylist())
                lattices = Lattices(texts, pieces)
                faint = lattices.expect(chance, times[places], sums)
                for place, text in [*rest, *((places[i], texts[i]) for i in faint)]:
                    for number, part in expected(text, pieces, weight):
                        sums[number] += times[place] * part
            used = np.flatnonzero(sums)
            yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(sums[used])], names=["piece", "n"])

        found = counts.select("word", "n").mapInArrow(run, "piece long, n double").groupBy("piece").agg(F.sum("n").alias("n")).collect()
        sums = np.full(len(weights), PIECE_SMOOTH)  # one number per piece of the vocabulary
        for row in found:
            sums[row.piece] += row.n
        sums[known.end] += ends
        weights = np.log(sums / sums.sum())
    return weights


def likelihoods(words: list[bytes], pieces: Vocabulary, weights: np.ndarray) -> np.ndarray:
    """Natural logarithm of each word's marginal likelihood."""
    out = np.empty(len(words))
    places, texts, rest = _short_and_long(words)
    lattices = Lattices(texts, pieces)
    totals = lattices.totals(lattices.forward(np.exp(weights))[0])
    fine = totals >= VANISHED
    out[places[fine]] = np.log(totals[fine])
    weight = weights.tolist()
    for place, text in [*rest, *((places[i], texts[i]) for i in np.flatnonzero(~fine))]:
        out[place] = forward(text, pieces, weight)[-1]
    return out


def learn(
    rows: DataFrame,
    vocabulary: Callable[[], Vocabulary],
    rounds: int = ROUNDS,
    frequent: int = FREQUENT,
) -> tuple[Model, DataFrame]:
    """The model of the ``learned`` ones of ``rows`` (text, learned), and (word, n, likelihood) of all words, a table."""
    counts = written(word_counts(rows), "lm-words")
    ends = rows.where("learned").count()
    words, distinct, tokens = counts.agg(
        F.coalesce(F.sum("n"), F.lit(0)), F.count_if(F.col("n") > 0), F.coalesce(F.sum("m"), F.lit(0))
    ).first()
    weights = fit(counts.where("n > 0"), ends, vocabulary, rounds)
    shared = rows.sparkSession.sparkContext.broadcast(weights)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = vocabulary()
        for batch in batches:
            found = likelihoods(batch.column(0).to_pylist(), pieces, shared.value)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found)], names=["word", "n", "m", "likelihood"])

    scored = written(counts.mapInArrow(run, "word binary, n long, m long, likelihood double"), "lm-scored")
    often = scored.where((F.col("m") * frequent >= tokens) & (F.octet_length("word") <= FREQUENT_BYTES))
    sent = {bytes(r.word): (r.n, r.likelihood) for r in often.toLocalIterator()}  # at most ``frequent`` words
    return Model(weights, words + ends, distinct + (ends > 0), ends, sent), scored


def lattice_scores(
    docs: DataFrame,
    vocabulary: Callable[[], Vocabulary],
    id_col: str = "doc_id",
    text_col: str = "text",
    rounds: int = ROUNDS,
    frequent: int = FREQUENT,
) -> DataFrame:
    """(id, held_out, n_tokens, n_known, train_tokens, base_score, score) per row of ``docs``.

    A null or empty text has one token, the end. A row with a null id is learned from.
    Repeated rows are counted as often as they occur and each give a row. Other columns are
    not looked at. With nothing to learn from, every base score is zero and the pieces keep
    their first weights. An empty table gives no rows.
    """
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
    model, scored = learn(rows.select("text", (~held_out("id")).alias("learned")), vocabulary, rounds, frequent)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    bottom = math.log10(model.total + SMOOTH * (model.distinct + 1))
    end_number = vocabulary().end

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        place = {word: i for i, word in enumerate(known.frequent)}
        counts = np.array([n for n, _ in known.frequent.values()] + [0], np.float64)
        bases = np.log10(counts + SMOOTH) - bottom
        scores = np.array([x for _, x in known.frequent.values()] + [0.0])
        end = math.log10(known.ends + SMOOTH) - bottom
        for batch, texts in text_rows(batches):
            out = _Parts(batch.schema.field(1).type)
            for row, key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), texts, strict=True):
                counted = Counter(text.lower().split())
                times = np.fromiter(counted.values(), np.int64, len(counted))
                at = np.fromiter((place.get(word, -1) for word in counted), np.int64, len(counted))
                often = at >= 0
                met, used = at[often], times[often]
                out.add(
                    (
                        row,
                        key,
                        int(times.sum()) + 1,
                        int(known.ends > 0) + int(used[counts[met] > 0].sum()),
                        end + float(used @ bases[met]),
                        float(known.weights[end_number] + used @ scores[met]),
                    ),
                    list(compress(counted, ~often)),
                    times[~often],
                )
                if out.size > 100_000:
                    yield out.batch()
                    out = _Parts(batch.schema.field(1).type)
            yield out.batch()

    kind = rows.schema["id"].dataType.simpleString()
    parts = rows.select(F.monotonically_increasing_id().alias("row"), "id", "text").mapInArrow(
        run,
        f"row long, id {kind}, n_tokens long, n_known long, base double, score double,"
        " words array<binary>, times array<bigint>",
    )
    # The first word of each row is none: it holds a space, meets no count, and carries the row's own values.
    one = parts.select("*", F.posexplode(F.arrays_zip("words", "times")).alias("place", "one"))
    first = F.col("place") == 0
    one = one.select(
        "row",
        F.col("one.words").alias("word"),
        F.col("one.times").alias("times"),
        *[F.when(first, F.col(c)).alias(c) for c in ("id", "n_tokens", "n_known", "base", "score")],
    )
    n = F.coalesce("n", F.lit(0))
    whole = one.join(scored.drop("m"), "word", "left").groupBy("row").agg(
        F.max("id").alias("id"),
        F.max("n_tokens").alias("n_tokens"),
        F.sum(F.coalesce("n_known", F.lit(0)) + F.when(n > 0, F.col("times")).otherwise(0)).alias("n_known"),
        F.sum(F.coalesce("base", F.lit(0.0)) + F.col("times") * (F.log10(n + SMOOTH) - F.lit(bottom))).alias("base_score"),
        (F.sum(F.coalesce("score", F.lit(0.0)) + F.col("times") * F.coalesce("likelihood", F.lit(0.0))) / _LOG10).alias("score"),
    )
    return whole.select(
        F.col("id").alias(id_col),
        held_out("id").alias("held_out"),
        "n_tokens",
        "n_known",
        F.lit(model.total).cast("long").alias("train_tokens"),
        "base_score",
        "score",
    )


class _Parts:
    """Rows of what is known of documents, with their other words as arrays."""

    def __init__(self, key: pa.DataType) -> None:
        self.kinds = [pa.int64(), key, pa.int64(), pa.int64(), pa.float64(), pa.float64()]
        self.rows: list[tuple] = []
        self.words: list[bytes] = []
        self.times: list[np.ndarray] = []
        self.ends = [0]

    @property
    def size(self) -> int:
        return len(self.words)

    def add(self, values: tuple, words: list[bytes], times: np.ndarray) -> None:
        self.rows.append(values)
        self.words.append(b" %d" % values[0])
        self.words += words
        self.times += [np.zeros(1, np.int64), times]
        self.ends.append(len(self.words))

    def batch(self) -> pa.RecordBatch:
        columns = zip(*self.rows, strict=True) if self.rows else [[]] * len(self.kinds)
        values = [pa.array(list(c), k) for c, k in zip(columns, self.kinds, strict=True)]
        ends = pa.array(self.ends, pa.int32())
        times = np.concatenate(self.times) if self.times else np.empty(0, np.int64)
        return pa.RecordBatch.from_arrays(
            [
                *values,
                pa.ListArray.from_arrays(ends, pa.array(self.words, pa.binary())),
                pa.ListArray.from_arrays(ends, pa.array(times)),
            ],
            names=["row", "id", "n_tokens", "n_known", "base", "score", "words", "times"],
        )
