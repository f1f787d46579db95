"""Text classifiers fitted from trusted positives and unlabelled documents, and applied to whole texts."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import small_batches, trimmed
from tidemark.llm.pu_learning import Rows, class_prior, logistic, train
from tidemark.llm.text_features import SIZE

MOST_POSITIVES = 6_000
MOST_UNLABELLED = 12_000
SAMPLE_STEPS = 1_000_000


@dataclass(frozen=True)
class Classifier:
    weights: np.ndarray
    bias: float
    prior: float


def fold(id_col: str, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus``; a null id is in fold -1, so nothing is learned from its label."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % modulus, F.lit(-1))


def _drawn(rows: DataFrame, id_col: str, bound: int, salt: int) -> DataFrame:
    """About ``bound`` rows at most, chosen by a hash of the id."""
    count = rows.count()
    if count <= bound:
        return rows
    share = int(SAMPLE_STEPS * bound / count)
    return rows.where(F.pmod(F.xxhash64(F.lit(salt), F.col(id_col)), F.lit(SAMPLE_STEPS)) < share)


def featured(docs: DataFrame, features: Callable[[], Callable[[str], np.ndarray]]) -> DataFrame:
    """(found: binary) of each row's ``text``; ``features`` makes, once in a task, the function of a text."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of_text = features()
        for batch in batches:
            found = [of_text(x or "").tobytes() for x in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.binary())], names=["found"])

    return docs.select("text").mapInArrow(trimmed(run), "found binary")


def fit(
    docs: DataFrame,
    labels: DataFrame,
    label_col: str,
    features: Callable[[], Callable[[str], np.ndarray]],
    held_out: Callable[[str], Column],
    id_col: str = "doc_id",
    text_col: str = "text",
    most_positives: int = MOST_POSITIVES,
    most_unlabelled: int = MOST_UNLABELLED,
    **training,
) -> Classifier:
    """Learn from documents that are not ``held_out``.

    Trusted positives are those whose label is 1; the unlabelled sample is drawn from all
    documents without looking at labels. The class prior is estimated from these two samples
    (``class_prior``); labels other than 1 are never looked at. Both samples are bounded, by
    ``most_positives`` and ``most_unlabelled``; a document counts once however often it is labelled.
    """
    known = (
        labels.select(F.col(id_col).alias("id"), F.col(label_col).alias("label"))
        .where(~held_out("id") & (F.col("label") == 1) & F.col("id").isNotNull())
        .select("id")
        .distinct()
    )
    small_batches(docs.sparkSession)
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    trusted = _drawn(known, "id", most_positives, 1)
    # Bounded by most_positives, hence safe to broadcast.
    positive = texts.join(F.broadcast(trusted), "id", "left_semi")
    unlabelled = _drawn(texts.where(~held_out("id")), "id", most_unlabelled, 2)

    def rows(sample: DataFrame) -> Rows:
        return Rows.of([r.found for r in featured(sample, features).toLocalIterator()])

    samples = rows(positive), rows(unlabelled)
    prior = class_prior(*samples, SIZE, **training)
    weights, bias = train(*samples, prior, SIZE, **training)
    return Classifier(weights, bias, prior)


def _scores(model: Classifier, of_text: Callable[[str], np.ndarray], texts: list[str | None]) -> np.ndarray:
    sums = [float(model.weights[of_text(x or "")].sum(dtype=np.float64)) for x in texts]
    return logistic(np.array(sums, dtype=np.float64) + model.bias)


def score(
    docs: DataFrame,
    model: Classifier,
    features: Callable[[], Callable[[str], np.ndarray]],
    text_col: str = "text",
) -> DataFrame:
    """(doc, score): each row as a struct ``doc`` without its text, and its score from 0 to 1.

    Every text is read as a whole. The weights are ``SIZE`` numbers whatever the data, so
    they are sent to every executor once.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of_text, known = features(), shared.value
        for batch in batches:
            scores = _scores(known, of_text, batch.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores, pa.float64())], names=["doc", "score"])

    others = [F.col(f"`{c}`") for c in docs.columns if c != text_col] or [F.lit(True).alias("present")]
    rows = docs.select(F.struct(*others).alias("doc"), F.col(f"`{text_col}`").alias("text"))
    return rows.mapInArrow(trimmed(run), f"doc {rows.schema['doc'].dataType.simpleString()}, score double")


def below(
    docs: DataFrame,
    model: Classifier,
    features: Callable[[], Callable[[str], np.ndarray]],
    threshold: float,
    text_col: str = "text",
) -> DataFrame:
    """The rows of ``docs`` with a score below ``threshold``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    names = [f"c{i}" for i in range(len(docs.columns))]  # by position: columns may bear any name
    text = docs.columns.index(text_col)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of_text, known = features(), shared.value
        for batch in batches:
            scores = _scores(known, of_text, batch.column(text).to_pylist())
            yield batch.filter(pa.array(scores < threshold))

    rows = docs.select(*[F.col(f"`{c}`").alias(n) for c, n in zip(docs.columns, names, strict=True)])
    return rows.mapInArrow(trimmed(run), rows.schema).toDF(*docs.columns)
