"""From raw documents to packed training sequences, in five stages.

Each stage is given all that the one before kept, written as Parquet and read again. The
first four return the columns of ``documents``; the last returns packed pieces.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm.common import table, written
from tidemark.llm.contained import without_leaks
from tidemark.llm.packing_slack import packing_digest
from tidemark.llm.queries import tokenizer_file
from tidemark.llm.simhash_ball import keep_one
from tidemark.llm.suffix_levels import without_repeats
from tidemark.llm.toxicity_pu import without_toxic

#: Passages of just over 50 words are to go, and words are seldom shorter than four letters and a space.
REPEAT_BYTES = 256
#: Units that the encoder of packing remembers: its workers still hold what earlier stages took.
KNOWN_UNITS = 60_000


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored toxic go."""
    return without_toxic(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates the document with the smallest id stays."""
    return keep_one(docs)


def repeated_strings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Strings of ``REPEAT_BYTES`` that occur elsewhere are cut out; ``n_chars`` counts what is left of the text."""
    return with_length(without_repeats(docs, length=REPEAT_BYTES, anchor=REPEAT_BYTES // 2))


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return without_leaks(docs, table(spark, sf_dir, "benchmark"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents, packed into sequences of at most 4096 tokens."""
    return packing_digest(docs, tokenizer_file("word_bpe_49k.json"), known=KNOWN_UNITS)


def with_length(docs: DataFrame) -> DataFrame:
    if "n_chars" not in docs.columns:
        return docs
    kind = docs.schema["n_chars"].dataType.simpleString()
    return docs.selectExpr(*[f"cast(length(text) AS {kind}) AS n_chars" if c == "n_chars" else f"`{c}`" for c in docs.columns])


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", toxicity),
    ("simhash near-dedup", near_duplicates),
    ("suffix-array dedup", repeated_strings),
    ("benchmark decontamination", benchmark_leaks),
    ("packing", packing),
]

#: Hashing, suffixes, tokens and a learned score are beyond SQL; tests/llm/test_pipeline.py holds each stage to brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)
