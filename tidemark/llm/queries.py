"""The registered queries of this package, and SQL where SQL can express one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm.common import table
from tidemark.llm.contained import contained, contained_sql
from tidemark.llm.filter_audit import audit, audit_sql
from tidemark.llm.flat_graph import near_vectors
from tidemark.llm.lattice_lm import Vocabulary, lattice_scores
from tidemark.llm.merkle_manifest import manifest, manifest_sql
from tidemark.llm.packing_slack import packing_digest
from tidemark.llm.quality_pu import quality
from tidemark.llm.simhash_ball import simhash_components
from tidemark.llm.suffix_levels import cut_repeats, digest
from tidemark.llm.token_files import token_digest
from tidemark.llm.toxicity_pu import toxicity
from tidemark.llm.url_intervals import judged_pages, judged_sql
from tidemark.llm.warc import archive_digest, archive_sql

# The rules (host, path, verdict) that pages are judged by.
URL_RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]


def op1_flat_graph(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(table(spark, sf_dir, "embeddings"))


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archive_digest(table(spark, sf_dir, "pages"))


def op3_toxicity_pu(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_quality_pu(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


# Bytes of a shorter repeat, counted beside the contract's 400: passages of some fifty words are shorter.
SHORT_REPEAT = 256


def op4_suffix_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digest(cut_repeats(table(spark, sf_dir, "documents"), short=SHORT_REPEAT))


def tokenizer_file(name: str) -> Callable[[], str]:
    """Where a tokenizer file of the installed package is, asked on the machine that needs it."""

    def path() -> str:
        import public_tokenizers

        return public_tokenizers.path(name)

    return path


def op6_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_digest(table(spark, sf_dir, "documents"), tokenizer_file("byte_bpe_50k.json"))


def op7_packing_slack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing_digest(table(spark, sf_dir, "documents"), tokenizer_file("word_bpe_49k.json"))


def public_vocabulary() -> Vocabulary:
    return Vocabulary.load(tokenizer_file("piece_bpe_32k.model")())


def op8_lattice_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lattice_scores(table(spark, sf_dir, "documents"), public_vocabulary)


def op9_simhash_ball(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_components(table(spark, sf_dir, "documents"))


def op10_contained(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contained(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op11_url_intervals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judged_pages(table(spark, sf_dir, "pages"), URL_RULES)


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest(table(spark, sf_dir, "documents"))


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_flat_graph": op1_flat_graph,
    "op2_warc": op2_warc,
    "op3_toxicity_pu": op3_toxicity_pu,
    "op4_suffix_levels": op4_suffix_levels,
    "op5_quality_pu": op5_quality_pu,
    "op6_token_files": op6_token_files,
    "op7_packing_slack": op7_packing_slack,
    "op8_lattice_lm": op8_lattice_lm,
    "op9_simhash_ball": op9_simhash_ball,
    "op10_contained": op10_contained,
    "op11_url_intervals": op11_url_intervals,
    "op12_merkle_manifest": op12_merkle_manifest,
    "op13_filter_audit": op13_filter_audit,
}

ORACLE_SQL: dict[str, str] = {
    "op2_warc": archive_sql(),
    "op10_contained": contained_sql(),
    "op11_url_intervals": judged_sql(URL_RULES),
    "op12_merkle_manifest": manifest_sql(),
    "op13_filter_audit": audit_sql(),
}
