"""Benchmark decontamination: MinHash containment search, DataFrame functions only.

An item leaks into a document if the document holds at least ``THRESHOLD`` of the item's
distinct shingles of ``SHINGLE`` words. The size that counts is the item's, not the
document's, so a short item is found in a document of any length.

* Items are partitioned by their number of shingles into classes of doubling size. Each
  class keeps of every item the MinHash sketch of its smallest shingle hashes, as many as a
  document that holds ``THRESHOLD`` of the largest item of the class can lack, and one
  more: a leak must then hold one of them, so the search loses nothing.
* Shingle hashes of documents are looked up in the sketches.
* Candidates are verified by their exact shingles, as texts, not by hash.

The sketches are broadcast only when counted to be at most ``BROADCAST_ROWS`` rows; beyond
that the same join is shuffled.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import written

SHINGLE = 5
THRESHOLD = 0.8
BROADCAST_ROWS = 200_000
NOT_WORD = r"[^\p{L}\p{N}]+"


def words(text: Column) -> Column:
    """Lower-case runs of letters and digits; none for a null text."""
    parts = F.split(F.lower(F.coalesce(text, F.lit(""))), NOT_WORD)
    return F.filter(parts, lambda word: word != "")


def once(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value worked out once per row: a plain column would be copied into every lambda."""
    return F.element_at(F.transform(F.array(value), use), 1)


def shingle_hashes(hashes: Column, size: int) -> Column:
    """A hash of each shingle of an array of word hashes; none if there are fewer words."""
    return once(
        hashes,
        lambda h: F.when(
            F.size(h) >= size,
            F.transform(
                F.sequence(F.lit(0), F.size(h) - size), lambda i: F.xxhash64(*[F.get(h, i + k) for k in range(size)])
            ),
        ).otherwise(F.expr("cast(array() AS array<bigint>)")),
    )


def shingle_texts(words: Column, size: int) -> Column:
    """The shingles of an array of words; none if there are fewer words."""
    return once(
        words,
        lambda w: F.when(
            F.size(w) >= size,
            F.transform(F.sequence(F.lit(1), F.size(w) - size + 1), lambda i: F.array_join(F.slice(w, i, size), " ")),
        ).otherwise(F.expr("cast(array() AS array<string>)")),
    )


def contained(
    docs: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text: str = "text",
    size: int = SHINGLE,
    threshold: float = THRESHOLD,
    broadcast_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """(id, item, n_shingles, n_shared, containment) of every pair at or above ``threshold``.

    Shingles count once in an item and once in a document. An item of fewer words than a
    shingle, or with a null text or id, is in no pair; nor is a document with a null text or
    id. Rows that repeat an id are one document, or one item, with the shingles of all of
    them. Other columns are not looked at. Empty tables give no pairs.
    """
    rows = docs.select(F.col(f"`{id_col}`").alias("doc"), F.col(f"`{text_col}`").alias("text")).where("doc IS NOT NULL")
    wanted = items.select(F.col(f"`{item_col}`").alias("item"), words(F.col(f"`{item_text}`")).alias("words"))
    shingles = written(
        wanted.where("item IS NOT NULL")
        .select("item", F.explode(shingle_texts(F.col("words"), size)).alias("shingle"))
        .distinct()
        .withColumn("hash", F.expr("xxhash64(" + ", ".join(f"xxhash64(split(shingle, ' ')[{k}])" for k in range(size)) + ")")),
        "contained-items",
    )
    counted = shingles.groupBy("item").agg(
        F.count("*").alias("n"), F.array_sort(F.collect_set("hash")).alias("sketch")
    )
    # Class c holds items of 2^c to 2^(c+1) - 1 shingles; its sketches are as long as its largest item needs.
    lacks = f"cast(floor((shiftleft(2L, cast(log2(n) AS int)) - 1) * (1 - {threshold}) + 1e-9) AS int) + 1"
    sketches = written(
        counted.selectExpr(
            "item",
            f"explode(slice(sketch, 1, {lacks})) AS hash",
        ),
        "contained-sketches",
    )
    few = sketches.count() <= broadcast_rows
    probes = (
        rows.select(
            "doc",
            F.explode(shingle_hashes(F.transform(words(F.col("text")), lambda w: F.xxhash64(w)), size)).alias("hash"),
        )
    )
    met = probes.join(F.broadcast(sketches) if few else sketches, "hash")
    candidates = written(met.groupBy("doc", "item").agg(F.count("*").alias("met")).select("doc", "item"), "contained-pairs")

    # Exact: shingles of candidate documents only, as texts.
    suspects = written(candidates.select("doc").distinct(), "contained-suspects")
    held = (
        rows.join(suspects, "doc", "left_semi")
        .select("doc", F.explode(shingle_texts(words(F.col("text")), size)).alias("shingle"))
    )
    shared = (
        held.join(F.broadcast(shingles) if few and shingles.count() <= broadcast_rows else shingles, "shingle")
        .select("doc", "item", "shingle")
        .distinct()
        .groupBy("doc", "item")
        .agg(F.count("*").alias("n_shared"))
    )
    totals = shingles.groupBy("item").agg(F.count("*").alias("n_shingles"))
    return (
        shared.join(candidates, ["doc", "item"], "left_semi")
        .join(totals, "item")
        .withColumn("containment", F.expr("n_shared / n_shingles"))
        .where(F.col("containment") >= threshold)
        .select(
            F.col("doc").alias(id_col), F.col("item").alias(item_col), "n_shingles", "n_shared", "containment"
        )
    )


def without_leaks(docs: DataFrame, items: DataFrame, text_col: str = "text", **settings) -> DataFrame:
    """The rows of ``docs`` whose own text holds no item; a null text holds none.

    Rows are looked up by the SHA-256 of their text, so ids, which may be null or repeated,
    do not matter, and equal texts are searched once. Columns may bear any name.
    """
    digest = F.unhex(F.sha2(F.col(f"`{text_col}`").cast("binary"), 256))
    texts = docs.select(digest.alias("digest"), F.col(f"`{text_col}`").alias("text"))
    leaks = contained(texts, items, "digest", "text", **settings).select("digest").distinct()
    rows = docs.select(digest.alias("digest"), F.struct(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(docs.columns)]).alias("rest"))
    kept = rows.join(written(leaks, "contained-leaks"), "digest", "left_anti")
    return kept.select(*[F.col(f"rest.c{i}").alias(c) for i, c in enumerate(docs.columns)])


def contained_sql(size: int = SHINGLE, threshold: float = THRESHOLD) -> str:
    """The same pairs in DuckDB, from all shingles of ``documents`` and ``benchmark``."""

    def shingles(key: str, name: str) -> str:
        parts = " || ' ' || ".join(f"w[i + {k}]" for k in range(size))
        return (
            f"(SELECT DISTINCT {key}, {parts} AS shingle FROM"
            f" (SELECT {key}, w, unnest(range(1, len(w) - {size - 2})) AS i FROM"
            f" (SELECT {key}, list_filter(regexp_split_to_array(lower(text), '{NOT_WORD}'), lambda x: x <> '') AS w"
            f" FROM {name} WHERE {key} IS NOT NULL AND text IS NOT NULL)))"
        )

    return (
        f"WITH d AS {shingles('doc_id', 'documents')}, b AS {shingles('item_id', 'benchmark')},"
        " n AS (SELECT item_id, count(*) AS n_shingles FROM b GROUP BY item_id)"
        " SELECT doc_id, item_id, any_value(n_shingles) AS n_shingles, count(*) AS n_shared,"
        " count(*) / any_value(n_shingles) AS containment FROM d JOIN b USING (shingle) JOIN n USING (item_id)"
        f" GROUP BY doc_id, item_id HAVING count(*) / any_value(n_shingles) >= {threshold}"
    )
