import random
import re

import duckdb
import pytest
from conftest import plan_of
from pyspark.sql import functions as F

from tidemark.llm.contained import contained, contained_sql, without_leaks


def shingles(text):
    w = re.findall(r"[^\W_]+", (text or "").lower())
    return {" ".join(w[i : i + 5]) for i in range(len(w) - 4)}


def brute(docs, items, threshold=0.8):
    merged = {}
    for key, rows in (("d", docs), ("i", items)):
        for i, t in rows:
            if i is not None:
                merged.setdefault((key, i), set()).update(shingles(t))
    return sorted(
        (d, i, len(y), len(x & y))
        for (k, d), x in merged.items()
        if k == "d"
        for (k2, i), y in merged.items()
        if k2 == "i" and y and len(x & y) / len(y) >= threshold
    )


def made():
    rng = random.Random(2)
    prose = lambda n: " ".join("".join(rng.choices("abcdeé", k=3)) for _ in range(n))
    items = [(i, prose(n)) for i, n in enumerate([4, 5, 6, 9, 12, 20, 35, 64, 70, 130])]
    items += [(20, None), (None, prose(20)), (5, items[5][1]), (21, items[6][1] + " tail")]
    docs = [(0, None), (1, ""), (None, items[7][1]), (2, prose(3000))]
    for i, (_, text) in enumerate(items):
        if text is None:
            continue
        w = text.split()
        for edits in (0, 1, 2, 3, 5):
            copy = [*w]
            for _ in range(edits):
                copy[rng.randrange(len(copy))] = "zzz"
            docs.append((100 * i + edits + 10, prose(rng.choice([0, 5, 400])) + "\n" + ", ".join(copy).upper() + prose(30)))
    return [*docs, docs[20], docs[20]], items


@pytest.mark.parametrize("broadcast_rows", [200_000, 0])
def test_equals_brute_force(spark, broadcast_rows):
    docs, items = made()
    d = spark.createDataFrame(docs, "doc_id long, text string").withColumn("item", F.lit(1)).withColumn("hash", F.lit(2))
    b = spark.createDataFrame(items, "item_id long, text string").withColumn("doc", F.lit("x"))
    got = sorted(tuple(r)[:4] for r in contained(d, b, broadcast_rows=broadcast_rows).collect())
    want = brute(docs, items)
    assert got == want and len(want) > 20
    kept = without_leaks(d, b)
    assert kept.columns == d.columns
    # Each row is judged by its own text: here ids are null or repeated, and rows are told apart by number.
    leaked = {x[0] for x in brute([(n, text) for n, (_, text) in enumerate(docs)], items)}
    left = sorted(((i, t) for n, (i, t) in enumerate(docs) if n not in leaked), key=str)
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=str) == left


def test_rows_of_one_id_are_kept_apart(spark):
    rows = [(1, "a b c d e f", "x", 1), (1, "clean", "x", 2), (None, "a b c d e f", "x", 3), (None, None, "x", 4), (2, "a b c d e f", "x", 5)]
    d = spark.createDataFrame(rows, "doc_id long, text string, digest string, c0 int")
    b = spark.createDataFrame([(1, "a b c d e f")], "item_id long, text string")
    kept = without_leaks(d, b)
    assert kept.columns == d.columns and sorted(r.c0 for r in kept.collect()) == [2, 4]


def test_equals_sql(spark, sf_dir):
    docs, items = spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    connection = duckdb.connect()
    for name in ("documents", "benchmark"):
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    want = sorted(connection.execute(contained_sql()).fetchall())
    assert sorted(map(tuple, contained(docs, items).collect())) == want and want


def test_native_and_empty(spark):
    d = spark.createDataFrame([(1, "a b c d e f")], "doc_id long, text string")
    b = spark.createDataFrame([(1, "a b c d e f")], "item_id long, text string")
    pairs = contained(d, b)
    assert "Python" not in plan_of(pairs) and "Arrow" not in plan_of(pairs)
    assert [tuple(r) for r in pairs.collect()] == [(1, 1, 2, 2, 1.0)]
    assert contained(d.where(F.lit(False)), b).count() == contained(d, b.where(F.lit(False))).count() == 0
