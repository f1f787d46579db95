import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tidemark.functions.synthetic import Draw, digests, null_threshold
from tidemark.operators.encode import encode_rows
from tidemark.operators.generate import (
    ATTESTATION_STATUS,
    BUSINESS_CRITICALITY,
    OPERATIONS,
    SOURCE_TABLES,
    change_records,
    change_stream,
    line_bytes,
)
from tidemark.operators.project import flatten
from tidemark.schema import change_schema, key_names

ROWS = 2000


@pytest.fixture(scope="module")
def flat(spark):
    stamp = F.lit(1_700_000_000_000) + F.col("id")
    return flatten(change_records(spark.range(ROWS), timestamp_ms=stamp)).toPandas()


def test_schema(spark):
    got = change_records(spark.range(1)).schema
    assert got.simpleString() == change_schema().simpleString()


def test_domains(flat):
    assert set(flat["type"]) == {"record"}
    assert set(flat["operation"]) == set(OPERATIONS)
    assert set(flat["source_table"]) == set(SOURCE_TABLES)
    assert set(flat["attestation_status"].dropna()) == set(ATTESTATION_STATUS)
    assert set(flat["business_criticality"].dropna()) == set(BUSINESS_CRITICALITY)
    assert flat["aliases"].isna().all()
    assert list(flat["timestamp"]) == list(range(1_700_000_000_000, 1_700_000_000_000 + ROWS))


def test_texts(flat):
    texts = flat[["payload_sys_id", "asset", "asset_tag", "assigned_to", *key_names()]]
    found = texts.stack().dropna()
    assert found.map(lambda text: bool(re.fullmatch("[A-Za-z0-9]{16}", text))).all()
    assert found.is_unique


def test_mixed_text(spark):
    rows = flatten(change_records(spark.range(300), mixed_text=True)).toPandas()
    found = rows[["payload_sys_id", "asset", *key_names()]].stack().dropna()
    assert found.map(lambda text: bool(re.fullmatch("[A-Za-z0-9]{16}", text))).all()
    assert found.is_unique
    counts = Counter("".join(found))
    assert len(counts) == 62
    even = sum(counts.values()) / 62
    assert all(abs(n / even - 1) < 0.06 for n in counts.values())


def test_null_share(flat):
    named = ["asset", "asset_tag", "assigned_to", "attestation_status", "business_criticality"]
    share = flat[[*named, *key_names()]].isna().mean()
    assert share.between(0.25, 0.35).all()
    assert abs(share.mean() - 0.30) < 0.005


def test_pools_are_even(flat):
    for name, pool in (("operation", OPERATIONS), ("source_table", SOURCE_TABLES)):
        share = flat[name].value_counts(normalize=True)
        assert (abs(share - 1 / len(pool)) < 0.05).all()


def test_same_rows_under_any_partitioning(spark):
    stamp = F.lit(0)
    whole = flatten(change_records(spark.range(0, 300, 1, 1), timestamp_ms=stamp, count=5))
    split = flatten(change_records(spark.range(0, 300, 1, 7), timestamp_ms=stamp, count=5))
    assert sorted(whole.collect(), key=str) == sorted(split.collect(), key=str)


def test_seed_changes_the_data(spark):
    one, two = (
        change_records(spark.range(20), seed=seed).select("payload_sys_id").collect()
        for seed in (1, 2)
    )
    assert not set(one) & set(two)


def test_null_percent_bounds(spark):
    def share(percent):
        rows = flatten(change_records(spark.range(50), null_percent=percent, count=3))
        return rows.select(F.avg(F.col("key_2").isNull().cast("int"))).first()[0]

    assert share(0) == 0.0
    assert share(100) == 1.0
    assert null_threshold(30) == "4ccc"
    with pytest.raises(ValueError):
        null_threshold(101)


def test_given_payload_columns(spark):
    rows = change_records(
        spark.range(3), payload={"asset": F.col("id") * 2}, keep=("id",), count=1
    )
    assert [(r.id, r.data.asset) for r in rows.collect()] == [(0, "0"), (1, "2"), (2, "4")]
    with pytest.raises(ValueError):
        change_records(spark.range(1), payload={"key_1": F.lit("x")})


@pytest.mark.parametrize(
    "settings",
    [
        {},
        {"timestamp_ms": "id"},
        {"count": 0, "null_percent": 0},
        {"prefix": 'é"x', "count": 7, "null_percent": 100},
        {"payload": {"asset": """CASE WHEN id % 2 = 0 THEN concat('a"é', id) END"""}, "count": 3},
    ],
)
def test_line_sizes_without_drawing(spark, settings):
    settings = dict(settings)
    if "timestamp_ms" in settings:
        settings["timestamp_ms"] = F.expr(settings["timestamp_ms"])
    if "payload" in settings:
        settings["payload"] = {name: F.expr(text) for name, text in settings["payload"].items()}
    lines = encode_rows(change_records(spark.range(ROWS), mixed_text=True, **settings))
    (mean,) = lines.select(F.avg(F.octet_length("value") + 1)).first()
    assert abs(line_bytes(spark.range(ROWS), **settings) / mean - 1) < 0.005


def test_line_size_of_an_empty_batch(spark):
    assert line_bytes(spark.range(0)) > 0


def test_default_time_is_now_in_millis(spark):
    got, now = (
        change_records(spark.range(1), count=1)
        .select("timestamp", F.unix_millis(F.current_timestamp()))
        .first()
    )
    assert got == now


def test_draws_do_not_share_digits(spark):
    drawn = spark.range(1).select(digests(F.col("id"), 4).alias("d"))
    texts = drawn.selectExpr(*[Draw("d", slot).text() for slot in range(4)]).first()
    assert len(set(texts)) == 4


def test_pool_values_with_quotes(spark):
    pool = ["it's", 'a "b"', "back\\slash"]
    rows = spark.range(50).select(digests(F.col("id"), 1).alias("d"))
    assert {r[0] for r in rows.selectExpr(Draw("d", 0).pick(pool)).collect()} == set(pool)


def test_rate_stream(spark):
    stream = change_stream(spark, rows_per_second=5, count=2)
    assert stream.isStreaming
    assert stream.schema.simpleString() == change_schema(count=2).simpleString()


def test_one_partition_of_ids_is_spread_over_the_cores(spark):
    ids = spark.range(0, 400, 1, numPartitions=1)
    rows = change_records(ids, timestamp_ms=F.lit(0))
    assert rows.rdd.getNumPartitions() == spark.sparkContext.defaultParallelism > 1
    assert rows.count() == 400
