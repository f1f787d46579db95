"""Sequences and outliers against brute force."""

import random
from datetime import datetime, timedelta, timezone
from statistics import fmean, pvariance

import pytest
from pyspark.sql import functions as F

from tidemark.operators.patterns import anomalies, merged, moments, sequences

BASE = datetime(2024, 3, 1, tzinfo=timezone.utc)
STEPS = ["kind = 'a'", "kind = 'b'", "kind = 'c'"]


def frame(spark, rows):
    """Rows (key, minutes, id, kind, value)."""
    dated = [(k, None if m is None else (BASE + timedelta(minutes=m)).isoformat(), *rest) for k, m, *rest in rows]
    df = spark.createDataFrame(dated, "key string, at string, id long, kind string, value double")
    return df.withColumn("at", F.col("at").cast("timestamp"))


def brute(rows, kinds, minutes, strict):
    found = []
    for key in {r[0] for r in rows} - {None}:
        mine = sorted((r for r in rows if r[0] == key and r[1] is not None), key=lambda r: (r[1], r[2]))
        for i, first in enumerate(mine):
            if first[3] != kinds[0]:
                continue
            chain, j = [first], i
            for kind in kinds[1:]:
                options = range(j + 1, min(j + 2, len(mine)) if strict else len(mine))
                j = next((x for x in options if mine[x][3] == kind), None)
                if j is None:
                    break
                chain.append(mine[j])
            if len(chain) == len(kinds) and chain[-1][1] - first[1] <= minutes:
                found.append((key, *[r[2] for r in chain]))
    return sorted(found)


@pytest.mark.parametrize("strict", [False, True])
@pytest.mark.parametrize("slices", [1, 4])
def test_sequences_equal_brute_force(spark, strict, slices):
    rng = random.Random(5)
    # One key holds half of the rows; times tie, lie before the epoch's slices' ends and are missing.
    rows = [
        (rng.choice(["hot", "hot", "x", "y", None]), rng.choice([None, *range(0, 400)]), i, rng.choice(["a", "b", "c", None]), 0.0)
        for i in range(600)
    ]
    got = sequences(frame(spark, rows), "key", "at", "id", STEPS, timedelta(minutes=10), strict, slices)
    want = brute(rows, "abc", 10, strict)
    assert want and sorted(map(tuple, got.collect())) == want
    twice = sequences(frame(spark, rows), "key", "at", "id", ["kind = 'a'"] * 2, timedelta(minutes=10), strict, slices)
    assert sorted(map(tuple, twice.collect())) == brute(rows, "aa", 10, strict)


def test_sequence_edges(spark):
    rows = [("k", 0, 1, "a", 0.0), ("k", 10, 2, "b", 0.0), ("k", 20, 3, "b", 0.0)]
    at = [tuple(r) for r in sequences(frame(spark, rows), "key", "at", "id", STEPS[:2], timedelta(minutes=10)).collect()]
    assert at == [("k", 1, 2)]  # the last instant counts
    assert sequences(frame(spark, rows), "key", "at", "id", STEPS[:1], timedelta(minutes=1)).count() == 1
    assert sequences(frame(spark, []), "key", "at", "id", STEPS, timedelta(minutes=1)).collect() == []
    with pytest.raises(ValueError):
        sequences(frame(spark, rows), "key", "at", "id", [], timedelta(minutes=1))


def test_sequences_sort_once(spark):
    df = sequences(frame(spark, []), "key", "at", "id", STEPS, timedelta(minutes=1))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and plan.count("Sort [") == 1


def test_moments_merge_to_those_of_the_whole(spark):
    rng = random.Random(3)
    rows = [(rng.choice("xyz"), i, i, rng.choice("ab"), rng.choice([None, float("nan"), float("inf"), 1.25, -7.5, 1e6])) for i in range(300)]
    df = frame(spark, rows)
    whole = moments(df, ["key"], "value", "0.01")
    parts = merged(moments(df, ["key", "kind"], "value", "0.01"), ["key"])
    assert whole.schema["q"].dataType == parts.schema["q"].dataType
    got = sorted(map(tuple, parts.collect()))
    assert got == sorted(map(tuple, whole.collect()))
    for key, n, s, q in got:
        units = [round(r[4] * 100) for r in rows if r[0] == key and r[4] in (1.25, -7.5, 1e6)]
        assert (n, s, q) == (len(units), sum(units), sum(u * u for u in units))


def test_anomalies_equal_brute_force(spark):
    rng = random.Random(11)
    rows = [(rng.choice(["hot", "hot", "x", None]), rng.randrange(0, 600), i, None, round(rng.gauss(50, 5), 2)) for i in range(800)]
    rows += [("hot", 500, 900, None, 500.0), ("x", 3, 901, None, 9e5), ("x", 400, 902, None, None), ("x", None, 903, None, 1e5)]
    found = anomalies(frame(spark, rows), "key", "at", "value", timedelta(minutes=60), 3, 3, "0.01", least=5)
    assert found.columns == ["key", "at", "id", "kind", "value", "past_n"]
    usable = [r for r in rows if None not in (r[0], r[1], r[4])]
    want = []
    for key, minute, id_, _, value in usable:
        past = [r[4] for r in usable if r[0] == key and minute // 60 - 3 <= r[1] // 60 <= minute // 60 - 1]
        if len(past) >= 5 and (value - fmean(past)) ** 2 > 9 * pvariance(past):
            want.append((id_, len(past)))
    assert any(id_ == 900 for id_, _ in want)
    assert sorted((r.id, r.past_n) for r in found.collect()) == sorted(want)
    assert anomalies(frame(spark, []), "key", "at", "value", timedelta(hours=1), 3, 3).collect() == []
