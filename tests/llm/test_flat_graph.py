import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import flat_graph
from tidemark.llm.flat_graph import _audit, _linked, _truth, medoid, near_vectors, prune, search, unit


def brute(rows, least=0.95):
    sound = {}
    for k, (i, v) in enumerate(rows):
        if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v):
            sound.setdefault(len(v), []).append(k)
    links, root = [0] * len(rows), [i for i, _ in rows]
    for ks in sound.values():
        points = unit(np.array([rows[k][1] for k in ks], np.float64))
        near = points @ points.T >= least
        np.fill_diagonal(near, False)
        for k, row in zip(ks, near, strict=True):
            links[k] = int(row.sum())
        label = np.array([rows[k][0] for k in ks])
        while True:
            new = np.array([min([label[a], *label[near[a]]]) for a in range(len(ks))])
            if (new == label).all():
                break
            label = new
        for k, x in zip(ks, label.tolist(), strict=True):
            root[k] = x
    return sorted(((i, n, r, i is not None and i == r) for (i, _), n, r in zip(rows, links, root, strict=True)), key=str)


def made(count, seed=0):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(12, 24))
    base = centres[rng.integers(0, 12, count)] + rng.normal(size=(count, 24))
    base[: count // 4] = base[0] + rng.normal(size=(count // 4, 24)) * 0.12
    base[-40:] = base[-80:-40] * 3 + rng.normal(size=(40, 24)) * 0.05
    return [(int(i), v.tolist()) for i, v in zip(rng.permutation(count) * 7, base, strict=True)]


def test_graph_search_finds_the_range():
    points = unit(np.array([v for _, v in made(600)]))
    edges = prune(points)
    both = [set(x[x >= 0]) for x in edges]
    for a, near in enumerate(edges):
        for b in near[near >= 0]:
            both[b].add(a)
    full = np.full((600, max(map(len, both))), -1)
    for row, near in zip(full, both, strict=True):
        row[: len(near)] = list(near)
    found = search(points, full, medoid(points), 0.95)
    true = points @ points.T >= 0.95
    np.fill_diagonal(true, False)
    assert not (found & ~true).any() and found.sum() >= 0.99 * true.sum() > 1000


def test_equals_brute_force_in_one_and_in_many_shards(spark):
    rows = made(900)
    rows += [(10_001, None), (10_002, []), (10_003, [0.0] * 24), (10_004, [None] + [1.0] * 23), (10_005, [float("nan")] * 24),
             (10_006, [float("inf")] + [1.0] * 23), (None, rows[0][1]), (10_007, [1.0, 2.0]), (10_008, [2.0, 4.0]),
             (10_009, rows[5][1]), (10_010, rows[5][1]), (10_010, rows[5][1]), (10_011, [1e200] * 24), (10_012, [1e-200] * 24)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("id", F.lit("x"))
    want = brute(rows)
    assert sorted(map(tuple, near_vectors(df).collect()), key=str) == want
    got = sorted(map(tuple, near_vectors(df, limit=400, audited=10_000).collect()), key=str)
    true, have = sum(r[1] for r in want), sum(min(a[1], b[1]) for a, b in zip(want, got, strict=True))
    assert [r[0] for r in got] == [r[0] for r in want] and all(a[1] <= b[1] for a, b in zip(got, want, strict=True))
    assert have >= 0.9 * true


def test_table_and_empty_table(spark, sf_dir):
    df = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    rows = [(r.vec_id, [float(x) for x in r.embedding]) for r in df.collect()]
    assert sorted(map(tuple, near_vectors(df).collect()), key=str) == brute(rows)
    assert near_vectors(df.where(F.lit(False))).count() == 0


def test_a_group_over_many_shards_is_counted_whole(spark):
    rng = np.random.default_rng(3)
    clump = rng.normal(size=16) + rng.normal(size=(1500, 16)) * 0.1
    rows = [(i, v.tolist()) for i, v in enumerate(np.concatenate((clump, rng.normal(size=(300, 16)))))]
    units = unit(np.array([v for _, v in rows]))
    reps = spark.createDataFrame([(i, 1, v.tolist()) for i, v in enumerate(units)], "id long, n long, vec array<double>")
    linked = _linked(reps, 0.95, 2, 400).groupBy("id").agg(F.sum("links").alias("links"), F.min("root").alias("root"))
    got = {r.id: r.links for r in linked.collect()}
    true = (units @ units.T >= 0.95).sum(axis=1) - 1
    have = np.array([got.get(i, 0) for i in range(len(units))])
    assert true.sum() > 500_000 and (have <= true).all()
    assert have.sum() >= 0.99 * true.sum()
    assert (have[true > 0] >= 0.9 * true[true > 0]).mean() >= 0.99


def test_the_audit_needs_evidence_and_is_enforced(spark, monkeypatch):
    rng = np.random.default_rng(4)
    points = rng.normal(size=(600, 32))
    points[3], points[303] = points[1], points[301]
    points[[3, 303]] += rng.normal(size=(2, 32)) * 0.05
    units = unit(points)
    reps = spark.createDataFrame([(i, 1, v.tolist()) for i, v in enumerate(units)], "id long, n long, vec array<double>")
    truth = _truth(reps, 0.95, 128, 100)  # few are linked, none of them divisible by fifty
    assert sorted(map(tuple, truth.collect())) == [(1, 1), (3, 1), (301, 1), (303, 1)]
    nothing = spark.createDataFrame([(1, 1)], "id long, links long")
    assert _audit(truth, nothing) == (4, 0.25, 0.25)
    monkeypatch.setattr(flat_graph, "_linked", lambda *_: spark.createDataFrame([(1, 1, 1)], "id long, links long, root long"))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(points)], "vec_id long, embedding array<double>")
    with pytest.raises(RuntimeError, match="recall 0.25"):
        near_vectors(df, most_overlap=2)


def test_rows_that_repeat_an_id_keep_vectors_of_their_own(spark):
    rng = np.random.default_rng(5)
    a, b = rng.normal(size=(2, 24))
    near = [(a + rng.normal(size=24) * 0.02), (b + rng.normal(size=24) * 0.02)]
    rows = [(7, a.tolist()), (7, b.tolist()), (8, near[0].tolist()), (9, near[1].tolist()), (10, near[1].tolist())]
    rows += [(int(i) % 40 + 100, v.tolist()) for i, v in enumerate(rng.normal(size=(600, 24)))]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    want = brute(rows)
    assert [r[1] for r in want if r[0] == 7] == [1, 2]
    assert sorted(map(tuple, near_vectors(df).collect()), key=str) == want
    assert sorted(map(tuple, near_vectors(df, limit=200).collect()), key=str) == want


def test_vectors_of_one_direction_are_split_by_hash(spark):
    v = np.random.default_rng(6).normal(size=8)
    units = unit(np.array([v * (1 + i / 7) for i in range(900)]))
    reps = spark.createDataFrame([(i, 1, x.tolist()) for i, x in enumerate(units)], "id long, n long, vec array<double>")
    stuck = reps.select(F.lit(0).cast("long").alias("shard"), "id", "n", "vec", F.lit(True).alias("home"))
    dealt = flat_graph._dealt_by_hash(stuck, 2, 200, 400)
    assert dealt.groupBy("shard").count().agg(F.max("count")).first()[0] <= 400
    assert dealt.where("home").count() == dealt.select("id").distinct().count() == 900


def test_probes_are_found_but_count_for_nobody_and_join_nothing(spark):
    rng = np.random.default_rng(7)
    units = unit(rng.normal(size=(500, 24)))
    reps = spark.createDataFrame([(i, 1, v.tolist()) for i, v in enumerate(units)], "id long, n long, vec array<double>")
    probes = flat_graph.probes_of(reps, 0.95)
    points = {r.id: np.array(r.vec) for r in probes.collect()}
    cosines = np.array([points[-1 - i] @ v for i, v in enumerate(units)])
    assert len(points) == 500 and (0.95 < cosines).all() and (cosines < 1).all() and cosines.std() > 0.01
    linked = _linked(reps.union(probes), 0.95, 2, 200)
    links = {r.id: r.n for r in linked.groupBy("id").agg(F.sum("links").alias("n")).collect()}
    assert sum(links.get(-1 - i, 0) == 1 for i in range(500)) >= 450 and not any(links.get(i, 0) for i in range(500))
    assert linked.where("id <> root").isEmpty()
