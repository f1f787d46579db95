import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import quality_pu, toxicity_pu
from tidemark.llm.common import table
from tidemark.llm.pu_learning import Rows, class_prior, logistic, train
from tidemark.llm.pu_text import fit, fold
from tidemark.llm.text_features import SIZE

SMALL = "/root/testdata/sf0.001"
MIDDLE = "/root/testdata/sf0.1"


def rows(lists):
    return Rows.of([np.array(x, np.int32).tobytes() for x in lists])


def test_sums_and_spread_are_transposes():
    a = rows([[0, 2], [], [1, 2, 3]])
    w = np.array([1.0, 2, 4, 8])
    assert a.sums(w).tolist() == [5, 0, 14]
    assert a.spread(np.array([1.0, 10, 100]), 4).tolist() == [1, 100, 101, 100]
    kept = a.kept(np.array([True, False, True, True]))
    assert kept.sums(np.array([1.0, 4, 8])).tolist() == [5, 0, 12]


def test_learns_without_negatives():
    rng = np.random.default_rng(1)
    noise = lambda: rng.choice(np.arange(5, 60), 8, replace=False).tolist()
    pos = [[0, *noise()] for _ in range(200)]
    unl = [([0] if i % 5 == 0 else [1]) + noise() for i in range(1000)]
    w, b = train(rows(pos), rows(unl), 0.2, 64)
    score = logistic(rows(unl).sums(w) + b)
    assert ((score > 0.7) == (np.arange(1000) % 5 == 0)).mean() > 0.98
    assert abs(score.mean() - 0.2) < 0.05


def test_without_positives_the_score_is_the_prior():
    w, b = train(rows([]), rows([[1], [2]]), 0.25, 8)
    assert not w.any() and logistic(np.array([b]))[0] == pytest.approx(0.25)


def test_fold_is_the_crc_of_the_id_as_text(spark):
    got = spark.range(-5, 200).select("id", fold("id", 3).alias("f"), fold("id", 5).alias("g")).collect()
    assert all((r.f, r.g) == (zlib.crc32(str(r.id).encode()) % 3, zlib.crc32(str(r.id).encode()) % 5) for r in got)


@pytest.mark.parametrize(
    ("make", "label", "modulus", "held", "least"),
    [(toxicity_pu.toxicity, "toxic", 3, 1, 0.95), (quality_pu.quality, "quality", 5, 0, 0.94)],
)
def test_held_out_accuracy(spark, make, label, modulus, held, least):
    docs, labels = table(spark, MIDDLE, "documents"), table(spark, MIDDLE, "labels")
    got = make(docs, labels).join(labels, "doc_id").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % modulus == held) for r in got)
    test = [r for r in got if r.held_out]
    assert all(0 <= r.score <= 1 for r in got) and len(test) > 500
    assert np.mean([r.predicted == r[label] for r in test]) > least


@pytest.mark.parametrize("make", [toxicity_pu.toxicity, quality_pu.quality])
def test_edges(spark, make):
    docs = spark.createDataFrame(
        [(1, None, "x"), (2, "", "x"), (None, "a b", "y"), (2, "", "x"), (4, "idiot " * 50_000, None)],
        "doc_id long, text string, doc string",
    )
    labels = spark.createDataFrame([(1, None, 1), (None, 1, 1), (9, 7, None)], "doc_id long, toxic int, quality int")
    got = make(docs, labels).collect()
    assert sorted((r.doc_id or 0) for r in got) == [0, 1, 2, 2, 4]
    assert all(0 <= r.score <= 1 and r.predicted in (0, 1) for r in got)
    assert make(docs.where(F.lit(False)), labels.where(F.lit(False))).count() == 0


def test_labels_of_held_out_rows_change_nothing(spark):
    docs = spark.range(300).select(
        F.col("id").alias("doc_id"), F.expr("concat('w', id % 7, ' ', if(id % 4 = 0, 'bad', 'good'))").alias("text")
    )
    labels = docs.selectExpr("doc_id", "int(doc_id % 4 = 0) AS toxic")
    other = labels.withColumn("toxic", F.when(toxicity_pu.held_out("doc_id"), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    a, b = (sorted(map(tuple, toxicity_pu.toxicity(docs, x).collect())) for x in (labels, other))
    assert a == b
    kept = toxicity_pu.without_toxic(docs, labels)
    assert kept.columns == docs.columns and kept.where("doc_id % 4 = 0").count() == 0 and kept.count() == 225


def test_each_row_is_judged_by_its_own_text(spark):
    rows = [(i, "bad" if i % 4 == 0 else "good", i, 0) for i in range(300)] + [(8, "good", -1, 1), (None, "bad", -2, 1), (None, "good", -3, 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score long, c1 int")
    labels = docs.where("c1 = 0").selectExpr("doc_id", "int(doc_id % 4 = 0) AS toxic")
    kept = toxicity_pu.without_toxic(docs, labels)
    assert kept.columns == docs.columns
    assert {r.score for r in kept.collect()} == {i for i in range(300) if i % 4} | {-1, -3}


@pytest.mark.parametrize("share", [0.05, 0.3, 0.8])
def test_class_prior_is_found_without_negatives(share):
    rng = np.random.default_rng(4)

    def sample(count, positive):
        marks = np.where(rng.random(count) < positive, 0, 1)
        noisy = np.where(rng.random(count) < 0.1, 2, marks)  # a tenth of both kinds look alike
        return rows([[int(m), *rng.integers(5, 60, 6).tolist()] for m in noisy])

    assert abs(class_prior(sample(1500, 1.0), sample(6000, share), 64) - share) < 0.06


def test_class_prior_of_next_to_nothing():
    assert class_prior(rows([[1]]), rows([[1], [2]]), 8) == 0.5
    assert class_prior(rows([]), rows([]), 8) == 0.5


@pytest.mark.parametrize(
    ("module", "label", "most"),
    [(toxicity_pu, "toxic", 0.1), (quality_pu, "quality", 0.1)],
)
def test_estimated_prior_against_the_labels(spark, module, label, most):
    """Labels of 0 serve as the oracle here, and nowhere else."""
    docs, labels = table(spark, MIDDLE, "documents"), table(spark, MIDDLE, "labels")
    settings = {"decay": toxicity_pu.DECAY} if module is toxicity_pu else {"steps": quality_pu.STEPS}
    model = fit(docs, labels, label, module.features, module.held_out, **settings)
    share = labels.where(~module.held_out("doc_id")).agg(F.avg(label)).first()[0]
    assert abs(model.prior - share) < most


def test_labels_of_0_change_nothing(spark):
    docs = spark.range(300).select(
        F.col("id").alias("doc_id"), F.expr("concat('w', id % 7, ' ', if(id % 4 = 0, 'bad', 'good'))").alias("text")
    )
    labels = docs.selectExpr("doc_id", "int(doc_id % 4 = 0) AS quality")
    a, b = (
        sorted(map(tuple, quality_pu.quality(docs, x).collect())) for x in (labels, labels.where("quality = 1"))
    )
    assert a == b


def dense_model(pos, unl, prior, steps, rate=0.05, decay=1e-5, least_rows=3, least_z=4.0):
    """The same learning over 0/1 matrices, risk by risk as the formula says."""
    shares = pos.mean(0), unl.mean(0)
    count = pos.sum(0) + unl.sum(0)
    pooled = count / (len(pos) + len(unl))
    error = np.sqrt(pooled * (1 - pooled) * (1 / len(pos) + 1 / len(unl))) + 1e-12
    keep = (count >= least_rows) & (np.abs(shares[0] - shares[1]) >= least_z * error)
    x = [np.hstack([m[:, keep], np.ones((len(m), 1))]) for m in (pos, unl)]
    w = np.zeros(keep.sum() + 1)
    prior = min(max(prior, 1e-3), 1 - 1e-3)
    w[-1] = np.log(prior / (1 - prior))
    mean, square = np.zeros_like(w), np.zeros_like(w)
    penalty = np.append(np.full(keep.sum(), decay), 0)
    for step in range(1, steps + 1):
        f_pos, f_unl = x[0] @ w, x[1] @ w
        negative = np.logaddexp(0, f_unl).mean() - prior * np.logaddexp(0, f_pos).mean()
        up = (x[0] * -logistic(-f_pos)[:, None]).mean(0) * prior
        down = (x[1] * logistic(f_unl)[:, None]).mean(0) - prior * (x[0] * logistic(f_pos)[:, None]).mean(0)
        slope = (-down if negative < 0 else up + down) + penalty * w
        mean, square = 0.9 * mean + 0.1 * slope, 0.99 * square + 0.01 * slope**2
        w = w - rate * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.99**step)) + 1e-6)
    full = np.zeros(pos.shape[1])
    full[keep] = w[:-1]
    return full, w[-1]


@pytest.mark.parametrize(
    ("module", "label", "settings"),
    [(toxicity_pu, "toxic", {"decay": toxicity_pu.DECAY}), (quality_pu, "quality", {"steps": quality_pu.STEPS})],
)
def test_scores_against_dense_matrices(spark, module, label, settings):
    docs, labels = table(spark, SMALL, "documents"), table(spark, SMALL, "labels")
    make = toxicity_pu.toxicity if module is toxicity_pu else quality_pu.quality
    got = {r.doc_id: r.score for r in make(docs, labels).collect()}
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    positive = {r.doc_id for r in labels.collect() if r[label] == 1}
    modulus, held = (3, 1) if module is toxicity_pu else (5, 0)
    learned = [i for i in texts if zlib.crc32(str(i).encode()) % modulus != held]
    of_text = module.features()
    found = {i: of_text(t) for i, t in texts.items()}
    used = np.unique(np.concatenate([f for f in found.values() if len(f)]))
    assert used[-1] < SIZE

    def matrix(ids):
        out = np.zeros((len(ids), len(used)))
        for i, key in enumerate(ids):
            out[i, np.searchsorted(used, found[key])] = 1
        return out

    prior = fit(docs, labels, label, module.features, module.held_out, **settings).prior
    assert prior > 0
    weights, bias = dense_model(
        matrix([i for i in learned if i in positive]), matrix(learned), prior, settings.get("steps", 300), decay=settings.get("decay", 1e-5)
    )
    ids = sorted(texts)
    want = logistic(matrix(ids) @ weights + bias)
    assert np.abs(want - np.array([got[i] for i in ids])).max() < 1e-3
