import math
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm.lattice_lm import MARK, Lattices, Vocabulary, expected, forward, lattice_scores, likelihoods, marked
from tidemark.llm.queries import public_vocabulary

SMALL = Vocabulary([MARK, "a", "b", "ab", MARK + "a", "ba", "aba", MARK + "ab"], [-1, -2, -3, -4, -5, -6, -7, -8])


def cuts(text, v):
    if not text:
        yield ()
    for n in range(1, len(text) + 1):
        if text[:n] in v.number:
            yield from ((v.number[text[:n]], *rest) for rest in cuts(text[n:], v))
    if text and text[0] not in v.number:
        yield from ((*[v.bytes + b for b in text[0].replace("￿", MARK).encode()], *rest) for rest in cuts(text[1:], v))


@pytest.mark.parametrize("word", ["a", "ab", "abab", "abaabab", "xé", "a日b", "aba▁ab"])
def test_forward_and_expected_equal_enumeration(word):
    weight = np.log(SMALL.first).tolist()
    ways = [(math.exp(sum(weight[i] for i in way)), way) for way in cuts(MARK + word.replace(MARK, "￿"), SMALL)]
    total = sum(p for p, _ in ways)
    text = marked(word.encode())
    assert forward(text, SMALL, weight)[-1] == pytest.approx(math.log(total))
    assert likelihoods([b"b", word.encode(), b""], SMALL, np.log(SMALL.first))[1] == pytest.approx(math.log(total))
    want = Counter()
    for p, way in ways:
        for i in way:
            want[i] += p / total
    got = Counter()
    for i, part in expected(text, SMALL, weight):
        got[i] += part
    assert got.keys() == want.keys() and all(got[i] == pytest.approx(want[i]) for i in want)
    sums = np.zeros(len(weight))
    assert not len(Lattices([marked(b"ab"), text], SMALL).expect(SMALL.first, np.array([0.0, 3.0]), sums))
    assert all(sums[i] == pytest.approx(3 * want[i]) for i in range(len(sums)))


def test_a_word_of_a_million_bytes_and_faint_words():
    v = public_vocabulary()
    weights = np.log(v.first)
    faint = "\U0002a6d6" * 20
    words = [b"x" * 1_000_000, faint.encode(), "é".encode() * 12, b"\xff\xfe", b""]
    got = likelihoods(words, v, weights)
    assert all(g == pytest.approx(forward(marked(w), v, weights.tolist())[-1]) for g, w in zip(got, words, strict=True))
    sums = np.zeros(len(weights))
    assert Lattices([marked(faint.encode())], v).expect(v.first, np.ones(1), sums).tolist() == [0] and not sums.any()


def test_public_vocabulary_is_a_distribution():
    v = public_vocabulary()
    assert v.first.sum() == pytest.approx(1) and len(v.first) == len(v.number) + 257
    long_word = "abc" * 20_000
    assert forward(marked(long_word.encode()), v, np.log(v.first).tolist())[-1] < -1000


@pytest.mark.parametrize("frequent", [1, 100_000])
def test_tables_equal_brute_force(spark, sf_dir, frequent):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", F.lit("w").alias("word"))
    more = [(-1, None, ""), (-2, "", ""), (-3, "A\x1fb\xa0C d\x0bE", ""), (-4, "again", ""), (-4, "again", "")]
    docs = docs.union(spark.createDataFrame(more, docs.schema))
    rows = [(r.doc_id, (r.text or "").encode().lower().split()) for r in docs.collect()]
    test = lambda i: zlib.crc32(str(i).encode()) % 10 == 0
    counts = Counter(w for i, words in rows if not test(i) for w in words)
    ends = sum(not test(i) for i, _ in rows)
    total, distinct = sum(counts.values()) + ends, len(counts) + 1
    got = sorted(lattice_scores(docs, public_vocabulary, frequent=frequent).collect(), key=lambda r: (r.doc_id, r.n_tokens))
    assert len(got) == len(rows)
    for (i, words), r in zip(sorted(rows, key=lambda r: (r[0], len(r[1]))), got, strict=True):
        c = [counts[w] for w in words] + [ends]
        base = sum(math.log10((x + 0.1) / (total + 0.1 * (distinct + 1))) for x in c)
        assert (r.doc_id, r.held_out, r.n_tokens, r.n_known) == (i, test(i), len(c), sum(x > 0 for x in c))
        assert r.train_tokens == total and r.base_score == pytest.approx(base)
    untrained = {r.doc_id: r.score for r in lattice_scores(docs, public_vocabulary, rounds=0).collect()}
    held = [r for r in got if r.held_out and r.n_tokens > 50]
    assert len(held) > 10 and all(r.score > untrained[r.doc_id] for r in held)
    assert all(r.score < 0 for r in got)


def test_null_ids_and_empty_table(spark):
    docs = spark.createDataFrame([(None, "ab ab"), (None, None)], "doc_id long, text string")
    vocabulary = SMALL

    def small():
        return vocabulary

    got = sorted(tuple(r)[1:5] for r in lattice_scores(docs, small).collect())
    assert got == [(False, 1, 1, 4), (False, 3, 3, 4)]
    assert lattice_scores(docs.where(F.lit(False)), small).count() == 0
