import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm.suffix_levels import SuffixLevels, cut_repeats, digest, suffix_keys, without_repeats


def brute(texts, length):
    data = [(t or "").encode() for t in texts]
    seen = Counter(d[i : i + length] for d in data for i in range(len(d) - length + 1))
    out = []
    for d in data:
        gone = bytearray(len(d))
        for i in range(len(d) - length + 1):
            if seen[d[i : i + length]] > 1:
                gone[i : i + length] = b"\1" * length
        kept = bytes(x for x, g in zip(d, gone, strict=True) if not g)
        runs = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        out.append((len(d), sum(gone), runs, hashlib.sha256(kept).hexdigest()))
    return out


def corpus(length):
    rng = random.Random(5)
    word = lambda: "".join(rng.choices("abcdé", k=rng.randrange(2, 7)))
    prose = lambda n: " ".join(word() for _ in range(n))
    shared, short = prose(length // 2), prose(length)[: length // 2 + 5]
    texts = [None, "", "a", "a" * (length - 1), "a" * length, "b" * (length + 1), "ab" * (2 * length), prose(300)]
    texts += [prose(rng.randrange(60)) + shared + prose(rng.randrange(60)) for _ in range(6)]
    texts += [prose(80) + short + prose(80) for _ in range(8)]
    base = prose(200)
    for _ in range(6):
        at = rng.randrange(len(base))
        texts.append(base[:at] + "#" + base[at + rng.randrange(1, 4) :])
    return [*texts, base, base, shared[: length // 2] + shared]


@pytest.mark.parametrize("heavy", [10_000, 1])
def test_equals_brute_force(spark, heavy):
    length = 60
    texts = corpus(length)
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, kept string")
    got = digest(cut_repeats(docs.repartition(3), length=length, anchor=30, heavy=heavy)).orderBy("doc_id").collect()
    assert [tuple(r)[1:] for r in got] == brute(texts, length)


def test_production_length_and_pipeline_form(spark):
    rng = random.Random(1)
    text = "".join(rng.choices("abc dé", k=3000))
    short = text[100:499].encode()[:398].decode("utf-8", "ignore")  # shared, but under 400 bytes
    texts = [text, text[500:1300] + "é" * 300, "é" + short, None, short]
    docs = spark.createDataFrame([(i, t, i) for i, t in enumerate(texts)], "null long, text string, row long")
    want = brute(texts, 400)
    got = digest(cut_repeats(docs), "row").orderBy("row").collect()
    assert [tuple(r)[1:] for r in got] == want
    plain = {r.row: r for r in without_repeats(docs).collect()}
    assert without_repeats(docs).columns == docs.columns
    assert plain[3].text is None and plain[2].text == texts[2] and plain[4].text == texts[4]
    lost = want[0][0] - want[0][1] - len(plain[0].text.encode())
    assert 0 <= lost <= 2 * want[0][2]  # the rest of a character that was cut


@pytest.mark.parametrize("heavy_windows", [1 << 20, 50])
def test_periodic_texts_of_different_lengths(spark, heavy_windows):
    length = 60
    texts = ["same line\n" * n for n in range(1, 40)] + ["a" * n for n in range(50, 90)] + ["b" * 5000]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    cut = cut_repeats(docs, length=length, anchor=30, heavy_windows=heavy_windows)
    assert [tuple(r)[1:] for r in digest(cut).orderBy("doc_id").collect()] == brute(texts, length)


def test_empty_table_and_null_ids(spark):
    docs = spark.createDataFrame([(None, "x" * 500), (None, "y")], "doc_id long, text string")
    assert sorted(tuple(r)[1:4] for r in digest(cut_repeats(docs)).collect()) == [(1, 0, 0), (500, 500, 1)]
    assert digest(cut_repeats(docs.where(F.lit(False)))).count() == 0


def test_levels_are_geometric_and_find_every_pair():
    rng = np.random.default_rng(0)
    index, found, seen = SuffixLevels(), Counter(), []
    for _ in range(40):
        keys = rng.integers(0, 3000, 100).astype(">u8").view("S8")
        numbers = np.arange(len(seen), len(seen) + 100)
        seen += keys.tolist()
        found.update(index.add(keys, numbers).tolist())
        sizes = [len(x[0]) for x in index.levels]
        assert all(a >= 2 * b for a, b in zip(sizes, sizes[1:], strict=False))
    counts = Counter(seen)
    assert found == Counter({i: 1 for i, key in enumerate(seen) if counts[key] > 1})


def test_keys_tell_windows_apart():
    data = bytes(range(256)) * 2
    keys = suffix_keys(data, 400)
    assert len(set(keys.tolist())) == len(keys)


def test_short_repeats_counted_beside_the_cut(spark):
    rng = random.Random(7)
    prose = lambda n: " ".join("".join(rng.choices("abcdé", k=rng.randrange(2, 7))) for _ in range(n))
    passage = prose(60)[:300]  # some fifty words, under 400 bytes
    texts = [prose(100) + passage + prose(100), prose(80) + passage + prose(90), prose(200), None, passage + passage]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = digest(cut_repeats(docs, short=256)).orderBy("doc_id").collect()
    assert [tuple(r)[1:5] for r in got] == brute(texts, 400)
    assert [r.n_short for r in got] == [x[1] for x in brute(texts, 256)]
    assert got[0].n_removed == 0 and got[0].n_short >= 256 and got[2].n_short == 0
