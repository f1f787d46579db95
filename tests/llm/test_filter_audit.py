import random
import re
from collections import Counter
from itertools import permutations

import pytest
from pyspark.sql import functions as F

from tidemark.llm.filter_audit import Trie, audit, failed, masks, with_prefixes


def plain_mask(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    fails = [
        len(words) < 100,
        100 * len(set(words)) < 80 * len(words),
        100 * len(re.findall("[A-Z]", text)) > 10 * len(text),
        bool(re.search("[#$%&*|]", text)),
    ]
    return sum(f << k for k, f in enumerate(fails))


def documents():
    rng = random.Random(2)
    word = lambda: "".join(rng.choices("abcdeÉß\u2003\x1c", k=rng.randrange(1, 6)))
    long = " ".join(word() for _ in range(30_000))
    texts = [None, "", " \t\n", "a", "A", "#", "A" * 10 + "b" * 90, "A" * 11 + "b" * 89, long, long + "x", long, "x" * 100_000]
    texts += [" ".join(f"w{i % n}" for i in range(k)) for n, k in ((100, 100), (80, 100), (79, 100), (99, 99), (1, 300))]
    texts += [" ".join(word() for _ in range(rng.randrange(250))) + rng.choice(["", "|"]) for _ in range(80)]
    texts += [rng.choice(texts) for _ in range(150)] + ["copy " * 120] * 200
    rng.shuffle(texts)
    return [(i, t, rng.choice(["en", "de", None, ""]), "x", i) for i, t in enumerate(texts)]


SCHEMA = "doc_id long, text string, lang string, mask string, row long"


def plain(rows, labels):
    least = {}
    for i, text, *_ in rows:
        least[text or ""] = min(least.get(text or "", i), i)
    known = {}
    for i, quality, toxic in labels:
        q, t = known.get(i, (False, False))
        known[i] = (q or quality == 1, t or toxic == 1)
    docs = [(lang or "", plain_mask(t) | (least[t or ""] != i) << 4, *known.get(i, (False, False))) for i, t, lang, *_ in rows]
    out = {}
    for part in {d[0] for d in docs}:
        mine, shapley = [d for d in docs if d[0] == part], Counter()
        for order in permutations("ABCDE"):
            alive = mine
            for step, name in enumerate(order, 1):
                bit = 1 << "ABCDE".index(name)
                gone = [d for d in alive if d[1] & bit]
                alive = [d for d in alive if not d[1] & bit]
                fails = sum(1 for d in mine if d[1] & bit)
                shapley[name] += len(gone)
                out[part, "".join(order), step] = [
                    len(alive),
                    len(gone),
                    fails - len(gone),
                    sum(1 for d in mine if d[1] == bit),
                    sum(d[2] for d in gone),
                    sum(d[3] for d in gone),
                ]
        for (p, order, step), row in out.items():
            if p == part:
                row.append(shapley[order[step - 1]])
    return {(*k, *v) for k, v in out.items()}


@pytest.mark.parametrize("bounds", [{}, {"prefix_bytes": 300, "range_bytes": 20_000}])
def test_equals_brute_force(spark, bounds):
    rows = documents()
    labels = [(i, i % 2, i % 3 % 2) for i in range(0, 300)] + [(1, 0, 0), (2, None, 1), (None, 1, 1)]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(4)
    got = audit(docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), **bounds).collect()
    assert len(got) == 3 * 120 * 5
    assert {tuple(r) for r in got} == plain(rows, labels)


def test_masks_of_bytes():
    for _, text, *_ in documents():
        assert failed((text or "").encode()) == plain_mask(text)


def test_ids_null_or_repeated_and_empty_tables(spark):
    rows = [(None, "t"), (2, "t"), (2, "t"), (None, "u"), (None, "u"), (5, None), (4, "")]
    docs = spark.createDataFrame([(*r, None) for r in rows], "doc_id long, text string, lang string").coalesce(1)
    for table in (docs, docs.repartition(5)):
        got = Counter((r.id, bool(r.mask & 16)) for r in masks(table, "doc_id", "text", "lang").collect())
        assert got == Counter({(None, True): 1, (2, False): 2, (None, False): 2, (5, True): 1, (4, False): 1})
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert audit(docs, labels).count() == 600
    assert audit(docs.where(F.lit(False)), labels).count() == 0


def test_prefixes_are_light_or_whole_texts(spark):
    texts = [(i, i, ("same start " * 20 + str(i % 50)).encode()) for i in range(200)] + [(200 + i, i, b"same") for i in range(50)]
    got = with_prefixes(spark.createDataFrame(texts, "row long, id long, text binary"), 900).collect()
    held, whole = Counter(), {}
    for r in got:
        prefix, text = bytes(r.prefix), bytes(r.text)
        assert text.startswith(prefix)
        held[prefix] += len(text)
        whole[prefix] = whole.get(prefix, True) and text == prefix
    assert len(got) == 250 and all(n <= 900 or whole[p] for p, n in held.items())


def test_trie_holds_what_was_put_in():
    rng = random.Random(4)
    texts = [bytes(rng.choices(b"ab", k=rng.randrange(8))) for _ in range(500)]
    trie, least = Trie(), {}
    for i, text in enumerate(reversed(texts)):
        trie.insert(text, i, 499 - i)
    for i, text in enumerate(texts):
        least.setdefault(text, i)
    flags = dict(trie.flags())
    assert flags == {499 - i: least[text] != i for i, text in enumerate(texts)}
