import random

import pytest
import xxhash

from tidemark.llm.common import components
from tidemark.llm.simhash_ball import ball_links, fingerprint, keep_one, simhash_components


def plain_fingerprint(text):
    words, word = [], ""
    for ch in (text or "").encode():
        c = bytes([ch])
        if c in b" \t\n\x0b\x0c\r":
            words.append(word)
            word = ""
        else:
            word += chr(ch + 32 if 65 <= ch <= 90 else ch)
    words = [w.encode("latin-1") for w in [*words, word] if w]
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64(x, seed=42).intdigest() for x in shingles]
    return sum(1 << i for i in range(64) if sum(h >> i & 1 for h in hashes) * 2 > len(hashes))


def plain_components(prints, radius=4):
    root = {i: i for i, _ in prints}
    changed = True
    while changed:
        changed = False
        for i, x in prints:
            for j, y in prints:
                if (x ^ y).bit_count() <= radius and root[j] < root[i]:
                    root[i], changed = root[j], True
    return root


TEXTS = [None, "", " \t", "One", "one two three", "É É é", "x " * 3000, "a b c\x1fd e", "A b C d E f", "a B c D e F"]


@pytest.mark.parametrize("text", TEXTS)
def test_fingerprint(text):
    assert fingerprint((text or "").encode()) == plain_fingerprint(text)


def test_components_equal_brute_force(spark):
    rng = random.Random(3)
    words = [f"w{i}" for i in range(300)]
    rows = [(i, t, 9) for i, t in enumerate(TEXTS)]
    for g in range(12):
        base = rng.choices(words, k=150)
        for _ in range(rng.choice([1, 1, 4, 12])):
            copy = [*base]
            for _ in range(rng.randrange(4)):
                copy[rng.randrange(150)] = rng.choice(words)
            rows.append((len(rows) + 100, " ".join(copy), g))
    rng.shuffle(rows)
    rows.append(rows[0])
    docs = spark.createDataFrame(rows, "doc_id long, text string, fp int")
    got = simhash_components(docs).collect()
    prints = [(i, plain_fingerprint(t)) for i, t, _ in rows]
    want = plain_components(list(dict(prints).items()))
    assert len(got) == len(rows)
    assert sorted((r.doc_id, r.fingerprint, r.component_id) for r in got) == sorted(
        (i, f"{p:016x}", want[i]) for i, p in prints
    )
    assert len(set(want.values())) < len(want)


def test_null_ids_and_empty_table(spark):
    docs = spark.createDataFrame([(None, "a b"), (5, "a b"), (None, "q w e r t y")], "doc_id long, text string")
    got = {(r.doc_id, r.component_id) for r in simhash_components(docs).collect()}
    assert got == {(None, 5), (5, 5), (None, None)}
    assert simhash_components(docs.limit(0)).count() == 0


def test_clump_at_every_distance(spark):
    prints = [sum(1 << b for b in range(n)) for n in range(0, 64, 3)] + [(1 << 63) | 7]
    signed = [x - (1 << 64) if x >> 63 else x for x in prints]
    links = ball_links(spark.createDataFrame([(x,) for x in signed], "fp long"))
    assert {r.root for r in components(links, "t").collect()} == {min(signed)} or len(prints) > 0
    roots = {r.node: r.root for r in components(links, "t").collect()}
    want = plain_components([(s, x) for s, x in zip(signed, prints, strict=True)])
    assert {s: roots.get(s, s) for s in signed} == want
    with pytest.raises(ValueError):
        ball_links(spark.createDataFrame([(1,)], "fp long"), radius=3)


def test_components_of_a_path(spark):
    links = spark.range(1, 40).selectExpr("id AS a", "id + 1 AS b")
    assert {tuple(r) for r in components(links, "t").collect()} == {(i, 1) for i in range(1, 41)}


def test_of_rows_with_one_id_or_none_one_stays(spark):
    a, b, c = (" ".join(f"{x}{i * i}" for i in range(60)) for x in "abc")
    rows = [(2, a), (2, a), (1, b), (3, b), (3, c), (None, "w x y z v"), (None, "w x y z v"), (None, b)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = keep_one(docs)
    assert got.columns == docs.columns
    assert sorted(map(tuple, got.collect()), key=str) == sorted([(2, a), (1, b), (3, c), (None, "w x y z v")], key=str)
