import random
import zlib
from collections import Counter, defaultdict
from itertools import combinations

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidemark.llm.packing_slack import fill, pack, packed, packing_digest, places

PATH = public_tokenizers.path("word_bpe_49k.json")


def test_fill_is_the_best_subset():
    rng = random.Random(4)
    for _ in range(200):
        lengths = [rng.randrange(1, 30) for _ in range(rng.randrange(0, 9))]
        capacity = rng.randrange(0, 60)
        best = max(sum(c) for n in range(len(lengths) + 1) for c in combinations(lengths, n) if sum(c) <= capacity)
        got = fill(Counter(lengths), capacity)
        assert sum(k * n for k, n in got.items()) == best and not got - Counter(lengths)


def test_pack_places_each_once():
    rng = random.Random(5)
    lengths = [rng.randrange(1, 4096) for _ in range(1500)]
    bins = pack(lengths)
    assert sorted(i for b in bins for i in b) == list(range(1500))
    sums = [sum(lengths[i] for i in b) for b in bins]
    assert max(sums) <= 4096 and len(bins) <= 1.02 * sum(lengths) / 4096 + 1


@pytest.mark.parametrize("group", [4096, 40])
def test_pieces_and_sequences(spark, sf_dir, group):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", F.lit(1).alias("piece"))
    more = [(-1, None, 1), (-2, "", 1), (None, "no id", 1), (-3, "long " * 9000, 1), (-3, "long " * 9000, 1), (-4, "w " * 4095, 1)]
    docs = docs.union(spark.createDataFrame(more, docs.schema))
    tokenizer = Tokenizer.from_file(PATH)
    want = defaultdict(list)
    for r in docs.collect():
        want[r.doc_id].append([*tokenizer.encode(r.text or "", add_special_tokens=False).ids, 2])
    rows = packed(docs, PATH, group=group).collect()
    of, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        ids = np.frombuffer(r.ids, "<u4").tolist()
        assert len(ids) == r.length
        of[r.doc_id].append((r.start, r.doc_tokens, ids))
        sequences[r.sequence_id].append((r.offset, r.length))
    for key, texts in want.items():
        got = sorted(of.pop(key))
        assert sum((g[2] for g in got), []) == sum((t for t in texts), []) or len(texts) > 1
        assert Counter(x for g in got for x in g[2]) == Counter(x for t in texts for x in t)
        assert {g[1] for g in got} == {len(t) for t in texts}
    assert not of
    used = 0
    for pieces in sequences.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= 4096
        used += at
    assert used >= 0.97 * 4096 * (len(sequences) - 1)


def test_digest_and_empty_table(spark):
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    (row,) = packing_digest(docs, PATH).collect()
    ids = [*Tokenizer.from_file(PATH).encode("a b", add_special_tokens=False).ids, 2]
    assert row.ids_crc32 == zlib.crc32(np.array(ids, "<u4").tobytes()) and row.offset == 0 and row.length == len(ids)
    assert packing_digest(docs.where(F.lit(False)), PATH).count() == 0


def test_places_ends_when_no_window_fills(spark):
    pieces = spark.createDataFrame([(i, 3000) for i in range(12)], "piece long, length long")
    rows = places(pieces, group=4).collect()
    assert sorted(r.piece for r in rows) == list(range(12))
    assert all(r.offset == 0 for r in rows) and len({r.sequence_id for r in rows}) == 12
