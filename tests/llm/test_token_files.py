import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidemark.llm.token_files import documents_in, read_tokens, token_digest, write_tokens

PATH = public_tokenizers.path("byte_bpe_50k.json")


def test_round_trip(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").withColumn("part", F.lit("x"))
    extra = spark.createDataFrame([(7, "again"), (7, None), (None, "no id"), (10**12, "")], "doc_id long, text string")
    docs = docs.unionByName(extra, allowMissingColumns=True).repartition(5)
    tokenizer = Tokenizer.from_file(PATH)
    tokenizer.encode_special_tokens = True
    rows = sorted(
        ((r.doc_id, r.text) for r in docs.collect()), key=lambda r: (r[0] is not None, r[0], r[1] is not None, r[1])
    )
    want, start = [], 0
    for key, text in rows:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]
        want.append((key, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    got = [tuple(r) for r in token_digest(docs, PATH).collect()]
    assert sorted(got, key=lambda r: r[1]) == want


def test_files_are_flat_and_bases_are_prefix_sums(spark, tmp_path):
    docs = spark.range(100).select(F.col("id").alias("doc_id"), F.expr("repeat('word ', id)").alias("text"))
    corpus = write_tokens(docs, PATH, str(tmp_path / "c"), parts=4)
    assert len(corpus.files) > 1 and corpus.files[0][3] == 0
    for (_, _, ids, base), (_, _, _, after) in zip(corpus.files, corpus.files[1:], strict=False):
        assert base + ids == after
    keys = []
    for file, n, ids, base in corpus.files:
        assert np.fromfile(f"{file}.ids", "<u2").size == ids
        found = list(documents_in(file, 2, base))
        assert len(found) == n and found[0][1] == base and all(d[2][-1] == 0 for d in found)
        keys += [d[0] for d in found]
    assert keys == list(range(100)) and corpus.total == sum(f[2] for f in corpus.files)
    assert read_tokens(spark, corpus).count() == 100


def test_empty_table_and_narrow_width(spark, tmp_path):
    docs = spark.createDataFrame([(1, "hello")], "doc_id long, text string")
    assert token_digest(docs.where(F.lit(False)), PATH).count() == 0
    with pytest.raises(Exception, match="needs more than 1 bytes"):
        write_tokens(docs, PATH, str(tmp_path / "n"), width=1)


def test_files_are_found_by_their_uri(spark, tmp_path):
    docs = spark.createDataFrame([(1, "hello there")], "doc_id long, text string")
    corpus = write_tokens(docs, PATH, f"file://{tmp_path}/u")
    assert corpus.files[0][0].startswith("file://")
    assert read_tokens(spark, corpus).first().start == 0
