import random
import re
import sys
from collections import Counter, defaultdict
from pathlib import Path

import public_tokenizers
from tokenizers import Tokenizer

sys.path.insert(0, str(Path(__file__).resolve().parent))

import corpus_pipeline
from test_simhash_ball import plain_components, plain_fingerprint
from tidemark.llm.common import table
from tidemark.llm.toxicity_pu import toxicity


def cut_everywhere(texts, length=corpus_pipeline.REPEAT_BYTES):
    data = [(t or "").encode() for t in texts]
    seen = Counter(d[i : i + length] for d in data for i in range(len(d) - length + 1))
    out = []
    for d in data:
        gone = bytearray(len(d))
        for i in range(len(d) - length + 1):
            if seen[d[i : i + length]] > 1:
                gone[i : i + length] = b"\1" * length
        out.append(bytes(x for x, g in zip(d, gone, strict=True) if not g).decode("utf-8", "ignore"))
    return out


def shingles(text):
    w = re.findall(r"[^\W_]+", (text or "").lower())
    return {" ".join(w[i : i + 5]) for i in range(len(w) - 4)}


def test_each_stage_equals_brute_force(spark, sf_dir, tmp_path):
    docs = table(spark, sf_dir, "documents")
    columns, rejected = docs.columns, {r.doc_id for r in toxicity(docs, table(spark, sf_dir, "labels")).where("predicted = 1").collect()}
    state = {r.doc_id: r for r in docs.collect()}
    items = [shingles(r.text) for r in table(spark, sf_dir, "benchmark").collect()]
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, sf_dir)
        out.write.parquet(str(tmp_path / str(k)))
        docs = spark.read.parquet(str(tmp_path / str(k)))
        before = {i: r.text for i, r in state.items()}
        if k == 4:
            break
        assert docs.columns == columns
        state = {r.doc_id: r for r in docs.collect()}
        now = {i: r.text for i, r in state.items()}
        if name == "toxicity":
            want = {i: t for i, t in before.items() if i not in rejected}
        elif name == "simhash near-dedup":
            root = plain_components([(i, plain_fingerprint(t)) for i, t in before.items()])
            want = {i: t for i, t in before.items() if root[i] == i}
        elif name == "suffix-array dedup":
            want = dict(zip(before, cut_everywhere(list(before.values())), strict=True))
            assert all(r.n_chars == len(r.text) for r in state.values())
        else:
            want = {i: t for i, t in before.items() if not any(x and len(x & shingles(t)) / len(x) >= 0.8 for x in items)}
        assert now == want
        assert k == 2 or len(now) < len(before)
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    pieces = defaultdict(list)
    for r in docs.collect():
        pieces[r.doc_id].append((r.start, r.length, r.doc_tokens))
    assert pieces.keys() == before.keys()
    for i, parts in pieces.items():
        total = len(tokenizer.encode(before[i] or "", add_special_tokens=False).ids) + 1
        assert sum(p[1] for p in parts) == total == parts[0][2]


def test_run_gives_pieces(spark, sf_dir):
    assert corpus_pipeline.run(spark, sf_dir).count() > 0


def test_repeated_passages_of_just_over_50_words_go(spark, sf_dir):
    words = [w for r in table(spark, sf_dir, "documents").orderBy("doc_id").limit(40).collect() for w in (r.text or "").split()]
    rng = random.Random(9)
    passages = [" ".join(rng.choices([w for w in words if 2 < len(w) < 12], k=n)) for n in range(51, 66)]
    prose = lambda: " ".join(rng.choices(words, k=120))
    texts = [f"{prose()} {p} {prose()}" for p in passages for _ in range(2)] + [prose() for _ in range(20)]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in enumerate(texts)], table(spark, sf_dir, "documents").schema)
    got = {r.doc_id: r.text for r in corpus_pipeline.repeated_strings(spark, docs, sf_dir).collect()}
    for i, text in enumerate(texts[:30]):
        assert passages[i // 2] not in got[i] and len(text) - len(got[i]) >= len(passages[i // 2])
    assert [got[i] for i in range(30, 50)] == texts[30:]
