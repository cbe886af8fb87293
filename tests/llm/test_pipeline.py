"""The pipeline's stages, each against a plain version of its rule on the same input."""

from __future__ import annotations

import hashlib
from collections import Counter, defaultdict

import public_tokenizers
import tokenizers

import corpus_pipeline
from sluice.llm import quality

from .test_dedup import plain_lines
from .test_tables import plain_simhash, union_find, waterfill
from .test_texts import plain_quality

SF = "/root/testdata/sf0.001"


def test_stages(spark, folder):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    docs = docs.union(spark.createDataFrame([
        (9001, None, None, None, None), (9002, "", "en", "src0", 0), (9003, "x " * 9, "en", "src1", 18)], docs.schema))
    columns = docs.columns
    kept = [docs]
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, kept[-1], SF).write.parquet(f"{folder}/{k}")
        kept.append(spark.read.parquet(f"{folder}/{k}"))
    assert all(d.columns == columns for d in kept[:-1])
    rows = [[(r.doc_id, r.text, r.source) for r in d.collect()] for d in kept[:-1]]

    judge = quality._Judge(quality.Rules())
    assert Counter(rows[1]) == Counter(r for r in rows[0] if not plain_quality(r[1])[5] and judge.bands(r[1].encode())[2])
    assert 0 < len(rows[1]) < len(rows[0])

    cut = plain_lines([r[:2] for r in rows[1]], 3)
    assert Counter(rows[2]) == Counter((i, cut[i, t][0], s) for i, t, s in rows[1])
    assert rows[2] != rows[1] and all(r.n_chars == len(r.text) for r in kept[2].collect())

    prints = {i: plain_simhash(t) for i, t, _ in rows[2]}
    found = sorted(set(prints.values()))
    root = union_find(found, [(a, b) for a in found for b in found if a < b and (a ^ b).bit_count() <= 2])
    first = defaultdict(lambda: 1 << 60)
    for i, p in prints.items():
        first[root[p]] = min(first[root[p]], i)
    assert Counter(rows[3]) == Counter(r for r in rows[2] if r[0] in set(first.values()))
    assert len(rows[3]) < len(rows[2])

    size = lambda t: len((t or "").encode().split())
    sizes, taken, largest = Counter(), Counter(), Counter()
    for _, t, s in rows[3]:
        sizes[s] += size(t)
        largest[s] = max(largest[s], size(t))
    for _, t, s in rows[4]:
        taken[s] += size(t)
    target = waterfill(sizes)
    assert all(abs(taken[s] - target[s]) <= largest[s] / 2 + 1 for s in sizes)
    assert set(rows[4]) <= set(rows[3]) and max(Counter(rows[4]).values()) <= 2

    library = tokenizers.Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    texts = {i: t for i, t, _ in rows[3]}
    last = kept[-1].collect()
    assert Counter(r.doc_id for r in last) == Counter(r[0] for r in rows[4])
    for r in last:
        assert r.ids == library.encode(texts[r.doc_id], add_special_tokens=False).ids
        assert r.n_tokens == len(r.ids) and r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()


def test_run_agrees_with_itself(spark):
    first, second = (Counter(map(repr, corpus_pipeline.run(spark, SF).drop("ids").collect())) for _ in range(2))
    assert first == second and first


def test_empty_input(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF)
        assert out.count() == 0
        docs = out if out.columns == docs.columns else docs
