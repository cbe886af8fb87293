"""Limits of the compression bands that are learnt from labelled texts, against a plain version and held-out labels."""

from __future__ import annotations

import math
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from sluice.llm import quality

from .test_texts import plain_quality


def tables(spark, sf):
    return (spark.read.parquet(f"/root/testdata/sf{sf}/{t}.parquet") for t in ("documents", "labels"))


def fold(i):
    return zlib.crc32(str(i).encode()) % 4


def plain_learnt(rows, learning):
    """Limits by (whole, class) and the margin, from (id, text) of good texts."""
    judge = quality._Judge(quality.Rules())

    def top(size, tops):
        return next(t for t in tops if t is None or size <= t)

    def parts(text):
        data = text.encode()
        yield True, top(len(data), quality.WHOLE_TOPS), judge.ratio(data)
        for c in judge.chunks(data):
            yield False, top(len(c), quality.CHUNK_TOPS), judge.ratio(c)

    used = [(i, list(parts(t))) for i, t in rows if t and not plain_quality(t)[5] and quality._Judge(quality.WIDE).bands(t.encode())[2]]
    ratios, filled = defaultdict(list), defaultdict(set)
    for i, found in used:
        if fold(i) in (0, 1):
            for whole, t, r in found:
                ratios[whole, t].append(r)
                filled[whole, t].add(i)
    lows = {k: float(np.quantile(v, learning.tail)) for k, v in ratios.items() if len(filled[k]) >= learning.least_texts}
    needs = []
    for i, found in used:
        if fold(i) == 3:
            short = [(whole, lows.get((whole, t), -9.0) - r) for whole, t, r in found]
            chunks = sorted((s for whole, s in short if not whole), reverse=True)
            allowed = math.floor(len(chunks) * 0.2)
            needs.append(max(0.0, short[0][1], chunks[allowed] if chunks else 0.0))
    margin = float(np.quantile(needs, 1 - learning.max_lost)) if needs else 0.0
    return lows, margin


@pytest.mark.parametrize("max_lost", [0.0, 0.05])
def test_equals_a_plain_version(spark, max_lost):
    docs, labels = tables(spark, "0.01")
    learning = quality.Learning(least_texts=5, max_lost=max_lost)
    good = {r.doc_id for r in labels.where("quality = 1").collect()}
    rows = [(r.doc_id, r.text) for r in docs.collect() if r.doc_id in good]
    lows, margin = plain_learnt(rows, learning)
    rules, base = quality.learnt(docs, labels, learning=learning), quality.Rules()
    assert len(lows) > 6 and margin > 0
    for whole, found, given in ((True, rules.whole_bands, base.whole_bands), (False, rules.chunk_bands, base.chunk_bands)):
        for (t, low, high), (_, old, old_high) in zip(found, given):
            assert high == old_high and low == pytest.approx(lows[whole, t] - margin if (whole, t) in lows else old, abs=0.0006)


def test_held_out_good_texts_stay_and_junk_goes(spark):
    """A fourth of the ids is read by nothing that sets a limit or the margin."""
    docs, labels = tables(spark, "0.1")
    rules = quality.learnt(docs, labels)
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2
    judged = quality.measure(docs.where(held), rules=rules).join(labels, "doc_id").where("not base_failed")
    found = {r.quality: (r.n, r.gone) for r in judged.groupBy("quality").agg(
        F.count("*").alias("n"), F.sum((~F.col("kept")).cast("int")).alias("gone")).collect()}
    assert found[1][0] > 500 and found[1][1] <= 0.002 * found[1][0]
    assert found[0][0] > 50 and found[0][1] >= 0.5 * found[0][0]
    # neither their labels nor their texts count
    other = labels.withColumn("quality", F.when(held, F.lit(1)).otherwise(F.col("quality")))
    assert quality.learnt(docs.withColumn("text", F.when(held, F.lit("x y " * 40)).otherwise(F.col("text"))), other) == rules


def test_odd_labels_and_tables(spark):
    """Nulls, repeated and contradicting labels, empty tables, other columns; what there is too little of stays as given."""
    docs, labels = tables(spark, "0.01")
    learning = quality.Learning(least_texts=5)
    rules = quality.learnt(docs, labels, learning=learning)
    assert rules != quality.Rules()
    assert quality.learnt(docs.limit(0), labels) == quality.learnt(docs, labels.limit(0)) == quality.Rules()
    assert quality.learnt(docs, labels.where("quality = 0")) == quality.Rules()
    null = labels.select(F.lit(None).cast("bigint").alias("doc_id"), F.lit(1).alias("quality"))
    again = labels.select("doc_id", "quality").union(labels.select("doc_id", "quality")).union(null)
    odd = docs.unionByName(docs.limit(1).withColumns({"doc_id": F.lit(None).cast(docs.schema["doc_id"].dataType), "text": F.lit("#" * 500)}))
    clash = odd.withColumn("__of", F.lit(1)).withColumn("__text", F.lit("clash")).withColumn("QUALITY", F.lit(0)).withColumn("ratios", F.lit(0))
    assert quality.learnt(clash, again, learning=learning) == rules
    # an id with any other label is no good one; neither is one whose label is null
    junk = docs.join(labels.where("quality = 0").select("doc_id"), "doc_id", "left_semi").select("doc_id")
    both = junk.withColumn("quality", F.lit(1)).union(junk.withColumn("quality", F.lit(None).cast("int")))
    assert quality.learnt(docs, labels.select("doc_id", "quality").union(both), learning=learning) == rules
    # nothing but the bound decides how many ids are read, and their order does not matter
    few = quality.Learning(least_texts=5, max_labelled=120)
    assert quality.learnt(docs, labels, learning=few) == quality.learnt(docs.repartition(5), labels.repartition(3), learning=few) != rules


def test_columns_named_like_the_inner_ones(spark):
    docs, labels = tables(spark, "0.01")
    clear = docs.join(labels.where("quality = 1"), "doc_id", "left_semi").where("n_chars between 500 and 3000").orderBy("doc_id").first()
    texts = [(1, clear.text, "own"), (2, None, "own"), (3, "x " * 400, "own")]
    df = spark.createDataFrame(texts, "doc_id int, text string, `__text` string")
    assert [tuple(r) for r in quality.accepted(df).collect()] == texts[:1]
    assert quality.measure(df, keep=["doc_id", "__text"]).columns[:2] == ["doc_id", "__text"]
    other = spark.createDataFrame([(1, texts[0][1])], "doc_id int, `__text` string")
    assert quality.accepted(other, text="__text").count() == 1
