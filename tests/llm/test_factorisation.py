"""The factorisation machine: its identity, its vectors, its training, its held-out accuracy."""

from __future__ import annotations

import zlib
from itertools import combinations

import numpy as np
from pyspark.sql import functions as F

from sluice.llm import factorisation as fm
from sluice.llm import queries

SF = "/root/testdata/sf0.1"
SMALL = fm.Learning(hashed=32, factors=3, batch=8, epochs=3)


def some_rows(seed=1, learning=SMALL):
    rng = np.random.default_rng(seed)
    texts = [None, b"", b" \n", "é漢 a a b".encode(), b"x" * 9000] + [
        " ".join(f"w{k}" for k in rng.integers(0, 50, rng.integers(1, 40))).encode() for _ in range(40)]
    lengths = [None, 0.0, -3.0, 5.0, 1e12] + [float(x) for x in rng.integers(0, 500, 40)]
    return fm.Rows.of(texts, lengths, learning)


def test_identity_equals_the_sum_over_pairs():
    rng = np.random.default_rng(2)
    rows = some_rows()
    machine = fm.Machine(0.3, rng.normal(size=SMALL.size), rng.normal(size=(SMALL.size, SMALL.factors)))
    for i, odds in enumerate(machine.odds(rows)):
        part = slice(rows.ends[i], rows.ends[i + 1])
        x = dict(zip(rows.index[part].tolist(), rows.value[part]))
        pairs = sum(machine.factors[a] @ machine.factors[b] * x[a] * x[b] for a, b in combinations(x, 2))
        assert np.isclose(odds, machine.bias + sum(machine.linear[a] * v for a, v in x.items()) + pairs)


def test_gradients_are_those_of_the_loss():
    """A first step of the trainer goes against the slope of the mean loss, weight by weight."""
    rows, labels = some_rows(), np.random.default_rng(3).integers(0, 2, 45).astype(float)
    one = fm.Learning(hashed=32, factors=3, batch=100, epochs=1, step=1e-6, decay=0.0)
    rng = np.random.default_rng(one.seed)
    factors = rng.normal(0, 0.05, (one.size, one.factors))
    share = (labels.sum() + 1) / (len(labels) + 2)
    start = fm.Machine(float(np.log(share / (1 - share))), np.zeros(one.size), factors)

    def loss(machine):
        p = machine.scores(rows)
        return -np.mean(labels * np.log(p) + (1 - labels) * np.log(1 - p))

    after = fm.fit(rows, labels, one)
    moved = np.concatenate([(after.linear - start.linear)[:, None], after.factors - start.factors], axis=1)
    for feature in (3, 17, one.hashed + 1):
        for column in range(1 + one.factors):
            shifted = fm.Machine(start.bias, start.linear.copy(), factors.copy())
            (shifted.linear if column == 0 else shifted.factors[:, column - 1])[feature] += 1e-5
            slope = (loss(shifted) - loss(start)) / 1e-5
            assert slope == 0 or np.sign(moved[feature, column]) == -np.sign(slope)


def test_vectors_are_bounded():
    rows = some_rows()
    assert (np.diff(rows.ends) <= SMALL.size).all() and np.isfinite(rows.value).all()
    assert (rows.value >= 0).all() and (rows.value <= 1).all()
    for i in range(len(rows.ends) - 1):
        index = rows.index[rows.ends[i] : rows.ends[i + 1]]
        assert len(set(index)) == len(index) and index.max() < SMALL.size


def frames(spark):
    good = [(i, f"an ordinary text of number {i} with some words", 40) for i in range(60)]
    bad = [(100 + i, f"$$$ ### {i} %%% ***", None) for i in range(60)]
    odd = [(None, "no id", 5), (300, None, None), (301, "", 0), (302, "word " * 40_000, 200_000), (3, good[3][1], 40), (3, good[3][1], 40)]
    df = spark.createDataFrame([(*r, 9.0, "x") for r in good + bad + odd], "doc_id long, text string, n_chars int, score double, held_out string")
    labels = spark.createDataFrame(
        [(i, 1) for i, *_ in good] + [(i, 0) for i, *_ in bad] + [(5, 0), (None, 1), (300, None), (301, 7), (999, 1)], "doc_id long, quality int")
    return df.repartition(3), labels


def test_judged_rows(spark):
    df, labels = frames(spark)
    found = fm.judged(df, labels)
    rows = found.collect()
    assert found.dtypes == [("doc_id", "bigint"), ("held_out", "boolean"), ("score", "double"), ("predicted", "int")]
    assert len(rows) == df.count() and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in rows)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows if r.doc_id is not None)
    assert len({r.score for r in rows if r.doc_id == 3}) == 1
    again = {(r.doc_id, r.score) for r in fm.judged(df.repartition(2), labels.repartition(5)).collect()}
    assert again == {(r.doc_id, r.score) for r in rows}
    assert fm.judged(df.limit(0), labels).count() == 0
    assert {r.score for r in fm.judged(df, labels.limit(0)).collect()} == {0.5}


def test_nothing_is_learnt_from_held_out_rows(spark):
    """Turning the labels of all held-out rows round changes no score."""
    df, labels = frames(spark)
    turned = labels.withColumn("quality", F.when(fm.held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")))
    scores = [{(r.doc_id, r.score) for r in fm.judged(df, x).collect()} for x in (labels, turned)]
    assert scores[0] == scores[1]
    only = labels.where(fm.held_out(F.col("doc_id")))
    assert {r.score for r in fm.judged(df, only).collect()} == {0.5}


def test_held_out_accuracy(spark):
    found = queries.QUERIES["op12_factorisation_quality"](spark, SF).join(spark.read.parquet(f"{SF}/labels.parquet"), "doc_id")
    shares = {r.quality: r.kept for r in found.where("held_out").groupBy("quality").agg(F.avg("predicted").alias("kept")).collect()}
    assert shares[1] > 0.98 and shares[0] < 0.06
