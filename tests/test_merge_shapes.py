"""Upserts of sparse and wide batches: the results of the plain one, by other plans."""

import random

import pytest
from pyspark.sql import functions as F

from sluice import operators as O
from sluice.operators.merge import bloom_words, split_by_bloom

from .test_merge import BASE, CHANGE, merge_by_rows, random_rows, result, unique


@pytest.mark.parametrize("seed", range(3))
@pytest.mark.parametrize("batch, parts", [("sparse", False), ("sparse", True), ("wide", False)])
@pytest.mark.parametrize("null_keys", ["insert", "reject"])
def test_equals_row_by_row_merge(spark, seed, batch, parts, null_keys):
    rng = random.Random(seed)
    base, changes = unique(random_rows(rng, 20)), [(*r, i) for i, r in enumerate(random_rows(rng, 25))]
    brought = ["k1", "k2", "w"] if parts else ["k1", "k2", "v", "w"]
    frame = spark.createDataFrame(changes, CHANGE).select(*brought, "o").repartition(3)
    merged = O.upsert(spark.createDataFrame(base, BASE), frame, ["k1", "k2"], ["o"], null_keys=null_keys, batch=batch)
    assert merged.columns == ["k1", "k2", "v", "w"]
    assert result(merged) == merge_by_rows(base, changes, ["k1", "k2", "v", "w"], brought, ["k1", "k2"], lambda r: r[4], null_keys)


def test_a_batch_without_rows_and_one_without_keys(spark):
    base = spark.createDataFrame([(1, "a", "x", 1), (None, "b", "y", 2)], BASE)
    changes = spark.createDataFrame([(None, "b", "new", 3, 1)], CHANGE)
    for batch in ("sparse", "wide"):
        assert result(O.upsert(base, changes.limit(0), ["k1", "k2"], ["o"], batch=batch)) == result(base)
        assert result(O.upsert(base, changes, ["k1", "k2"], ["o"], batch=batch)) == sorted(
            [*result(base), (None, "b", "new", 3)], key=repr)
        assert result(O.upsert(base.limit(0), changes, ["k1", "k2"], ["o"], batch=batch)) == [(None, "b", "new", 3)]


def test_keys_of_another_type_are_found(spark):
    base = spark.createDataFrame([(1, "old"), (2, "old")], "k int, v string")
    changes = spark.createDataFrame([(2, "new")], "k bigint, v string")
    assert result(O.upsert(base, changes, ["k"], batch="sparse")) == [(1, "old"), (2, "new")]


def test_options_that_do_not_go_together(spark):
    base = spark.createDataFrame([(1, "a")], "k int, v string")
    for options in ({"batch": "huge"}, {"batch": "sparse", "newest": True}):
        with pytest.raises(ValueError):
            O.upsert(base, base, ["k"], **options)
    with pytest.raises(ValueError):
        O.upsert(base, base.select("k"), ["k"], batch="wide")


def test_bloom_filter_loses_no_hit(spark):
    base = spark.range(20_000).select(F.col("id").alias("k"), F.lit("x").alias("v"))
    batch = spark.range(0, 20_000, 200).select(F.col("id").alias("k"))
    for bits, most in ((1024, 600), (64, 20_000)):  # ten bits a key, and far too few
        maybe, never = split_by_bloom(base, bloom_words(batch, ["k"], bits), ["k"], bits)
        assert maybe.count() + never.count() == 20_000
        assert maybe.join(batch, "k", "left_semi").count() == 100 and maybe.count() <= most


def exchanged(df):
    """Rows that the shuffles of a finished plan carried."""
    text = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    return text


@pytest.mark.parametrize("parts", [False, True])
def test_rows_that_cannot_be_hit_are_not_exchanged(spark, folder, parts):
    spark.range(100_000).selectExpr("id as k", "'a' as v", "id as w").write.parquet(f"{folder}/base")
    base = spark.read.parquet(f"{folder}/base")
    new = spark.range(0, 100_000, 1000).selectExpr("id as k", "'b' as v", "1L as w", "id as o")
    merged = O.upsert(base, new.drop("w") if parts else new, ["k"], ["o"], batch="sparse")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rows = merged.collect()
        assert len(rows) == 100_000 and sum(r["v"] == "b" for r in rows) == 100
        plan = merged._jdf.queryExecution().executedPlan()
        written = shuffle_rows(plan)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # the batch's hundred rows, and of the base its hits and some false positives
    assert written and sum(written) < 2_500


def shuffle_rows(plan):
    """Records written by each shuffle of an executed plan."""
    found, todo = [], [plan]
    while todo:
        node = todo.pop()
        name = node.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            todo.append(node.executedPlan())
            continue
        if name.endswith("QueryStageExec"):
            todo.append(node.plan())
            continue
        if name == "ShuffleExchangeExec":
            found.append(node.metrics().apply("shuffleRecordsWritten").value())
        children = node.children()
        todo.extend(children.apply(i) for i in range(children.size()))
    return found


def test_a_wide_batch_is_read_and_shuffled_once(spark, folder):
    """One scan a side, and one shuffle for both, whose rows tasks have combined by key."""
    spark.range(2000).selectExpr("id as k", "'a' as v").write.parquet(f"{folder}/base")
    spark.range(9000).selectExpr("if(id % 3 = 0, -1, id) as k", "'b' as v", "id as o").coalesce(2).write.parquet(f"{folder}/new")
    base, new = spark.read.parquet(f"{folder}/base"), spark.read.parquet(f"{folder}/new")
    merged = O.upsert(base, new, ["k"], ["o"], batch="wide")
    assert len(merged.collect()) == len({*range(2000), -1, *(i for i in range(9000) if i % 3)})
    plan = exchanged(merged)
    assert plan.count("FileScan parquet") == 2 and plan.count("Exchange hashpartitioning") == 1
    assert "Join" not in plan and ("partial_max" in plan)
    # the key -1 has 3000 changes and leaves each task as one row
    assert 2000 <= sum(shuffle_rows(merged._jdf.queryExecution().executedPlan())) < 2000 + 6000 + 20
