import random

import pytest
from pyspark.sql import functions as F

from sluice import operators as O

BASE = "k1 int, k2 string, v string, w int"
CHANGE = BASE + ", o int"


def merge_by_rows(base, changes, columns, brought, keys, order, null_keys="insert"):
    """What a MERGE does that runs one row after the other; columns are (name, index) by position."""
    at = {c: i for i, c in enumerate(columns)}
    target = [dict(zip(columns, r)) for r in base]
    names = [*columns, "o"] if len(changes) and len(changes[0]) > len(columns) else columns
    for r in sorted(changes, key=order):
        row = {c: r[names.index(c)] for c in brought}
        if any(row[k] is None for k in keys):
            if null_keys == "insert":
                target.append({c: row.get(c) for c in columns})
            continue
        hits = [t for t in target if all(t[k] == row[k] for k in keys)]
        if hits:
            for t in hits:
                t.update(row)
        else:
            target.append({c: row.get(c) for c in columns})
    return sorted((tuple(t[c] for c in at) for t in target), key=repr)


def random_rows(rng, n, null_keys=True):
    def key(values):
        return None if null_keys and rng.random() < 0.1 else rng.choice(values)

    rows = [(key(range(6)), key("abc"), rng.choice(["x", "y", None]), rng.choice([1, 2, None])) for _ in range(n)]
    return rows


def unique(rows):
    seen, kept = set(), []
    for r in rows:
        if None in r[:2] or r[:2] not in seen:
            seen.add(r[:2])
            kept.append(r)
    return kept


def result(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.mark.parametrize("seed", range(4))
@pytest.mark.parametrize("mode", ["full", "partial", "reject"])
def test_equals_row_by_row_merge(spark, seed, mode):
    rng = random.Random(seed)
    base = unique(random_rows(rng, 20))
    changes = [(*r, i) for i, r in enumerate(random_rows(rng, 25))]
    brought = ["k1", "k2", "w"] if mode == "partial" else ["k1", "k2", "v", "w"]
    null_keys = "reject" if mode == "reject" else "insert"
    frame = spark.createDataFrame(changes, CHANGE).select(*brought, "o").repartition(3)
    merged = O.upsert(spark.createDataFrame(base, BASE), frame, ["k1", "k2"], ["o"], null_keys=null_keys)
    wanted = merge_by_rows(base, changes, ["k1", "k2", "v", "w"], brought, ["k1", "k2"], lambda r: r[4], null_keys)
    assert merged.columns == ["k1", "k2", "v", "w"]
    assert result(merged) == wanted


@pytest.mark.parametrize("seed", range(3))
def test_idempotent_and_splittable(spark, seed):
    rng = random.Random(seed)
    base = spark.createDataFrame(unique(random_rows(rng, 15, False)), BASE)
    rows = [(*r, i) for i, r in enumerate(random_rows(rng, 20, False))]
    whole = spark.createDataFrame(rows, CHANGE)
    first, second = whole.filter("o < 10"), whole.filter("o >= 10")

    def up(b, c):
        return O.upsert(b, c, ["k1", "k2"], ["o"])

    once = up(base, whole)
    assert result(up(once, whole)) == result(once)
    assert result(up(up(base, first), second)) == result(once)
    keys = [r[:2] for r in result(once)]
    assert len(keys) == len(set(keys))


def test_update_also_sets_null_and_nothing_is_deleted(spark):
    base = spark.createDataFrame([(1, "a", "x", 1), (2, "b", "y", 2)], BASE)
    changes = spark.createDataFrame([(1, "a", None, None, 1)], CHANGE)
    assert result(O.upsert(base, changes, ["k1", "k2"], ["o"])) == [(1, "a", None, None), (2, "b", "y", 2)]


def test_partial_update_can_set_null(spark):
    base = spark.createDataFrame([(1, "a", "x", 1)], BASE)
    changes = spark.createDataFrame([(1, "a", None, 1), (9, "z", 5, 1)], "k1 int, k2 string, w int, o int")
    assert result(O.upsert(base, changes, ["k1", "k2"], ["o"])) == [(1, "a", "x", None), (9, "z", None, 5)]


def test_newest_ignores_late_versions(spark):
    base = spark.createDataFrame([(1, "new", 5), (2, "old", 1), (3, "same", 3)], "k int, v string, ts int")
    changes = spark.createDataFrame([(1, "late", 4), (2, "young", 2), (3, "again", 3), (4, "x", None), (None, "n", 1)],
                                    "k int, v string, ts int")
    merged = O.upsert(base, changes, ["k"], ["ts"], newest=True)
    assert result(merged) == sorted(
        [(1, "new", 5), (2, "young", 2), (3, "again", 3), (4, "x", None), (None, "n", 1)], key=repr)


def test_last_row_orders_null_lowest_and_keeps_maps(spark):
    rows = spark.createDataFrame(
        [(1, None, {"a": 1}), (1, 3, {"b": 2}), (2, None, {"c": 3})], "k int, o int, m map<string,int>")
    assert sorted((r["k"], r["o"], r["m"]) for r in O.last_row(rows, ["k"], ["o"]).collect()) == [
        (1, 3, {"b": 2}), (2, None, {"c": 3})]


def test_ties_do_not_depend_on_partitions(spark):
    rows = spark.range(1000).select((F.col("id") % 3).alias("k"), F.lit(1).alias("o"), F.col("id").alias("v"))
    found = {tuple(map(tuple, O.last_row(rows.repartition(n), ["k"], ["o"]).orderBy("k").collect())) for n in (1, 3, 7)}
    assert found == {((0, 1, 999), (1, 1, 997), (2, 1, 998))}


def test_only_keys(spark):
    base = spark.createDataFrame([(1,), (2,)], "k int")
    assert result(O.upsert(base, spark.createDataFrame([(2,), (3,), (3,)], "k int"), ["k"])) == [(1,), (2,), (3,)]


def test_bad_options(spark):
    base = spark.createDataFrame([(1, "a")], "k int, v string")
    with pytest.raises(ValueError):
        O.upsert(base, base, ["k"], null_keys="drop")
    with pytest.raises(ValueError):
        O.upsert(base, base.select("k"), ["k"], newest=True)


def test_hot_key_leaves_each_task_as_one_row(spark):
    """A key holding a third of the batch: the shuffle carries at most one row per key and task."""
    rows = spark.range(0, 300000, 1, 6).select(
        F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id") % 100).alias("k"), F.col("id").alias("o"))
    last = O.last_row(rows, ["k"], ["o"])
    last.collect()
    plan = last._jdf.queryExecution().executedPlan().toString()
    assert "partial_max" in plan
    assert sorted(tuple(r) for r in last.collect())[0] == (-1, 299997)


@pytest.mark.parametrize("seed", range(3))
def test_newest_equals_brute_force(spark, seed):
    rng = random.Random(seed)

    def rows(n):
        return [(rng.choice([None, 1, 2, 3, 4, 5, 6]), rng.choice("abc"), rng.choice([None, *range(6)])) for _ in range(n)]

    base = list({r[0]: r for r in rows(12) if r[0] is not None}.values()) + [(None, "n", 1)]
    changes = rows(15)
    target = {r[0]: r for r in base if r[0] is not None}

    def rank(r):
        return (r[2] is not None, r[2] or 0)

    loose = [r for r in base + changes if r[0] is None]
    for r in sorted((c for c in changes if c[0] is not None), key=lambda r: (rank(r), r[1])):
        if r[0] not in target or rank(r) >= rank(target[r[0]]):
            target[r[0]] = r
    schema = "k int, v string, ts int"
    merged = O.upsert(spark.createDataFrame(base, schema), spark.createDataFrame(changes, schema).repartition(3), ["k"],
                      ["ts"], newest=True)
    assert result(merged) == sorted([*target.values(), *loose], key=repr)


@pytest.mark.parametrize("mode", ["full", "partial", "reject", "newest"])
def test_the_base_is_read_and_shuffled_once(spark, folder, mode):
    spark.range(2000).selectExpr("id as k", "'a' as v", "1 as ts").write.parquet(f"{folder}/base")
    spark.range(900).selectExpr("if(id % 3 = 0, null, id) as k", "'b' as v", "2 as ts", "id as o").write.parquet(f"{folder}/new")
    base, new = spark.read.parquet(f"{folder}/base"), spark.read.parquet(f"{folder}/new")
    if mode == "partial":
        new = new.drop("v")
    merged = O.upsert(base, new, ["k"], ["ts"] if mode == "newest" else ["o"], newest=mode == "newest",
                      null_keys="reject" if mode == "reject" else "insert")
    assert merged.count() == (2000 if mode == "reject" else 2300)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        merged.write.format("noop").mode("overwrite").save()
        assert merged.count() and len(merged.collect()) == (2000 if mode == "reject" else 2300)
        plan = merged._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # whole rows take the batch once for its keys and once for its rows; the base is never read twice
    assert plan.count("FileScan parquet") == plan.count("Exchange hashpartitioning") == (3 if mode in ("full", "reject") else 2)
