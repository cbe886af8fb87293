import os
import shutil
from glob import glob

import pytest
from pyspark.sql import functions as F

from sluice.sources import Table, hash_buckets, id_ranges, tables

SCHEMA = "k bigint, v string, w string"


def frame(spark, rows):
    return spark.createDataFrame(rows, "k bigint, v string, w string, o int")


def rows_of(table):
    return sorted((tuple(r) for r in table.read().collect()), key=repr)


def drop_superseded(t):
    """What an owner of the storage does; returns the folders."""
    gone = sorted(r["folder"] for r in t.superseded().collect())
    for g in gone:
        shutil.rmtree(f"{t.path}/{g}")
    return gone


def test_upsert_replay_and_null_keys(spark, folder):
    t = Table(spark, folder, SCHEMA, ["k"], buckets=4)
    assert rows_of(t) == []
    batch = frame(spark, [(1, "a", "x", 1), (1, "b", "y", 2), (2, "c", None, 1), (None, "n", "n", 1), (None, "n", "n", 2)])
    assert t.upsert(batch, ["o"], batch=("s", 1))
    state = [(1, "b", "y"), (2, "c", None), (None, "n", "n"), (None, "n", "n")]
    assert rows_of(t) == sorted(state, key=repr)
    assert not t.upsert(batch, ["o"], batch=("s", 1))
    assert rows_of(t) == sorted(state, key=repr)
    # a second batch with NULL keys only adds; a rejecting one does not
    assert t.upsert(frame(spark, [(None, "m", "m", 1)]), ["o"], batch=("s", 2))
    assert t.upsert(frame(spark, [(None, "no", "no", 1), (2, "d", "z", 1)]), ["o"], null_keys="reject")
    state = [(1, "b", "y"), (2, "d", "z"), (None, "n", "n"), (None, "n", "n"), (None, "m", "m")]
    assert rows_of(t) == sorted(state, key=repr)
    # an empty batch is remembered too
    assert t.upsert(batch.limit(0), ["o"], batch=("s", 3))
    assert not t.upsert(batch, ["o"], batch=("s", 3))
    assert rows_of(t) == sorted(state, key=repr)
    drop_superseded(t)
    assert rows_of(t) == sorted(state, key=repr)


def test_first_batch_is_written_once(spark, folder, monkeypatch):
    """Rows that all have a key and nothing to merge with: no staged copy."""
    staged = []
    keep = tables.settled
    monkeypatch.setattr(tables, "settled", lambda df, name, *more: staged.append(name) or keep(df, name, *more))
    t = Table(spark, folder, SCHEMA, ["k"], buckets=2)
    batch = [(1, "a", "x", 1), (1, "b", "y", 2), (2, "c", None, 1), (2, "c", None, 1), (None, "n", "n", 1)]
    t.upsert(frame(spark, batch), ["o"], null_keys="reject")
    assert not staged and rows_of(t) == [(1, "b", "y"), (2, "c", None)]
    t.upsert(frame(spark, [(2, "d", "z", 1), (None, "m", "m", 1)]), ["o"])
    assert staged == ["staged"] and rows_of(t) == sorted([(1, "b", "y"), (2, "d", "z"), (None, "m", "m")], key=repr)
    # an empty batch, then one with some of the columns
    part = Table(spark, folder + "/part", SCHEMA, ["k"], buckets=2)
    rows = "k bigint, v string"
    part.upsert(spark.createDataFrame([(None, "n")], rows), batch=("s", 1), null_keys="reject")
    assert rows_of(part) == []
    part.upsert(spark.createDataFrame([(None, "n"), (7, "p")], rows), null_keys="reject")
    assert rows_of(part) == [(7, "p", None)] and staged == ["staged"]
    assert part.superseded().count() == 0


def test_partial_columns(spark, folder):
    t = Table(spark, folder, SCHEMA, ["k"], buckets=2)
    t.upsert(frame(spark, [(1, "a", "x", 1), (2, "b", "y", 1)]), ["o"])
    t.upsert(spark.createDataFrame([(2, None, 1), (3, "new", 1)], "k bigint, v string, o int"), ["o"])
    assert rows_of(t) == [(1, "a", "x"), (2, None, "y"), (3, "new", None)]


def test_only_touched_buckets_are_rewritten(spark, folder):
    t = Table(spark, folder, SCHEMA, ["k"], layout=id_ranges(100))
    t.upsert(spark.range(1000).select(F.col("id").alias("k"), F.lit("a").alias("v"), F.lit("b").alias("w")))
    t.upsert(frame(spark, [(905, "new", "new", 1)]), ["o"])
    assert t._state().held == {**{b: 1 for b in range(9)}, 9: 2}
    assert t.read().count() == 1000
    assert t.read().filter("v = 'new'").collect()[0]["k"] == 905


def test_unfinished_write_is_invisible(spark, folder, monkeypatch):
    t = Table(spark, folder, SCHEMA, ["k"], buckets=2)
    t.upsert(frame(spark, [(1, "a", "x", 1)]), ["o"])

    def dies(*_):
        raise RuntimeError("driver lost")

    with monkeypatch.context() as m:
        m.setattr(Table, "_switch", dies)
        with pytest.raises(RuntimeError):
            t.upsert(frame(spark, [(1, "b", "y", 1), (5, "e", "e", 1), (None, "n", "n", 1)]), ["o"], batch=("b", 0))
    assert rows_of(t) == [(1, "a", "x")]
    # the next run takes the same version number and leaves nothing of the dead one
    t.upsert(frame(spark, [(1, "c", "z", 1)]), ["o"], batch=("b", 0))
    assert rows_of(t) == [(1, "c", "z")]
    t.upsert(frame(spark, [(None, "n", "n", 1)]), ["o"])
    assert rows_of(t) == [(1, "c", "z"), (None, "n", "n")]


def test_a_pointer_half_written_leaves_the_one_before(spark, folder):
    t = Table(spark, folder, SCHEMA, ["k"], buckets=2)
    assert t.superseded().count() == 0
    for v in ("a", "b", "c"):
        t.upsert(frame(spark, [(1, v, "x", 1)]), ["o"])
    assert t._state().version == 3
    # the fourth switch empties the slot of the second and dies before its line is there
    for file in glob(f"{folder}/state/slot=0/*"):
        os.remove(file)
    assert rows_of(t) == [(1, "c", "x")]
    t.upsert(frame(spark, [(1, "d", "x", 1)]), ["o"])
    assert rows_of(t) == [(1, "d", "x")] and t._state().version == 4


def test_superseded_names_nothing_that_is_read(spark, folder):
    """Buckets of different versions, negative ranges and rows without a key; a reload leaves only itself."""
    t = Table(spark, folder, SCHEMA, ["k"], layout=id_ranges(10))
    t.upsert(frame(spark, [(-5, "a", "x", 1), (15, "a", "x", 1), (None, "n", "n", 1)]), ["o"])
    t.upsert(frame(spark, [(-5, "b", "x", 1), (None, "m", "m", 1)]), ["o"])
    assert drop_superseded(t) == ["data/version=1/table_bucket=-1"]
    assert rows_of(t) == sorted([(-5, "b", "x"), (15, "a", "x"), (None, "n", "n"), (None, "m", "m")], key=repr)
    t.reload(frame(spark, [(7, "g", "g", 1)]))
    assert drop_superseded(t) == [
        "data/version=1/table_bucket=1", "data/version=2/table_bucket=-1", "loose/version=1", "loose/version=2"]
    assert rows_of(t) == [(7, "g", "g")]


def test_newest(spark, folder):
    t = Table(spark, folder, "k bigint, v string, ts int", ["k"], buckets=2)
    schema = "k bigint, v string, ts int"
    t.upsert(spark.createDataFrame([(1, "new", 5), (2, "old", 1)], schema), ["ts"], newest=True)
    t.upsert(spark.createDataFrame([(1, "late", 4), (2, "young", 2)], schema), ["ts"], newest=True)
    assert rows_of(t) == [(1, "new", 5), (2, "young", 2)]
    with pytest.raises(ValueError):
        t.upsert(spark.createDataFrame([(1, "late")], "k bigint, v string"), [], newest=True)


def test_reload_and_append(spark, folder):
    t = Table(spark, folder + "/plain", "v string")
    names = spark.createDataFrame([("a",), ("a",)], "v string")
    t.append(names)
    t.append(names)
    assert rows_of(t) == [("a",)] * 4
    t.reload(t.read().limit(1))
    assert rows_of(t) == [("a",)]
    assert t.append(names, batch=("n", 7)) and not t.append(names, batch=("n", 7))
    assert rows_of(t) == [("a",)] * 3
    t.reload(names.limit(0))
    assert rows_of(t) == []
    keyed = Table(spark, folder + "/keyed", SCHEMA, ["k"], buckets=2)
    keyed.upsert(frame(spark, [(1, "a", "x", 1), (None, "n", "n", 1)]), ["o"])
    keyed.reload(frame(spark, [(7, "g", "g", 1), (None, "z", "z", 1)]))
    assert rows_of(keyed) == [(7, "g", "g"), (None, "z", "z")]
    with pytest.raises(ValueError):
        keyed.append(frame(spark, []))
    with pytest.raises(ValueError):
        t.upsert(names)


def test_bucket_count_is_fixed(spark, folder):
    Table(spark, folder, SCHEMA, ["k"], buckets=2).upsert(frame(spark, [(1, "a", "x", 1)]), ["o"])
    with pytest.raises(ValueError):
        Table(spark, folder, SCHEMA, ["k"], buckets=3).read()


def test_read_prunes_columns_and_pushes_filters(spark, folder):
    t = Table(spark, folder, SCHEMA, ["k"], buckets=2)
    t.upsert(frame(spark, [(1, "a", "x", 1)]), ["o"])
    plan = t.read().filter("k = 1").select("v")._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<k:bigint,v:string>" in plan and "EqualTo(k,1)" in plan


def test_batch_after_batch(spark, folder):
    t = Table(spark, folder, SCHEMA, ["k"], buckets=3)
    full, partial = {}, "k bigint, w string, o int"
    for i in range(4):
        rows = [(j, f"v{i}", f"w{j}", 1) for j in range(i, i + 6)]
        t.upsert(frame(spark, rows), ["o"])
        full.update({r[0]: [r[1], r[2]] for r in rows})
    t.upsert(spark.createDataFrame([(2, "only w", 1), (90, "new", 1)], partial), ["o"])
    full[2][1] = "only w"
    full[90] = [None, "new"]
    assert rows_of(t) == sorted(((k, *v) for k, v in full.items()), key=repr)


def test_layout_is_recorded(spark, folder):
    """Another width or kind is refused, so that no key can end up in two buckets."""
    t = Table(spark, folder, SCHEMA, ["k"], layout=id_ranges(10))
    t.upsert(frame(spark, [(15, "a", "x", 1), (-5, "b", "y", 1), (None, "n", "n", 1)]), ["o"])
    t.upsert(frame(spark, [(15, "c", "x", 1), (-5, "d", "y", 1)]), ["o"])
    assert rows_of(t) == [(-5, "d", "y"), (15, "c", "x"), (None, "n", "n")]
    for other in (id_ranges(100), hash_buckets(10)):
        with pytest.raises(ValueError):
            Table(spark, folder, SCHEMA, ["k"], layout=other).upsert(frame(spark, [(15, "e", "x", 1)]), ["o"])


def test_what_is_kept_does_not_grow_with_batches(spark, folder):
    t = Table(spark, folder, SCHEMA, ["k"], buckets=2)
    for i in range(6):
        t.upsert(frame(spark, [(j, f"v{i}", "w", 1) for j in range(8)]), ["o"], batch=("s", i))
    assert len(glob(f"{folder}/state/*")) == 2 and not glob(f"{folder}/staged/*")
    assert t._state().sources == {"s": 5} and len(t._state().held) == 2
    found = {(r["folder"], r["files"] > 0, r["bytes"] > 0) for r in t.superseded().collect()}
    assert found == {(f"data/version={v}/table_bucket={b}", True, True) for v in range(1, 6) for b in range(2)}
    assert len(drop_superseded(t)) == 10 and len(glob(f"{folder}/data/version=*/table_bucket=*")) == 2
    assert t.superseded().count() == 0
    assert rows_of(t) == [(j, "v5", "w") for j in range(8)]


def test_a_merge_reads_and_shuffles_each_side_once(spark, folder, monkeypatch):
    """The plan behind a stored upsert: one scan of the base, one of the batch, one shuffle for each."""
    t = Table(spark, folder, "k bigint, v string, ts int", ["k"], buckets=2)
    rows = "k bigint, v string, ts int"
    t.upsert(spark.range(1000).selectExpr("id as k", "'a' as v", "1 as ts"))
    seen = []
    write = Table._write_buckets
    monkeypatch.setattr(Table, "_write_buckets", lambda self, merged, version: (
        seen.append(merged._jdf.queryExecution().executedPlan().toString()), write(self, merged, version)))
    t.upsert(spark.createDataFrame([(5, "n", 2), (None, "n", 1)], rows), ["ts"])
    t.upsert(spark.createDataFrame([(5, 3), (6, 3)], "k bigint, ts int"))
    t.upsert(spark.createDataFrame([(5, "late", 1)], rows), ["ts"], newest=True)
    for plan in seen:
        assert plan.count("FileScan parquet") == 2 and plan.count("Exchange hashpartitioning") <= 2
        assert "Python" not in plan and "Cartesian" not in plan and "NestedLoop" not in plan
    assert t.read().count() == 1001 and [r.v for r in t.read().filter("k = 5").collect()] == ["n"]
