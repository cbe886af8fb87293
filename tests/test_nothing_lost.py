"""Streams, snapshots and mixed headers: every record comes out somewhere, exactly once."""

import datetime as dt
import glob
import gzip
import os

import pytest
from pyspark.sql import functions as F

from sluice.plans.jobs import Jobs
from sluice.schemas import CHANGE_FILES
from sluice.sources import SnapshotDiffers, Table, proved_snapshot, read_mixed, snapshot_records, verify_snapshot
from sluice.sources.change_files import CORRUPT, read_texts, schema_of
from sluice.streaming import stream_checked, stream_texts

SCHEMA = "`key.id` bigint, `value.name` string, `meta.ts` timestamp"
HEADER = "key.id,value.name,meta.ts\n"


def put(folder, name, text):
    os.makedirs(folder, exist_ok=True)
    with gzip.open(f"{folder}/{name}.csv.gz", "wt", encoding="utf-8", newline="") as f:
        f.write(text)


def stream(spark, folder, table):
    stream_checked(
        stream_texts(spark, folder + "/in", SCHEMA, files_per_batch=1), SCHEMA, table, ["ts"], folder + "/check", folder + "/bad",
        prepare=lambda b: b.select(F.col("`key.id`").alias("k"), F.col("`value.name`").alias("v"), F.col("`meta.ts`").alias("ts"))).awaitTermination()


def test_stream_with_bad_rows(spark, folder):
    """Good and bad rows add up to the input, over batches, restarts and a replay of the last batch."""
    table = Table(spark, folder + "/t", "k bigint, v string, ts timestamp", ["k"], buckets=2)
    put(folder + "/in", "a", HEADER + '1,"a\nb",2024-01-01T00:00:00Z\n2.0,x,2024-01-01T00:00:00Z\n3,y,never\n')
    put(folder + "/in", "b", HEADER + "4,z,2024-01-02T00:00:00Z,surplus\n5\n6,ok,2024-01-02T00:00:00Z\n")
    put(folder + "/in", "c", HEADER + "7,no bad rows here,2024-01-02T00:00:00Z\n")

    def state():
        bad = spark.read.json(folder + "/bad").collect()
        return (sorted(r["k"] for r in table.read().collect()),
                sorted((r["raw"]["key.id"], tuple(r["bad_columns"])) for r in bad))

    stream(spark, folder, table)
    expected = [1, 6, 7], [("2.0", ("key.id",)), ("3", ("meta.ts",)), ("4", ("record",)), ("5", ("record",))]
    assert state() == expected
    stream(spark, folder, table)
    assert state() == expected
    last = max(glob.glob(folder + "/check/commits/[0-9]*"), key=lambda p: int(os.path.basename(p)))
    os.remove(last)  # as after a crash between the sinks and the commit
    os.remove(f"{os.path.dirname(last)}/.{os.path.basename(last)}.crc")
    stream(spark, folder, table)
    assert state() == expected
    put(folder + "/in", "d", HEADER + "x,late,2024-01-03T00:00:00Z\n8,late,2024-01-03T00:00:00Z\n")
    stream(spark, folder, table)
    assert state() == ([1, 6, 7, 8], sorted([*expected[1], ("x", ("key.id",))]))
    raw = {r["record"] for r in spark.read.json(folder + "/bad").collect() if r["record"]}
    assert raw == {"4,z,2024-01-02T00:00:00Z,surplus", "5"}


NASTY = ["plain", ' "quoted", with comma', "line\nbreak", " blanks around ", "cr\r\nlf", "back\\slash\\", 'ends with "', "é漢", "\\\"", "'", "\t"]


def test_snapshot_keeps_every_record(spark, folder):
    cells = ['"' + v.replace('"', '""') + '"' for v in NASTY]
    put(folder + "/in", "a", "key.id,value.name\n" + "".join(f"{i},{c}\n" for i, c in enumerate(cells)) + "90,\n")
    put(folder + "/in", "b", 'value.name,key.id\n"n",91,surplus\ncut\n"two, ""words""",92\n')
    jobs = Jobs(spark, folder + "/tables", dt.datetime(2024, 10, 2), buckets=1)
    path = jobs.snapshot("roles", folder + "/in", dt.datetime(2024, 10, 2), folder + "/snap")
    texts = [f.name for f in schema_of(CHANGE_FILES["roles"]).fields]
    found = read_texts(spark, path, CHANGE_FILES["roles"], mixed=False).select(*[f"`{c}`" for c in texts])
    assert sorted(map(tuple, found.collect()), key=repr) == sorted(
        [*((str(i), v) for i, v in enumerate(NASTY)), ("90", None), ("92", 'two, "words"')], key=repr)
    assert sorted(r["record"] for r in snapshot_records(spark, path).collect()) == ['"n",91,surplus', "cut"]
    verify_snapshot(spark, path)
    more = spark.createDataFrame([("93", "added")], "`key.id` string, `value.name` string")
    more.coalesce(1).write.mode("append").option("header", True).csv(path)
    with pytest.raises(SnapshotDiffers, match="rows"):
        verify_snapshot(spark, path)


def test_sums_do_not_depend_on_order(spark, folder):
    from sluice.sources.snapshots import _sums

    rows = [("a", None), (None, "a"), ("b", "c"), ("b", "c"), (None, None)]
    df = spark.createDataFrame(rows, "x string, y string")
    assert _sums(df) == _sums(df.orderBy(F.desc("y")).repartition(5))
    assert _sums(df)[1] != _sums(spark.createDataFrame([*rows[1:], ("a", "a")], df.schema))[1]
    assert _sums(df.limit(0)) == (0, "0")
    path = proved_snapshot(df.limit(0), folder + "/none", "2024-01-01T00:00:00Z")
    assert snapshot_records(spark, path).count() == 0


def test_many_small_files_of_one_header(spark, folder):
    """Thousands of files: the driver gets one header, and no list of paths is put together."""
    os.makedirs(folder + "/in")
    for i in range(2000):
        with open(f"{folder}/in/{i}.csv", "w") as f:
            f.write(f"value.name,key.id\nn{i},{i}\n")
    with open(f"{folder}/in/other.csv", "w") as f:
        f.write('key.id,value.unread,value.name,meta.ts\n5000,x,"a, b",2024-01-01T00:00:00Z\n')
    rows = read_mixed(spark, folder + "/in", SCHEMA)
    assert rows.agg(F.count("*"), F.sum("`key.id`"), F.count("`meta.ts`"), F.countDistinct("`value.name`")).first() == (
        2001, 1999 * 1000 + 5000, 1, 2001)
    import sluice.sources.change_files as source

    with open(source.__file__) as f:
        assert "collect_list" not in f.read()
    assert "collect_list" not in rows._jdf.queryExecution().toString()


def test_unfit_records_of_mixed_headers(spark, folder):
    """A record is held against its own file's header, whatever the widest one is."""
    put(folder + "/in", "narrow", 'key.id,value.name\n1,"a\n""b"""\n2,x,surplus\n3\n4,x,y,z\n5,\n')
    put(folder + "/in", "wide", "value.name,a,b,key.id\nx,,,10\nx,1,2\nx,1,2,11,more\n")
    rows = read_texts(spark, folder + "/in", "`key.id` bigint, `value.name` string").collect()
    good = sorted((r["key.id"], r["value.name"]) for r in rows if r[CORRUPT] is None if r["value.name"])
    assert good == [("1", 'a\n"b"'), ("10", "x")]
    assert [r["key.id"] for r in rows if r[CORRUPT] is None and r["value.name"] is None] == ["5"]
    assert sorted(r[CORRUPT] for r in rows if r[CORRUPT] is not None) == ["2,x,surplus", "3", "4,x,y,z", "x,1,2", "x,1,2,11,more"]
