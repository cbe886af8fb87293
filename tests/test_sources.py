import datetime as dt
import gzip
import json
import os

import pytest
from pyspark.sql import functions as F

from sluice import sources as S
from sluice.schemas import CHANGE_FILES, PAGES, TARGETS

SCHEMA = "`key.id` bigint, `value.name` string, `value.n` double, `value.t` timestamp"
HEADER = "key.id,value.name,value.n,value.t\n"


def gz(folder, name, text):
    os.makedirs(folder, exist_ok=True)
    path = os.path.join(folder, name)
    with gzip.open(path, "wt", encoding="utf-8") as f:
        f.write(text)
    return path


def test_change_files(spark, folder):
    a = gz(folder, "a.csv.gz", HEADER + '1,"two\nlines, ""quoted""",5236.0,2024-10-30T08:18:48.838Z\n2,,,\n')
    b = gz(folder, "b.csv.gz", HEADER)
    c = gz(folder, "c.csv.gz", HEADER + '3,"",7,2024-10-30 08:18:48\n')
    rows = S.read_changes(spark, [a, b, c], SCHEMA).select(
        "`key.id`", "`value.name`", "`value.n`", F.col("`value.t`").cast("string"))
    assert sorted((tuple(r) for r in rows.collect())) == [
        (1, 'two\nlines, "quoted"', 5236.0, "2024-10-30 08:18:48.838"), (2, None, None, None),
        (3, None, 7.0, "2024-10-30 08:18:48")]


def test_change_files_by_header(spark, folder):
    a = gz(folder, "a.csv.gz", "value.extra,value.name,key.id\nx,n1,1\n")
    rows = S.read_changes(spark, folder, SCHEMA)
    assert rows.columns == ["key.id", "value.name", "value.n", "value.t"]
    assert [tuple(r) for r in rows.collect()] == [(1, "n1", None, None)]
    b = gz(folder, "b.csv.gz", HEADER + "2,n2,1.5,\n")
    with pytest.raises(Exception, match="header|schema"):
        S.read_changes(spark, [a, b], SCHEMA).collect()
    mixed = S.read_mixed(spark, [a, b], SCHEMA)
    assert sorted(tuple(r) for r in mixed.collect()) == [(1, "n1", None, None), (2, "n2", 1.5, None)]


def test_no_files_give_an_empty_frame(spark, folder):
    for rows in (S.read_changes(spark, [], SCHEMA), S.read_changes(spark, folder, SCHEMA), S.read_mixed(spark, [], SCHEMA)):
        assert rows.columns == ["key.id", "value.name", "value.n", "value.t"] and rows.count() == 0
    assert "arrival" in S.read_changes(spark, [], SCHEMA, with_arrival=True).columns


def test_arrival_follows_the_files(spark, folder):
    a = gz(folder, "a.csv.gz", HEADER + "1,first,,\n1,second,,\n")
    b = gz(folder, "b.csv.gz", HEADER + "1,third,,\n")
    os.utime(a, (1000, 1000))
    os.utime(b, (2000, 2000))
    rows = S.read_changes(spark, [b, a], SCHEMA, with_arrival=True).orderBy("arrival")
    assert [r["value.name"] for r in rows.collect()] == ["first", "second", "third"]


def test_column_subset(spark, folder):
    path = gz(folder, "u.csv.gz", "user_id,sis_user_id\n1,a\n2,\n")
    rows = S.read_columns(spark, path, "user_id bigint, sis_user_id string", ["user_id"])
    assert [r[0] for r in rows.collect()] == [1, 2]
    assert "ReadSchema: struct<user_id:bigint>" in rows._jdf.queryExecution().executedPlan().toString()


def test_schemas_parse():
    from sluice.sources.change_files import schema_of

    assert len(schema_of(CHANGE_FILES["pseudonyms"]).fields) == 22
    assert len(schema_of(CHANGE_FILES["users"]).fields) == 24
    assert len(schema_of(CHANGE_FILES["accounts"]).fields) == 20
    assert len(schema_of(CHANGE_FILES["access_tokens"]).fields) == 11
    for keys, ddl in TARGETS.values():
        assert set(keys) <= set(schema_of(ddl).names)
    for ddl, nodes in PAGES.values():
        kind = schema_of(ddl)
        for step in nodes.split("."):
            kind = kind[step].dataType


def land(folder, name, page):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w", encoding="utf-8") as f:
        json.dump(page, f, ensure_ascii=False, indent=1)


def rights(plnr, programme):
    return {"personProfil": plnr and {"personlopenummer": plnr}, "studieprogram": {"kode": programme}}


def connection(nodes, more, cursor=None):
    return {"data": {"programStudieretter": {"pageInfo": {"endCursor": cursor, "hasNextPage": more}, "nodes": nodes}}}


def test_pages(spark, folder):
    land(folder, "p1.json", connection([rights("1", "A"), None, rights("2", "B")], True, "c1"))
    land(folder, "p2.json", connection([rights(None, "C")], False))
    land(folder, "p3.json", connection([], False))
    land(folder, "p4.json", {"errors": [{"message": "no"}]})
    nodes = S.read_nodes(spark, folder, "programme_rights")
    assert nodes.columns == ["arrival", "place", "node"]
    found = nodes.orderBy("arrival", "place").select("node.personProfil.personlopenummer", "node.studieprogram.kode")
    assert sorted(map(tuple, found.collect()), key=repr) == [("1", "A"), ("2", "B"), (None, "C")]


def test_page_check(spark):
    pages = spark.createDataFrame([
        ("whole", 1, True, 5, False), ("whole", 2, True, 5, False), ("whole", 2, True, 5, False), ("whole", 3, False, 1, False),
        ("gap", 1, True, 5, False), ("gap", 3, False, 5, False),
        ("open", 1, True, 5, False),
        ("failed", 1, True, 5, False), ("failed", 2, None, None, True),
        ("empty end", 1, None, 5, False), ("empty end", 2, None, 0, False),
    ], "s string, p int, more boolean, n int, failed boolean")
    found = S.check_pages(pages, F.col("p"), page_set=F.col("s"), has_next=F.col("more"), size=F.col("n"),
                          failed=F.col("failed"))
    by_set = {r["page_set"]: r for r in found.collect()}
    assert {s: r["complete"] for s, r in by_set.items()} == {
        "whole": True, "gap": False, "open": False, "failed": False, "empty end": True}
    assert (by_set["whole"]["pages_seen"], by_set["gap"]["gaps"], by_set["failed"]["failed_page"]) == (3, 1, 2)
    assert by_set["empty end"]["end_page"] == 2


def test_snapshots(spark, folder):
    rows = spark.createDataFrame([(1, 'a "b"\nc'), (2, None)], "id bigint, name string")
    assert S.snapshot_path("x", dt.datetime(2024, 10, 30, 8), whole_stamp=False) == "x/date=2024-10-30"
    assert S.snapshot_path("x", "2024-10-23T08:18:48Z") == "x/stamp=2024-10-23T08-18-48Z"
    for _ in range(2):
        path = S.write_snapshot(rows, folder + "/snap", "2024-10-30T08:00:00Z")
    assert sorted(map(tuple, S.read_snapshot(spark, path, rows.schema).collect())) == [(1, 'a "b"\nc'), (2, None)]


def test_a_watermark_only_advances(spark, folder):
    control = S.control_table(spark, folder)
    late, early, as_of = dt.datetime(2024, 3, 1, 8, 30), dt.datetime(2024, 2, 1), dt.datetime(2024, 3, 1, 9)
    S.advance_watermark(control, "users", early)  # nothing saved yet: earlier than the default is saved too
    assert S.get_watermark(control, "users", as_of) == early
    for until in (late, early, late):
        S.advance_watermark(control, "users", until)
        assert S.get_watermark(control, "users", as_of) == late
    assert control.read().count() == 1


def test_watermarks(spark, folder):
    control = S.control_table(spark, folder)
    as_of = dt.datetime(2024, 3, 1, 9)
    assert S.get_watermark(control, "users", as_of) == dt.datetime(2024, 2, 29)
    S.set_watermark(control, "users", dt.datetime(2024, 3, 1, 8, 30))
    S.set_watermark(control, "roles", dt.datetime(2024, 1, 1))
    S.set_watermark(control, "users", dt.datetime(2024, 2, 1))  # the last save counts, not the greatest
    assert S.get_watermark(control, "users", as_of) == dt.datetime(2024, 2, 1)
    names = spark.createDataFrame([("users",), ("accounts",)], "tabell string")
    found = S.watermarks_or_default(names, control.read(), as_of)
    assert sorted(map(tuple, found.select("tabell", F.col("sist_oppdatert").cast("string")).collect())) == [
        ("accounts", "2024-02-29 00:00:00"), ("users", "2024-02-01 00:00:00")]


def test_run_metrics(spark, folder):
    metrics = S.RunMetrics(spark)
    with metrics.stage("read") as stage:
        stage.watch(spark.range(7)).write.format("noop").mode("overwrite").save()
    with metrics.stage("wait"):
        pass
    metrics.save(folder + "/m")
    found = spark.read.schema("stage string, seconds double, rows bigint").option("header", True).csv(folder + "/m")
    assert sorted((r["stage"], r["rows"], r["seconds"] >= 0) for r in found.collect()) == [
        ("read", 7, True), ("wait", None, True)]


def test_shared_folder_comes_from_the_session(spark):
    from types import SimpleNamespace

    from sluice.session import CHECKPOINT_KEY, new_path, shared_dir

    named = spark.conf.get(CHECKPOINT_KEY, None)
    assert new_path(spark, "x") != new_path(spark, "x")
    assert named is None or new_path(spark, "x").startswith(named)

    def session(master, folder):
        conf = SimpleNamespace(get=lambda key, default: folder)
        nothing = SimpleNamespace(get=lambda key, default: default)
        return SimpleNamespace(conf=conf, sparkContext=SimpleNamespace(
            master=master, getConf=lambda: nothing, applicationId="app-1"))

    assert shared_dir(session("yarn", "hdfs://x/check/")) == "hdfs://x/check"
    with pytest.raises(RuntimeError):
        shared_dir(session("yarn", None))
    assert os.path.isdir(shared_dir(session("local[2]", None)))


def test_mixed_headers_keep_their_arrival(spark, folder):
    a = gz(folder, "a.csv.gz", "value.name,key.id\nfirst,1\nsecond,1\n")
    b = gz(folder, "b.csv.gz", HEADER + "1,third,,\n")
    os.utime(a, (2000, 2000))
    os.utime(b, (1000, 1000))
    rows = S.read_mixed(spark, [a, b], SCHEMA, with_arrival=True)
    assert [r["value.name"] for r in rows.orderBy("arrival").collect()] == ["third", "first", "second"]
    assert "arrival" in S.read_mixed(spark, [], SCHEMA, with_arrival=True).columns


def test_unread_counts_do_not_block(spark):
    import time

    metrics = S.RunMetrics(spark)
    started = time.perf_counter()
    with metrics.stage("no action") as stage:
        stage.watch(spark.range(3))
    with metrics.stage("none") as stage:
        stage.counted(7)
    assert [x[2] for x in metrics.lines] == [None, 7] and time.perf_counter() - started < 10


def test_bounds_with_an_offset_meet_columns_without_zone(spark):
    from sluice import operators as O

    rows = spark.sql("select timestamp_ntz'2024-01-01 09:00:00' as ts")
    zone = dt.timezone(dt.timedelta(hours=2))
    assert O.since(rows, "ts", dt.datetime(2024, 1, 1, 10, tzinfo=zone)).count() == 1
    assert O.since(rows, "ts", dt.datetime(2024, 1, 1, 12, tzinfo=zone)).count() == 0


def test_local_folder_is_one_per_session():
    from sluice.session import _own_dir

    assert _own_dir("app-2") == _own_dir("app-2") != _own_dir("app-3")
