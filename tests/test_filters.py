import datetime as dt

from pyspark.sql import functions as F

from sluice import operators as O


def ids(df, column="id"):
    return sorted(r[column] for r in df.collect())


def test_since_compares_times_not_text(spark):
    rows = spark.createDataFrame(
        [(1, "2024-01-01T00:00:20Z"), (2, "2024-01-01T00:00:20.123Z"), (3, "2024-01-02T00:00:00Z"), (4, None)],
        "id int, t string").select("id", F.col("t").cast("timestamp").alias("value.t"))
    low, high = "2024-01-01T00:00:20Z", "2024-01-02T00:00:00Z"
    assert ids(O.since(rows, "value.t", low, high)) == [2, 3]
    assert ids(O.since(rows, "value.t", low, inclusive=True)) == [1, 2, 3]
    assert ids(O.since(rows, "value.t", dt.datetime(2024, 1, 1, 0, 0, 20), dt.datetime(2024, 1, 1, 1))) == [2]


def test_since_prunes_date_partitions(spark, folder):
    rows = spark.range(10).select(
        "id", F.expr("timestamp_ntz'2024-01-01 12:00:00' + make_interval(0,0,0,id)").alias("t"))
    rows.withColumn("day", F.col("t").cast("date")).write.partitionBy("day").parquet(folder + "/p")
    found = O.since(spark.read.parquet(folder + "/p"), "t", "2024-01-03 12:00:00", "2024-01-05 12:00:00",
                    date_partition="day")
    assert ids(found) == [3, 4]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in plan and "PushedFilters: [IsNotNull(t), GreaterThan(t" in plan


def test_exclude_text(spark):
    rows = spark.createDataFrame(
        [(1, "A Student", "x"), (2, None, "STUDENTVIEW"), (3, "Teacher", None), (4, None, None)],
        "id int, `value.name` string, b string")
    assert ids(O.exclude_text(rows, "student")) == [3, 4]
    assert ids(O.exclude_text(rows, "3")) == [1, 2, 4]


TERMS = [
    (1, "Standardsemester"), (2, "2024 VÅR"), (3, "2024 HØST"), (4, "2023 HØST-2025 VÅR"), (5, "2024 VÅR-2024 HØST"),
    (6, "2024 HØST-2024 HØST"), (7, "2025 VÅR-2026 HØST"), (8, "ABCD HØST"), (9, "2024HØST"), (10, "Vår 2024"),
    (11, None), (12, "2022 HØST-2024 VÅR"), (13, "8124 VÅR"), (14, "ABCD HØST-2030 VÅR"),
]


def test_active_terms(spark):
    terms = spark.createDataFrame(TERMS, "id int, name string")
    assert ids(O.active_terms(terms, dt.date(2024, 10, 1))) == [3, 4, 5, 6]
    assert ids(O.active_terms(terms, dt.date(2024, 7, 31))) == [2, 4, 5, 12]


def test_active_by_code(spark):
    rows = spark.createDataFrame([
        (1, "UE_203_A_1_2024_HØST", 5), (2, "UE_203_A_1_2024_VÅR", 5), (3, "UE_203_A_1_2024_HØST", 1),
        (4, None, 5), (5, "UE_203_A", 5), (6, "UE_203_A_1_2024_HØST_2", None),
    ], "id int, sis_course_id string, enrollment_term_id int")
    assert ids(O.active_by_code(rows, dt.date(2024, 9, 1))) == [1, 6]


def test_events_and_cutoff(spark):
    rows = spark.createDataFrame([
        (1, "active", "2023-01-01"), (2, "active", "2022-12-31"), (3, "deleted", "2024-01-01"), (4, "active", None),
    ], "id int, workflow_state string, t string").withColumn("start_at", F.col("t").cast("timestamp"))
    assert ids(O.recent_active_events(rows, dt.datetime(2023, 1, 1))) == [1]
    years = spark.createDataFrame([(1, None), (2, 2016), (3, 2017)], "id int, y int")
    assert ids(O.still_taught(years, F.col("y"))) == [1, 3]


def test_quarantine_split(spark):
    texts = ["12", "9223372036854775807", "9223372036854775808", "1.5", "", "x", None, "-3"]
    rows = spark.createDataFrame(list(enumerate(texts)), "id int, `value.n` string")
    split = O.checked(rows, {"value.n": "bigint"})
    assert [(r["id"], r["value.n"]) for r in O.accepted(split).orderBy("id").collect()] == [
        (0, 12), (1, 9223372036854775807), (6, None), (7, -3)]
    bad = O.quarantined(split).orderBy("id").collect()
    assert [(r["id"], r["raw"]["value.n"], r["bad_columns"]) for r in bad] == [
        (i, texts[i], ["value.n"]) for i in (2, 3, 4, 5)]
    flags = rows.select(O.valid_bigint(O.quoted("value.n"))).collect()
    assert [r[0] for r in flags] == [True, True, False, False, False, False, False, True]


def test_plain_and_fill(spark):
    rows = spark.createDataFrame([(1, None, None)], "`key.id` int, `value.name` string, `value.n` int")
    assert O.plain(rows, ["key.id", "value.name", "value.n"]).columns == ["id", "name", "n"]
    assert O.plain(rows, {"key.id": "course"}).columns == ["course"]
    assert tuple(O.fill_text(rows).first()) == (1, "", None)


def test_union_frames(spark):
    a = spark.createDataFrame([(1, "x")], "id int, a string")
    b = spark.createDataFrame([("y", 2)], "b string, id int")
    empty = spark.createDataFrame([], "id int, a string")
    found = O.union_frames([a, empty, b])
    assert found.columns == ["id", "a", "b"]
    assert sorted(tuple(r) for r in found.collect()) == [(1, "x", None), (2, None, "y")]
