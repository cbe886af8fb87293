import datetime as dt

from pyspark.sql import functions as F

from sluice import operators as O


def test_recent_users(spark):
    users = spark.createDataFrame(
        [(1, "2024-01-10"), (2, "2024-01-01"), (3, None), (4, "2024-01-10"), (5, None), (1, "2024-01-01"), (None, None)],
        "user_id int, t string").select("user_id", F.col("t").cast("timestamp").alias("last_login"))
    activity = spark.createDataFrame(
        [(1, None), (1, None), (2, "2024-01-09"), (3, "2024-01-10"), (3, "2024-01-01"), (5, "2024-01-01"), (6, "2024-01-10"),
         (None, "2024-01-10")],
        "user_id int, t string").select("user_id", F.col("t").cast("timestamp").alias("last_activity_at"))
    as_of = dt.datetime(2024, 1, 11)
    found = O.recent_users(users, activity, as_of - dt.timedelta(days=4), as_of - dt.timedelta(days=1, hours=12))
    # 1 logged in, 3 was active without any login; 4 has no activity record, 2 and 5 are too old, 6 is no user
    assert sorted(r[0] for r in found.collect()) == [1, 3]


def test_recent_users_equals_outer_join_form(spark):
    users = spark.range(200).select(F.col("id").alias("user_id"), F.when(F.col("id") % 3 != 0, F.expr(
        "timestamp'2024-01-01' + make_interval(0,0,0,cast(id % 20 as int))")).alias("last_login"))
    activity = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 230).alias("user_id"),
        F.when(F.col("id") % 5 != 0, F.expr("timestamp'2024-01-01' + make_interval(0,0,0,cast(id % 17 as int))")).alias(
            "last_activity_at"))
    low, high = dt.datetime(2024, 1, 15), dt.datetime(2024, 1, 16)
    users.createOrReplaceTempView("u")
    activity.createOrReplaceTempView("a")
    wanted = spark.sql("""select distinct u.user_id from u left join a on a.user_id = u.user_id
        where a.user_id is not null and (last_login > timestamp'2024-01-15' or last_activity_at > timestamp'2024-01-16')""")
    found = O.recent_users(users, activity, low, high)
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, wanted.collect()))


def test_membership_does_not_multiply(spark):
    courses = spark.createDataFrame([(1, 10), (2, 11), (3, None), (4, 10)], "course_id int, enrollment_term_id int")
    terms = spark.createDataFrame([(10,), (10,), (None,)], "term_id int")
    running = O.in_active_terms(courses, terms)
    assert sorted(r["course_id"] for r in running.collect()) == [1, 4]
    pages = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (None, "d")], "course_id int, body string")
    assert sorted(r["body"] for r in O.of_courses(pages, running).collect()) == ["a", "b"]
    counted = O.rows_per_course(running, pages)
    assert sorted(map(tuple, counted.collect())) == [(1, 2), (4, 0)]


def test_lookup_keeps_every_row(spark):
    rows = spark.createDataFrame([(1, "a"), (2, "b"), (None, "c"), (1, "d")], "user_id int, x string")
    ids = spark.createDataFrame([(1, "s1"), (None, "no")], "user_id int, sis_user_id string")
    found = O.lookup(rows, ids, "user_id")
    assert found.columns == ["user_id", "x", "sis_user_id"]
    assert sorted(((r[1], r[2]) for r in found.collect())) == [("a", "s1"), ("b", None), ("c", None), ("d", "s1")]


def test_legacy_calendar(spark):
    terms = spark.createDataFrame(
        [(1, "2024 HØST"), (2, "2024 VÅR"), (3, "2023 HØST-2025 HØST"), (4, "other"), (5, "2023 HØST")],
        "term_id int, name string")
    courses = spark.createDataFrame([
        (9, 1, "UE_203_A", "available"), (8, 3, "ua_203_B", "completed"), (7, 1, "UE_203_A", "unpublished"),
        (6, 1, "UEx203_A", "available"), (5, 1, "XX_203_A", "available"), (4, 4, "UE_203_A", "available"),
        (3, 2, "UE_203_A", "available"), (2, 5, "UE_203_A", "available"), (1, 1, "UE_203_A", None), (9, 1, "UE_203_A", "x"),
    ], "course_id int, enrollment_term_id int, sis_course_id string, workflow_state string")
    found = O.legacy_calendar(courses, terms, dt.date(2024, 9, 1))
    assert [r[0] for r in found.collect()] == [6, 8, 9]


def test_top_rows(spark):
    rows = spark.range(100, numPartitions=4)
    assert [r[0] for r in O.top_rows(rows, [F.desc("id")], 3).collect()] == [99, 98, 97]
    try:
        O.top_rows(rows, [], 3)
    except ValueError:
        return
    raise AssertionError("an order is required")
