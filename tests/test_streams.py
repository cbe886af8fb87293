from pyspark.sql import functions as F

from sluice.sources import Table
from sluice.sources import write_changes
from sluice.streaming import drop_reread, stream_changes, stream_upsert, with_arrival

SCHEMA = "k bigint, v string, ts timestamp"


def write(spark, rows, path):
    spark.createDataFrame(rows, "k bigint, v string, t string").select(
        "k", "v", F.col("t").cast("timestamp").alias("ts")).coalesce(1).write.mode("append").parquet(path)


def rows_of(table):
    return sorted(((r["k"], r["v"]) for r in table.read().collect()), key=repr)


def test_stream_equals_batch_and_reads_on(spark, folder):
    path = folder + "/in"
    write(spark, [(1, "a", "2024-01-01"), (2, "b", "2024-01-02"), (1, "c", "2024-01-03"), (None, "n", "2024-01-01")], path)
    table = Table(spark, folder + "/t", SCHEMA, ["k"], buckets=2)

    def run(newest=False):
        stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(path)
        stream_upsert(stream, table, ["ts"], folder + "/check", newest=newest).awaitTermination()

    run()
    assert rows_of(table) == [(1, "c"), (2, "b"), (None, "n")]
    run()  # nothing new
    assert rows_of(table) == [(1, "c"), (2, "b"), (None, "n")]
    write(spark, [(1, "late", "2024-01-02"), (3, "d", "2024-01-02")], path)
    run(newest=True)
    assert rows_of(table) == [(1, "c"), (2, "b"), (3, "d"), (None, "n")]
    write(spark, [(1, "arrived", "2024-01-02")], path)
    run()  # without newest the arrival decides
    assert rows_of(table) == [(1, "arrived"), (2, "b"), (3, "d"), (None, "n")]


def test_lost_checkpoint_commit_is_replayed_safely(spark, folder):
    """The same batch id again, as after a crash between merge and checkpoint, changes nothing."""
    table = Table(spark, folder + "/t", SCHEMA, ["k"], buckets=2)
    batch = spark.createDataFrame([(None, "n")], "k bigint, v string").withColumn("ts", F.lit(None).cast("timestamp"))
    assert table.upsert(batch, ["ts"], batch=("stream", 0))
    assert not table.upsert(batch, ["ts"], batch=("stream", 0))
    assert rows_of(table) == [(None, "n")]


def test_arrival_order_in_a_stream(spark, folder):
    path = folder + "/in"
    write(spark, [(1, "first", "2024-01-09"), (1, "second", "2024-01-01")], path)
    table = Table(spark, folder + "/t", SCHEMA, ["k"], buckets=2)
    stream = with_arrival(spark.readStream.schema(SCHEMA).parquet(path))
    stream_upsert(stream, table, ["arrival"], folder + "/check").awaitTermination()
    assert rows_of(table) == [(1, "second")]


def test_reread_rows_come_once(spark, folder):
    path, out = folder + "/in", folder + "/out"
    rows = [(1, "a", "2024-01-01 10:00:00"), (2, "b", "2024-01-01 11:00:00")]

    def run():
        stream = spark.readStream.schema("k bigint, v string, ts timestamp_ntz").parquet(path)
        once = drop_reread(stream, "ts", ["k"], "2 days")
        once.writeStream.format("parquet").option("path", out).option("checkpointLocation", folder + "/c").trigger(
            availableNow=True).start().awaitTermination()
        return sorted(r["k"] for r in spark.read.parquet(out).collect())

    def write_ntz(new):
        spark.createDataFrame(new, "k bigint, v string, t string").select(
            "k", "v", F.col("t").cast("timestamp_ntz").alias("ts")).write.mode("append").parquet(path)

    write_ntz(rows)
    assert run() == [1, 2]
    write_ntz([*rows, (3, "c", "2024-01-01 12:00:00")])
    assert run() == [1, 2, 3]


def test_change_files_as_a_stream(spark, folder):
    schema = "`key.id` bigint, `value.name` string, `meta.ts` timestamp"

    def land(rows, name):
        df = spark.createDataFrame(rows, "`key.id` bigint, `value.name` string, t string")
        write_changes(df.select("`key.id`", "`value.name`", F.col("t").cast("timestamp").alias("meta.ts")).coalesce(1),
                      f"{folder}/in/{name}")

    def run():
        stream = stream_changes(spark, folder + "/in/*", schema, files_per_batch=1)
        stream_upsert(stream, table, ["ts"], folder + "/check", newest=True, prepare=lambda b: b.select(
            F.col("`key.id`").alias("k"), F.col("`value.name`").alias("v"), F.col("`meta.ts`").alias("ts"))
        ).awaitTermination()

    table = Table(spark, folder + "/t", SCHEMA, ["k"], buckets=2)
    land([(1, 'a "quoted"\nline', "2024-01-02"), (2, "b", "2024-01-01")], "one")
    run()
    assert rows_of(table) == [(1, 'a "quoted"\nline'), (2, "b")]
    land([(1, "late", "2024-01-01"), (2, "c", "2024-01-03")], "two")
    land([(2, "late", "2024-01-02")], "three")
    run()
    assert rows_of(table) == [(1, 'a "quoted"\nline'), (2, "c")]


def test_streams_into_one_table_lose_nothing(spark, folder):
    """Two streams, and a new checkpoint of one of them: every row arrives."""
    table = Table(spark, folder + "/t", SCHEMA, ["k"], buckets=2)

    def run(name, checkpoint):
        stream = spark.readStream.schema(SCHEMA).parquet(f"{folder}/{name}")
        stream_upsert(stream, table, ["ts"], f"{folder}/{checkpoint}").awaitTermination()

    write(spark, [(1, "a", "2024-01-01")], folder + "/one")
    write(spark, [(2, "b", "2024-01-01")], folder + "/two")
    run("one", "c1")
    run("two", "c2")
    assert rows_of(table) == [(1, "a"), (2, "b")]
    write(spark, [(3, "c", "2024-01-01")], folder + "/one")
    run("one", "c3")
    assert rows_of(table) == [(1, "a"), (2, "b"), (3, "c")]
    assert len(table._state().sources) == 3
