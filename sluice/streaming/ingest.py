"""Incremental ingestion with Structured Streaming.

The file source remembers which files it has read, so its checkpoint takes the place of the saved
watermark: each run with ``availableNow`` reads what arrived since the run before.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..operators.filters import accepted, checked, quarantined, quoted
from ..session import settled
from ..sources.change_files import ARRIVAL, CORRUPT, CSV_OPTIONS, schema_of
from ..sources.snapshots import RECORD
from ..sources.tables import Table


def stream_changes(spark: SparkSession, path: str, schema: str | T.StructType,
                   files_per_batch: int | None = None) -> DataFrame:
    """Change files of a folder as a stream; ``schema`` has the columns of the files, in their order.

    With ``files_per_batch`` a long backlog is worked off in steps of so many files.
    """
    reader = spark.readStream.schema(schema).options(**CSV_OPTIONS)
    return (reader.option("maxFilesPerTrigger", files_per_batch) if files_per_batch else reader).csv(path)


def stream_texts(spark: SparkSession, path: str, schema: str | T.StructType, files_per_batch: int | None = None) -> DataFrame:
    """Change files of a folder as a stream of the texts that arrived, with ``arrival`` and ``CORRUPT``.

    For streams that must lose no row: ``stream_checked`` casts the texts to ``schema`` and puts aside
    what does not fit.
    """
    texts = T.StructType([T.StructField(f.name, T.StringType()) for f in schema_of(schema).fields]).add(CORRUPT, T.StringType())
    return with_arrival(stream_changes(spark, path, texts, files_per_batch))


def stream_id(spark: SparkSession, checkpoint: str) -> str:
    """The id that Spark gave the stream of a checkpoint, and keeps over restarts."""
    return json.loads(spark.read.text(f"{checkpoint.rstrip('/')}/metadata", wholetext=True).first()[0])["id"]


def drop_reread(stream: DataFrame, ts: str, keys: Sequence[str], overlap: str) -> DataFrame:
    """Each key once, although slices overlap by up to ``overlap`` (such as ``36 hours``).

    State is kept for that long only. Rows later than that are dropped by the watermark; where such
    rows matter, leave this out: an upsert by key is repeatable and needs no de-duplication.
    """
    timed = stream.withColumn(ts, quoted(ts).cast("timestamp"))
    return timed.withWatermark(ts, overlap).dropDuplicatesWithinWatermark(list(keys))


def stream_upsert(stream: DataFrame, table: Table, order: Sequence[str], checkpoint: str, *,
                  newest: bool = False, null_keys: str = "insert",
                  prepare: Callable[[DataFrame], DataFrame] | None = None) -> StreamingQuery:
    """Merge everything that has arrived into ``table``, batch by batch, then stop.

    A batch is known by the id that the checkpoint holds and by its number there, so one that is
    replayed after a failure is skipped if it was merged, and no other ever is: streams into one
    table do not take each other's batches for theirs, and a stream with a new checkpoint merges all
    it reads. With ``newest`` a late, older version never replaces a newer row; without it, the
    arrival of the batches decides, and ``order`` settles repeats inside a batch.
    """

    def merge(batch: DataFrame, epoch: int) -> None:
        rows = prepare(batch) if prepare else batch
        ranked = list(order)
        if ARRIVAL in ranked:  # the place inside a file can only be told inside a batch
            rows = rows.withColumn("_row", F.monotonically_increasing_id())
            ranked.insert(ranked.index(ARRIVAL) + 1, "_row")
        batch = (stream_id(table.spark, checkpoint), epoch)
        table.upsert(rows, ranked, batch=batch, newest=newest, null_keys=null_keys)

    return (
        stream.writeStream.foreachBatch(merge)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def put_aside(rows: DataFrame, path: str, stream: str, epoch: int) -> None:
    """Writes the bad rows of a batch below the names of its stream and number: a replay replaces them."""
    if not rows.isEmpty():
        rows.withColumnRenamed(CORRUPT, RECORD).write.mode("overwrite").json(f"{path}/stream={stream}/batch={epoch}")


def stream_checked(stream: DataFrame, schema: str | T.StructType, table: Table, order: Sequence[str], checkpoint: str,
                   quarantine: str, *, newest: bool = False, null_keys: str = "insert",
                   prepare: Callable[[DataFrame], DataFrame] | None = None) -> StreamingQuery:
    """Like ``stream_upsert`` for a stream of ``stream_texts``; no row is lost to a value that cannot be read.

    Each batch is cast to ``schema`` once. Rows that fit go on to ``prepare`` and into ``table``. Records
    that do not fit the header, and rows with a value that cannot be read, go to the folder ``quarantine`` as
    JSON with their texts (``raw``, and ``record`` where the fields do not fit), file and faults (``bad_columns``). Both sinks know a batch by the id in the
    checkpoint and its number: a replay replaces the one's rows and is skipped by the other, so the
    rows of both add up to what came in. The bad side is written first; a batch is in the table only
    if its bad rows are in their place.
    """
    kind = schema_of(schema)
    casts = {f.name: f.dataType.simpleString() for f in kind.fields if f.dataType.typeName() != "string"}

    def merge(batch: DataFrame, epoch: int) -> None:
        name = stream_id(table.spark, checkpoint)
        marked = batch.withColumn("_row", F.monotonically_increasing_id())
        rows = settled(checked(marked, casts), "batch")
        unfit = F.col(CORRUPT).isNotNull()
        fault = F.when(unfit, F.array(F.lit("record"))).otherwise(F.col("bad_columns"))
        put_aside(quarantined(rows.withColumn("bad_columns", fault)).drop("_row"), quarantine, name, epoch)
        good = accepted(rows.filter(~unfit)).drop(CORRUPT)
        ranked = list(order)
        if ARRIVAL in ranked:  # the place inside a file can only be told inside a batch
            ranked.insert(ranked.index(ARRIVAL) + 1, "_row")
        else:
            good = good.drop("_row")
        ready = prepare(good) if prepare else good
        table.upsert(ready, [c for c in ranked if c != "_row" or c in ready.columns], batch=(name, epoch), newest=newest, null_keys=null_keys)

    return (
        stream.writeStream.foreachBatch(merge)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def with_arrival(stream: DataFrame) -> DataFrame:
    """Adds ``arrival`` to a file stream: which file a row came with.

    Naming it in the ``order`` of ``stream_upsert`` settles repeats as the rows came.
    """
    place = F.struct(F.col("_metadata.file_modification_time").alias("time"), F.col("_metadata.file_path").alias("file"))
    return stream.select(*[quoted(c) for c in stream.columns], place.alias(ARRIVAL))
