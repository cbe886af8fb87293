"""Watermarks and run metrics."""

from __future__ import annotations

import datetime as dt
import threading
import time
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions.times import yesterday
from .tables import Table

#: Seconds that a count may take to reach the driver after the action that made it.
GRACE_S = 2.0
METRICS = "stage string, seconds double, rows bigint"


def control_table(spark: SparkSession, base: str) -> Table:
    return Table.target(spark, base, "watermark", buckets=1)


def get_watermark(control: Table, name: str, as_of: dt.datetime) -> dt.datetime:
    """Until when ``name`` was read; the day before ``as_of`` when it never was."""
    saved = F.col("sist_oppdatert").cast("string")  # as text, so that only the session's time zone counts
    row = control.read().filter(F.col("tabell") == name).select(saved).first()
    return dt.datetime.fromisoformat(row[0]) if row and row[0] else yesterday(as_of)


def set_watermark(control: Table, name: str, until: dt.datetime) -> None:
    """Save a moment, whatever was saved before: for whoever wants a slice to be read again."""
    control.upsert(_line(control, name, until), ["sist_oppdatert"])


def advance_watermark(control: Table, name: str, until: dt.datetime) -> None:
    """Save the end of the slice that was read, unless a later one is saved: a job run again over an
    older slice does not make the next one read again what lies between. Call it after the data is
    written, so that a failure in between repeats the slice instead of losing it."""
    control.upsert(_line(control, name, until), ["sist_oppdatert"], newest=True)


def _line(control: Table, name: str, until: dt.datetime) -> DataFrame:
    return control.spark.range(1, numPartitions=1).select(
        F.lit(name).alias("tabell"), F.lit(until.isoformat()).cast("timestamp").alias("sist_oppdatert"))


def watermarks_or_default(names: DataFrame, control: DataFrame, as_of: dt.datetime) -> DataFrame:
    """Every name with its watermark, or the default where it has none."""
    found = names.join(control, "tabell", "left")
    kind = control.schema["sist_oppdatert"].dataType
    default = F.lit(yesterday(as_of).isoformat()).cast(kind)
    return found.select("tabell", F.coalesce("sist_oppdatert", default).alias("sist_oppdatert"))


class RunMetrics:
    """Seconds and row counts of the stages of a run, counted while the data passes."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.lines: list[tuple[str, float, int | None]] = []
        self._saved = 0

    @contextmanager
    def stage(self, name: str) -> Iterator[_Stage]:
        started = time.perf_counter()
        stage = _Stage(name)
        yield stage
        seconds = time.perf_counter() - started
        self.lines.append((name, seconds, stage.rows()))

    def frame(self) -> DataFrame:
        return self.spark.createDataFrame(self.lines, METRICS)

    def save(self, path: str) -> None:
        """Append the stages that are not saved yet to the metrics table; one line per stage."""
        new = self.lines[self._saved:]
        self._saved = len(self.lines)
        if new:
            self.spark.createDataFrame(new, METRICS).coalesce(1).write.mode("append").option("header", True).csv(path)


class _Stage:
    def __init__(self, name: str):
        self._name = name
        self._seen: Observation | None = None
        self._given: int | None = None

    def watch(self, df: DataFrame, *more: Column) -> DataFrame:
        """The same rows, counted by the action that consumes them."""
        self._seen = Observation(self._name)
        return df.observe(self._seen, F.count(F.lit(1)).alias("rows"), *more)

    def counted(self, rows: int) -> None:
        """A count that is known already."""
        self._given = rows

    def rows(self) -> int | None:
        """The count, or NULL if no action has consumed the watched rows; it never waits for one.

        Counts reach the driver just after an action, so one that is still on its way is waited for
        for a moment only.
        """
        if self._given is not None or self._seen is None:
            return self._given
        got: list[int] = []
        waiter = threading.Thread(target=lambda: got.append(self._seen.get["rows"]), daemon=True)
        waiter.start()
        waiter.join(GRACE_S)
        return got[0] if got else None
