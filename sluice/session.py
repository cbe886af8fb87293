"""Session helpers: where intermediate tables may live, and a local session for tests and benches."""

from __future__ import annotations

import os
import tempfile
import uuid
from functools import cache

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it in ``spark.checkpoint.dir``.

    A machine-local folder is only ever used when Spark itself runs inside one machine.
    """
    named = spark.conf.get(CHECKPOINT_KEY, None) or spark.sparkContext.getConf().get(CHECKPOINT_KEY, None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_KEY} to a folder shared by all executors")
    return _own_dir(spark.sparkContext.applicationId)


@cache
def _own_dir(application: str) -> str:
    """One temporary folder for all that a local application without a named folder writes."""
    return tempfile.mkdtemp(prefix="sluice-")


def new_path(spark: SparkSession, name: str) -> str:
    """A path nobody else uses, below the shared folder."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def settled(df: DataFrame, name: str, compression: str | None = None) -> DataFrame:
    """The same rows, written once below the shared folder and read back.

    Worth it for a result that is small but that the planner cannot know to be small (an aggregate,
    say): read back, its size is that of its files, and Spark broadcasts it only if that is below
    the session's threshold. The other side of a join is then not shuffled in vain. ``compression``
    names a codec other than the session's, for rows that are wide.
    """
    path = new_path(df.sparkSession, name)
    df.write.parquet(path, compression=compression)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def local_session(app: str = "sluice", cpus: str | int | None = None) -> SparkSession:
    """A single-machine session, as used by the tests and ``bench.py``."""
    cpus = cpus or os.environ.get("BENCH_CPUS", "8")
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("SLUICE_DRIVER_MEMORY", "8g"))
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
