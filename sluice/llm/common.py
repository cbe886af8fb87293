"""What the operators share: words, intermediate tables, free column names and Arrow batches."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from functools import cache
from pathlib import Path
from zipfile import ZipFile

import pyarrow as pa
from pyspark import SparkContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

import sluice
from sluice.session import new_path

#: Words are runs of anything but these six characters; ``bytes.split()`` cuts at the same ones.
WORD_SQL = r"[^\x20\x09-\x0D]+"

#: Rows in one Arrow batch at most, so that a batch of long texts stays small.
BATCH_ROWS = 512


def n_words(text: Column) -> Column:
    """Number of words of a text; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD_SQL)), F.lit(0)).cast("long")


def stored(df: DataFrame, name: str) -> DataFrame:
    """The rows of ``df``, written once to the shared folder and read back.

    It cuts the lineage like a reliable checkpoint: a lost executor costs a new read, not a new
    computation, and columnar files are smaller than checkpointed rows.
    """
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def without_summary(model, spark: SparkSession):
    """A fitted ML model, written to the shared folder and loaded again: what it learnt, and no more.

    A fresh model carries the summary of its training and through it the session, which cannot be
    sent to executors once the session has observed a query.
    """
    path = new_path(spark, "model")
    model.write().save(path)
    return type(model).load(path)


def free(df: DataFrame, name: str) -> str:
    """A column name that ``df`` does not have (Spark compares names without case)."""
    taken = {c.lower() for c in df.columns}
    return name if name.lower() not in taken else f"{name}_{uuid.uuid4().hex[:8]}"


@cache
def _ship(context: SparkContext) -> None:
    """Sends the package to the Python workers, once for a context.

    The archive lies with the driver, whose file server hands it out as long as the application runs.
    """
    root = Path(sluice.__file__).parent
    archive = f"{tempfile.mkdtemp(prefix='sluice-')}/sluice.zip"
    with ZipFile(archive, "w") as file:
        for path in sorted(root.rglob("*.py")):
            file.write(path, Path(root.name) / path.relative_to(root))
    context.addPyFile(archive)


def ready_for_python(spark: SparkSession) -> None:
    """Call before rows go to Python. Workers find this package wherever the driver found it, and Arrow
    batches hold ``BATCH_ROWS`` rows at most, so that a batch of very long texts fits a worker."""
    _ship(spark.sparkContext)
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= BATCH_ROWS:
        spark.conf.set(key, str(BATCH_ROWS))


def map_texts(
    df: DataFrame,
    text: str,
    keep: list[str],
    added: T.StructType,
    start: Callable[[], Callable[[list[str | None]], list[pa.Array]]],
) -> DataFrame:
    """Rows with the ``keep`` columns and columns computed from a text, in Arrow batches.

    ``start`` runs once per task and returns the function from a batch's texts to its new columns.
    A kept column with the name of an added one is dropped, whatever its case.
    """
    ready_for_python(df.sparkSession)
    new = {f.name.lower() for f in added.fields}
    keep = [c for c in keep if c.lower() not in new]
    value = free(df, "__text")
    source = df.select(*(F.col(f"`{c}`") for c in keep), F.col(f"`{text}`").alias(value))
    fields = [source.schema[c] for c in keep] + list(added.fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = start()
        for batch in batches:
            columns = work(batch.column(len(keep)).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [batch.column(i) for i in range(len(keep))] + columns,
                names=keep + [f.name for f in added.fields])

    return source.mapInArrow(run, T.StructType(fields))
