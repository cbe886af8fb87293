"""Dated CSV snapshots."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.times import stamp_date
from ..operators.filters import quoted
from .change_files import CORRUPT, read_changes

MANIFEST = "columns array<string>, rows bigint, checksum string, records bigint, records_checksum string"
RECORD = "record"


#: Blanks at either end of a value are part of it.
AS_IS = {"ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}


class SnapshotDiffers(RuntimeError):
    """A snapshot that does not hold what its manifest says."""


def snapshot_path(base: str, until: str | dt.datetime, *, whole_stamp: bool = True) -> str:
    """Folder of a snapshot: named by the whole stamp of ``until``, or by its date alone."""
    stamp = until.isoformat() if isinstance(until, dt.datetime) else until
    name = stamp.replace(":", "-") if whole_stamp else stamp_date(stamp)
    return f"{base}/{'stamp' if whole_stamp else 'date'}={name}"


def write_snapshot(df: DataFrame, base: str, until: str | dt.datetime, *, whole_stamp: bool = True) -> str:
    """Write the rows with a header line.

    A second run for the same stamp replaces the first; two slices of one date stand side by side.
    Only with ``whole_stamp=False`` is there one snapshot a date.
    """
    path = snapshot_path(base, until, whole_stamp=whole_stamp)
    df.write.mode("overwrite").options(**AS_IS).option("header", True).option("escape", '"').option(
        "timestampFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX").csv(path)
    return path


def read_snapshot(spark: SparkSession, path: str, schema: str | T.StructType) -> DataFrame:
    return read_changes(spark, path, schema)


def order_free(columns: list[Column]) -> Column:
    """A checksum of all rows that does not depend on their order or places: the sum of a hash of each.

    Every value is marked as present or not, since the hash passes over NULL.
    """
    marked = [F.coalesce(F.concat(F.lit("="), c.cast("string")), F.lit("-")) for c in columns]
    return F.coalesce(F.sum(F.xxhash64(*marked).cast("decimal(38,0)")), F.lit(0).cast("decimal(38,0)")).cast("string")


def _sums(df: DataFrame) -> tuple[int, str]:
    return tuple(df.agg(F.count(F.lit(1)), order_free([quoted(c) for c in df.columns])).first())


def _beside(path: str, what: str) -> str:
    base, name = path.rsplit("/", 1)
    return f"{base}_{what}/{name}"


def proved_snapshot(texts: DataFrame, base: str, until: str | dt.datetime) -> str:
    """A snapshot of texts as they arrived, with a manifest, read back and compared before it counts.

    ``texts`` has text columns only and, from ``read_texts``, ``CORRUPT``: records whose fields do not fit
    the header. Those are kept whole, as raw text, in ``<base>_records``; the rows are at the path
    that is returned, as in ``write_snapshot``. ``<base>_manifest`` has the columns, the number of rows
    and of records and an order-free checksum of each, taken from the input. A run for the same
    stamp replaces the first. ``SnapshotDiffers`` is raised if the files do not give the same sums.
    """
    path = snapshot_path(base, until)
    spark = texts.sparkSession
    unfit = F.col(CORRUPT).isNotNull() if CORRUPT in texts.columns else F.lit(False)
    rows = texts.filter(~unfit).drop(CORRUPT)
    records = texts.filter(unfit).select((F.col(CORRUPT) if CORRUPT in texts.columns else F.lit(None).cast("string")).alias(RECORD))
    line = spark.createDataFrame([(rows.columns, *_sums(rows), *_sums(records))], MANIFEST)
    write_snapshot(rows, base, until)
    records.write.mode("overwrite").json(_beside(path, "records"))
    line.coalesce(1).write.mode("overwrite").json(_beside(path, "manifest"))
    verify_snapshot(spark, path)
    return path


def snapshot_records(spark: SparkSession, path: str) -> DataFrame:
    """The raw records of a proved snapshot that did not fit its header."""
    return spark.read.schema(f"{RECORD} string").json(_beside(path, "records"))


def verify_snapshot(spark: SparkSession, path: str) -> None:
    """Compares the files of a proved snapshot with its manifest; raises ``SnapshotDiffers``."""
    said = spark.read.schema(MANIFEST).json(_beside(path, "manifest")).first()
    texts = T.StructType([T.StructField(c, T.StringType()) for c in said["columns"]])
    for what, found, told in (("rows", _sums(read_snapshot(spark, path, texts)), (said["rows"], said["checksum"])),
                              ("records", _sums(snapshot_records(spark, path)), (said["records"], said["records_checksum"]))):
        if found != told:
            raise SnapshotDiffers(f"{path}: {what} are {found}, the manifest says {told}")
