"""Time stamps, watermarks and numeric clean-up."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def parse_time(text: Column) -> Column:
    """ISO-8601 text to TIMESTAMP; anything else (also the text ``None``) gives NULL."""
    return F.try_to_timestamp(text)


def whole_number(value: Column) -> Column:
    """NULL to 0, then cut to a whole number."""
    return F.coalesce(value, F.lit(0.0)).cast("bigint")


def parse_whole(text: Column, kind: str = "bigint") -> Column:
    """Whole number in a text, or NULL where there is none or it does not fit.

    The text is looked at before it is cast: a failing cast raises and catches an exception for
    every row, which costs ten times as much as the row itself.
    """
    low, high = (-(2**31), 2**31 - 1) if kind == "int" else (-(2**63), 2**63 - 1)
    short = F.when(text.rlike(r"^\s*[+-]?0*[0-9]{1,18}\s*$"), text.try_cast("bigint"))
    if kind == "int":
        return F.when(short.between(low, high), short.cast("int"))
    wide = F.when(text.rlike(r"^\s*[+-]?0*[1-9][0-9]{18}\s*$"), F.trim(text).try_cast("decimal(20,0)"))
    return F.coalesce(short, F.when(wide.between(F.lit(str(low)).cast("decimal(20,0)"),
                                                 F.lit(str(high)).cast("decimal(20,0)")), wide.cast("bigint")))


def like_column(df: DataFrame, name: str, value) -> Column:
    """``value`` as a literal of exactly the type of ``df[name]``.

    Comparing a column with a literal of another type puts a cast around the column, and the
    filter then no longer reaches the Parquet scan. Columns without a zone hold UTC, so a moment
    with an offset is moved there first.
    """
    kind = df.schema[name].dataType
    if isinstance(value, dt.datetime) and value.tzinfo and isinstance(kind, T.TimestampNTZType):
        value = value.astimezone(dt.timezone.utc).replace(tzinfo=None)
    if isinstance(value, (dt.datetime, dt.date)) and isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        value = value.isoformat()
    return F.lit(value).cast(kind)


def yesterday(as_of: dt.datetime) -> dt.datetime:
    """Midnight of the day before: the watermark of a table that was never read."""
    return dt.datetime.combine(as_of.date() - dt.timedelta(days=1), dt.time(0))


def yesterday_noon(as_of: dt.datetime) -> dt.datetime:
    """Noon of the day before: start of the deliberately overlapping daily slices."""
    return yesterday(as_of) + dt.timedelta(hours=12)


def stamp_date(stamp: str | dt.datetime) -> str:
    """The date part (first ten characters) of an ISO stamp."""
    return (stamp.isoformat() if isinstance(stamp, dt.datetime) else stamp)[:10]
