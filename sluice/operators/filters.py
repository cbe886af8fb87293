"""Row selection: time slices, text exclusion, terms, code parts, and the good/bad split."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.terms import AUTUMN, SPRING, half_year, term_span
from ..functions.times import like_column, parse_whole


def quoted(name: str) -> Column:
    """A column by its literal name, dots included."""
    return F.col(f"`{name}`")


def plain(df: DataFrame, columns: Mapping[str, str] | Sequence[str]) -> DataFrame:
    """Select change-file columns under plain names (``value.user_id`` becomes ``user_id``).

    A mapping gives source name to new name; a list drops the ``key.``/``value.``/``meta.`` prefix.
    """
    if not isinstance(columns, Mapping):
        columns = {c: c.split(".", 1)[-1] for c in columns}
    return df.select(*[quoted(old).alias(new) for old, new in columns.items()])


def since(df: DataFrame, ts: str, low, high=None, *, inclusive: bool = False,
          date_partition: str | None = None) -> DataFrame:
    """Rows after the watermark ``low`` and not after ``high``.

    The lower end is open unless ``inclusive``; the upper end is closed and is the next watermark.
    Time stamps are compared as times. ``date_partition`` names a date partition column derived
    from ``ts``, so that untouched partitions are never listed or read.
    """
    start = like_column(df, ts, low)
    keep = quoted(ts) >= start if inclusive else quoted(ts) > start
    if date_partition:
        keep = keep & (quoted(date_partition) >= start.cast("date"))
    if high is not None:
        end = like_column(df, ts, high)
        keep = keep & (quoted(ts) <= end)
        if date_partition:
            keep = keep & (quoted(date_partition) <= end.cast("date"))
    return df.filter(keep)


def exclude_text(df: DataFrame, text: str, columns: Sequence[str] | None = None) -> DataFrame:
    """Drop rows where any column contains ``text``, whatever the case; NULL contains nothing."""
    needle = F.lit(text.lower())
    names = columns or df.columns
    hits = [F.coalesce(F.contains(F.lower(quoted(c).cast("string")), needle), F.lit(False)) for c in names]
    return df.filter(~reduce(lambda a, b: a | b, hits))


def active_terms(terms: DataFrame, as_of: dt.date | dt.datetime, name: str = "name") -> DataFrame:
    """Terms that run at ``as_of``; irregular names never do."""
    now = F.lit(half_year(as_of))
    span = term_span(quoted(name))
    return terms.filter((span["start"] <= now) & (now <= span["end"]))


def active_by_code(courses: DataFrame, as_of: dt.date | dt.datetime, code: str = "sis_course_id",
                   term_id: str = "enrollment_term_id", standard_term: int = 1) -> DataFrame:
    """Courses whose code names the current year and semester as its fifth and sixth part."""
    parts = F.split(quoted(code), "_")
    semester = SPRING if as_of.month <= 7 else AUTUMN
    return courses.filter(
        ~quoted(term_id).eqNullSafe(F.lit(standard_term))
        & (F.get(parts, 4) == str(as_of.year))
        & (F.get(parts, 5) == semester)
    )


def recent_active_events(events: DataFrame, after, ts: str = "start_at", state: str = "workflow_state") -> DataFrame:
    """Active events that start at or after a moment."""
    return events.filter((quoted(state) == "active") & (quoted(ts) >= like_column(events, ts, after)))


def still_taught(df: DataFrame, end_year: Column, cutoff: int = 2016) -> DataFrame:
    return df.filter(end_year.isNull() | (end_year > cutoff))


def valid_bigint(value: Column) -> Column:
    return parse_whole(value.cast("string")).isNotNull()


def _read(value: Column, kind: str) -> Column:
    return parse_whole(value, kind) if kind in ("int", "bigint") else value.try_cast(kind)


def checked(df: DataFrame, casts: Mapping[str, str]) -> DataFrame:
    """Cast text columns and collect the names of those whose text did not fit into ``bad_columns``.

    One pass over the input; ``accepted`` and ``quarantined`` pick the two sides.
    """
    raw = F.struct(*[quoted(c).alias(c) for c in casts]).alias("raw")
    read = df.select(*[_read(quoted(c), casts[c]).alias(c) if c in casts else quoted(c) for c in df.columns], raw)
    bad = [F.when(F.col("raw")[c].isNotNull() & quoted(c).isNull(), F.lit(c)) for c in casts]
    return read.withColumn("bad_columns", F.array_compact(F.array(*bad)))


def accepted(rows: DataFrame) -> DataFrame:
    return rows.filter(F.size("bad_columns") == 0).drop("bad_columns", "raw")


def quarantined(rows: DataFrame) -> DataFrame:
    """Rows that hold at least one unreadable value, with the texts as they arrived."""
    return rows.filter(F.size("bad_columns") > 0)


def fill_text(df: DataFrame, default: str = "") -> DataFrame:
    """NULL to ``default`` in the text columns only."""
    texts = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    return df.select(*[
        F.coalesce(quoted(c), F.lit(default)).alias(c) if c in texts else quoted(c) for c in df.columns
    ])
