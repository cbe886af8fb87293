"""Landed JSON pages: one object per page, holding a list of records."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from math import ceil, log2

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import PAGES
from ..session import settled
from .change_files import ARRIVAL, CORRUPT, arrival, schema_of


def read_pages(spark: SparkSession, paths: str | Sequence[str], schema: str | T.StructType, *,
               lines: bool = False) -> DataFrame:
    """One row per landed page, with its ``arrival`` among the files and, where it cannot be read,
    its text in ``CORRUPT``.

    With ``lines`` the files hold one page per line and can be split.
    """
    kind = schema_of(schema)
    read = T.StructType([*kind.fields, T.StructField(CORRUPT, T.StringType())])
    pages = spark.read.schema(read).option("multiLine", not lines).option("columnNameOfCorruptRecord", CORRUPT).json(paths)
    return pages.select(*kind.names, CORRUPT, arrival())


def failed_pages(pages: DataFrame, nodes: str) -> DataFrame:
    """Pages that hold no list: cut-off or unreadable ones (``reason`` is ``unreadable``), and those
    that hold something else, such as an error (``no list``)."""
    reason = F.when(F.col(CORRUPT).isNotNull(), "unreadable").when(F.col(nodes).isNull(), "no list")
    return pages.select("*", reason.alias("reason")).filter(F.col("reason").isNotNull())


def page_nodes(pages: DataFrame, nodes: str, keep: Sequence[str] = ()) -> DataFrame:
    """One row per record as ``node``, with its ``place`` in the page, beside the kept page columns.

    Pages without a list (an error page, an empty page) give no rows. A NULL element of the list is
    no record and is left out.
    """
    rows = pages.select(*keep, F.posexplode(F.col(nodes)).alias("place", "node"))
    return rows.filter(F.col("node").isNotNull())


def read_nodes(spark: SparkSession, paths: str | Sequence[str], kind: str, *, keep: Sequence[str] = (),
               lines: bool = False) -> DataFrame:
    """Records of a page kind listed in ``schemas.PAGES``, with ``arrival`` and ``place``."""
    schema, nodes = PAGES[kind]
    return page_nodes(read_pages(spark, paths, schema, lines=lines), nodes, [*keep, ARRIVAL])


def check_pages(pages: DataFrame, page: Column, *, page_set: Column | None = None,
                has_next: Column | None = None, size: Column | None = None,
                failed: Column | None = None) -> DataFrame:
    """One row per page set: what was landed, what is missing, and whether the set is whole.

    A set ends at its first page without a successor (cursor sets) or its first empty page (numbered
    sets). It is complete when it has such an end, no page number is missing and no page failed
    before the end. Computed by plain aggregation, so a set holding most pages is combined inside
    the map tasks.
    """
    no = F.lit(False)
    per_page = pages.select(
        (page_set if page_set is not None else F.lit("all")).alias("page_set"),
        page.alias("page"),
        (F.coalesce(~has_next, no) if has_next is not None else no).alias("final"),
        (F.coalesce(size, F.lit(0)) <= 0 if size is not None else no).alias("empty"),
        (F.coalesce(failed, no) if failed is not None else no).alias("failed"),
    ).groupBy("page_set", "page").agg(
        F.bool_or("final").alias("final"), F.bool_or("empty").alias("empty"), F.bool_or("failed").alias("failed")
    )
    ends = F.col("final") | (F.col("empty") & ~F.col("failed"))
    found = per_page.groupBy("page_set").agg(
        F.count("page").alias("pages_seen"),
        F.min("page").alias("first_page"),
        F.max("page").alias("last_page"),
        F.min(F.when(ends, F.col("page"))).alias("end_page"),
        F.min(F.when(F.col("failed"), F.col("page"))).alias("failed_page"),
    )
    gaps = F.col("last_page") - F.col("first_page") + 1 - F.col("pages_seen")
    whole = (
        F.col("end_page").isNotNull() & (F.col("gaps") == 0)
        & (F.col("failed_page").isNull() | (F.col("failed_page") > F.col("end_page")))
    )
    return found.withColumn("gaps", gaps).withColumn("complete", whole)


FAULTS = "page_set string, reason string, at string"
FIRST = ""  # where a chain of cursors begins


def followed(links: DataFrame) -> DataFrame:
    """Where each page leads, by pointer doubling: (page_set, at, to, steps).

    ``links`` has a row for each page: ``at``, the cursor it was asked for (``FIRST`` for none), and ``to``, the
    cursor of the page behind it, null for a last page. Each round joins every pointer with the one it
    points to, so the logarithm of the longest set's length is enough. What then has a null ``to``
    has reached an end, after ``steps`` pages; one that points to no page has run into a gap; one that
    still points to a page runs in a circle. Every round is written, so no plan grows.
    """
    most = links.groupBy("page_set").count().agg(F.max("count")).first()[0] or 1
    state = links.select("page_set", "at", "to", F.lit(1).cast("bigint").alias("steps"))
    for _ in range(ceil(log2(most)) if most > 1 else 0):
        ahead = state.select(F.col("page_set").alias("_set"), F.col("at").alias("_at"), F.col("to").alias("_to"), F.col("steps").alias("_steps"))
        joined = state.join(ahead, (F.col("page_set") == F.col("_set")) & (F.col("to") == F.col("_at")), "left")
        hit = F.col("_at").isNotNull()
        state = settled(joined.select(
            "page_set", "at", F.when(hit, F.col("_to")).otherwise(F.col("to")).alias("to"),
            (F.col("steps") + F.coalesce("_steps", F.lit(0))).alias("steps")), "pointers")
    return state


def cursor_faults(pages: DataFrame, page_set: Column, after: Column, end: Column, more: Column, arrival: Column) -> DataFrame:
    """What is missing of sets of pages that are linked by cursors, as ``FAULTS``.

    A page tells by ``more`` whether another follows, which is asked for by its ``end`` cursor and
    landed with that as ``after``. Reasons: ``missing page`` (``at``: its cursor, or nothing for the
    first), ``missing end`` (no page says that it is the last), ``circle`` (cursors lead back) and
    ``unreached`` (``at``: how many pages the chain from the first one does not come to).

    A page landed again counts once, as it came last. A set whose pages do not say what they were
    asked for cannot be followed: there the page that came last has to be the end. Pages that say
    nothing of a successor are not looked at.
    """
    told = pages.select(page_set.alias("page_set"), after.alias("after"), end.alias("end"), more.alias("more"), arrival.alias("_came"))
    once = told.filter(F.col("more").isNotNull()).groupBy("page_set", "after").agg(
        F.max_by(F.struct("more", "end"), F.struct("_came", "more", "end")).alias("last"))
    links = settled(once.select(
        "page_set", F.coalesce(F.concat(F.lit("c"), "after"), F.lit(FIRST)).alias("at"),
        F.when(F.col("last.more"), F.coalesce(F.concat(F.lit("c"), "last.end"), F.lit("?"))).alias("to")), "links")
    sets = settled(links.groupBy("page_set").agg(
        F.count("*").alias("seen"), F.bool_or(F.col("at") != FIRST).alias("linked"), F.bool_or(F.col("at") == FIRST).alias("begun"),
        F.bool_or(F.col("to").isNull()).alias("ended")), "page_sets")
    if sets.filter("linked or not ended").isEmpty():
        return sets.sparkSession.createDataFrame([], FAULTS)

    def fault(df: DataFrame, reason: str, at: Column) -> DataFrame:
        return df.select("page_set", F.lit(reason).alias("reason"), at.cast("string").alias("at"))

    chains = links.join(sets.filter("linked").select("page_set"), "page_set", "left_semi")
    known = links.select(F.col("page_set").alias("_set"), F.col("at").alias("_at"))
    same = (F.col("page_set") == F.col("_set")) & (F.col("to") == F.col("_at"))
    dangling = chains.filter(F.col("to").isNotNull()).join(known, same, "left_anti")
    way = settled(followed(chains), "ways")
    circles = way.filter(F.col("to").isNotNull()).join(known, same, "left_semi").groupBy("page_set").agg(F.min("at").alias("at"))
    reached = way.filter(F.col("at") == FIRST).select(F.col("page_set").alias("_set"), "steps")
    counted = sets.filter("linked and begun").join(reached, F.col("page_set") == F.col("_set"))
    return reduce(DataFrame.unionByName, [
        fault(dangling, "missing page", F.substring("to", 2, 1 << 30)),
        fault(sets.filter("linked and not begun"), "missing page", F.lit(None)),
        fault(sets.filter("not ended"), "missing end", F.lit(None)),
        fault(circles, "circle", F.substring("at", 2, 1 << 30)),
        fault(counted.filter("steps < seen"), "unreached", F.col("seen") - F.col("steps")),
    ])


def number_faults(pages: DataFrame, page_set: Column, page: Column, more: Column, nodes: Column, arrival: Column, *,
                  require_end: bool = False) -> DataFrame:
    """What is missing of sets of numbered pages, as ``FAULTS``: pages before the end, and the end.

    A set ends at its first page without a successor (``more`` is false) or without records. Numbers
    begin with 0 or 1. Missing numbers are found by a join with the next number, so no set is sorted
    in one task; of a longer gap the first number is named. If no page of a set says anything of an
    end, its last one is taken for it, unless ``require_end``. A page landed again counts once.
    """
    told = pages.select(
        page_set.alias("page_set"), page.alias("page"), more.alias("more"), (F.size(nodes) == 0).alias("empty"), arrival.alias("_came"))
    once = told.filter(F.col("page").isNotNull()).groupBy("page_set", "page").agg(
        F.max_by(F.struct("more", "empty"), F.struct("_came", "more", "empty")).alias("last"))
    seen = settled(once.select(
        "page_set", "page", F.coalesce("last.more", F.lit(False)).alias("more"), F.col("last.more").isNotNull().alias("tells"),
        (F.coalesce(~F.col("last.more"), F.lit(False)) | F.coalesce("last.empty", F.lit(False))).alias("final")), "numbers")
    sets = settled(seen.groupBy("page_set").agg(
        F.min("page").alias("low"), F.max("page").alias("high"), F.min(F.when(F.col("final"), F.col("page"))).alias("end"),
        F.bool_or(F.col("tells") | F.col("final")).alias("known"), F.max_by("more", "page").alias("open")), "page_sets")
    spans = sets.select(F.col("page_set").alias("_set"), "high", "end")
    wants = seen.join(spans, F.col("page_set") == F.col("_set")).filter(
        (F.col("end").isNull() | (F.col("page") < F.col("end"))) & ((F.col("page") < F.col("high")) | F.col("more")))
    known = seen.select(F.col("page_set").alias("_of"), (F.col("page") - 1).alias("_before"))
    gaps = wants.join(known, (F.col("page_set") == F.col("_of")) & (F.col("page") == F.col("_before")), "left_anti")
    late, open_end = sets.filter("low > 1"), sets.filter("end is null and not open")
    if not require_end:
        open_end = open_end.filter("known")

    def fault(df: DataFrame, reason: str, at: Column) -> DataFrame:
        return df.select("page_set", F.lit(reason).alias("reason"), at.cast("string").alias("at"))

    return fault(gaps, "missing page", F.col("page") + 1).unionByName(fault(late, "missing page", F.lit(1))).unionByName(
        fault(open_end, "missing end", F.col("high") + 1))


#: Columns that part the pages of a kind into sets, each with its own first and last page.
SET_COLUMNS = ("course_id", "user_id")


def page_faults(pages: DataFrame, nodes: str, *, require_end: bool = False) -> DataFrame:
    """What is missing of the landed pages of one kind: see ``cursor_faults`` and ``number_faults``.

    ``pages`` come from ``read_pages``; which rule holds follows from their schema. Unreadable pages are
    not there for this check, so what they should have been is missing too.
    """
    own = [F.col(c).cast("string") for c in SET_COLUMNS if c in pages.columns]
    page_set = F.coalesce(F.concat_ws("/", *own), F.lit("")) if own else F.lit("all")
    readable = pages.filter(F.col(CORRUPT).isNull())
    if "page" in pages.columns:
        return number_faults(readable, page_set, F.col("page"), F.col("has_next"), F.col(nodes), F.col(ARRIVAL), require_end=require_end)
    info = nodes.rsplit(".", 1)[0] + ".pageInfo"
    return cursor_faults(readable, page_set, F.col("after"), F.col(f"{info}.endCursor"), F.col(f"{info}.hasNextPage"), F.col(ARRIVAL))
