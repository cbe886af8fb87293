"""Generators: one row per element of a nested array.

The record shapers take rows with a ``node`` struct, as ``sources.page_nodes`` makes them, and pass
on the columns named in ``carry`` (usually ``arrival`` and ``place``, which settle repeated keys).
Arrays come in with their record, so flattening needs no shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.nested import NOT_REGISTERED, fallback_period
from ..functions.terms import semester_label
from ..functions.text import blank_unless, joined_key
from ..functions.times import parse_time, parse_whole
from .filters import still_taught


def flatten(df: DataFrame, array: Column, keep: Sequence[Column | str], element: str = "item",
            place: str | None = None) -> DataFrame:
    """The kept columns beside each array element; a NULL element gives a row, an empty array none."""
    if place:
        return df.select(*keep, F.posexplode(array).alias(place, element))
    return df.select(*keep, F.explode(array).alias(element))


def module_items(nodes: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
    """Modules to their items; ``published`` of the item becomes ``item_published``.

    With ``carry`` the place of the item in its module is passed on as ``item_place``.
    """
    rows = flatten(nodes, F.col("node.items"), ["node", "course_id", *carry], place="item_place")
    return rows.select(
        F.col("node.items_count").alias("items_count"),
        F.col("node.items_url").alias("items_url"),
        F.col("node.id").alias("module_id"),
        "course_id",
        F.col("item.type").alias("type"),
        F.col("item.id").alias("module_item_id"),
        F.col("item.title").alias("title"),
        F.col("item.module_id").alias("parent_module_id"),
        F.col("item.external_url").alias("external_url"),
        F.col("item.published").alias("item_published"),
        F.col("node.name").alias("name"),
        F.col("node.published").alias("published"),
        *carry, *(["item_place"] if carry else []),
    )


def course_enrollments(nodes: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
    """Enrollments of a course with their user; created and updated are the user's."""
    return nodes.select(
        parse_whole(F.col("node._id")).alias("enrollment_id"),
        parse_whole(F.col("node.user._id")).alias("user_id"),
        F.col("node.user.sisId").alias("sis_user_id"),
        "course_id",
        F.col("node.type").alias("type"),
        parse_time(F.col("node.user.createdAt")).alias("created_at"),
        parse_time(F.col("node.user.updatedAt")).alias("updated_at"),
        F.col("node.state").alias("enrollment_state"),
        F.col("node.totalActivityTime").cast("bigint").alias("total_activity_time"),
        parse_time(F.col("node.lastActivityAt")).alias("last_activity_at"),
        *carry,
    )


def summaries_flat(nodes: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
    """Student summaries as the flat pages give them."""
    counts = ["page_views", "id", "max_page_views", "page_views_level", "participations", "max_participations",
              "participations_level"]
    punctuality = ["missing", "late", "on_time", "floating", "total"]
    return nodes.select(
        *[F.col(f"node.{c}").alias(c) for c in counts],
        "course_id",
        *[F.col(f"node.tardiness_breakdown.{c}").alias(c) for c in punctuality],
        *carry,
    )


def summaries_nested(nodes: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
    """Student summaries from nested users; users without analytics are left out.

    This source has no ``floating`` count, so the column is absent and an upsert keeps it.
    """
    known = nodes.filter(F.col("node.summaryAnalytics").isNotNull())
    views, parts, punctuality = (
        F.col(f"node.summaryAnalytics.{p}") for p in ("pageViews", "participations", "tardinessBreakdown")
    )
    return known.select(
        views["total"].alias("page_views"),
        parse_whole(F.col("node._id")).alias("id"),
        views["max"].alias("max_page_views"),
        views["level"].alias("page_views_level"),
        parts["total"].alias("participations"),
        parts["max"].alias("max_participations"),
        parts["level"].alias("participations_level"),
        "course_id",
        punctuality["missing"].alias("missing"),
        punctuality["late"].alias("late"),
        punctuality["onTime"].alias("on_time"),
        punctuality["total"].alias("total"),
        *carry,
    )


def course_programmes(nodes: DataFrame, carry: Sequence[str] = (), cutoff: int = 2016) -> DataFrame:
    """Course versions to their study programmes, with the period each is taught in.

    A programme without a first (last) term of its own takes the course's; a NULL programme record
    keeps a row without programme. With ``carry`` the place of the programme is ``item_place``.
    """
    course = F.col("node.undervisesIPeriode")
    taught = still_taught(nodes, course["sisteTermin"]["arstall"], cutoff)
    rows = flatten(taught, F.col("node.studieprogramkoblinger"), ["node", *carry], place="item_place")
    begin = fallback_period(F.col("item.periode.fraTermin"), course["forsteTermin"])
    end = fallback_period(F.col("item.periode.tilTermin"), course["sisteTermin"])
    code, version, programme = F.col("node.kode"), F.col("node.versjonskode"), F.col("item.studieprogram.kode")
    return rows.select(
        code.alias("Emnekode"),
        version.alias("Versjonskode"),
        programme.alias("Studieprogramkode"),
        begin["arstall"].alias("Undervises_forste_ar"),
        begin["betegnelse"]["kode"].alias("Undervises_forste_termin"),
        end["arstall"].alias("Undervises_siste_ar"),
        blank_unless(end["betegnelse"]["kode"], end["arstall"]).alias("Undervises_siste_termin"),
        joined_key(code, version).alias("Emnekode2"),
        joined_key(programme, code, version).alias("programEmneKode"),
        *carry, *(["item_place"] if carry else []),
    )


def pivot_last(df: DataFrame, keys: Sequence[str], category: Column, content: Column, order: Sequence[Column],
               values: Sequence[str], default: str = NOT_REGISTERED) -> DataFrame:
    """One column per category value, holding its last content by ``order`` or else ``default``.

    Rows of other categories are ignored; keys that have only such rows are still listed. Each
    column is a ``max`` that is combined inside the map tasks, whatever the size of a group.
    """
    best = F.struct(*[o.alias(f"o{i}") for i, o in enumerate(order)], content.alias("content"))
    found = df.groupBy(*keys).agg(*[F.max(F.when(category == v, best)).alias(v) for v in values])
    return found.select(*keys, *[
        F.when(F.col(v).isNull(), F.lit(default)).otherwise(F.col(v)["content"]).alias(v) for v in values
    ])


def semester_of(term: Column) -> Column:
    """``2024_HØST``-like label of a nested term."""
    return semester_label(term["arstall"], term["betegnelse"]["kode"])
