"""Joins: active terms, recent users, id lookup, per-course pages, counts.

No join carries an unconditional broadcast hint: Spark measures the small side (file sizes, or the
shuffled bytes under adaptive execution) and broadcasts it only below its threshold.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.terms import legacy_term_end
from ..functions.times import like_column
from .filters import quoted
from .merge import last_row


def in_active_terms(courses: DataFrame, terms: DataFrame, course_term: str = "enrollment_term_id",
                    term_id: str = "term_id") -> DataFrame:
    """Courses whose term is in the list: a membership test, so no course is multiplied."""
    listed = terms.select(quoted(term_id).alias("_term"))
    return courses.join(listed, quoted(course_term) == F.col("_term"), "left_semi")


def of_courses(pages: DataFrame, courses: DataFrame, course_id: str = "course_id") -> DataFrame:
    """Landed pages of the given courses; a course without pages simply has none."""
    listed = courses.select(quoted(course_id).alias("_course"))
    return pages.join(listed, quoted(course_id) == F.col("_course"), "left_semi")


def recent_users(users: DataFrame, activity: DataFrame, login_after, active_after, *, user_id: str = "user_id",
                 last_login: str = "last_login", activity_user: str = "user_id",
                 last_activity: str = "last_activity_at") -> DataFrame:
    """Distinct users with an activity record who logged in, or were active, after a moment.

    The condition reaches across both sides, but it only asks for the latest moment of each, so
    both sides shrink to one row per user before they meet. That also makes the result distinct.
    """
    login = like_column(users, last_login, login_after)
    moment = like_column(activity, last_activity, active_after)
    seen = users.groupBy(quoted(user_id).alias("user_id")).agg(F.max(quoted(last_login)).alias("_login"))
    active = activity.groupBy(quoted(activity_user).alias("user_id")).agg(
        F.max(quoted(last_activity)).alias("_active")
    )
    return seen.join(active, "user_id").filter((F.col("_login") > login) | (F.col("_active") > moment)).select("user_id")


def lookup(rows: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    """Every row with the columns ``ids`` has for its key; unknown and NULL keys keep NULLs.

    Rows without a key skip the join, so they cannot pile up in one partition. Of several ids for a
    key the one that is greatest by its columns, from left to right, counts (NULL lowest), so no row
    is multiplied; give ``ids`` its deciding column first, or reduce it with ``last_row`` before.
    """
    added = [c for c in ids.columns if c != key]
    ids = last_row(ids.filter(quoted(key).isNotNull()), [key], added)
    kept = rows
    if rows.schema[key].nullable:
        kept = rows.filter(quoted(key).isNotNull())
    found = kept.join(ids, key, "left").select(*[quoted(c) for c in [*rows.columns, *added]])
    if rows.schema[key].nullable:
        found = found.unionByName(rows.filter(quoted(key).isNull()), allowMissingColumns=True)
    return found


def rows_per_course(courses: DataFrame, rows: DataFrame, course_id: str = "course_id", count: str = "n") -> DataFrame:
    """Number of rows of each course, zero included; counted before the join."""
    counted = rows.filter(quoted(course_id).isNotNull()).groupBy(quoted(course_id)).agg(F.count("*").alias(count))
    return courses.select(quoted(course_id)).join(counted, course_id, "left").select(
        quoted(course_id), F.coalesce(F.col(count), F.lit(0)).alias(count)
    )


def legacy_calendar(courses: DataFrame, terms: DataFrame, as_of: dt.date | dt.datetime, *,
                    course_id: str = "course_id", course_term: str = "enrollment_term_id",
                    code: str = "sis_course_id", state: str = "workflow_state", term_id: str = "term_id",
                    name: str = "name") -> DataFrame:
    """Course ids whose term has not ended at ``as_of``, by the older calendar rule, in id order.

    Patterns follow SQL LIKE, where the underscore stands for any one character. The condition on
    the term side makes the outer join an inner one, and membership is all that is asked.
    """
    end = legacy_term_end(quoted(name), as_of)
    running = terms.filter((end["end_year"] >= as_of.year) & (end["end_month"] >= as_of.month)).select(
        quoted(term_id).alias("_term")
    )
    wanted = courses.filter(
        ~F.lower(quoted(state)).like("%unpub%")
        & (F.upper(quoted(code)).like("%UE_203%") | F.upper(quoted(code)).like("%UA_203%"))
    )
    return (
        wanted.join(running, quoted(course_term) == F.col("_term"), "left_semi")
        .select(quoted(course_id).alias("course_id"))
        .distinct()
        .orderBy("course_id")
    )
