"""DataFrame-to-DataFrame operators."""

from .filters import (
    accepted,
    active_by_code,
    active_terms,
    checked,
    exclude_text,
    fill_text,
    plain,
    quarantined,
    quoted,
    recent_active_events,
    since,
    still_taught,
    valid_bigint,
)
from .joins import in_active_terms, legacy_calendar, lookup, of_courses, recent_users, rows_per_course
from .merge import last_row, merge_last, upsert
from .nested import (
    course_enrollments,
    course_programmes,
    flatten,
    module_items,
    pivot_last,
    semester_of,
    summaries_flat,
    summaries_nested,
)
from .sets import top_rows, union_frames

__all__ = [
    "accepted", "active_by_code", "active_terms", "checked", "course_enrollments", "course_programmes",
    "exclude_text", "fill_text", "flatten", "in_active_terms", "last_row", "legacy_calendar",
    "lookup", "merge_last", "module_items", "of_courses", "pivot_last", "plain", "quarantined", "quoted", "recent_active_events", "recent_users",
    "rows_per_course", "semester_of", "since", "still_taught", "summaries_flat",
    "summaries_nested", "top_rows", "union_frames", "upsert", "valid_bigint",
]
