"""Column-to-Column functions. All are native expressions and stay inside code generation."""

from .crypto import pseudonym
from .nested import (
    descriptions,
    fallback_period,
    get_or,
    last_entries,
    link_relations,
    people_json,
    programme_list,
)
from .terms import (
    catalogue_term,
    description_year,
    half_year,
    legacy_term_end,
    semester_label,
    semester_name,
    term_span,
)
from .text import before, between, blank_unless, code_part, joined_key, room_name, teacher, timeedit_id
from .times import like_column, parse_time, parse_whole, stamp_date, whole_number, yesterday, yesterday_noon

__all__ = [
    "before", "between", "blank_unless", "catalogue_term", "code_part", "description_year", "descriptions",
    "fallback_period", "get_or", "half_year", "joined_key", "last_entries", "legacy_term_end", "like_column",
    "link_relations", "parse_time", "parse_whole", "people_json", "programme_list", "pseudonym", "room_name", "semester_label",
    "semester_name", "stamp_date", "teacher", "term_span", "timeedit_id", "whole_number", "yesterday",
    "yesterday_noon",
]
