"""Expressions over nested records: arrays of structs that arrive inside one row."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# The text written where something is not registered, the description categories
# and languages with a column of their own.
NOT_REGISTERED = "Ikkje registrert"
DESCRIPTION_KEYS = ("LUB_NNO", "LUB_NOB", "LUB_ENG", "ARB_NNO", "ARB_NOB", "ARB_ENG")


def get_or(value: Column, default="") -> Column:
    """A nested value, or ``default`` where any step of its path is missing."""
    return F.coalesce(value, F.lit(default))


def last_entries(entries: Column, key: Callable[[Column], Column]) -> Column:
    """Array without the elements that a later element with the same key replaces."""

    def stands(entry: Column, i: Column) -> Column:
        later = F.slice(entries, i + 2, F.size(entries))
        return ~F.exists(later, lambda other: key(other).eqNullSafe(key(entry)))

    return F.filter(entries, stands)


def link_relations(header: Column) -> Column:
    """Map of relation to URL from a ``Link`` header; the last of a repeated relation counts."""

    def entry(link: Column) -> Column:
        url = F.regexp_replace(F.trim(F.substring_index(link, ";", 1)), "[<>]", "")
        rel = F.regexp_extract(link, ";[^=]*=([^=;]*)", 1)
        return F.struct(F.trim(F.regexp_replace(rel, '"', "")).alias("rel"), url.alias("url"))

    entries = F.transform(F.split(header, r",\s*(?=<)"), entry)  # a URL may hold commas
    return F.map_from_entries(last_entries(entries, lambda e: e["rel"]))


def _json_text(value: Column) -> Column:
    # the brackets of a list of one; those inside the text are behind its quotes
    return F.btrim(F.to_json(F.array(value.cast("string"))), F.lit("[]"))


def people_json(people: Column, names: Callable[[Column], Sequence[Column]],
                whole: Callable[[Column], Column]) -> Column:
    """JSON list with one list of names per person, in the given order, non-ASCII kept.

    ``names`` picks the texts of a person and ``whole`` tells whether its record has all parts.
    One broken record, or a missing list, turns the whole value into the JSON text for
    "not registered"; an empty list gives ``[]``.
    """

    def person(p: Column) -> Column:
        texts: list[Column] = []
        for i, name in enumerate(names(p)):
            texts += [F.lit(", ")] if i else []
            texts.append(_json_text(name))
        return F.concat(F.lit("["), *texts, F.lit("]"))

    listed = F.concat(F.lit("["), F.array_join(F.transform(people, person), ", "), F.lit("]"))
    intact = people.isNotNull() & F.forall(people, lambda p: F.coalesce(whole(p), F.lit(False)))
    return F.when(intact, listed).otherwise(F.lit(f'"{NOT_REGISTERED}"'))


def descriptions(entries: Column, category: Callable[[Column], Column], language: Callable[[Column], Column],
                 content: Callable[[Column], Column], keys: Sequence[str] = DESCRIPTION_KEYS,
                 default: str = NOT_REGISTERED) -> dict[str, Column]:
    """One column per ``CATEGORY_LANGUAGE`` key from an array of descriptions.

    The category code loses its first two characters; the last entry of a key counts; a key that
    is absent gets ``default``, one that is present with NULL content stays NULL.
    """

    def entry_key(e: Column) -> Column:
        return F.concat(F.substr(category(e), F.lit(3)), F.lit("_"), language(e))

    def column(key: str) -> Column:
        hits = F.filter(entries, lambda e: F.coalesce(entry_key(e) == key, F.lit(False)))
        return F.when(F.size(hits) > 0, content(F.try_element_at(hits, F.lit(-1)))).otherwise(F.lit(default))

    return {key: column(key) for key in keys}


def programme_list(entries: Column, code: Callable[[Column], Column], weight: Callable[[Column], Column],
                   semester: Callable[[Column], Column]) -> Column:
    """Array of (code, weight, semester) from the study-programme records of one student."""
    return F.transform(
        entries,
        lambda e: F.struct(code(e).alias("code"), weight(e).alias("weight"), semester(e).alias("semester")),
    )


def fallback_period(own: Column, other: Column) -> Column:
    """``own`` where it exists, else ``other``: decided on the whole struct, never field by field."""
    return F.when(own.isNull(), other).otherwise(own)
