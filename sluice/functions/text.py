"""Cuts and keys made from text columns."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F


def code_part(code: Column, index: int, institution: str) -> Column:
    """Part ``index`` of an underscore code such as ``UE_203_ABC100_1_2024_HØST``.

    Codes that do not carry the institution mark (or are NULL) give a single blank; a marked code
    with too few parts gives NULL.
    """
    marked = F.contains(code, F.lit(f"_{institution}_"))
    return F.when(marked, F.get(F.split(code, "_"), index)).otherwise(F.lit(" "))


def before(text: Column, marker: str) -> Column:
    """Text in front of the first ``marker``; the whole text where the marker is missing."""
    return F.when(F.instr(text, marker) > 0, F.substring_index(text, marker, 1)).otherwise(text)


def between(text: Column, start: str, end: str = "<") -> Column:
    """Text after the first ``start`` (and one optional blank) up to the next ``end`` character.

    NULL where there is no such stretch or it is empty.
    """
    stop = re.escape(end)
    found = F.regexp_extract(text, f"{re.escape(start)} ?([^{stop}]*){stop}", 1)
    return F.nullif(found, F.lit(""))


def teacher(description: Column) -> Column:
    return before(description, "<br")


def timeedit_id(description: Column) -> Column:
    return between(description, "ID:", "<")


def room_name(location: Column) -> Column:
    """Room in front of any markup, without the blank that separates the two."""
    return F.when(F.instr(location, "<") > 0, F.rtrim(F.substring_index(location, "<", 1))).otherwise(location)


def joined_key(*parts: Column) -> Column:
    """Parts joined by an underscore; NULL as soon as one part is NULL."""
    spaced: list[Column] = []
    for i, part in enumerate(parts):
        if i:
            spaced.append(F.lit("_"))
        spaced.append(part.cast("string"))
    return F.concat(*spaced)


def blank_unless(value: Column, present: Column) -> Column:
    """``value`` where ``present`` is not NULL, else NULL (an end term without an end year)."""
    return F.when(present.isNotNull(), value)
