"""Half-year calendar: ``2024.0`` is spring 2024, ``2024.5`` autumn 2024.

Every rule takes the reference date as an argument; nothing reads the clock.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# The words and codes the source systems use.
SPRING = "VÅR"
AUTUMN = "HØST"
SPRING_CODE = "VAR"
AUTUMN_CODE = "HOST"


def semester_name(date: Column) -> Column:
    return F.when(F.month(date) <= 7, F.lit(SPRING)).otherwise(F.lit(AUTUMN))


def half_year(date: Column | dt.date | dt.datetime):
    """Half-year number of a date column, or of a Python date (then a float)."""
    if isinstance(date, Column):
        return F.year(date) + F.when(F.month(date) <= 7, F.lit(0.0)).otherwise(F.lit(0.5))
    return date.year + (0.0 if date.month <= 7 else 0.5)


_SINGLE = f"^[1-9][0-9]* ({SPRING}|{AUTUMN})$"
_SPAN = "^[0-9]+ [^-]*-[0-9]+ "


def _half(name: Column, lead: str) -> Column:
    """Half-year of the year and word that follow ``lead``; the name is known to have the shape."""
    year = F.regexp_extract(name, f"{lead}([0-9]+) ", 1).try_cast("double")
    return year + F.when(name.rlike(f"{lead}[0-9]+ {AUTUMN}( |-|$)"), F.lit(0.5)).otherwise(F.lit(0.0))


def term_span(name: Column) -> Column:
    """Struct (start, end) of half-years for a term name; both NULL for irregular names.

    ``2024 HØST-2025 VÅR`` gives (2024.5, 2025.0); a single term must be exactly year, blank, word.
    """
    single, span = name.rlike(_SINGLE), name.rlike(_SPAN)
    start = F.when(single | span, _half(name, "^"))
    end = F.when(single, _half(name, "^")).when(span, _half(name, "^[^-]*-"))
    return F.struct(start.alias("start"), end.alias("end"))


def catalogue_term(date: Column) -> Column:
    """Term code the course catalogue asks for: July already counts as autumn here."""
    return F.when(F.month(date) < 7, F.lit(SPRING_CODE)).otherwise(F.lit(AUTUMN_CODE))


def description_year(date: Column) -> Column:
    """Year of the valid course descriptions: last year's until the end of April."""
    return F.when(F.month(date) < 5, F.year(date) - 1).otherwise(F.year(date))


def semester_label(year: Column, code: Column) -> Column:
    return F.concat(year.cast("string"), F.lit("_"), code)


def _year(text: Column) -> Column:
    # only digits are cast: a failing cast costs an exception per row
    return F.when(text.rlike(r"^\s*[0-9]+\s*$"), text.try_cast("int"))


def legacy_term_end(name: Column, as_of: dt.date | dt.datetime) -> Column:
    """Struct (end_year, end_month) of the older term calendar, case-insensitive like its SQL form."""
    low = F.lower(name)
    has_digit = name.rlike("[0-9]")
    has_dash = F.contains(name, F.lit("-"))
    head, tail = F.left(name, F.lit(4)), F.right(name, F.lit(4))
    after_dash = F.substr(name, F.instr(name, "-") + 1, F.lit(4))
    end_year = (
        F.when(~has_dash & head.rlike("[0-9]"), _year(head))
        .when(~has_dash & tail.rlike("[0-9]"), _year(tail))
        .when(F.contains(low, F.lit("standard")) | F.contains(low, F.lit("eveg vår")), F.lit(as_of.year))
        .when(has_dash & has_digit, _year(after_dash))
    )
    standard_month = 7 if as_of.month < 8 else 12
    end_month = (
        F.when(F.endswith(low, F.lit("vår")), F.lit(7))
        .when(F.endswith(low, F.lit("høst")), F.lit(12))
        .when(F.contains(low, F.lit("vår")), F.lit(7))
        .when(F.contains(low, F.lit("høst")), F.lit(12))
        .when(F.contains(low, F.lit("standard")), F.lit(standard_month))
        .otherwise(F.lit(12))
    )
    return F.struct(end_year.alias("end_year"), end_month.alias("end_month"))
