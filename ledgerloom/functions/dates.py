"""Dates in the spellings reports use, and period labels."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerloom.functions.text import strip

ISO = "yyyy-MM-dd"
MIXED_FORMATS = (
    ISO, "yyyy-MM", "M/d/yyyy", "MMMM yyyy", "MMM yyyy", "yyyy/MM/dd", "M/d/yy", "d-MMM-yyyy", "MMMM d, yyyy", "MMM d, yyyy"
)

# fixed values: month abbreviations
MONTHS = ("Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug", "Sep", "Oct", "Nov", "Dec")


# How the letters of a format look in text; longer runs first.
_SHAPES = (("yyyy", r"\d{4}"), ("MMMM", "[A-Za-z]{3,9}"), ("MMM", "[A-Za-z]{3}"), ("MM", r"\d{2}"), ("dd", r"\d{2}"),
           ("yy", r"\d{2}"), ("M", r"\d{1,2}"), ("d", r"\d{1,2}"))
# A time of day behind a date, as workbook cells carry it.
_TIME_PART = r"(?i)[T\s]+\d{1,2}:\d{2}(:\d{2}(\.\d+)?)?\s*([AP]M)?(Z|[+-]\d{2}:?\d{2})?$"


def _shape(fmt: str) -> str:
    """Regular expression that every text in this format fits."""
    letters = dict(_SHAPES)
    pattern = "|".join(run for run, _ in _SHAPES)
    return "^" + re.sub(pattern, lambda m: letters[m.group()], fmt) + "$"


def parse_date(col: Column, formats: tuple[str, ...] = MIXED_FORMATS) -> Column:
    """First format that fits; text that fits none is NULL.  A format without a day means the 1st.

    A time of day behind the date is dropped.  A two-digit year from 70 on is 19xx, an earlier one 20xx.
    A format is only tried on text of its shape: a failed parse costs far more than a pattern.
    """
    text = strip(col.cast("string"))
    text = F.when(text.contains(":"), F.regexp_replace(text, _TIME_PART, "")).otherwise(text)

    def parsed(fmt: str) -> Column:
        date = F.try_to_timestamp(text, F.lit(fmt)).cast("date")
        if "yy" in fmt and "yyyy" not in fmt:
            date = F.when(F.year(date) >= 2070, F.add_months(date, F.lit(-1200))).otherwise(date)
        return F.when(text.rlike(_shape(fmt)), date)

    return F.coalesce(*[parsed(f) for f in formats])


def month_number(col: Column) -> Column:
    """1-12 from a month name or abbreviation; other text is NULL."""
    numbers = F.create_map(*[item for i, m in enumerate(MONTHS, 1) for item in (F.lit(m.upper()), F.lit(i))])
    return F.try_element_at(numbers, F.upper(col))


def parse_period_name(col: Column) -> Column:
    """``MAY-26`` to 2026-05-01; other spellings go through :func:`parse_date`.

    Years below 100 belong to this century.  A fallback date before 1900 had a two-digit year:
    70 and later are 19xx, earlier ones 20xx.
    """
    text = strip(col)
    year = strip(F.substring_index(text, "-", -1)).try_cast("int")
    first_day = F.make_date(F.when(year < 100, year + 2000).otherwise(year), month_number(F.substring(text, 1, 3)), F.lit(1))
    named = F.when(text.rlike(r"^[A-Za-z]{3}-\s*\d{1,4}$"), first_day)

    def this_era(date: Column) -> Column:
        return (
            F.when(F.year(date) >= 1900, date)
            .when(F.year(date) >= 70, F.add_months(date, F.lit(1900 * 12)))
            .otherwise(F.add_months(date, F.lit(2000 * 12)))
        )

    # The one-element array holds the parsed date, so it is parsed once.
    return F.coalesce(named, F.transform(F.array(parse_date(text)), this_era)[0])


def month_start(col: Column) -> Column:
    return F.trunc(col, "MM")


def period(col: Column) -> Column:
    """``yyyy-MM`` text of a date."""
    return F.date_format(col, "yyyy-MM")


def month_label(col: Column) -> Column:
    """``2024-11`` to ``Nov 2024``; a bare month ``01`` to ``Jan``."""
    names = F.array(*[F.lit(m) for m in MONTHS])
    number = F.substring_index(col, "-", -1).try_cast("int")
    name = F.try_element_at(names, number)
    year = F.substring_index(col, "-", 1)
    return F.when(col.contains("-"), F.concat(name, F.lit(" "), year)).otherwise(name)
