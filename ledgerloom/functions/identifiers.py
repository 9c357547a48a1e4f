"""Product identifiers: one spelling per identifier, whatever the spreadsheet did to it."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerloom.functions.text import strip


def normalize_identifier(col: Column) -> Column:
    """Trim, drop one leading apostrophe and all hyphens, undo ``.0`` on plain numbers, upper-case."""
    value = F.regexp_replace(strip(col.cast("string")), "^'", "")
    value = F.replace(value, F.lit("-"), F.lit(""))
    return F.upper(F.regexp_replace(value, r"^(\d+)\.0$", "$1"))


def normalize_isbn(col: Column, digits_only: bool = False) -> Column:
    """A 10 or 13 character ISBN, else NULL.

    ``digits_only`` is the strict form for wrapped and quoted cells: everything but digits goes,
    so an ISBN-10 with check digit X does not survive.
    """
    value = strip(col.cast("string"))
    if digits_only:
        value = F.regexp_replace(value, r"[^0-9]", "")
    else:
        value = F.regexp_replace(F.regexp_replace(value, r"\.0$", ""), r"[- ]", "")
    return F.when(F.length(value).isin(10, 13), value)


def first_identifier(*cols: Column) -> Column:
    """First usable ISBN among several columns, in order."""
    return F.coalesce(*[normalize_isbn(col) for col in cols])
