"""Numbers and money out of text."""

from __future__ import annotations

import string

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerloom.functions.text import strip

NUMBER = "decimal(24,4)"  # twenty digits before the point
_SYMBOLS = "€£¥$"
_LETTERS = string.ascii_letters
_TOKEN = r"\(?-?[\d.,]+\)?"
#: Four tokens that look like amounts, a blank between them; a line mark other than white space may end each.
MONEY_TOKENS = rf"^{_TOKEN}(?:[\u0085\u2028\u2029]? {_TOKEN}){{3}}$"


def coerce_number(col: Column, on_error: float | None = 0, type_: str = NUMBER) -> Column:
    """Text to number; a cell that is no number becomes ``on_error`` (0, or NULL)."""
    number = strip(col.cast("string")).try_cast(type_)
    return number if on_error is None else F.coalesce(number, F.lit(on_error).cast(type_))


def percent_to_fraction(col: Column) -> Column:
    """``35%`` to 0.35."""
    number = strip(F.replace(col, F.lit("%"), F.lit(""))).try_cast("decimal(12,4)")
    return (number / F.lit(100)).cast("decimal(12,6)")


def _without(text: Column, letters: str) -> Column:
    """Text without these letters; ``translate`` goes letter by letter, so it is left out where there are none."""
    return F.when(text.rlike(f"[{letters}]"), F.translate(text, letters, "")).otherwise(text)


def without_symbols(col: Column) -> Column:
    return _without(col, _SYMBOLS)


def money_parts(col: Column) -> dict[str, Column]:
    """What ``money_of`` reads from a cell; columns of their own where many cells of a row are parsed."""
    text = strip(col.cast("string"))
    return {
        "body": F.btrim(_without(text, _SYMBOLS + _LETTERS), F.lit("() ")),
        "sign": text.startswith("(").cast("int") + 2 * text.endswith(")").cast("int"),
    }


def money_of(body: Column, brackets: Column) -> Column:
    """The amount of a cell's digits and marks, and its brackets (1 opened, 2 closed, 3 both)."""
    no_comma = F.replace(body, F.lit(","), F.lit(""))
    comma_is_point = F.replace(F.replace(body, F.lit("."), F.lit("")), F.lit(","), F.lit("."))
    after_comma, after_point = (F.length(F.substring_index(body, mark, -1)) for mark in (",", "."))
    lone_comma = F.length(body) - F.length(no_comma) == 1
    plain = (
        F.when(~body.contains(","), body)
        .when(body.contains("."), F.when(after_comma < after_point, comma_is_point).otherwise(no_comma))
        .when(lone_comma & (after_comma <= 2), comma_is_point)
        .otherwise(no_comma)
    )
    amount = F.coalesce(plain.try_cast(NUMBER), F.lit(0).cast(NUMBER))
    sign = F.when(brackets == 3, -1).when(brackets > 0, 0).otherwise(1)
    return F.coalesce((amount * sign).cast(NUMBER), F.lit(0).cast(NUMBER))


def parse_money(col: Column) -> Column:
    """An amount as printed on a statement; anything unreadable is 0.

    Brackets negate, currency signs and letters are ignored, and the last separator is the decimal
    mark.  A lone comma is decimal when at most two digits follow it, otherwise it groups thousands.
    Only plain string functions are used: this runs several times per statement line.
    """
    parts = money_parts(col)
    return money_of(parts["body"], parts["sign"])


def is_money_token(col: Column) -> Column:
    """Whether one blank-delimited token looks like an amount."""
    return without_symbols(col).rlike(f"^{_TOKEN}$")
