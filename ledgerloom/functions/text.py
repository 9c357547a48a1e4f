"""Text cleaning: blanks, titles, codes, formula wrappers, labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_BLANKS = " \t\n\r\f\u000b"


def strip(col: Column) -> Column:
    """Trim every kind of white space, not only spaces."""
    return F.btrim(col, F.lit(_BLANKS))


def blank_to_null(col: Column) -> Column:
    return F.nullif(strip(col), F.lit(""))


def clean_title(col: Column, strip_subtitle: bool = False) -> Column:
    """Lower-case, ``&`` spelled out, trimmed.

    The long form first drops ``: subtitle`` and parenthesised parts, which must happen before
    ``&`` is replaced and the ends are trimmed.
    """
    title = F.lower(col)
    if strip_subtitle:
        title = F.regexp_replace(strip(title), r"\s*:\s*.*$", "")
        title = F.regexp_replace(title, r"\s*\([^)]*\)", "")
    return strip(F.replace(title, F.lit("&"), F.lit("and")))


def clean_market(col: Column) -> Column:
    """Drop the ``LS-`` / ``LS - `` prefix of a market name, in any case."""
    return strip(F.regexp_replace(strip(col), r"(?i)^LS\s*-\s*", ""))


def unwrap_formula(col: Column) -> Column:
    """Peel spreadsheet wrapping, one layer at a time: quotes, ``="x"``, quotes, single quotes."""
    value = strip(col)
    for layer in (r'(?s)^"(.*)"$', r'(?s)^="(.*)"$', r'(?s)^"(.*)"$', r"(?s)^'(.*)'$"):
        value = F.regexp_replace(value, layer, "$1")
    return value


def classify_binding(col: Column) -> Column:
    """Binding description to edition format; the first rule that matches wins, NULL is unknown."""
    text = F.lower(strip(col))

    def mentions(*words: str) -> Column:
        hit = F.lit(False)
        for word in words:
            hit = hit | F.contains(text, F.lit(word))
        return hit

    return (
        F.when(text.isNull(), "unknown")
        .when(mentions("cloth", "laminate", "hard"), "hardcover")
        .when(mentions("perfect", "paper", "soft"), "paperback")
        .when(mentions("ebook", "digital"), "ebook")
        .when(mentions("board"), "board_book")
        .when(mentions("spiral", "wire"), "spiral_bound")
        .otherwise("unknown")
    )


def infer_edition(catalog_format: Column, source_label: Column | None = None) -> Column:
    """Catalog format when present, else what the source label says, else ebook."""
    known = F.when(strip(catalog_format) != "", catalog_format)
    if source_label is None:
        return F.coalesce(known, F.lit("ebook"))
    label = F.lower(F.coalesce(source_label, F.lit("")))
    guess = (
        F.when(label.rlike("nook|ebook|digital"), "ebook")
        .when(label.rlike("paper|soft"), "paperback")
        .when(label.rlike("hard"), "hardcover")
        .otherwise("ebook")
    )
    return F.coalesce(known, guess)


def prettify_slug(col: Column) -> Column:
    """``fallen_gods`` to ``Fallen Gods``; blank and the unmatched label stay as they are."""
    keep = (col == "") | (col == "(Unmatched)")
    return F.when(keep, col).otherwise(F.initcap(F.replace(col, F.lit("_"), F.lit(" "))))


def format_usd(col: Column, thousands: bool = True) -> Column:
    """``$1,234.50``; NULL is ``$0.00``.  Without thousands marks: ``$1234.50``."""
    amount = F.coalesce(F.round(col.cast("decimal(30,6)"), 2), F.lit(0).cast("decimal(30,2)"))
    if not thousands:
        return F.concat(F.lit("$"), amount.cast("decimal(30,2)").cast("string"))
    return F.concat(F.lit("$"), F.format_number(amount, 2))


def format_compact(col: Column) -> Column:
    """``1.2M``, ``3.4K`` or a whole number; NULL is ``0``."""
    value = col.cast("decimal(30,6)")

    def scaled(divisor: int, suffix: str) -> Column:
        short = F.round((value / F.lit(divisor)).cast("decimal(30,6)"), 1).cast("decimal(30,1)")
        return F.concat(short.cast("string"), F.lit(suffix))

    return (
        F.when(value.isNull(), "0")
        .when(value >= 1_000_000, scaled(1_000_000, "M"))
        .when(value >= 1_000, scaled(1_000, "K"))
        .otherwise(value.cast("bigint").cast("string"))
    )
