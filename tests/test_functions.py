"""Table-driven rules of the column expressions."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from ledgerloom.functions import dates, identifiers, numbers, text


def one(spark, expression, *values):
    """The expression's value for each input text."""
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r.out for r in df.select("i", expression(F.col("v")).alias("out")).orderBy("i").collect()]


MONEY = {
    "(10.37)": -10.37, "€1.234,56": 1234.56, "14,97": 14.97, "1,200": 1200, "-": 0, "": 0, "abc": 0, "1.234.567": 0,
    "1,234.56": 1234.56, "USD 12.50": 12.5, "($1,234.00)": -1234, "-3.50": -3.5, "(5": 0, "1,234,567": 1234567, "£0,5": 0.5,
    "12 34": 0, " 7 ": 7, "$12,345,678,901,234,567,890.50": 12345678901234567890.5,
}
IDENTIFIERS = {
    "978-1-2345": "97812345", "9781234567890.0": "9781234567890", "'b00x": "B00X", "A1.0": "A1.0", None: None, "  x-1 ": "X1",
    "''9": "'9",
}
LOOSE = {"9781234567890": "9781234567890", "978-1234567890": "9781234567890", "123456789X": "123456789X", "12345": None,
         "9781234567890.0": "9781234567890", "": None, None: None, "978 1234567890": "9781234567890"}
STRICT = {'"=""1234567890123"" "': "1234567890123", '="1234567890"': "1234567890", "123456789X": None, "n/a": None,
          "9781234567890.0": None, "'1234567890'": "1234567890"}
PERIODS = {"MAY-26": dt.date(2026, 5, 1), "apr-2025": dt.date(2025, 4, 1), None: None, "XYZ-1": None,
           "2024-03": dt.date(2024, 3, 1), "JAN-XX": None, " DEC-05 ": dt.date(2005, 12, 1)}
DATES = {"2024-01-05 00:00:00": dt.date(2024, 1, 5), "2024-01-05T23:59:59.5Z": dt.date(2024, 1, 5), "1/5/24": dt.date(2024, 1, 5),
         "1/5/99": dt.date(1999, 1, 5), "5-Jan-2024": dt.date(2024, 1, 5), "January 5, 2024": dt.date(2024, 1, 5),
         "Jan 5, 2024": dt.date(2024, 1, 5), "2024/01/05": dt.date(2024, 1, 5), "1/5/2024 3:04 PM": dt.date(2024, 1, 5),
         "2024-01": dt.date(2024, 1, 1), "Total": None, "": None, None: None, "2024-13-05": None}
BINDINGS = {"Cloth": "hardcover", "Perfectbound (Trade Paper": "paperback", "Cardboard book": "board_book", None: "unknown",
            "hard paper": "hardcover", "Wire-O": "spiral_bound", "Digital": "ebook", "??": "unknown", "Case Laminate": "hardcover"}
LONG_TITLES = {"Salt & Iron: A Novel (Book 2)": "salt and iron", "A (x) & B": "a and b", None: None, "  Plain ": "plain"}
WRAPPED = {'="Carmilla"': "Carmilla", '""Carmilla""': "Carmilla", '"=""2940185885482"" "': '="2940185885482" '.strip(), "'x'": "x",
           "plain": "plain", None: None}
COMPACT = {None: "0", "1234.5": "1.2K", "2500000": "2.5M", "999.9": "999", "1000": "1.0K"}
USD = {None: "$0.00", "1234.5": "$1,234.50", "0": "$0.00"}
MARKETS = {"LS-United States": "United States", "ls - Australia": "Australia", "Canada": "Canada", None: None}
LABELS = {"2024-11": "Nov 2024", "01": "Jan", "12": "Dec"}
SLUGS = {"fallen_gods": "Fallen Gods", "(Unmatched)": "(Unmatched)", "": "", None: None}


@pytest.mark.parametrize(
    "expression, cases",
    [
        (numbers.parse_money, MONEY),
        (identifiers.normalize_identifier, IDENTIFIERS),
        (identifiers.normalize_isbn, LOOSE),
        (lambda c: identifiers.normalize_isbn(c, True), STRICT),
        (dates.parse_period_name, PERIODS),
        (dates.parse_date, DATES),
        (text.classify_binding, BINDINGS),
        (lambda c: text.clean_title(c, True), LONG_TITLES),
        (text.format_compact, COMPACT),
        (text.format_usd, USD),
        (text.clean_market, MARKETS),
        (dates.month_label, LABELS),
        (text.prettify_slug, SLUGS),
    ],
    ids=["money", "identifier", "isbn", "strict isbn", "period", "date", "binding", "title", "compact", "usd", "market", "label", "slug"],
)
def test_rules(spark, expression, cases):
    got = one(spark, expression, *cases)
    got = [float(v) if hasattr(v, "as_tuple") else v for v in got]
    assert dict(zip(cases, got)) == cases


def test_unwrap_formula(spark):
    cells = ['="Carmilla"', '""Carmilla""', "'x'", "plain", None]
    assert one(spark, text.unwrap_formula, *cells) == ["Carmilla", "Carmilla", "x", "plain", None]


def test_coerce_and_percent(spark):
    assert [None if v is None else float(v) for v in one(spark, lambda c: numbers.coerce_number(c, None), "1.5", "x", None)] == [1.5, None, None]
    assert [float(v) for v in one(spark, numbers.coerce_number, "1.5", "x", None)] == [1.5, 0, 0]
    assert [float(v) for v in one(spark, numbers.percent_to_fraction, "35%", "70 %")] == [0.35, 0.7]


def test_money_tokens(spark):
    tokens = ["(1,2)", "€5", "-3.0", "abc", "12a", "$", "1.2.3"]
    assert one(spark, numbers.is_money_token, *tokens) == [True, True, True, False, False, False, True]


def test_file_names(spark):
    from ledgerloom.sources.filenames import period_from_filename

    names = {
        "X_MONTHLY_Apr_2026.xlsx": ("2026-04-01", "2026-04-30"),
        "X_April_2021.xls": ("2021-04-01", "2021-04-30"),
        "wc-after-2024-01-01_before-2024-01-31.csv": ("2024-01-01", "2024-01-31"),
        "January_2024.csv": ("2024-01-01", "2024-01-31"),
        "Sept_2024.csv": (None, None),
        "royaltiesMAY_2024_final.csv": ("2024-05-01", "2024-05-31"),
        "Jan_x_Feb_2023.csv": ("2023-02-01", "2023-02-28"),
        "X_Jan_20.xlsx": (None, None),
        "export.csv": (None, None),
        "X_Foo_2021.xls": (None, None),
    }
    df = period_from_filename(spark.createDataFrame([(n,) for n in names], "file_name string"))
    got = {r.file_name: tuple(None if v is None else str(v) for v in (r.period_start, r.period_end)) for r in df.collect()}
    assert got == names
