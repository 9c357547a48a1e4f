"""File names are read once a report, and jobs that do not depend on each other run side by side."""

import threading

import pytest
from pyspark.sql import functions as F
from test_resolve import catalog_of

from ledgerloom.plans import channels as ch
from ledgerloom.scale import at_once
from ledgerloom.sources.filenames import period_of, with_period

NAMES = ["Royalty_X_MONTHLY_Mar_2024.xlsx", "X_ACX_MONTHLY_August_2019.xls", "wc-after-2024-01-01_before-2024-01-31.csv",
         "export.csv", "", None, "Royalty_X_MONTHLY_Mar_2024.xlsx", "May_2023.csv", "may_20x3.csv"]


def test_period_by_name_equals_period_by_row(spark):
    df = spark.createDataFrame([(i, n, "old") for i, n in enumerate(NAMES)], "i int, file_name string, first string")
    start, end = period_of(F.col("file_name"))
    expected = df.select("i", "file_name", start.alias("first"), end.alias("final"))
    got = with_period(df, "first", "final")
    assert got.columns == ["i", "file_name", "first", "final"]
    assert sorted(got.collect()) == sorted(expected.collect())


def test_audio_chain_does_not_read_the_file_name_row_by_row(spark):
    cells = "`Product ID` string, Title string, Currency string, `Net Units` string, `Net Sales` string, `Net Royalties Earned` string"
    raw = spark.createDataFrame([
        (NAMES[0], "B000", "Cats", "USD", "2", "3.0", "1.0"), ("export.csv", "B000", "Cats", "USD", "3", "3.0", "1.0"),
        (None, "B000", "Cats", "USD", "4", "3.0", "1.0"), (NAMES[0], None, None, None, None, None, None),
    ], f"file_name string, {cells}")
    rates = spark.createDataFrame([], "rate_date date, currency string, per_eur decimal(18,8)")
    fact = ch.normalize_audio_monthly(raw, catalog_of(spark, ["Cats"]), rates)
    assert [(str(r.sale_date), r.quantity) for r in fact.collect()] == [("2024-03-01", 2)]
    assert "lambda" not in fact._jdf.queryExecution().optimizedPlan().toString()


def test_at_once_keeps_order_and_raises():
    both = threading.Barrier(2, timeout=20)
    assert list(at_once({"b": lambda: both.wait() and 0, "a": lambda: both.wait() and 0})) == ["b", "a"]
    assert at_once({}) == {}
    with pytest.raises(ZeroDivisionError):
        at_once({"good": lambda: 1, "bad": lambda: 1 // 0})
