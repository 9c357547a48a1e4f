"""Currency and pool rules at their edges, and running totals against brute force."""

import datetime as dt
import random

from pyspark.sql import functions as F

from ledgerloom.operators import fx, pool, quality, trends
from ledgerloom.operators.running import running_total


def test_fx_edges(spark):
    rates = spark.createDataFrame(
        [(dt.date(2024, 1, 5), "USD", 1.1), (dt.date(2024, 1, 5), "GBP", 0.55), (dt.date(2024, 3, 1), "USD", 1.2)],
        "rate_date date, currency string, per_eur double",
    ).withColumn("per_eur", F.col("per_eur").cast("decimal(18,8)"))
    rows = [
        (1, 10.0, "GBP", "2024-01-05"), (2, 10.0, "gbp ", "2024-01-07"), (3, 10.0, "GBP", "2024-02-03"), (4, 10.0, "GBP", "2024-02-04"),
        (5, 10.0, "USD", "1990-01-01"), (6, None, "GBP", "2024-01-05"), (7, 10.0, None, "2024-01-05"), (8, 10.0, "XXX", "2024-01-05"),
        (9, 10.0, "EUR", "2024-01-06"), (10, 10.0, "GBP", "2024-01-04"), (11, 10.0, "EUR", "2024-03-02"), (12, 10.0, "GBP", "2024-03-02"),
    ]
    df = spark.createDataFrame(rows, "n int, amount double, currency string, sale_date string")
    out = fx.to_usd(df, {"amount": "usd"}, rates)
    got = {r.n: None if r.usd is None else float(r.usd) for r in out.collect()}
    assert got == {1: 20, 2: 20, 3: 20, 4: None, 5: 10, 6: None, 7: None, 8: None, 9: 11, 10: None, 11: 12, 12: None}


def test_pool_rules(spark):
    day = dt.date(2024, 5, 1)
    summary = spark.createDataFrame(
        [(day, "USD", 100.0), (day, "GBP", 0.0), (day, "EUR", None), (day, "JPY", 50.0)], "month date, currency string, summary_total double"
    ).withColumn("summary_total", F.col("summary_total").cast("decimal(28,4)"))
    detail = spark.createDataFrame([(day, "USD", 60.0), (day, "GBP", 5.0), (day, "EUR", 0.0)], "month date, currency string, royalty double")
    detail = detail.withColumn("royalty", F.col("royalty").cast("decimal(18,4)"))
    pools = {r.currency: float(r.pool) for r in pool.pool_by_month(summary, detail).collect()}
    assert pools == {"USD": 40, "GBP": -5, "JPY": 50}
    reads = spark.createDataFrame(
        [(dt.date(2024, 5, 3), "USD", 300), (dt.date(2024, 5, 9), "USD", 100), (dt.date(2024, 5, 9), "JPY", 0), (dt.date(2024, 5, 9), "EUR", 7)],
        "sale_date date, currency string, page_count long",
    )
    got = sorted((r.currency, r.page_count, None if r.royalty_amount is None else float(r.royalty_amount)) for r in pool.allocate_pool(summary, detail, reads).collect())
    assert got == [("EUR", 7, None), ("JPY", 0, None), ("USD", 100, 10.0), ("USD", 300, 30.0)]


def test_running_total_with_many_ties(spark):
    pick = random.Random(5)
    rows = [(f"t{i:04d}", pick.choice([0, 0, 0, 5, 7, i % 13])) for i in range(500)]
    df = spark.createDataFrame(rows, "k string, v long").withColumn("v", F.col("v").cast("decimal(20,2)"))
    got = [(r.k, r.row_rank, float(r.running)) for r in running_total(df, "v", [F.desc("v"), F.asc("k")]).collect()]
    expected, total = [], 0
    for rank, (k, v) in enumerate(sorted(rows, key=lambda r: (-r[1], r[0])), 1):
        total += v
        expected.append((k, rank, float(total)))
    assert sorted(got) == sorted(expected)
    assert sum(v for _, v in rows) == total


def sales_of(spark, rows):
    df = spark.createDataFrame(rows, "sale_date string, series string, canonical_work_slug string, source_platform string, amount double")
    amount = F.col("amount").cast("decimal(18,4)")
    return df.select(
        F.col("sale_date").cast("date").alias("sale_date"), "series", "canonical_work_slug", "source_platform",
        F.lit(1).cast("bigint").alias("quantity"), amount.alias("royalty_amount"), amount.alias("royalty_amount_usd"),
    )


def test_pareto_frames_on_ties(spark):
    rows = [("2024-01-01", "s", w, "p", a) for w, a in (("a", 40.0), ("b", 20.0), ("c", 20.0), ("d", 20.0))]
    by_row = {r.canonical_work_slug: r.running_share for r in trends.pareto_titles(sales_of(spark, rows), None).collect()}
    assert by_row == {"a": "40.0%", "b": "60.0%", "c": "80.0%", "d": "100.0%"}
    by_value = {r.canonical_work_slug: r.cumulative_pct for r in trends.pareto_range_frame(sales_of(spark, rows), 100).collect()}
    assert by_value == {"a": 40.0, "b": 100.0, "c": 100.0, "d": 100.0}


def test_gaps_dominance_and_calendar(spark):
    rows = [("2024-01-05", "s", "a", "x", 1.0), ("2024-04-05", "s", "a", "x", 4.0), ("2024-04-06", "s", "a", "y", 4.0)]
    sales = sales_of(spark, rows)
    gaps = {r.period: (r.status, r.transactions) for r in trends.month_gaps(sales).collect()}
    assert gaps == {"2024-01": ("ACTIVE", 1), "2024-02": ("GAP MONTH", 0), "2024-03": ("GAP MONTH", 0), "2024-04": ("ACTIVE", 2)}
    top = sorted((r.period, r.dominant_platform) for r in trends.dominant_channel(sales).collect())
    assert top == [("2024-01", "x"), ("2024-04", "x"), ("2024-04", "y")]
    events = sales.select("sale_date", F.col("royalty_amount").alias("revenue"))
    by_rows = {r.period: r.ma_3month for r in trends.moving_average(events).collect()}
    by_months = {r.period: r.ma_3month for r in trends.moving_average(events, calendar=True).collect()}
    assert by_rows["2024-04"] == "$4.50" and by_months["2024-04"] == "$2.67" and by_months["2024-03"] == "$0.33"


def test_merge_and_dedupe(spark):
    df = spark.createDataFrame(
        [("a", "f2", 1, 5, "late"), ("a", "f1", 9, 7, None), ("b", "f1", 2, 1, None), (None, "f1", 3, 1, "x")],
        "k string, file string, line int, units long, sku string",
    )
    kept = sorted(tuple(r) for r in quality.dedupe_keep_first(df.dropna(subset=["k"]), ["k"], ["file", "line"]).collect())
    assert [(r[0], r[1]) for r in kept] == [("a", "f1"), ("b", "f1")]
    merged = sorted(tuple(r) for r in quality.merge_overlapping(df, ["k"], ["units"], ["sku"], ["file", "line"]).collect())
    assert merged == [("a", 12, "late"), ("b", 1, None)]
