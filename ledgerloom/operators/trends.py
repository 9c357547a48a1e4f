"""Rankings, growth, running totals, moving windows and gaps.

Windows without a partition key only ever run over calendar grains (months or years), which stay
small however many facts there are.  Orderings over titles go through
:mod:`ledgerloom.operators.running`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.functions.dates import month_label, month_start, period
from ledgerloom.functions.rounding import dollars, money2, ratio, ratio_decimal, to_cents
from ledgerloom.operators.revenue import UNMATCHED, channel_periods, season_cells
from ledgerloom.operators.running import running_total

# fixed values: wording of the risk levels
HIGH_RISK, MODERATE_RISK, HEALTHY = "⚠️ HIGH RISK", "⚡ MODERATE-RISK", "✓ HEALTHY"


def _percent(value: Column) -> Column:
    return F.concat(value.cast("string"), F.lit("%"))


def _months(df: DataFrame, *keys: str, amount: str = "royalty_amount_usd") -> DataFrame:
    return df.groupBy(month_start(F.col("sale_date")).alias("month"), *keys).agg(
        to_cents(F.sum(amount)).alias("revenue")
    )


def rank_in_series(sales: DataFrame, n: int = 5) -> DataFrame:
    """Top ``n`` works of each series with their share of the series.

    Series totals come from an aggregation of their own: a filter on the row number alone lets
    Spark cut each series to ``n`` rows before the shuffle, however many works it has.
    """
    known = sales.where(F.col("series").isNotNull())
    works = known.groupBy("series", "canonical_work_slug").agg(F.sum("royalty_amount_usd").alias("book"))
    totals = works.groupBy("series").agg(F.sum("book").alias("series_sum"))
    order = Window.partitionBy("series").orderBy(F.desc("book"), "canonical_work_slug")
    top = works.withColumn("rank_in_series", F.row_number().over(order)).where(F.col("rank_in_series") <= n)
    return (
        top.join(totals, "series")
        .orderBy("series", "rank_in_series")
        .select(
            "series",
            "canonical_work_slug",
            F.col("rank_in_series").cast("bigint").alias("rank_in_series"),
            dollars(F.col("book")).alias("book_revenue"),
            dollars(F.col("series_sum")).alias("series_total"),
            _percent(ratio_decimal(F.col("book"), F.col("series_sum"))).alias("contribution_pct"),
        )
    )


def mom_growth(sales: DataFrame, channel: str = "source_platform") -> DataFrame:
    """Month over month change per channel; the growth is ``N/A`` without a non-zero month before."""
    previous = F.lag("revenue").over(Window.partitionBy(channel).orderBy("month"))
    months = _months(sales, channel).withColumn("prev", previous)
    before = F.coalesce("prev", F.lit(0))
    growth = _percent(ratio_decimal(F.col("revenue") - F.col("prev"), F.col("prev")))
    no_base = F.col("prev").isNull() | (F.col("prev") == 0)
    return months.orderBy(channel, F.desc("month")).select(
        channel,
        period("month").alias("period"),
        dollars(F.col("revenue")).alias("current_revenue"),
        dollars(before).alias("previous_revenue"),
        dollars(F.col("revenue") - before).alias("absolute_change"),
        F.when(no_base, "N/A").otherwise(growth).alias("pct_growth"),
    )


def cumulative_revenue(sales: DataFrame) -> DataFrame:
    so_far = Window.orderBy("month").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    months = _months(sales).withColumn("cumulative", F.sum("revenue").over(so_far))
    return months.orderBy("month").select(
        period("month").alias("period"),
        F.col("revenue").cast("double").alias("revenue"),
        money2(F.col("cumulative")).alias("cumulative"),
    )


def cumulative_by_channel(events: DataFrame) -> DataFrame:
    """Running totals per channel and over all channels, ordered by (period, channel)."""
    unbounded = (Window.unboundedPreceding, Window.currentRow)
    per_channel = Window.partitionBy("channel").orderBy("month").rowsBetween(*unbounded)
    overall = Window.orderBy("month", "channel").rowsBetween(*unbounded)
    return (
        channel_periods(events)
        .withColumn("channel_total", F.sum("revenue").over(per_channel))
        .withColumn("overall_total", F.sum("revenue").over(overall))
        .orderBy("month", "channel")
        .select(
            period("month").alias("period"),
            "channel",
            F.col("revenue").cast("double").alias("revenue"),
            money2(F.col("channel_total")).alias("cumulative_revenue"),
            money2(F.col("overall_total")).alias("total_cumulative"),
        )
    )


# ---------------------------------------------------------------- Pareto


def _title_revenue(sales: DataFrame) -> DataFrame:
    """One row per (series, work); rows without a work slug do not take part."""
    named = sales.where(F.col("canonical_work_slug").isNotNull())
    return named.groupBy(F.coalesce("series", F.lit(UNMATCHED)).alias("work_group"), "canonical_work_slug").agg(
        F.sum("quantity").alias("units_sold"),
        to_cents(F.sum("royalty_amount_usd")).alias("total"),
        F.count(F.lit(1)).alias("transaction_count"),
    )


def _ranked_titles(sales: DataFrame) -> DataFrame:
    order = [F.desc("total"), F.asc("canonical_work_slug"), F.asc("work_group")]
    ranked = running_total(_title_revenue(sales), "total", order)
    return ranked.withColumn("cumulative_pct", ratio_decimal(F.col("running"), F.col("grand_total")))


def pareto_titles(sales: DataFrame, cutoff: float | None = 80) -> DataFrame:
    """Titles by revenue with cumulative revenue and share; with a cutoff, the rows up to it."""
    ranked = _ranked_titles(sales)
    if cutoff is not None:
        ranked = ranked.where(F.col("cumulative_pct") <= cutoff)
    return ranked.select(
        F.col("row_rank").alias("rank"),
        "work_group",
        "canonical_work_slug",
        dollars(F.col("total")).alias("revenue"),
        "units_sold",
        "transaction_count",
        money2(F.col("running")).alias("cumulative_revenue"),
        money2(F.col("grand_total")).alias("grand_total"),
        _percent(F.col("cumulative_pct")).alias("running_share"),
    )


def pareto_range_frame(sales: DataFrame, cutoff: float = 80) -> DataFrame:
    """Pareto in which titles of equal revenue share one cumulative value.

    The running total goes over the distinct revenue values; every title then picks up the value of
    its own revenue.
    """
    titles = sales.groupBy("canonical_work_slug").agg(to_cents(F.sum("royalty_amount_usd")).alias("total"))
    levels = titles.groupBy("total").agg(F.sum("total").alias("level"))
    ranked = running_total(levels, "level", [F.desc("total")])
    share = ratio_decimal(F.col("running"), F.col("grand_total"))
    within = ranked.withColumn("cumulative_pct", share).where(F.col("cumulative_pct") <= cutoff)
    return titles.join(within.select("total", "cumulative_pct"), "total").select(
        "canonical_work_slug",
        F.col("total").cast("double").alias("revenue"),
        F.col("cumulative_pct").cast("double").alias("cumulative_pct"),
    )


def pareto_summary(sales: DataFrame, cutoff: float = 80) -> DataFrame:
    """How many titles there are and how many carry the revenue up to the cutoff."""
    counts = _ranked_titles(sales).agg(
        F.count(F.lit(1)).alias("total_titles"),
        F.count_if(F.col("cumulative_pct") <= cutoff).alias("titles_for_cutoff"),
        F.max("grand_total").alias("grand_total"),
    )
    return counts.select(
        "total_titles",
        "titles_for_cutoff",
        ratio(F.col("titles_for_cutoff"), F.col("total_titles"), 1, 100.0).alias("pct_of_titles"),
        money2(F.col("grand_total")).alias("grand_total"),
    )


def pareto_series(sales: DataFrame) -> DataFrame:
    series = (
        sales.where(F.col("series").isNotNull())
        .groupBy(F.col("series").alias("series_name"))
        .agg(to_cents(F.sum("royalty_amount_usd")).alias("total"))
    )
    ranked = running_total(series, "total", [F.desc("total"), F.asc("series_name")])
    return ranked.select(
        "series_name",
        F.col("total").cast("double").alias("total_revenue"),
        F.col("row_rank").alias("rank"),
        ratio(F.col("running"), F.col("grand_total"), 1, 100.0).alias("cumulative_pct"),
    )


# ---------------------------------------------------------------- moving windows


def combined_months(events: DataFrame, rounded_branches: bool = False, calendar: bool = False) -> DataFrame:
    """All-channel month totals.

    ``rounded_branches`` rounds each channel before adding, as the dashboard form does.
    ``calendar`` inserts the months without any sale, so that frames count months and not rows.
    """
    if rounded_branches:
        months = channel_periods(events).groupBy("month").agg(F.sum("revenue").alias("revenue"))
    else:
        months = events.groupBy(month_start(F.col("sale_date")).alias("month")).agg(F.sum("revenue").alias("revenue"))
    if calendar:
        months = calendar_months(months).join(months, "month", "left").na.fill(0, ["revenue"])
    return months


def moving_average(events: DataFrame, sizes: tuple[int, ...] = (3, 12), calendar: bool = False) -> DataFrame:
    """Monthly revenue with moving averages over the last ``sizes`` rows."""
    months = combined_months(events, calendar=calendar)
    columns = [period("month").alias("period"), dollars(F.col("revenue")).alias("monthly_revenue")]
    for size in sizes:
        frame = Window.orderBy("month").rowsBetween(1 - size, 0)
        mean = ratio_decimal(F.sum("revenue").over(frame), F.count("revenue").over(frame), 2, 1.0)
        columns.append(dollars(mean).alias(f"ma_{size}month"))
    return months.orderBy("month").select(*columns)


def ttm_run_rate(events: DataFrame, size: int = 12, last: int = 24, calendar: bool = False) -> DataFrame:
    """Trailing sums over ``size`` rows; the latest ``last`` periods, newest first.

    ``growth_pct`` is the change of the trailing sum from the first period of all to the latest.
    """
    frame = Window.orderBy("month").rowsBetween(1 - size, 0)
    rates = combined_months(events, calendar=calendar).withColumn("ttm", F.sum("revenue").over(frame))
    whole = Window.partitionBy()
    start, latest = F.min_by("ttm", "month").over(whole), F.max_by("ttm", "month").over(whole)
    growth = F.when(start > 0, ratio(to_cents(latest) - to_cents(start), to_cents(start), 1, 100.0)).otherwise(F.lit(0.0))
    with_growth = rates.withColumn("growth_pct", growth)
    return (
        with_growth.orderBy(F.desc("month"))
        .limit(last)
        .select(
            period("month").alias("period"),
            dollars(F.col("revenue")).alias("monthly_revenue"),
            dollars(F.col("ttm")).alias("ttm_run_rate"),
            "growth_pct",
        )
    )


# ---------------------------------------------------------------- gaps, dominance, concentration


def calendar_months(df: DataFrame, month: str = "month", keys: tuple[str, ...] = ()) -> DataFrame:
    """Every month from the first to the last one seen (per key)."""
    span = df.groupBy(*keys).agg(F.min(month).alias("first"), F.max(month).alias("final"))
    steps = F.sequence("first", "final", F.expr("interval 1 month"))
    return span.where(F.col("first").isNotNull()).select(*keys, F.explode(steps).alias("month"))


def month_gaps(sales: DataFrame, keys: tuple[str, ...] = ()) -> DataFrame:
    """Calendar from first to last active month (per key); months without sales are gaps."""
    active = sales.groupBy(month_start(F.col("sale_date")).alias("month"), *keys).agg(
        F.count(F.lit(1)).alias("n"), to_cents(F.sum("royalty_amount_usd")).alias("revenue")
    )
    months = calendar_months(active, keys=keys).join(active, ["month", *keys], "left")
    return months.select(
        *keys,
        period("month").alias("period"),
        F.coalesce("n", F.lit(0)).alias("transactions"),
        F.coalesce("revenue", F.lit(0)).cast("double").alias("revenue"),
        F.when(F.col("n").isNull(), "GAP MONTH").otherwise("ACTIVE").alias("status"),
    )


def dominant_channel(sales: DataFrame, channel: str = "source_platform") -> DataFrame:
    """The channel with the month's highest revenue; a tie gives several rows."""
    best = F.max("revenue").over(Window.partitionBy("month"))
    top = _months(sales, channel).withColumn("best", best).where("revenue = best")
    return top.orderBy(F.desc("month"), channel).select(
        period("month").alias("period"),
        F.col(channel).alias("dominant_platform"),
        dollars(F.col("revenue")).alias("top_revenue"),
        F.col("best").cast("double").alias("confirmation"),
    )


def _top_shares(events: DataFrame) -> DataFrame:
    """Per month: top channel share, number of channels, total of the rounded channel sums."""
    month_total = F.sum("revenue").over(Window.partitionBy("month"))
    shares = channel_periods(events).withColumn("month_total", month_total)
    share = ratio_decimal(F.col("revenue"), F.col("month_total"))
    return shares.withColumn("share", share).groupBy("month").agg(
        F.max("share").alias("top_share"),
        F.countDistinct("channel").alias("channels"),
        F.max("month_total").alias("total"),
    )


def concentration(events: DataFrame, others: int = 5) -> DataFrame:
    """Top channel share, diversification score and risk level per month.

    ``others`` is the number of channels besides the first one that would make the score 100.
    """
    risk = (
        F.when(F.col("top_share") >= 80, HIGH_RISK)
        .when(F.col("top_share") >= 70, MODERATE_RISK)
        .otherwise(HEALTHY)
    )
    return _top_shares(events).orderBy(F.desc("month")).select(
        period("month").alias("period"),
        _percent(F.col("top_share")).alias("top_platform_share"),
        F.col("channels").alias("active_platforms"),
        _percent(ratio_decimal(F.col("channels") - 1, F.lit(others))).alias("diversification_score"),
        dollars(F.col("total")).alias("total_revenue"),
        risk.alias("risk_level"),
    )


def concentration_summary(events: DataFrame) -> DataFrame:
    picked = _top_shares(events).agg(
        F.max_by("top_share", "month").alias("latest"),
        F.sum("top_share").alias("total"),
        F.count("top_share").alias("n"),
        F.max("top_share").alias("highest"),
    )
    return picked.select(
        F.col("latest").cast("double").alias("latest_share"),
        ratio(F.col("total"), F.col("n"), 1).alias("avg_share"),
        F.col("highest").cast("double").alias("max_share"),
    )


def share_over_time(months: DataFrame, key: str) -> DataFrame:
    """Each key's share of its month; ``months`` has month, key, revenue."""
    total = F.sum("revenue").over(Window.partitionBy("month"))
    return months.select(
        period("month").alias("period"),
        key,
        F.col("revenue").cast("double").alias("revenue"),
        ratio(F.col("revenue"), total, 1, 100.0).alias("share_pct"),
    )


def yoy_monthly_lines(events: DataFrame) -> DataFrame:
    """Long form for year lines: one row per month of year and year."""
    return season_cells(events).orderBy("m", "year").select(
        month_label(F.format_string("%02d", "m")).alias("month_name"),
        F.col("year").cast("string").alias("year"),
        F.col("revenue").cast("double").alias("revenue"),
    )
