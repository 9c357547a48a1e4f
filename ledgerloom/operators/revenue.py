"""Revenue summaries over the fact tables and over the combined revenue events.

Every summary aggregates rows to a calendar or entity grain first (partial aggregation runs before
the shuffle) and only then ranks, shares or sorts the small result.

``events`` frames have one row per revenue event: fact, channel, sale_date, revenue, units,
distributor.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.functions.dates import MONTHS, month_label, month_start, period
from ledgerloom.functions.rounding import money2, ratio, to_cents

UNMATCHED = "(Unmatched)"
# fixed values: the six channels of the combined view
CHANNELS = ("audio_store", "book_store", "page_reads", "memberships", "web_shop", "wide_audio")


def _by_month(df: DataFrame, *keys: str, date: str = "sale_date"):
    return df.groupBy(month_start(F.col(date)).alias("month"), *keys)


def monthly_revenue(sales: DataFrame, amount: str = "royalty_amount") -> DataFrame:
    months = _by_month(sales).agg(
        F.sum("quantity").alias("units"),
        F.sum(amount).alias("total"),
        F.count(amount).alias("amounts"),
        F.count(F.lit(1)).alias("transaction_count"),
    )
    return months.select(
        period("month").alias("period"),
        F.col("units").alias("total_units"),
        money2(F.col("total")).alias("total_royalties"),
        ratio(F.col("total"), F.col("amounts")).alias("avg_per_transaction"),
        "transaction_count",
    ).orderBy("period")


def monthly_by_channel(sales: DataFrame, channel: str = "source_platform") -> DataFrame:
    months = _by_month(sales, channel).agg(
        F.sum("quantity").alias("total_units"),
        F.sum("royalty_amount_usd").alias("total"),
        F.count(F.lit(1)).alias("transaction_count"),
    )
    return months.select(
        period("month").alias("period"),
        channel,
        "total_units",
        money2(F.col("total")).alias("total_revenue"),
        "transaction_count",
    ).orderBy(F.desc("period"), channel)


def series_performance(sales: DataFrame, amount: str = "royalty_amount", positive_only: bool = False) -> DataFrame:
    """Per series; ``positive_only`` keeps series whose rounded total is above zero."""
    totals = (
        sales.where(F.col("series").isNotNull() & (F.col("series") != ""))
        .groupBy("series")
        .agg(
            F.countDistinct("canonical_work_slug").alias("unique_works"),
            F.sum("quantity").alias("total_units_sold"),
            F.sum(amount).alias("total"),
            F.sum("royalty_rate").alias("rate_sum"),
            F.count("royalty_rate").alias("rates"),
        )
    )
    if positive_only:
        totals = totals.where(to_cents(F.col("total")) > 0)
    return totals.orderBy(F.desc("total"), "series").select(
        "series",
        "unique_works",
        "total_units_sold",
        money2(F.col("total")).alias("total_royalties"),
        ratio(F.col("total"), F.col("total_units_sold")).alias("revenue_per_unit"),
        ratio(F.col("rate_sum"), F.col("rates"), digits=1, scale=100.0).alias("avg_royalty_percent"),
    )


def regional_share(sales: DataFrame, amount: str = "royalty_amount") -> DataFrame:
    """Per region with its share of the grand total.  The window runs over one row per region."""
    regions = sales.groupBy("region").agg(F.sum("quantity").alias("total_units"), F.sum(amount).alias("total"))
    grand = F.sum("total").over(Window.partitionBy())
    return regions.orderBy(F.desc("total"), "region").select(
        "region",
        "total_units",
        money2(F.col("total")).alias("total_royalties"),
        ratio(F.col("total"), grand, digits=1, scale=100.0).alias("pct_of_revenue"),
    )


def yoy_by_month(sales: DataFrame, years: list[int] | None = None, amount: str = "royalty_amount") -> DataFrame:
    """Month-of-year rows with one revenue column per year and the growth between neighbours.

    Without ``years`` all years with sales are shown; finding them reads the dates once more.
    """
    year = F.year("sale_date")
    if years is None:
        found = sales.select(year.alias("y")).where(F.col("y").isNotNull()).distinct()
        years = sorted(row.y for row in found.toLocalIterator())
    sums = sales.groupBy(F.month("sale_date").alias("m")).agg(
        *[F.sum(F.when(year == y, F.col(amount)).otherwise(F.lit(0))).alias(f"y{y}") for y in years]
    )
    columns = [F.format_string("%02d", "m").alias("month")]
    columns += [money2(F.col(f"y{y}")).alias(f"revenue_{y}") for y in years]
    for before, after in zip(years, years[1:]):
        previous, current = F.col(f"y{before}"), F.col(f"y{after}")
        growth = F.when(previous > 0, ratio(current - previous, previous, digits=1, scale=100.0))
        columns.append(growth.alias(f"yoy_growth_pct_{after}_vs_{before}"))
    return sums.orderBy("m").select(*columns)


def top_titles(sales: DataFrame, n: int = 10, amount: str = "royalty_amount") -> DataFrame:
    """Best works by total; ties go to the lower slug."""
    works = sales.groupBy("canonical_work_slug").agg(
        F.min("series").alias("series"),
        F.sum("quantity").alias("total_units_sold"),
        F.sum(amount).alias("total"),
        F.min("sale_date").alias("first_sale"),
        F.max("sale_date").alias("last_sale"),
    )
    best = works.orderBy(F.desc("total"), "canonical_work_slug").limit(n)
    return best.select(
        "canonical_work_slug",
        "series",
        "total_units_sold",
        money2(F.col("total")).alias("total_royalties"),
        "first_sale",
        "last_sale",
    )


def best_months(sales: DataFrame, n: int = 5, amount: str = "royalty_amount") -> DataFrame:
    months = _by_month(sales).agg(
        F.sum("quantity").alias("total_units"), F.sum(amount).alias("total"), F.count(amount).alias("amounts")
    )
    best = months.orderBy(F.desc("total"), "month").limit(n)
    return best.select(
        period("month").alias("period"),
        "total_units",
        money2(F.col("total")).alias("total_royalties"),
        ratio(F.col("total"), F.col("amounts")).alias("avg_transaction_value"),
    )


def distributor_breakdown(statements: DataFrame) -> DataFrame:
    totals = statements.groupBy(F.coalesce("distributor", F.lit("Unknown")).alias("distributor")).agg(
        F.sum("royalty_amount_usd").alias("total"),
        F.count("royalty_amount_usd").alias("amounts"),
        F.sum("quantity").alias("total_units"),
        F.count(F.lit(1)).alias("transaction_count"),
    )
    return totals.orderBy(F.desc("total"), "distributor").select(
        "distributor",
        money2(F.col("total")).alias("total_revenue"),
        "total_units",
        "transaction_count",
        ratio(F.col("total"), F.col("amounts")).alias("avg_transaction_value"),
    )


def product_performance(shop: DataFrame, n: int = 10) -> DataFrame:
    products = shop.groupBy("product_name").agg(F.sum("items_sold").alias("units"), F.sum("net_sales").alias("total"))
    best = products.orderBy(F.desc("total"), "product_name").limit(n)
    return best.select("product_name", "units", money2(F.col("total")).alias("revenue"))


def membership_monthly(memberships: DataFrame) -> DataFrame:
    months = _by_month(memberships).agg(F.sum("net_earnings").alias("total"))
    return months.select(period("month").alias("period"), money2(F.col("total")).alias("net")).orderBy("period")


def page_reads_monthly(reads: DataFrame) -> DataFrame:
    """Monthly pages, revenue and equivalent copies of the reads that earned something."""
    months = _by_month(reads.where(F.col("royalty_amount_usd") > 0)).agg(
        F.sum("page_count").alias("pages_read"),
        F.sum("royalty_amount_usd").alias("total"),
        F.sum("equivalent_copies").alias("copies"),
    )
    return months.orderBy(F.desc("month")).select(
        period("month").alias("period"),
        "pages_read",
        money2(F.col("total")).alias("revenue"),
        money2(F.col("copies")).alias("equiv_copies"),
        ratio(to_cents(F.col("total")), to_cents(F.col("copies"))).alias("revenue_per_copy"),
    )


def books_vs_merch(shop: DataFrame) -> DataFrame:
    """Month by kind, with the books' share of everything sold."""
    kind = F.when(F.col("series").isNotNull(), "Books").otherwise("Merchandise")
    months = _by_month(shop.withColumn("kind", kind), "kind").agg(
        F.sum("items_sold").alias("units"), to_cents(F.sum("net_sales")).alias("total")
    )
    everything = Window.partitionBy()
    books = F.sum(F.when(F.col("kind") == "Books", F.col("total"))).over(everything)
    return months.orderBy("month", "kind").select(
        period("month").alias("period"),
        F.col("kind").alias("category"),
        "units",
        money2(F.col("total")).alias("revenue"),
        ratio(F.coalesce(books, F.lit(0)), F.sum("total").over(everything), digits=1, scale=100.0).alias(
            "books_pct_of_total"
        ),
    )


# ---------------------------------------------------------------- combined channels


def channel_periods(events: DataFrame, *extra: str) -> DataFrame:
    """Month by channel totals, rounded per branch: the common start of the combined reports."""
    return _by_month(events, *extra, "channel").agg(
        to_cents(F.sum("revenue")).alias("revenue"),
        F.round(F.sum("units"), 0).cast("bigint").alias("units"),
    )


def channel_totals(events: DataFrame) -> DataFrame:
    totals = events.groupBy("channel").agg(
        to_cents(F.sum("revenue")).alias("total"), F.count(F.lit(1)).alias("record_count")
    )
    return (
        totals.where("total > 0")
        .orderBy(F.desc("total"), "channel")
        .select("channel", F.col("total").cast("double").alias("total_revenue"), "record_count")
    )


def top_month(events: DataFrame) -> DataFrame:
    months = channel_periods(events).groupBy("month").agg(F.sum("revenue").alias("total"))
    best = months.orderBy(F.desc("total"), "month").limit(1)
    label = month_label(period("month"))
    return best.select(period("month").alias("period"), label.alias("label"), money2(F.col("total")).alias("total_revenue"))


def active_range(events: DataFrame) -> DataFrame:
    span = events.agg(F.min("sale_date").alias("earliest"), F.max("sale_date").alias("latest"))
    years = F.concat(F.year("earliest").cast("string"), F.lit("–"), F.year("latest").cast("string"))
    return span.select("earliest", "latest", years.alias("active_period"))


def channel_cards(events: DataFrame) -> DataFrame:
    cards = events.groupBy("channel").agg(
        F.count(F.lit(1)).alias("record_count"),
        F.sum("revenue").alias("total"),
        F.count("revenue").alias("amounts"),
        F.sum("units").alias("n"),
        F.countDistinct("distributor").alias("distributors"),
    )
    return cards.orderBy("channel").select(
        "channel",
        "record_count",
        money2(F.col("total")).alias("revenue_sum"),
        ratio(F.col("total"), F.col("amounts")).alias("avg_transaction"),
        F.round("n", 0).cast("bigint").alias("units"),
        "distributors",
    )


def channel_monthly(events: DataFrame) -> DataFrame:
    return (
        channel_periods(events)
        .select(period("month").alias("period"), "channel", F.col("revenue").cast("double").alias("revenue"), "units")
        .orderBy("period", "channel")
    )


def _yearly(events: DataFrame) -> DataFrame:
    return events.groupBy(F.year("sale_date").alias("year"), "channel").agg(
        to_cents(F.sum("revenue")).alias("revenue")
    )


def channel_yearly(events: DataFrame, channels: tuple[str, ...] = CHANNELS) -> DataFrame:
    """Year rows, one column per channel and a total; years without sales in a channel hold 0."""
    wide = _yearly(events).groupBy("year").pivot("channel", list(channels)).agg(F.sum("revenue"))
    filled = {c: F.coalesce(F.col(c), F.lit(0)).cast("decimal(28,2)") for c in channels}
    total = sum(filled.values(), F.lit(0).cast("decimal(28,2)"))
    return wide.orderBy("year").select(
        F.col("year").cast("string").alias("year"),
        *[value.cast("double").alias(name) for name, value in filled.items()],
        total.cast("double").alias("total"),
    )


def year_summary(events: DataFrame) -> DataFrame:
    """Latest year against the one before, and the best year (the earliest one on a tie)."""
    years = _yearly(events).groupBy("year").agg(F.sum("revenue").alias("total"))
    before = Window.orderBy("year")
    with_previous = years.select(
        "year", "total", F.lag("year").over(before).alias("prev_year"), F.lag("total").over(before).alias("prev_total")
    )
    picked = with_previous.agg(
        F.max_by(F.struct("year", "total", "prev_year", "prev_total"), F.col("year")).alias("latest"),
        F.max(F.struct("total", (-F.col("year")).alias("key"), "year")).alias("best"),
    )
    growth = ratio(F.col("latest.total") - F.col("latest.prev_total"), F.col("latest.prev_total"), 1, 100.0)
    return picked.select(
        F.col("latest.year").cast("string").alias("latest_year"),
        money2(F.col("latest.total")).alias("latest_revenue"),
        F.col("latest.prev_year").cast("string").alias("previous_year"),
        money2(F.col("latest.prev_total")).alias("previous_revenue"),
        growth.alias("growth_pct"),
        F.col("best.year").cast("string").alias("best_year"),
        money2(F.col("best.total")).alias("best_revenue"),
    )


def season_cells(events: DataFrame) -> DataFrame:
    """Year by month-of-year totals: rounded per fact table, then added."""
    per_fact = _by_month(events, "fact").agg(to_cents(F.sum("revenue")).alias("revenue"))
    return per_fact.groupBy("month").agg(F.sum("revenue").alias("revenue")).select(
        F.year("month").alias("year"), F.month("month").alias("m"), "month", "revenue"
    )


def season_heatmap(events: DataFrame) -> DataFrame:
    """Year rows with all twelve months, empty cells as 0."""
    wide = season_cells(events).groupBy("year").pivot("m", list(range(1, 13))).agg(F.sum("revenue"))
    cells = [
        F.coalesce(F.col(f"`{i}`"), F.lit(0)).cast("double").alias(name.lower()) for i, name in enumerate(MONTHS, 1)
    ]
    return wide.orderBy("year").select(F.col("year").cast("string").alias("year"), *cells)


def season_stats(events: DataFrame) -> DataFrame:
    """Month-of-year mean, range and sample deviation, plus the extreme months over all years.

    On ties the earliest month wins.  A month seen in one year has no deviation and is ignored when
    the most and least consistent months are chosen.
    """
    stats = season_cells(events).groupBy("m").agg(
        F.sum("revenue").alias("total"),
        F.count("revenue").alias("n"),
        F.min("revenue").alias("low"),
        F.max("revenue").alias("high"),
        F.round(F.stddev_samp(F.col("revenue").cast("double")).cast("decimal(28,6)"), 2).alias("std"),
        F.min(F.struct("revenue", "month")).alias("worst"),
        F.max(F.struct("revenue", F.date_diff(F.lit("1970-01-01").cast("date"), F.col("month")), "month")).alias("best"),
    )
    months = Window.partitionBy()
    has_std = F.col("std").isNotNull()
    steady = F.min(F.when(has_std, F.struct("std", "m"))).over(months)
    unsteady = F.max(F.when(has_std, F.struct("std", (-F.col("m")).alias("key"), "m"))).over(months)

    def label(number):
        return month_label(F.format_string("%02d", number))

    return stats.orderBy("m").select(
        F.format_string("%02d", "m").alias("month"),
        label(F.col("m")).alias("month_name"),
        ratio(F.col("total"), F.col("n")).alias("avg_revenue"),
        F.col("low").cast("double").alias("min_revenue"),
        F.col("high").cast("double").alias("max_revenue"),
        F.col("std").cast("double").alias("std_revenue"),
        month_label(period(F.max("best").over(months)["month"])).alias("best_month_ever"),
        month_label(period(F.min("worst").over(months)["month"])).alias("worst_month_ever"),
        label(steady["m"]).alias("most_consistent_month"),
        label(unsteady["m"]).alias("least_consistent_month"),
    )
