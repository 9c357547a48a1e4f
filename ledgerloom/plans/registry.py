"""Registered queries: every operator on the driver's tables, as ``(spark, folder) -> DataFrame``."""

from __future__ import annotations

from ledgerloom.operators import revenue, trends
from ledgerloom.plans import stand_ins as t
from ledgerloom.plans.cleaning import CLEANING
from ledgerloom.plans.filing import FILING
from ledgerloom.plans.matching import MATCHING
from ledgerloom.plans.reports import CHANNEL_JOBS


def _on(build, *columns, **options):
    return lambda run, **more: lambda spark, folder: run(build(spark, folder, *columns, **options), **more)


_sales = _on(t.sales)
_sales_products = _on(t.sales, "canonical_work_slug", "series")
_events = _on(t.revenue_events)

REVENUE = {
    "monthly_revenue": _sales(revenue.monthly_revenue),
    "monthly_by_channel": _sales(revenue.monthly_by_channel),
    "series_performance": _sales_products(revenue.series_performance, positive_only=True),
    "regional_share": _on(t.sales, "region")(revenue.regional_share),
    "yoy_by_month": _sales(revenue.yoy_by_month),
    "top_titles": _sales_products(revenue.top_titles),
    "best_months": _sales(revenue.best_months),
    "distributor_breakdown": _on(t.statements)(revenue.distributor_breakdown),
    "product_performance": _on(t.shop)(revenue.product_performance),
    "membership_monthly": _on(t.memberships)(revenue.membership_monthly),
    "page_reads_monthly": _on(t.reads)(revenue.page_reads_monthly),
    "books_vs_merch": _on(t.shop)(revenue.books_vs_merch),
    "channel_totals": _events(revenue.channel_totals),
    "top_month": _events(revenue.top_month),
    "active_range": _on(t.revenue_events, earned_reads_only=False)(revenue.active_range),
    "channel_cards": _events(revenue.channel_cards),
    "channel_monthly": _events(revenue.channel_monthly),
    "channel_yearly": _events(revenue.channel_yearly),
    "year_summary": _events(revenue.year_summary),
    "season_heatmap": _events(revenue.season_heatmap),
    "season_stats": _events(revenue.season_stats),
}

TRENDS = {
    "rank_in_series": _sales_products(trends.rank_in_series),
    "mom_growth": _sales(trends.mom_growth),
    "cumulative_revenue": _sales(trends.cumulative_revenue),
    "cumulative_by_channel": _events(trends.cumulative_by_channel),
    "pareto_titles": _sales_products(trends.pareto_titles),
    "pareto_range_frame": _on(t.sales, "canonical_work_slug")(trends.pareto_range_frame),
    "pareto_summary": _sales_products(trends.pareto_summary),
    "pareto_series": _on(t.sales, "series")(trends.pareto_series),
    "moving_average": _events(trends.moving_average),
    "ttm_run_rate": _events(trends.ttm_run_rate),
    "month_gaps": _on(t.sales, "l_partkey")(trends.month_gaps, keys=("l_partkey",)),
    "dominant_channel": _sales(trends.dominant_channel),
    "concentration": _events(trends.concentration),
    "concentration_summary": _events(trends.concentration_summary),
    "share_over_time": _events(lambda df: trends.share_over_time(revenue.channel_periods(df), "channel")),
    "yoy_monthly_lines": _events(trends.yoy_monthly_lines),
}

QUERIES = {**FILING, **CLEANING, **MATCHING, **REVENUE, **TRENDS, **CHANNEL_JOBS}
