"""Oracles of the revenue summaries and the trend reports."""

from oracles.facts import ctes, m2, ratio, ratio_dec, usd

YEARS = tuple(range(1995, 2002))  # all years of the sales
CHANNELS = ("audio_store", "book_store", "page_reads", "memberships", "web_shop", "wide_audio")
_MONTH_NAMES = "['Jan','Feb','Mar','Apr','May','Jun','Jul','Aug','Sep','Oct','Nov','Dec']"


def _year_sum(year: int) -> str:
    return f"sum(CASE WHEN year(sale_date) = {year} THEN royalty_amount ELSE 0 END)"


def _growth(before: int, after: int) -> str:
    a, b = _year_sum(before), _year_sum(after)
    return f"CASE WHEN {a} > 0 THEN {ratio(f'({b} - {a})', a, 1, '100.0')} END AS yoy_growth_pct_{after}_vs_{before}"


ORACLES = {
    "monthly_revenue": ctes("sales") + f"""
        SELECT strftime(sale_date, '%Y-%m') AS period, CAST(sum(quantity) AS BIGINT) AS total_units,
               {m2('sum(royalty_amount)')} AS total_royalties,
               {ratio('sum(royalty_amount)', 'count(*)')} AS avg_per_transaction, count(*) AS transaction_count
        FROM sales GROUP BY 1""",
    "monthly_by_channel": ctes("sales") + f"""
        SELECT strftime(sale_date, '%Y-%m') AS period, source_platform, CAST(sum(quantity) AS BIGINT) AS total_units,
               {m2('sum(royalty_amount_usd)')} AS total_revenue, count(*) AS transaction_count
        FROM sales GROUP BY 1, 2""",
    "series_performance": ctes("sales") + f"""
        SELECT series, count(DISTINCT canonical_work_slug) AS unique_works,
               CAST(sum(quantity) AS BIGINT) AS total_units_sold, {m2('sum(royalty_amount)')} AS total_royalties,
               {ratio('sum(royalty_amount)', 'sum(quantity)')} AS revenue_per_unit,
               {ratio('sum(royalty_rate)', 'count(royalty_rate)', 1, '100.0')} AS avg_royalty_percent
        FROM sales WHERE series IS NOT NULL GROUP BY 1 HAVING round(sum(royalty_amount), 2) > 0""",
    "regional_share": ctes("sales") + f"""
        SELECT region, CAST(sum(quantity) AS BIGINT) AS total_units, {m2('sum(royalty_amount)')} AS total_royalties,
               {ratio('sum(royalty_amount)', '(SELECT sum(royalty_amount) FROM sales)', 1, '100.0')} AS pct_of_revenue
        FROM sales GROUP BY 1""",
    "yoy_by_month": ctes("sales") + f"""
        SELECT strftime(sale_date, '%m') AS month,
               {', '.join(f'{m2(_year_sum(y))} AS revenue_{y}' for y in YEARS)},
               {', '.join(_growth(a, b) for a, b in zip(YEARS, YEARS[1:]))}
        FROM sales GROUP BY 1""",
    "top_titles": ctes("sales") + f"""
        SELECT canonical_work_slug, min(series) AS series, CAST(sum(quantity) AS BIGINT) AS total_units_sold,
               {m2('sum(royalty_amount)')} AS total_royalties, min(sale_date) AS first_sale, max(sale_date) AS last_sale
        FROM sales GROUP BY 1 ORDER BY sum(royalty_amount) DESC, 1 LIMIT 10""",
    "best_months": ctes("sales") + f"""
        SELECT strftime(sale_date, '%Y-%m') AS period, CAST(sum(quantity) AS BIGINT) AS total_units,
               {m2('sum(royalty_amount)')} AS total_royalties,
               {ratio('sum(royalty_amount)', 'count(*)')} AS avg_transaction_value
        FROM sales GROUP BY 1 ORDER BY sum(royalty_amount) DESC, 1 LIMIT 5""",
    "distributor_breakdown": ctes("statements") + f"""
        SELECT coalesce(distributor, 'Unknown') AS distributor, {m2('sum(royalty_amount_usd)')} AS total_revenue,
               CAST(sum(quantity) AS BIGINT) AS total_units, count(*) AS transaction_count,
               {ratio('sum(royalty_amount_usd)', 'count(*)')} AS avg_transaction_value
        FROM statements GROUP BY 1""",
    "product_performance": ctes("shop") + f"""
        SELECT product_name, CAST(sum(items_sold) AS BIGINT) AS units, {m2('sum(net_sales)')} AS revenue
        FROM shop GROUP BY 1 ORDER BY sum(net_sales) DESC, 1 LIMIT 10""",
    "membership_monthly": ctes("memberships") + f"""
        SELECT strftime(sale_date, '%Y-%m') AS period, {m2('sum(net_earnings)')} AS net FROM memberships GROUP BY 1""",
    "page_reads_monthly": ctes("reads") + f"""
        SELECT strftime(sale_date, '%Y-%m') AS period, CAST(sum(page_count) AS BIGINT) AS pages_read,
               {m2('sum(royalty_amount_usd)')} AS revenue, {m2('sum(equivalent_copies)')} AS equiv_copies,
               {ratio('round(sum(royalty_amount_usd),2)', 'round(sum(equivalent_copies),2)')} AS revenue_per_copy
        FROM reads WHERE royalty_amount_usd > 0 GROUP BY 1""",
    "books_vs_merch": ctes("shop", grouped="""
        SELECT strftime(sale_date, '%Y-%m') AS period,
               CASE WHEN series IS NOT NULL THEN 'Books' ELSE 'Merchandise' END AS category,
               CAST(sum(items_sold) AS BIGINT) AS units, round(sum(net_sales), 2) AS total
        FROM shop GROUP BY 1, 2""") + f"""
        SELECT period, category, units, CAST(total AS DOUBLE) AS revenue,
               {ratio("coalesce((SELECT sum(total) FROM grouped WHERE category = 'Books'), 0)",
                      "(SELECT sum(total) FROM grouped)", 1, "100.0")} AS books_pct_of_total
        FROM grouped""",
    "channel_totals": ctes("events_view") + f"""
        SELECT channel, {m2('sum(revenue)')} AS total_revenue, count(*) AS record_count
        FROM events_view GROUP BY 1 HAVING round(sum(revenue), 2) > 0""",
    "top_month": ctes("branch") + f"""
        SELECT period, {_MONTH_NAMES}[CAST(substr(period, 6) AS INT)] || ' ' || substr(period, 1, 4) AS label,
               {m2('sum(revenue)')} AS total_revenue
        FROM branch GROUP BY period ORDER BY sum(revenue) DESC, period LIMIT 1""",
    "active_range": ctes("events_all") + """
        SELECT min(sale_date) AS earliest, max(sale_date) AS latest,
               CAST(year(min(sale_date)) AS VARCHAR) || '–' || CAST(year(max(sale_date)) AS VARCHAR) AS active_period
        FROM events_all""",
    "channel_cards": ctes("events_view") + f"""
        SELECT channel, count(*) AS record_count, {m2('sum(revenue)')} AS revenue_sum,
               {ratio('sum(revenue)', 'count(revenue)')} AS avg_transaction,
               CAST(round(sum(units), 0) AS BIGINT) AS units, count(DISTINCT distributor) AS distributors
        FROM events_view GROUP BY 1""",
    "channel_monthly": ctes("branch") + """
        SELECT period, channel, CAST(revenue AS DOUBLE) AS revenue, units FROM branch""",
    "channel_yearly": ctes("events_view", yearly="""
        SELECT strftime(sale_date, '%Y') AS year, channel, round(sum(revenue), 2) AS revenue
        FROM events_view GROUP BY 1, 2""") + f"""
        SELECT year, {', '.join(
            f"CAST(coalesce(sum(CASE WHEN channel = '{c}' THEN revenue END), 0) AS DOUBLE) AS {c}" for c in CHANNELS)},
               CAST(sum(revenue) AS DOUBLE) AS total
        FROM yearly GROUP BY 1""",
    "year_summary": ctes("events_view", yearly="""
        SELECT y, sum(revenue) AS total
        FROM (SELECT year(sale_date) AS y, channel, round(sum(revenue), 2) AS revenue FROM events_view GROUP BY 1, 2)
        GROUP BY 1""") + f"""
        SELECT CAST(a.y AS VARCHAR) AS latest_year, {m2('a.total')} AS latest_revenue,
               CAST(b.y AS VARCHAR) AS previous_year, {m2('b.total')} AS previous_revenue,
               {ratio('(a.total - b.total)', 'b.total', 1, '100.0')} AS growth_pct,
               CAST(c.y AS VARCHAR) AS best_year, {m2('c.total')} AS best_revenue
        FROM (SELECT * FROM yearly ORDER BY y DESC LIMIT 1) a
        CROSS JOIN (SELECT * FROM yearly ORDER BY y DESC LIMIT 1 OFFSET 1) b
        CROSS JOIN (SELECT * FROM yearly ORDER BY total DESC, y LIMIT 1) c""",
    "season_heatmap": ctes("cells") + f"""
        SELECT CAST(y AS VARCHAR) AS year, {', '.join(
            f"CAST(coalesce(sum(CASE WHEN m = {i} THEN revenue END), 0) AS DOUBLE) AS {name}"
            for i, name in enumerate('jan feb mar apr may jun jul aug sep oct nov dec'.split(), 1))}
        FROM cells GROUP BY 1""",
    "season_stats": ctes("cells", stats="""
        SELECT m, avg(CAST(revenue AS DOUBLE)) AS mean, min(revenue) AS lo, max(revenue) AS hi, sum(revenue) AS total,
               count(*) AS n, round(CAST(stddev_samp(CAST(revenue AS DOUBLE)) AS DECIMAL(28,6)), 2) AS std
        FROM cells GROUP BY m""") + f"""
        SELECT lpad(CAST(m AS VARCHAR), 2, '0') AS month, {_MONTH_NAMES}[m] AS month_name,
               {ratio('total', 'n')} AS avg_revenue, CAST(lo AS DOUBLE) AS min_revenue, CAST(hi AS DOUBLE) AS max_revenue,
               CAST(std AS DOUBLE) AS std_revenue,
               (SELECT {_MONTH_NAMES}[m] || ' ' || CAST(y AS VARCHAR) FROM cells ORDER BY revenue DESC, y, m LIMIT 1)
                   AS best_month_ever,
               (SELECT {_MONTH_NAMES}[m] || ' ' || CAST(y AS VARCHAR) FROM cells ORDER BY revenue, y, m LIMIT 1)
                   AS worst_month_ever,
               (SELECT {_MONTH_NAMES}[m] FROM stats WHERE std IS NOT NULL ORDER BY std, m LIMIT 1)
                   AS most_consistent_month,
               (SELECT {_MONTH_NAMES}[m] FROM stats WHERE std IS NOT NULL ORDER BY std DESC, m LIMIT 1)
                   AS least_consistent_month
        FROM stats""",
    # ------------------------------------------------------------ trends
    "rank_in_series": ctes("sales", works="""
        SELECT series, canonical_work_slug, sum(royalty_amount_usd) AS book FROM sales
        WHERE series IS NOT NULL GROUP BY 1, 2""", ranked="""
        SELECT *, row_number() OVER (PARTITION BY series ORDER BY book DESC, canonical_work_slug) AS rank_in_series,
               sum(book) OVER (PARTITION BY series) AS series_sum FROM works""") + f"""
        SELECT series, canonical_work_slug, rank_in_series, {usd('book')} AS book_revenue,
               {usd('series_sum')} AS series_total,
               CAST({ratio_dec('book', 'series_sum')} AS VARCHAR) || '%' AS contribution_pct
        FROM ranked WHERE rank_in_series <= 5""",
    "mom_growth": ctes("sales", monthly="""
        SELECT source_platform, strftime(sale_date, '%Y-%m') AS period, round(sum(royalty_amount_usd), 2) AS revenue
        FROM sales GROUP BY 1, 2""", prior="""
        SELECT *, lag(revenue) OVER (PARTITION BY source_platform ORDER BY period) AS prev FROM monthly""") + f"""
        SELECT source_platform, period, {usd('revenue')} AS current_revenue,
               {usd('coalesce(prev, 0)')} AS previous_revenue, {usd('revenue - coalesce(prev, 0)')} AS absolute_change,
               CASE WHEN prev IS NULL OR prev = 0 THEN 'N/A'
                    ELSE CAST({ratio_dec('(revenue - prev)', 'prev')} AS VARCHAR) || '%' END AS pct_growth
        FROM prior""",
    "cumulative_revenue": ctes("sales", monthly="""
        SELECT strftime(sale_date, '%Y-%m') AS period, round(sum(royalty_amount_usd), 2) AS revenue
        FROM sales GROUP BY 1""") + """
        SELECT period, CAST(revenue AS DOUBLE) AS revenue,
               CAST(sum(revenue) OVER (ORDER BY period ROWS UNBOUNDED PRECEDING) AS DOUBLE) AS cumulative
        FROM monthly""",
    "cumulative_by_channel": ctes("branch") + """
        SELECT period, channel, CAST(revenue AS DOUBLE) AS revenue,
               CAST(sum(revenue) OVER (PARTITION BY channel ORDER BY period ROWS UNBOUNDED PRECEDING) AS DOUBLE)
                   AS cumulative_revenue,
               CAST(sum(revenue) OVER (ORDER BY period, channel ROWS UNBOUNDED PRECEDING) AS DOUBLE)
                   AS total_cumulative
        FROM branch""",
    "pareto_titles": ctes("sales", titles="""
        SELECT coalesce(series, '(Unmatched)') AS work_group, canonical_work_slug,
               CAST(sum(quantity) AS BIGINT) AS units_sold, round(sum(royalty_amount_usd), 2) AS total,
               count(*) AS transaction_count
        FROM sales GROUP BY 1, 2""", ranked=f"""
        SELECT *, row_number() OVER w AS rank, sum(total) OVER w AS running, sum(total) OVER () AS grand,
               {ratio_dec('sum(total) OVER w', 'sum(total) OVER ()')} AS pct
        FROM titles WINDOW w AS (ORDER BY total DESC, canonical_work_slug, work_group ROWS UNBOUNDED PRECEDING)""") + f"""
        SELECT rank, work_group, canonical_work_slug, {usd('total')} AS revenue, units_sold, transaction_count,
               CAST(running AS DOUBLE) AS cumulative_revenue, CAST(grand AS DOUBLE) AS grand_total,
               CAST(pct AS VARCHAR) || '%' AS running_share
        FROM ranked WHERE pct <= 80""",
    "pareto_range_frame": ctes("sales", titles="""
        SELECT canonical_work_slug, round(sum(royalty_amount_usd), 2) AS total FROM sales GROUP BY 1""", ranked=f"""
        SELECT *, {ratio_dec('sum(total) OVER (ORDER BY total DESC)', 'sum(total) OVER ()')} AS pct FROM titles""") + """
        SELECT canonical_work_slug, CAST(total AS DOUBLE) AS revenue, CAST(pct AS DOUBLE) AS cumulative_pct
        FROM ranked WHERE pct <= 80""",
    "pareto_summary": ctes("sales", titles="""
        SELECT series, canonical_work_slug, round(sum(royalty_amount_usd), 2) AS total FROM sales GROUP BY 1, 2""",
        ranked=f"""
        SELECT total, {ratio_dec(
            'sum(total) OVER (ORDER BY total DESC, canonical_work_slug, series ROWS UNBOUNDED PRECEDING)',
            'sum(total) OVER ()')} AS pct
        FROM titles""") + f"""
        SELECT count(*) AS total_titles, count(*) FILTER (WHERE pct <= 80) AS titles_for_cutoff,
               {ratio('count(*) FILTER (WHERE pct <= 80)', 'count(*)', 1, '100.0')} AS pct_of_titles,
               CAST(sum(total) AS DOUBLE) AS grand_total
        FROM ranked""",
    "pareto_series": ctes("sales", totals="""
        SELECT series AS series_name, round(sum(royalty_amount_usd), 2) AS total FROM sales
        WHERE series IS NOT NULL GROUP BY 1""") + f"""
        SELECT series_name, CAST(total AS DOUBLE) AS total_revenue,
               row_number() OVER (ORDER BY total DESC, series_name) AS rank,
               {ratio('sum(total) OVER (ORDER BY total DESC, series_name ROWS UNBOUNDED PRECEDING)',
                      'sum(total) OVER ()', 1, '100.0')} AS cumulative_pct
        FROM totals""",
    "moving_average": ctes("events_view", months="""
        SELECT strftime(sale_date, '%Y-%m') AS period, sum(revenue) AS revenue FROM events_view GROUP BY 1""") + f"""
        SELECT period, {usd('revenue')} AS monthly_revenue, {', '.join(
            usd(ratio_dec(f'sum(revenue) OVER (ORDER BY period ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)',
                          f'count(*) OVER (ORDER BY period ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)', 2, '1.0'))
            + f' AS ma_{n}month' for n in (3, 12))}
        FROM months""",
    "ttm_run_rate": ctes("events_view", months="""
        SELECT strftime(sale_date, '%Y-%m') AS period, sum(revenue) AS revenue FROM events_view GROUP BY 1""", rates="""
        SELECT *, round(sum(revenue) OVER (ORDER BY period ROWS BETWEEN 11 PRECEDING AND CURRENT ROW), 2) AS ttm
        FROM months""") + f"""
        SELECT period, {usd('revenue')} AS monthly_revenue, {usd('ttm')} AS ttm_run_rate,
               {ratio('((SELECT ttm FROM rates ORDER BY period DESC LIMIT 1) - (SELECT ttm FROM rates ORDER BY period LIMIT 1))',
                      '(SELECT ttm FROM rates ORDER BY period LIMIT 1)', 1, '100.0')} AS growth_pct
        FROM rates ORDER BY period DESC LIMIT 24""",
    "month_gaps": ctes("sales", activity="""
        SELECT l_partkey, CAST(date_trunc('month', sale_date) AS DATE) AS month, count(*) AS n,
               round(sum(royalty_amount_usd), 2) AS revenue
        FROM sales GROUP BY 1, 2""", calendar="""
        SELECT l_partkey, min(month) AS month, max(month) AS final FROM activity GROUP BY 1
        UNION ALL
        SELECT l_partkey, CAST(month + INTERVAL 1 MONTH AS DATE), final FROM calendar WHERE month < final""") + """
        SELECT c.l_partkey, strftime(c.month, '%Y-%m') AS period, coalesce(a.n, 0) AS transactions,
               CAST(coalesce(a.revenue, 0) AS DOUBLE) AS revenue,
               CASE WHEN a.n IS NULL THEN 'GAP MONTH' ELSE 'ACTIVE' END AS status
        FROM calendar c LEFT JOIN activity a ON a.l_partkey = c.l_partkey AND a.month = c.month""",
    "dominant_channel": ctes("sales", monthly="""
        SELECT strftime(sale_date, '%Y-%m') AS period, source_platform, round(sum(royalty_amount_usd), 2) AS revenue
        FROM sales GROUP BY 1, 2""") + f"""
        SELECT period, source_platform AS dominant_platform, {usd('revenue')} AS top_revenue,
               CAST(revenue AS DOUBLE) AS confirmation
        FROM monthly m WHERE revenue = (SELECT max(s.revenue) FROM monthly s WHERE s.period = m.period)""",
    "concentration": ctes("branch", shares=f"""
        SELECT b.period, b.channel, t.total, {ratio_dec('b.revenue', 't.total')} AS share
        FROM branch b JOIN (SELECT period, sum(revenue) AS total FROM branch GROUP BY 1) t ON t.period = b.period""",
        top="""
        SELECT period, max(share) AS share, count(DISTINCT channel) AS channels, max(total) AS total
        FROM shares GROUP BY 1""") + f"""
        SELECT period, CAST(share AS VARCHAR) || '%' AS top_platform_share, channels AS active_platforms,
               CAST({ratio_dec('(channels - 1)', '5')} AS VARCHAR) || '%' AS diversification_score,
               {usd('total')} AS total_revenue,
               CASE WHEN share >= 80 THEN '⚠️ HIGH RISK' WHEN share >= 70 THEN '⚡ MODERATE-RISK' ELSE '✓ HEALTHY' END
                   AS risk_level
        FROM top""",
    "concentration_summary": ctes("branch", top=f"""
        SELECT period, max(share) AS share
        FROM (SELECT period, {ratio_dec('revenue', 'sum(revenue) OVER (PARTITION BY period)')} AS share FROM branch)
        GROUP BY 1""") + f"""
        SELECT (SELECT CAST(share AS DOUBLE) FROM top ORDER BY period DESC LIMIT 1) AS latest_share,
               {ratio('sum(share)', 'count(*)', 1)} AS avg_share, CAST(max(share) AS DOUBLE) AS max_share
        FROM top""",
    "share_over_time": ctes("branch") + f"""
        SELECT period, channel, CAST(revenue AS DOUBLE) AS revenue,
               {ratio('revenue', 'sum(revenue) OVER (PARTITION BY period)', 1, '100.0')} AS share_pct
        FROM branch""",
    "yoy_monthly_lines": ctes("cells") + f"""
        SELECT {_MONTH_NAMES}[m] AS month_name, CAST(y AS VARCHAR) AS year, CAST(revenue AS DOUBLE) AS revenue
        FROM cells""",
}
