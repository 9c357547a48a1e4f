"""Common table expressions for the stand-in facts, and rounding snippets."""


def ctes(*names: str, **extra: str) -> str:
    """A WITH clause holding the named facts (with what they depend on) and extra expressions."""
    needed: list[str] = []

    def need(name: str) -> None:
        for parent in DEPENDS.get(name, ()):
            need(parent)
        if name not in needed:
            needed.append(name)

    for name in names:
        need(name)
    parts = [f"{n} AS ({FACTS[n]})" for n in needed] + [f"{n} AS ({sql})" for n, sql in extra.items()]
    return "WITH RECURSIVE " + ",\n".join(parts) + "\n"


def m2(expr: str) -> str:
    """Rounded money as double."""
    return f"CAST(round({expr}, 2) AS DOUBLE)"


def ratio(num: str, den: str, digits: int = 2, scale: str = "1.0") -> str:
    return (
        f"CAST(round(CAST(CAST({num} AS DOUBLE) * CAST({scale} AS DOUBLE) / nullif(CAST({den} AS DOUBLE), 0) "
        f"AS DECIMAL(24,6)), {digits}) AS DOUBLE)"
    )


def ratio_dec(num: str, den: str, digits: int = 1, scale: str = "100.0") -> str:
    return (
        f"CAST(round(CAST(CAST({num} AS DOUBLE) * CAST({scale} AS DOUBLE) / nullif(CAST({den} AS DOUBLE), 0) "
        f"AS DECIMAL(24,6)), {digits}) AS DECIMAL(20,{digits}))"
    )


def usd(expr: str) -> str:
    return f"('$' || CAST(CAST(round({expr}, 2) AS DECIMAL(38,2)) AS VARCHAR))"


ROYALTY = (
    "CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * (1 - CAST(l_discount AS DECIMAL(4,2))) AS DECIMAL(18,4))"
)
INITCAP_NAME = (
    "upper(substr(p_name,1,1)) || substr(split_part(p_name,' ',1),2) || ' ' || "
    "upper(substr(split_part(p_name,' ',2),1,1)) || substr(split_part(p_name,' ',2),2)"
)

FACTS = {
    "catalog": f"""
        SELECT nullif(p_brand, 'Brand#5') AS series,
               replace(p_name, ' ', '_') || '_' || replace(lower(p_brand), 'brand#', '') AS canonical_work_slug,
               {INITCAP_NAME} || ' & ' || p_brand AS display_title,
               lower(p_type) AS edition_format,
               CAST(p_size AS VARCHAR) AS kenp_page_count,
               CASE WHEN p_type <> 'PROMO' THEN 'B' || lpad(CAST(p_partkey AS VARCHAR), 9, '0') END AS asin,
               CASE WHEN p_type <> 'ECONOMY' THEN lpad(CAST(p_partkey AS VARCHAR), 10, '0') END AS isbn_10,
               '978-' || substr(lpad(CAST(p_partkey AS VARCHAR), 10, '0'), 1, 1) || '-' ||
                   substr(lpad(CAST(p_partkey AS VARCHAR), 10, '0'), 2, 6) || '-' ||
                   substr(lpad(CAST(p_partkey AS VARCHAR), 10, '0'), 8, 3) AS isbn_13,
               CASE WHEN p_type = 'SMALL' THEN 'ax' || CAST(p_size AS VARCHAR) END AS other_id,
               p_partkey AS catalog_order
        FROM part""",
    "sales": f"""
        SELECT l_partkey, CAST(l_shipdate AS DATE) AS sale_date,
               CASE l_returnflag WHEN 'A' THEN 'Audio_Store' WHEN 'N' THEN 'book_store' ELSE 'book_store_legacy' END
                   AS source_platform,
               CAST(l_quantity AS BIGINT) AS quantity,
               CAST(l_extendedprice AS DECIMAL(18,2)) AS price,
               {ROYALTY} AS royalty_amount, {ROYALTY} AS royalty_amount_usd,
               CAST(l_discount AS DECIMAL(4,2)) AS royalty_rate,
               c.canonical_work_slug, c.series, c.edition_format, c.isbn_13 AS book_identifier, c.display_title,
               n_name AS region,
               CASE n_regionkey WHEN 0 THEN 'USD' WHEN 1 THEN 'EUR' WHEN 2 THEN 'GBP' WHEN 3 THEN 'JPY' ELSE 'CAD' END
                   AS currency
        FROM lineitem
        JOIN catalog c ON c.catalog_order = l_partkey
        JOIN supplier ON s_suppkey = l_suppkey
        JOIN nation ON n_nationkey = s_nationkey""",
    "reads": f"""
        SELECT CAST(l_shipdate AS DATE) AS sale_date, CAST(l_quantity AS BIGINT) AS page_count,
               CASE WHEN l_linestatus = 'F' THEN {ROYALTY} ELSE 0 END AS royalty_amount_usd,
               p_size AS kenp_page_count,
               round(CAST(l_quantity / coalesce(p_size, 1) AS DECIMAL(18,6)), 2) AS equivalent_copies
        FROM lineitem LEFT JOIN part ON p_partkey = l_partkey
        WHERE l_returnflag = 'R'""",
    "memberships": """
        SELECT sale_date, 'USD' AS currency, gross AS gross_total,
               round(gross * 0.05, 2) AS platform_fees,
               CAST(gross - round(gross * 0.05, 2) AS DECIMAL(28,2)) AS net_earnings
        FROM (SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS sale_date,
                     sum(CAST(o_totalprice AS DECIMAL(18,2))) AS gross
              FROM orders GROUP BY 1)""",
    "shop": f"""
        SELECT o_orderkey AS line_no, o_orderstatus AS file,
               coalesce({INITCAP_NAME} || ' Tote', 'Gift Card ' || substr(o_orderpriority, 1, 1)) AS product_name,
               CASE WHEN o_orderstatus <> 'O' THEN 'sku-' || CAST(o_custkey AS VARCHAR) END AS sku,
               split_part(o_orderpriority, '-', 2) AS category,
               CAST(date_trunc('month', o_orderdate) AS DATE) AS period_start,
               last_day(CAST(o_orderdate AS DATE)) AS period_end,
               last_day(CAST(o_orderdate AS DATE)) AS sale_date,
               CAST(substr(o_orderpriority, 1, 1) AS BIGINT) AS items_sold,
               CAST(o_totalprice AS DECIMAL(18,2)) AS net_sales,
               1 AS orders_count,
               nullif(p_brand, 'Brand#5') AS series
        FROM orders LEFT JOIN part ON p_partkey = o_custkey""",
    "statements": f"""
        SELECT CAST(l_shipdate AS DATE) AS sale_date,
               CASE WHEN s_nationkey <> 7 THEN replace(s_name, '#', ' No') END AS distributor,
               CAST(l_quantity AS BIGINT) AS quantity,
               CAST(l_extendedprice AS DECIMAL(18,2)) AS gross_local,
               CAST({ROYALTY} * CAST(0.25 AS DECIMAL(4,2)) AS DECIMAL(18,4)) AS royalty_amount_usd
        FROM lineitem JOIN supplier ON s_suppkey = l_suppkey""",
    "events_all": """
        SELECT 'sales' AS fact,
               CASE WHEN source_platform ILIKE '%audio%' THEN 'audio_store' ELSE 'book_store' END AS channel,
               sale_date, CAST(royalty_amount_usd AS DECIMAL(28,4)) AS revenue, CAST(quantity AS DECIMAL(18,2)) AS units,
               CAST(NULL AS VARCHAR) AS distributor
        FROM sales
        UNION ALL SELECT 'reads', 'page_reads', sale_date, royalty_amount_usd, equivalent_copies, NULL FROM reads
        UNION ALL SELECT 'memberships', 'memberships', sale_date, net_earnings, 0, NULL FROM memberships
        UNION ALL SELECT 'shop', 'web_shop', sale_date, net_sales, items_sold, NULL FROM shop
        UNION ALL SELECT 'statements', 'wide_audio', sale_date, royalty_amount_usd, quantity, distributor
        FROM statements""",
    "events_view": "SELECT * FROM events_all WHERE channel <> 'page_reads' OR revenue > 0",
    "branch": """
        SELECT strftime(sale_date, '%Y-%m') AS period, channel, round(sum(revenue), 2) AS revenue,
               CAST(round(sum(units), 0) AS BIGINT) AS units
        FROM events_view GROUP BY 1, 2""",
    "cells": """
        SELECT y, m, sum(revenue) AS revenue
        FROM (SELECT fact, year(sale_date) AS y, month(sale_date) AS m, round(sum(revenue), 2) AS revenue
              FROM events_view GROUP BY 1, 2, 3)
        GROUP BY 1, 2""",
    "fx_rates": """
        SELECT rate_date, currency,
               CAST((base + tick * (date_diff('day', DATE '1970-01-01', rate_date) % 97)) / 10000.0 AS DECIMAL(18,8))
                   AS per_eur
        FROM (SELECT CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS rate_date
              FROM (SELECT CAST(min(l_shipdate) AS DATE) AS lo, CAST(max(l_shipdate) AS DATE) AS hi FROM lineitem))
        CROSS JOIN (VALUES ('USD', 11000, 7), ('GBP', 8500, 5), ('JPY', 1300000, 1100), ('CAD', 14500, 9))
            AS q(currency, base, tick)
        WHERE isodow(rate_date) <= 5 AND NOT rate_date BETWEEN DATE '1998-06-01' AND DATE '1998-07-31'""",
}

DEPENDS = {
    "sales": ("catalog",),
    "events_all": ("sales", "reads", "memberships", "shop", "statements"),
    "events_view": ("events_all",),
    "branch": ("events_view",),
    "cells": ("events_view",),
}
