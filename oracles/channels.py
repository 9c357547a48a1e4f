"""Oracles of the channel jobs, from the tables the raw reports were rendered from."""

from oracles.cleaning import _LINES as _SECTIONS
from oracles.facts import ROYALTY, ctes, m2
from oracles.matching import _BEST, _CROSSWALK, _FX, _NAMES

_CCY = "CASE n_regionkey WHEN 0 THEN 'USD' WHEN 1 THEN 'EUR' WHEN 2 THEN 'GBP' WHEN 3 THEN 'JPY' ELSE 'CAD' END"
_BASE = f"""
    SELECT l_partkey, l_suppkey, lpad(CAST(l_partkey AS VARCHAR), 10, '0') AS key, CAST(l_shipdate AS DATE) AS day,
           CAST(date_trunc('month', l_shipdate) AS DATE) AS month, CAST(l_quantity AS BIGINT) AS qty,
           round({ROYALTY}, 2) AS royalty, l_returnflag AS flag, l_linestatus AS status, l_linenumber AS ln,
           n_regionkey AS rk, n_nationkey AS nk, {_CCY} AS ccy
    FROM lineitem JOIN supplier ON s_suppkey = l_suppkey JOIN nation ON n_nationkey = s_nationkey"""
_FIRST_TITLES = """
    SELECT DISTINCT ON (display_title) display_title, series, edition_format, canonical_work_slug FROM catalog
    ORDER BY display_title, catalog_order"""
_QX = """
    SELECT * FROM quotes
    UNION ALL SELECT CAST(rate_date + INTERVAL 30 DAY AS DATE), currency, NULL, NULL FROM quotes s
    WHERE NOT EXISTS (SELECT 1 FROM quotes n WHERE n.currency = s.currency AND n.rate_date > s.rate_date
                      AND n.rate_date <= s.rate_date + INTERVAL 30 DAY)"""


def _converted(name: str) -> str:
    return f"""
    SELECT f.*, CASE WHEN f.currency = 'USD' THEN f.amount
                     ELSE round(CAST(CAST(f.amount AS DOUBLE) / CAST(q.per_eur AS DOUBLE) * CAST(q.usd_per_eur AS DOUBLE)
                                AS DECIMAL(28,6)), 2) END AS usd
    FROM {name} f ASOF LEFT JOIN qx q ON q.currency = f.currency AND q.rate_date <= f.sale_date"""


def _staged(identifier: str) -> str:
    """FROM clause and attributes of identifier then title matching."""
    return f"""
    FROM base x JOIN catalog c ON c.catalog_order = x.l_partkey
    LEFT JOIN best b ON b.identifier = {identifier} LEFT JOIN first_titles f ON f.display_title = c.display_title"""


_STAGED_COLUMNS = """
    CASE WHEN b.series IS NULL THEN f.series ELSE b.series END AS series,
    CASE WHEN b.series IS NULL THEN f.edition_format ELSE b.edition_format END AS edition_format"""

_EBOOK_ID = "CASE flag WHEN 'A' THEN '978' || key WHEN 'N' THEN key ELSE 'ZZ' || key END"
_DOMAIN_CCY = (
    "['USD','GBP','EUR','EUR','EUR','EUR','AUD','CAD','JPY','INR','EUR','MXN','BRL','SEK','PLN'][nk + 1]"
)

FACTS = {
    "audio_monthly": f"""
        SELECT {_STAGED_COLUMNS}, ccy AS currency, month AS sale_date, CASE WHEN qty <> 50 THEN qty END AS quantity, royalty AS amount
        {_staged("CASE flag WHEN 'R' THEN 'QX' || key ELSE 'B' || substr(key, 2) END")} WHERE ln <> 7""",
    "audio_crosstab": """
        SELECT b.series, b.edition_format, 'USD' AS currency, month AS sale_date, CAST(NULL AS BIGINT) AS quantity, amount
        FROM (SELECT month, key, rk, CASE rk WHEN 2 THEN -sum(royalty) ELSE sum(royalty) END AS amount
              FROM base WHERE status = 'F' AND rk < 4 GROUP BY 1, 2, 3)
        LEFT JOIN best b ON b.identifier = 'B' || substr(key, 2) WHERE amount > 0""",
    "ebook_sales": f"""
        SELECT {_STAGED_COLUMNS}, CASE WHEN qty <> 50 THEN ccy ELSE 'USD' END AS currency, month AS sale_date, qty AS quantity,
               royalty AS amount {_staged(_EBOOK_ID)}""",
    "page_reads": """
        SELECT b.series, CASE WHEN b.series IS NULL THEN 'ebook' ELSE b.edition_format END AS edition_format, r.currency,
               r.day AS sale_date, r.qty AS quantity, round(CAST(r.qty * p.rate AS DECIMAL(28,6)), 2) AS amount
        FROM reads_in r LEFT JOIN read_rates p ON p.month = r.month AND p.currency = r.currency
        LEFT JOIN best b ON b.identifier = 'B' || substr(r.key, 2)""",
    "statements": """
        SELECT b.series, 'audiobook' AS edition_format, s.currency, x.day AS sale_date,
               CASE x.status WHEN 'F' THEN -x.qty ELSE x.qty END AS quantity, x.royalty AS amount
        FROM base x JOIN in_force s ON s.file = x.l_suppkey AND s.l_partkey = x.l_partkey
        LEFT JOIN best b ON s.p_size <> 2 AND b.identifier = '978' || x.key""",
    "wide_ebooks": """
        SELECT b.series, coalesce(b.edition_format, 'ebook') AS edition_format, ccy AS currency, day AS sale_date, qty AS quantity,
               royalty AS amount
        FROM base LEFT JOIN best b ON flag <> 'R' AND b.identifier = '978' || key WHERE qty <> 50""",
    "press": """
        SELECT b.series,
               coalesce(b.edition_format, CASE flag WHEN 'A' THEN 'ebook' WHEN 'N' THEN 'paperback' ELSE 'hardcover' END)
                   AS edition_format,
               CASE status WHEN 'F' THEN ccy ELSE 'USD' END AS currency, day AS sale_date, qty AS quantity, royalty AS amount
        FROM base LEFT JOIN best b ON flag = 'A' AND b.identifier = '978' || key WHERE qty <> 50""",
    "store_invoices": """
        SELECT b.series, b.edition_format, CASE flag WHEN 'R' THEN 'USD' ELSE ccy END AS currency, day AS sale_date,
               CASE status WHEN 'F' THEN -qty ELSE qty END AS quantity, CASE status WHEN 'F' THEN -royalty ELSE royalty END AS amount
        FROM base LEFT JOIN best b ON b.identifier = '978' || key WHERE qty <> 50""",
    "subscription_reads": """
        SELECT b.series, coalesce(b.edition_format, 'ebook') AS edition_format, CASE flag WHEN 'R' THEN 'USD' ELSE ccy END AS currency,
               month AS sale_date, qty AS quantity, royalty AS amount
        FROM base LEFT JOIN best b ON b.identifier = CASE flag WHEN 'A' THEN key WHEN 'N' THEN '978' || key END""",
    "print": """
        SELECT b.series, CASE flag WHEN 'A' THEN 'paperback' WHEN 'N' THEN 'hardcover' ELSE 'unknown' END AS edition_format,
               ccy AS currency, month AS sale_date, qty AS quantity, royalty AS amount
        FROM base LEFT JOIN best b ON flag <> 'R' AND b.identifier = '978' || key WHERE NOT (flag = 'R' AND qty = 50)""",
}

_PAGE_READS = {
    "reads_in": f"SELECT day, month, key, qty, {_DOMAIN_CCY} AS currency FROM base WHERE flag = 'R'",
    "read_summary": """
        SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS month,
               ['USD','GBP','EUR','JPY','CAD'][CAST(substr(o_orderpriority, 1, 1) AS INT)] AS currency,
               sum(CAST(o_totalprice AS DECIMAL(18,2))) AS total
        FROM orders GROUP BY 1, 2""",
    "read_spent": "SELECT month, ccy AS currency, sum(royalty) AS total FROM base WHERE flag <> 'R' GROUP BY 1, 2",
    "read_cells": """
        SELECT m.month, c.currency, s.total FROM (SELECT DISTINCT month FROM read_summary) m
        CROSS JOIN (VALUES ('USD'), ('GBP'), ('EUR'), ('JPY'), ('CAD'), ('AUD')) c(currency)
        LEFT JOIN read_summary s ON s.month = m.month AND s.currency = c.currency""",
    "read_pools": """
        SELECT c.month, c.currency, CASE WHEN coalesce(c.total, 0) <> 0 THEN c.total - coalesce(d.total, 0)
                                         WHEN d.total > 0 THEN -d.total END AS pool
        FROM read_cells c LEFT JOIN read_spent d ON d.month = c.month AND d.currency = c.currency""",
    "read_rates": """
        SELECT p.month, p.currency, CAST(p.pool AS DOUBLE) / r.pages AS rate
        FROM read_pools p JOIN (SELECT month, currency, sum(qty) AS pages FROM reads_in GROUP BY 1, 2) r
          ON r.month = p.month AND r.currency = p.currency WHERE p.pool IS NOT NULL""",
}
_STATEMENTS = {
    "sections": f"SELECT file, l_partkey, n, p_size FROM ({_SECTIONS}) JOIN part ON p_partkey = l_partkey",
    "in_force": """
        SELECT file, l_partkey, p_size,
               coalesce((SELECT CASE WHEN s.l_partkey % 2 = 0 THEN 'EUR' ELSE 'GBP' END FROM sections s
                         WHERE s.file = d.file AND s.l_partkey <= d.l_partkey AND s.p_size = 3
                         ORDER BY s.l_partkey DESC LIMIT 1), 'USD') AS currency
        FROM sections d""",
}
_EXTRA = {"page_reads": _PAGE_READS, "statements": _STATEMENTS}
_SHARED = {"crosswalk": _CROSSWALK, "best": _BEST, "first_titles": _FIRST_TITLES, "quotes": _FX, "qx": _QX, "base": _BASE}

_SUMMARY = """
    SELECT series, edition_format, currency, CAST(year(sale_date) AS INTEGER) AS year, count(*) AS n,
           CAST(coalesce(sum(quantity), 0) AS BIGINT) AS units, CAST(coalesce(sum(amount), 0) AS DOUBLE) AS royalty,
           CAST(coalesce(sum(usd), 0) AS DOUBLE) AS royalty_usd
    FROM converted GROUP BY 1, 2, 3, 4"""


def _channel(name: str) -> str:
    return ctes("catalog", "fx_rates", **_SHARED, **_EXTRA.get(name, {}), fact=FACTS[name], converted=_converted("fact")) + _SUMMARY


_MEMBERSHIPS = """
    SELECT sale_date, 'patreon' AS source_platform, 'USD' AS currency, CAST(gross AS DOUBLE) AS gross_total,
           CAST(0 AS DOUBLE) AS platform_fees, CAST(0 AS DOUBLE) AS refunds, CAST(gross AS DOUBLE) AS net_earnings
    FROM (SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS sale_date, o_orderpriority AS file,
                 min(o_orderkey) AS line, sum(CAST(o_totalprice AS DECIMAL(18,2))) AS gross
          FROM orders GROUP BY 1, 2)
    WHERE substr(file, 1, 1) <> '1' OR month(sale_date) <> 2
    QUALIFY row_number() OVER (PARTITION BY sale_date ORDER BY file, line) = 1"""

_SHOP_CTES = {
    "shop_names": _NAMES,
    "names": "SELECT DISTINCT product_name, trim(replace(lower(product_name), '&', 'and')) AS clean FROM shop_names",
    "titles": """
        SELECT *, trim(replace(lower(display_title), '&', 'and')) AS title FROM catalog
        QUALIFY row_number() OVER (PARTITION BY display_title ORDER BY catalog_order) = 1""",
    "contained": """
        SELECT n.product_name, t.series, t.canonical_work_slug FROM names n JOIN titles t ON contains(n.clean, t.title)
        QUALIFY row_number() OVER (PARTITION BY n.product_name ORDER BY length(t.title) DESC, t.catalog_order) = 1""",
    "merged": """
        SELECT product_name, last_day(CAST(o_orderdate AS DATE)) AS sale_date,
               sum(CAST(substr(o_orderpriority, 1, 1) AS BIGINT)) AS units, count(*) AS orders,
               sum(CAST(o_totalprice AS DECIMAL(18,2))) AS net
        FROM shop_names JOIN orders USING (o_orderkey) WHERE o_orderstatus <> 'P' GROUP BY 1, 2""",
    "resolved": """
        SELECT m.*, c.series, coalesce(c.canonical_work_slug, m.product_name) AS canonical_work_slug,
               CASE WHEN c.product_name IS NULL THEN NULL
                    WHEN contains(lower(m.product_name), 'hardcover') THEN 'deluxe hardcover'
                    WHEN contains(lower(m.product_name), 'paperback') THEN 'deluxe paperback' END AS edition_format
        FROM merged m LEFT JOIN contained c ON c.product_name = m.product_name""",
}

_WAREHOUSE_FACTS = {
    "fact_page_reads": "page_reads", "fact_statements": "statements", "fact_wide_ebooks": "wide_ebooks", "fact_press": "press",
    "fact_store_invoices": "store_invoices", "fact_subscription_reads": "subscription_reads", "fact_print": "print",
}

_REPORTS = {
    "audio_monthly": "SELECT count(DISTINCT month) FROM base", "audio_crosstab": "SELECT count(DISTINCT month) FROM base",
    "memberships": "SELECT count(DISTINCT o_orderpriority) FROM orders",
    "shop": """
        SELECT count(DISTINCT CASE o_orderstatus WHEN 'P' THEN 'export' ELSE o_orderstatus || strftime(o_orderdate, '%Y-%m') END)
        FROM orders JOIN shop_names USING (o_orderkey)""",
}


def _ingested(layout: str, source: str, total: str) -> str:
    return f"""
        SELECT '{layout}' AS layout, ({_REPORTS.get(layout, 'SELECT 1')}) AS reports, count(*) AS row_count,
               {m2(f'sum({total})')} AS measure_total FROM {source}"""


_INGESTED = [
    *[_ingested(n, f"out_{n}", "usd") for n in FACTS],
    _ingested("memberships", "memberships", "CAST(net_earnings AS DECIMAL(28,2))"),
    _ingested("shop", "resolved", "net"),
    *[f"SELECT '{n}', 1, NULL, NULL" for n in ("page_read_summary", "page_read_detail", "unknown layout")],
]
_ALL_FACTS = {
    **_SHARED, **_PAGE_READS, **_STATEMENTS, **_SHOP_CTES, **{f"in_{n}": sql for n, sql in FACTS.items()},
    **{f"out_{n}": _converted(f"in_{n}") for n in FACTS}, "memberships": _MEMBERSHIPS,
}

ORACLES = {
    **{f"normalize_{name}": _channel(name) for name in FACTS},
    "normalize_memberships": _MEMBERSHIPS,
    "normalize_shop": ctes("catalog", **_SHOP_CTES) + """
        SELECT series, canonical_work_slug, edition_format, CAST(year(sale_date) AS INTEGER) AS year, count(*) AS n,
               CAST(sum(units) AS BIGINT) AS units, CAST(sum(orders) AS BIGINT) AS orders, CAST(sum(net) AS DOUBLE) AS net
        FROM resolved GROUP BY 1, 2, 3, 4""",
    "ingest_folder": ctes("catalog", "fx_rates", **_ALL_FACTS) + " UNION ALL ".join(_INGESTED),
    "build_warehouse": ctes("catalog", "fx_rates", **_ALL_FACTS) + f"""
        SELECT 'fact_sales' AS table_name, count(*) AS row_count, {m2('sum(usd)')} AS measure_total
        FROM (SELECT usd FROM out_audio_monthly UNION ALL SELECT usd FROM out_audio_crosstab UNION ALL SELECT usd FROM out_ebook_sales)
        {' '.join(f"UNION ALL SELECT '{t}', count(*), {m2('sum(usd)')} FROM out_{n}" for t, n in _WAREHOUSE_FACTS.items())}
        UNION ALL SELECT 'fact_memberships', count(*), {m2('sum(CAST(net_earnings AS DECIMAL(28,2)))')} FROM memberships
        UNION ALL SELECT 'fact_shop', count(*), {m2('sum(net)')} FROM resolved
        UNION ALL SELECT 'dim_catalog', count(*), NULL FROM catalog""",
}
