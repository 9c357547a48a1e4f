"""Oracles of the cleaning operators: the clean source columns, with the rules written out."""

from oracles.facts import INITCAP_NAME, ROYALTY, ctes

_P1 = "substr(o_orderpriority, 1, 1)"
_DAY = "CAST(o_orderdate AS DATE)"
_FIRST = "CAST(date_trunc('month', o_orderdate) AS DATE)"
_PAD = "lpad(CAST(p_partkey AS VARCHAR), 10, '0')"
_LPAD = "lpad(CAST(l_partkey AS VARCHAR), 10, '0')"
_REGIONS = (
    "['US','UK','DE','FR','IT','ES','AU','CA','JP','IN','NL','MX','BR','SE','PL']",
    "['USD','GBP','EUR','EUR','EUR','EUR','AUD','CAD','JPY','INR','EUR','MXN','BRL','SEK','PLN']",
)

_CROSSTAB = f"""
    SELECT lpad(CAST(l_partkey AS VARCHAR), 6, '0') AS book_identifier,
           sum(CASE WHEN quarter(l_shipdate) = 1 THEN {ROYALTY} END) AS us,
           sum(CASE WHEN quarter(l_shipdate) = 2 THEN {ROYALTY} END) AS uk,
           sum(CASE WHEN quarter(l_shipdate) = 3 THEN {ROYALTY} END) AS de,
           sum(CASE WHEN quarter(l_shipdate) = 4 THEN {ROYALTY} END) AS fr
    FROM lineitem WHERE l_returnflag = 'A' GROUP BY 1"""

_LINES = """
    SELECT l_suppkey AS file, l_partkey, count(*) AS n FROM lineitem GROUP BY 1, 2"""

ORACLES = {
    "period_from_filename": f"""
        SELECT o_orderkey,
               CASE {_P1} WHEN '5' THEN NULL ELSE {_FIRST} END AS period_start,
               CASE {_P1} WHEN '5' THEN NULL WHEN '3' THEN {_DAY} ELSE last_day({_DAY}) END AS period_end
        FROM orders""",
    "union_channels_by_name": ctes("sales", "shop") + """
        SELECT source_platform, count(*) AS n, CAST(sum(quantity) AS BIGINT) AS units,
               CAST(sum(royalty_amount) AS DOUBLE) AS royalty, CAST(NULL AS DOUBLE) AS net
        FROM sales GROUP BY 1
        UNION ALL SELECT 'shop', count(*), 0, NULL, CAST(sum(net_sales) AS DOUBLE) FROM shop""",
    "project_to_target": ctes("shop") + """
        SELECT file AS source_platform, 'USD' AS currency, CASE WHEN items_sold = 3 THEN 0 ELSE items_sold END AS quantity,
               count(*) AS n, CAST(0 AS DOUBLE) AS price, CAST(0 AS BIGINT) AS rates, max(sale_date) AS latest
        FROM shop GROUP BY 1, 2, 3""",
    "rename_by_map": """
        SELECT p_partkey AS book_identifier, p_name AS book_title, p_size AS quantity, p_type AS "Other" FROM part""",
    "drop_sensitive_columns": "SELECT c_custkey, c_nationkey, c_acctbal, c_mktsegment FROM customer",
    "keep_period_measures": """
        SELECT l_returnflag AS market, sum(l_quantity) AS "MTD_quantity" FROM lineitem GROUP BY 1""",
    "coerce_numeric": """
        SELECT o_orderkey, CASE o_orderstatus WHEN 'P' THEN 0 ELSE CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS DOUBLE) END
                   AS filled,
               CASE o_orderstatus WHEN 'P' THEN NULL ELSE CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS DOUBLE) END AS nulled
        FROM orders""",
    "percent_to_fraction": """
        SELECT CAST(CAST(l_discount AS DECIMAL(4,2)) AS DOUBLE) AS rate, count(*) AS n FROM lineitem GROUP BY 1""",
    "map_codes": f"""
        SELECT c_custkey, {_REGIONS[0]}[c_nationkey + 1] AS region, {_REGIONS[1]}[c_nationkey + 1] AS currency
        FROM customer""",
    "unmapped_codes": """
        SELECT DISTINCT CASE c_nationkey WHEN 15 THEN 'Amazon.sg' ELSE 'Amazon.ae' END AS marketplace
        FROM customer WHERE c_nationkey IN (15, 16)""",
    "parse_dates": f"""
        SELECT o_orderkey, CASE {_P1} WHEN '1' THEN {_FIRST} WHEN '2' THEN {_FIRST} WHEN '5' THEN NULL ELSE {_DAY} END
                   AS sale_date
        FROM orders""",
    "parse_period_name": f"""
        SELECT o_orderkey, CASE {_P1} WHEN '1' THEN make_date(2000 + year({_DAY}) % 100, month({_DAY}), 1)
                                      WHEN '2' THEN {_FIRST} WHEN '3' THEN {_FIRST} END AS sale_date
        FROM orders""",
    "drop_null_dates": f"""
        SELECT o_orderstatus, count(*) FILTER (WHERE {_P1} <> '5') AS kept, count(*) FILTER (WHERE {_P1} = '5') AS dropped,
               max({_DAY}) FILTER (WHERE {_P1} <> '5') AS latest
        FROM orders GROUP BY 1""",
    "default_currency": """
        SELECT CASE o_orderstatus WHEN 'F' THEN 'EUR' WHEN 'O' THEN 'GBP' ELSE 'USD' END AS currency, count(*) AS n
        FROM orders GROUP BY 1""",
    "classify_binding": """
        SELECT p_partkey, CASE p_type WHEN 'LARGE' THEN 'hardcover' WHEN 'MEDIUM' THEN 'paperback'
                   WHEN 'SMALL' THEN 'board_book' WHEN 'PROMO' THEN 'hardcover' WHEN 'ECONOMY' THEN 'spiral_bound'
                   ELSE 'unknown' END AS edition_format
        FROM part""",
    "infer_edition": """
        SELECT p_partkey, CASE WHEN p_size <= 10 THEN 'board game' WHEN p_type IN ('MEDIUM', 'PROMO') THEN 'paperback'
                   WHEN p_type = 'SMALL' THEN 'hardcover' ELSE 'ebook' END AS edition_format
        FROM part""",
    "clean_market": "SELECT n_name AS country, count(*) AS n FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY 1",
    "unwrap_formula": "SELECT p_partkey, p_name AS title FROM part",
    "normalize_identifier": f"""
        SELECT CASE l_returnflag WHEN 'R' THEN 'B' || {_LPAD} || '.0' ELSE {_LPAD} END AS identifier, count(*) AS n
        FROM lineitem GROUP BY 1""",
    "normalize_isbn": f"""
        SELECT p_partkey,
               CASE p_type WHEN 'LARGE' THEN '978' || {_PAD} WHEN 'MEDIUM' THEN '978' || {_PAD} WHEN 'SMALL' THEN NULL
                    WHEN 'PROMO' THEN substr({_PAD}, 2) || 'X' END AS loose,
               CASE p_type WHEN 'LARGE' THEN '978' || {_PAD} WHEN 'SMALL' THEN '978' || {_PAD} END AS strict
        FROM part""",
    "isbn_fallback": f"""
        SELECT p_partkey AS catalog_order, CASE p_type WHEN 'PROMO' THEN {_PAD} ELSE '978' || {_PAD} END AS book_identifier
        FROM part""",
    "parse_money": f"""
        SELECT o_orderkey,
               CAST(CASE {_P1} WHEN '1' THEN -CAST(o_totalprice AS DECIMAL(18,2)) WHEN '2' THEN CAST(o_totalprice AS DECIMAL(18,2))
                    WHEN '3' THEN CAST(o_totalprice AS DECIMAL(18,2))
                    WHEN '4' THEN floor(CAST(o_totalprice AS DECIMAL(18,2))) + 1000 ELSE 0 END AS DOUBLE) AS amount
        FROM orders""",
    "clean_title": """
        SELECT p_partkey, p_name || ' and ' || lower(p_brand) || ' (book ' || CAST(p_size AS VARCHAR) || ') : a tale' AS short_form,
               p_name || ' and ' || lower(p_brand) AS long_form
        FROM part""",
    "filter_positive": """
        SELECT c_mktsegment, count(*) AS n, CAST(sum(CAST(c_acctbal AS DECIMAL(18,2))) AS DOUBLE) AS total
        FROM customer WHERE CAST(c_acctbal AS DECIMAL(18,2)) > 0 GROUP BY 1""",
    "drop_blank_rows": f"""
        SELECT CASE WHEN {_P1} <> '5' THEN o_orderpriority END AS b, count(*) AS n, count(*) AS keys
        FROM orders WHERE o_orderstatus <> 'P' GROUP BY 1""",
    "date_range_filter": ctes("sales") + """
        SELECT source_platform, count(*) AS n, min(sale_date) AS first, max(sale_date) AS last FROM sales
        WHERE sale_date BETWEEN DATE '1998-03-15' AND DATE '1999-02-28' GROUP BY 1""",
    "exclude_channels": ctes("events_view") + """
        SELECT channel, count(*) AS n FROM events_view WHERE channel NOT IN ('web_shop', 'page_reads') GROUP BY 1""",
    "split_by_pattern": f"""
        SELECT CASE l_returnflag WHEN 'A' THEN 'audio' ELSE 'books' END AS channel, count(*) AS n,
               CAST(round(sum({ROYALTY}), 2) AS DOUBLE) AS revenue
        FROM lineitem GROUP BY 1""",
    "select_subtotals": f"""
        SELECT book_identifier, CAST(us AS VARCHAR) AS "US" FROM ({_CROSSTAB})""",
    "unpivot_crosstab": f"""
        SELECT book_identifier, region, CAST(amount AS DOUBLE) AS royalty_amount
        FROM (SELECT book_identifier, 'US' AS region, us AS amount FROM ({_CROSSTAB})
              UNION ALL SELECT book_identifier, 'UK', uk FROM ({_CROSSTAB})
              UNION ALL SELECT book_identifier, 'DE', -de FROM ({_CROSSTAB})
              UNION ALL SELECT book_identifier, 'FR', fr FROM ({_CROSSTAB}))
        WHERE amount > 0""",
    "format_usd": """
        SELECT o_orderkey, CASE o_orderstatus WHEN 'P' THEN '$0.00' ELSE '$' || format('{:,.2f}', o_totalprice) END AS dashboard,
               CASE o_orderstatus WHEN 'P' THEN '$0.00' ELSE '$' || format('{:.2f}', o_totalprice) END AS plain
        FROM orders""",
    "format_compact": """
        SELECT o_custkey, CASE
            WHEN v IS NULL THEN '0'
            WHEN v >= 1000000 THEN CAST(CAST(round(CAST(v / 1000000 AS DECIMAL(30,6)), 1) AS DECIMAL(30,1)) AS VARCHAR) || 'M'
            WHEN v >= 1000 THEN CAST(CAST(round(CAST(v / 1000 AS DECIMAL(30,6)), 1) AS DECIMAL(30,1)) AS VARCHAR) || 'K'
            ELSE CAST(CAST(floor(v) AS BIGINT) AS VARCHAR) END AS label
        FROM (SELECT o_custkey, CASE WHEN total > 90000 THEN total WHEN total > 50000 THEN CAST(total / 100 AS DECIMAL(30,6)) END AS v
              FROM (SELECT o_custkey, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DECIMAL(30,6)) AS total
                    FROM orders GROUP BY 1))""",
    "prettify_slug": f"""
        SELECT p_partkey, CASE p_size WHEN 1 THEN '(Unmatched)' WHEN 2 THEN '' ELSE {INITCAP_NAME} END AS label FROM part""",
    "month_label": f"""
        SELECT o_orderkey, strftime({_DAY}, '%b %Y') AS long, strftime({_DAY}, '%b') AS short FROM orders""",
    "parse_statement_rows": f"""
        SELECT l_partkey, CASE l_returnflag WHEN 'A' THEN 'Some Shop 24h' ELSE 'Library' END AS distributor,
               'NATION zone' AS region_code, count(*) AS n, min(CAST(l_shipdate AS DATE)) AS first_date,
               CAST(sum(CASE l_linestatus WHEN 'F' THEN -l_quantity ELSE l_quantity END) AS BIGINT) AS quantity,
               CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS gross_local,
               CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2)) - CAST(l_tax AS DECIMAL(18,2))) AS DOUBLE) AS received_local,
               CAST(sum(CAST(l_tax AS DECIMAL(18,2))) AS DOUBLE) AS fee_local,
               CAST(-sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS payable_local,
               CAST(sum(CAST(l_discount AS DECIMAL(4,2)) * 100) AS DOUBLE) AS royalty_rate_pct,
               CAST(sum(round({ROYALTY}, 2)) AS DOUBLE) AS royalty_amount_local
        FROM lineitem GROUP BY 1, 2""",
    "classify_lines": f"""
        WITH sections AS ({_LINES})
        SELECT file, 'data' AS kind, CAST(sum(n) AS BIGINT) AS n FROM sections GROUP BY 1
        UNION ALL SELECT file, 'skip', 3 * count(*) FROM sections GROUP BY 1
        UNION ALL SELECT file, 'blank', count(*) FROM sections GROUP BY 1
        UNION ALL SELECT file, 'other', count(*) FROM sections GROUP BY 1
        UNION ALL SELECT file, 'identifier', count(*) FROM sections GROUP BY 1
        UNION ALL SELECT file, 'title', count(*) FROM sections JOIN part ON p_partkey = l_partkey WHERE p_size <> 1 GROUP BY 1
        UNION ALL SELECT file, 'currency', count(*) FROM sections JOIN part ON p_partkey = l_partkey WHERE p_size = 3 GROUP BY 1""",
    "section_context": f"""
        WITH sections AS (SELECT file, l_partkey, n, p_size, p_name FROM ({_LINES}) JOIN part ON p_partkey = l_partkey)
        SELECT file, l_partkey * 1000 + 900 AS line_no,
               (SELECT 'Tale of ' || {INITCAP_NAME.replace('p_name', 's.p_name')} || ' ' || lpad(CAST(s.l_partkey AS VARCHAR), 10, '0')
                FROM sections s WHERE s.file = d.file AND s.l_partkey <= d.l_partkey AND s.p_size <> 1
                ORDER BY s.l_partkey DESC LIMIT 1) AS display_title,
               CASE p_size WHEN 2 THEN 'ax' ELSE '978' END || lpad(CAST(l_partkey AS VARCHAR), 10, '0') AS book_isbn,
               coalesce((SELECT CASE WHEN s.l_partkey % 2 = 0 THEN 'EUR' ELSE 'GBP' END
                FROM sections s WHERE s.file = d.file AND s.l_partkey <= d.l_partkey AND s.p_size = 3
                ORDER BY s.l_partkey DESC LIMIT 1), 'USD') AS currency,
               n
        FROM sections d""",
}
