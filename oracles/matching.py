"""Oracles of resolution, currency, pool and quality operators."""

from oracles.facts import ROYALTY, ctes, m2

_PAD = "lpad(CAST(l_partkey AS VARCHAR), 10, '0')"

_CROSSWALK = """
    SELECT upper(replace(identifier, '-', '')) AS identifier, id_type, rank, canonical_work_slug, series, edition_format,
           display_title, catalog_order
    FROM (SELECT asin AS identifier, 'asin' AS id_type, 1 AS rank, * FROM catalog
          UNION ALL SELECT isbn_13, 'isbn_13', 2, * FROM catalog
          UNION ALL SELECT isbn_10, 'isbn_10', 3, * FROM catalog
          UNION ALL SELECT other_id, 'other_id', 4, * FROM catalog)
    WHERE identifier IS NOT NULL"""

# part key, platform, raw identifier, normalised identifier
_LINES = f"""
    SELECT l_partkey, l_suppkey, CAST(l_shipdate AS DATE) AS sale_date, l_returnflag AS source_platform,
           CAST(l_quantity AS BIGINT) AS quantity,
           CASE WHEN l_returnflag = 'A' THEN '978-' || substr({_PAD}, 1, 1) || '-' || substr({_PAD}, 2)
                WHEN l_returnflag = 'N' AND l_linestatus = 'F' THEN '''b' || substr({_PAD}, 2)
                WHEN l_returnflag = 'N' THEN {_PAD} || '.0'
                WHEN l_linestatus = 'F' THEN 'zz-' || {_PAD} END AS raw,
           CASE WHEN l_returnflag = 'A' THEN '978' || {_PAD}
                WHEN l_returnflag = 'N' AND l_linestatus = 'F' THEN 'B' || substr({_PAD}, 2)
                WHEN l_returnflag = 'N' THEN {_PAD} END AS norm
    FROM lineitem"""

_BEST = "SELECT * FROM crosswalk QUALIFY row_number() OVER (PARTITION BY identifier ORDER BY rank, catalog_order) = 1"

_ENRICHED = """
    SELECT k.*, coalesce(b.canonical_work_slug, k.raw) AS canonical_work_slug, b.canonical_work_slug AS own_slug,
           b.series, b.edition_format
    FROM keyed k LEFT JOIN best b ON b.identifier = k.norm"""

_NAMES = """
    SELECT o_orderkey,
           CASE o_orderstatus
               WHEN 'O' THEN 'Signed ' || coalesce(display_title, 'Blue Mug') || ' Deluxe Hardcover'
               WHEN 'F' THEN upper(coalesce(display_title, 'Blue Mug')) || ' - paperback (deluxe)'
               ELSE 'The' || replace(coalesce(display_title, 'Blue Mug'), '&', 'and') || 's' END AS product_name
    FROM orders LEFT JOIN catalog ON catalog_order = o_custkey"""

_FX = """
    SELECT q.rate_date, q.currency, q.per_eur, d.per_eur AS usd_per_eur
    FROM fx_rates q JOIN fx_rates d ON d.rate_date = q.rate_date AND d.currency = 'USD' WHERE q.currency <> 'USD'
    UNION ALL
    SELECT rate_date, 'EUR', CAST(1 AS DECIMAL(18,8)), per_eur FROM fx_rates WHERE currency = 'USD'"""

_PRICED = """
    SELECT source_platform, sale_date, price, royalty_amount,
           CASE WHEN quantity <> 50 THEN CASE source_platform WHEN 'Audio_Store' THEN ' ' || lower(currency) ELSE currency END
           END AS currency
    FROM sales"""


def _long_clean(title: str) -> str:
    bare = f"regexp_replace(regexp_replace(trim(lower({title})), '\\s*:\\s*.*$', ''), '\\s*\\([^)]*\\)', '', 'g')"
    return f"trim(replace({bare}, '&', 'and'))"


def _usd(amount: str) -> str:
    return (
        f"CASE WHEN upper(trim(p.currency)) = 'USD' THEN round(CAST(p.{amount} AS DECIMAL(28,6)), 2) "
        f"ELSE round(CAST(CAST(p.{amount} AS DOUBLE) / CAST(q.per_eur AS DOUBLE) * CAST(q.usd_per_eur AS DOUBLE) "
        f"AS DECIMAL(28,6)), 2) END"
    )


_CONVERTED = f"""
    SELECT p.source_platform, p.currency, p.sale_date, {_usd('royalty_amount')} AS royalty_amount_usd,
           {_usd('price')} AS price_usd
    FROM priced p ASOF LEFT JOIN
         (SELECT * FROM quotes
          UNION ALL SELECT CAST(rate_date + INTERVAL 30 DAY AS DATE), currency, NULL, NULL FROM quotes s
          WHERE NOT EXISTS (SELECT 1 FROM quotes n WHERE n.currency = s.currency AND n.rate_date > s.rate_date
                            AND n.rate_date <= s.rate_date + INTERVAL 30 DAY)) q
      ON q.currency = upper(trim(p.currency)) AND q.rate_date <= p.sale_date"""

_POOL = {
    "currency_lines": f"""
        SELECT CAST(date_trunc('month', l_shipdate) AS DATE) AS month,
               CASE n_regionkey WHEN 0 THEN 'USD' WHEN 1 THEN 'EUR' WHEN 2 THEN 'GBP' WHEN 3 THEN 'JPY' ELSE 'CAD' END
                   AS currency,
               l_returnflag AS flag, {ROYALTY} AS royalty, CAST(l_quantity AS BIGINT) AS pages
        FROM lineitem JOIN supplier ON s_suppkey = l_suppkey JOIN nation ON n_nationkey = s_nationkey""",
    "summary": """
        SELECT m.month, c.currency,
               CASE WHEN c.currency = 'GBP' AND month(m.month) = 3 THEN NULL
                    WHEN c.currency = 'JPY' AND month(m.month) = 4 THEN 0 ELSE o.total END AS summary_total
        FROM (SELECT DISTINCT CAST(date_trunc('month', o_orderdate) AS DATE) AS month FROM orders) m
        CROSS JOIN (VALUES ('USD', '1'), ('GBP', '2'), ('EUR', '3'), ('JPY', '4'), ('CAD', '5')) c(currency, digit)
        LEFT JOIN (SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS month, substr(o_orderpriority, 1, 1) AS digit,
                          sum(CAST(o_totalprice AS DECIMAL(18,2))) AS total
                   FROM orders GROUP BY 1, 2) o ON o.month = m.month AND o.digit = c.digit""",
    "detail": "SELECT month, currency, sum(royalty) AS detail_total FROM currency_lines WHERE flag <> 'R' GROUP BY 1, 2",
    "pools": """
        SELECT s.month, s.currency, s.summary_total, d.detail_total,
               CASE WHEN s.summary_total IS NULL OR s.summary_total = 0
                    THEN CASE WHEN d.detail_total > 0 THEN CAST(-d.detail_total AS DECIMAL(28,4)) END
                    ELSE CAST(round(s.summary_total - coalesce(d.detail_total, 0), 2) AS DECIMAL(28,4)) END AS pool
        FROM summary s LEFT JOIN detail d ON d.month = s.month AND d.currency = s.currency""",
    "rates": """
        SELECT p.month, p.currency, CAST(p.pool AS DOUBLE) / r.pages AS rate
        FROM pools p JOIN (SELECT month, currency, sum(pages) AS pages FROM currency_lines WHERE flag = 'R' GROUP BY 1, 2) r
          ON r.month = p.month AND r.currency = p.currency
        WHERE p.pool IS NOT NULL AND r.pages > 0""",
    "shares": """
        SELECT l.month, l.currency, x.rate, round(CAST(l.pages * x.rate AS DECIMAL(28,6)), 2) AS royalty
        FROM currency_lines l LEFT JOIN rates x ON x.month = l.month AND x.currency = l.currency WHERE flag = 'R'""",
}

ORACLES = {
    "dim_catalog": ctes("catalog") + """
        SELECT coalesce(asin, isbn_13, isbn_10, other_id) AS book_identifier, canonical_work_slug, display_title, series,
               edition_format,
               concat_ws('; ', 'asin:' || asin, 'isbn_13:' || isbn_13, 'isbn_10:' || isbn_10, 'other_id:' || other_id)
                   AS other_ids
        FROM catalog""",
    "identifier_crosswalk": ctes("catalog", crosswalk=_CROSSWALK) + """
        SELECT identifier, id_type, canonical_work_slug, series, catalog_order FROM crosswalk""",
    "enrich_by_identifier": ctes("catalog", crosswalk=_CROSSWALK, best=_BEST, keyed=_LINES, enriched=_ENRICHED) + """
        SELECT source_platform, canonical_work_slug, series, edition_format, count(*) AS n,
               CAST(sum(quantity) AS BIGINT) AS units
        FROM enriched GROUP BY ALL""",
    "staged_resolution": ctes("catalog", crosswalk=_CROSSWALK, best=_BEST, keyed=_LINES, enriched=_ENRICHED, first_titles="""
        SELECT DISTINCT ON (display_title) display_title, series, canonical_work_slug, edition_format FROM catalog
        ORDER BY display_title, catalog_order""") + """
        SELECT e.source_platform,
               CASE WHEN e.series IS NULL THEN f.canonical_work_slug ELSE e.own_slug END AS canonical_work_slug,
               CASE WHEN e.series IS NULL THEN f.series ELSE e.series END AS series,
               CASE WHEN e.series IS NULL THEN f.edition_format ELSE e.edition_format END AS edition_format,
               count(*) AS n, CAST(sum(e.quantity) AS BIGINT) AS units
        FROM enriched e JOIN catalog c ON c.catalog_order = e.l_partkey
        LEFT JOIN first_titles f ON e.source_platform = 'R' AND f.display_title = c.display_title
        GROUP BY 1, 2, 3, 4""",
    "containment_match": ctes("catalog", shop_names=_NAMES, names="""
        SELECT DISTINCT product_name, trim(replace(lower(product_name), '&', 'and')) AS clean FROM shop_names""", titles="""
        SELECT *, trim(replace(lower(display_title), '&', 'and')) AS title FROM catalog""", hits="""
        SELECT n.product_name, n.clean, t.* EXCLUDE (edition_format)
        FROM names n JOIN (SELECT * FROM titles QUALIFY row_number() OVER (PARTITION BY title ORDER BY catalog_order) = 1) t
          ON contains(n.clean, t.title) AND length(t.title) > 5""") + """
        SELECT product_name, title AS matched_title, series, canonical_work_slug,
               CASE WHEN contains(clean, 'hardcover') THEN 'deluxe hardcover'
                    WHEN contains(clean, 'paperback') AND contains(clean, 'deluxe') THEN 'deluxe paperback' END
                   AS edition_format
        FROM hits QUALIFY row_number() OVER (PARTITION BY product_name ORDER BY length(title) DESC, catalog_order) = 1""",
    # Ratcliff/Obershelp by segments: equal letters form diagonal runs, the longest run inside a segment (earliest in the
    # title, then in the candidate) is matched, and what lies left and right of it goes on as two segments.
    "fuzzy_title_match": ctes("catalog", spelled="""
        SELECT CASE WHEN CAST(kenp_page_count AS INTEGER) <= 15 THEN substring(display_title, 1, 3) || substring(display_title, 5)
                    WHEN CAST(kenp_page_count AS INTEGER) <= 30 THEN 'The ' || display_title
                    WHEN CAST(kenp_page_count AS INTEGER) <= 40 THEN display_title || ': Large Print'
                    ELSE reverse(display_title) END AS book_title FROM catalog
        UNION ALL SELECT c_name FROM customer""", names=f"""
        SELECT DISTINCT book_title, {_long_clean('book_title')} AS clean FROM spelled WHERE book_title IS NOT NULL""", known=f"""
        SELECT clean, min(catalog_order) AS catalog_order
        FROM (SELECT {_long_clean('display_title')} AS clean, catalog_order FROM catalog) GROUP BY clean""", open_titles="""
        SELECT DISTINCT clean FROM names WHERE clean NOT IN (SELECT clean FROM known)""", strings="""
        SELECT clean, row_number() OVER () AS id, length(clean) AS size, clean IN (SELECT clean FROM open_titles) AS open
        FROM (SELECT clean FROM open_titles UNION SELECT clean FROM known)""", letters="""
        SELECT id, open, size, ascii(letter) * 256 + row_number() OVER (PARTITION BY id, letter) AS letter
        FROM (SELECT id, open, size, unnest(string_split(clean, '')) AS letter FROM strings)""", pairs="""
        SELECT row_number() OVER () AS pair, a.clean, b.clean AS candidate, a.size, b.size AS c_size
        FROM (SELECT a.id, b.id AS c_id
              FROM letters a JOIN letters b ON a.letter = b.letter AND a.open AND NOT b.open
                AND 8 * least(a.size, b.size) >= 3 * (a.size + b.size)
              GROUP BY a.id, b.id HAVING 8 * count(*) >= 3 * (any_value(a.size) + any_value(b.size)))
        JOIN strings a USING (id) JOIN strings b ON b.id = c_id""", places="""
        SELECT pair, i, j, i - j AS diagonal
        FROM (SELECT pair, clean, candidate, i, unnest(range(1, c_size + 1)) AS j
              FROM (SELECT *, unnest(range(1, size + 1)) AS i FROM pairs))
        WHERE substring(clean, i, 1) = substring(candidate, j, 1)""", runs="""
        SELECT pair, diagonal, min(i) AS first, max(i) + 1 AS past
        FROM (SELECT *, i - row_number() OVER (PARTITION BY pair, diagonal ORDER BY i) AS run FROM places)
        GROUP BY pair, diagonal, run""", segments="""
        SELECT pair, 1 AS lo, size + 1 AS hi, 1 AS c_lo, c_size + 1 AS c_hi, 0 AS matched FROM pairs
        UNION ALL
        SELECT pair, CASE WHEN side = 0 THEN lo ELSE best.start + best.size END, CASE WHEN side = 0 THEN best.start ELSE hi END,
               CASE WHEN side = 0 THEN c_lo ELSE best.start - best.diagonal + best.size END,
               CASE WHEN side = 0 THEN best.start - best.diagonal ELSE c_hi END, CASE WHEN side = 0 THEN best.size ELSE 0 END
        FROM (
            SELECT pair, lo, hi, c_lo, c_hi,
                   arg_max({'start': start, 'diagonal': diagonal, 'size': past - start}, (past - start, -start, diagonal)) AS best
            FROM (SELECT s.pair, lo, hi, c_lo, c_hi, diagonal, greatest(first, lo, c_lo + diagonal) AS start,
                         least(past, hi, c_hi + diagonal) AS past
                  FROM segments s JOIN runs r ON s.pair = r.pair)
            WHERE past > start GROUP BY pair, lo, hi, c_lo, c_hi), (SELECT unnest([0, 1]) AS side)""", scored="""
        SELECT clean, candidate, 2 * CAST(sum(matched) AS DOUBLE) / (size + c_size) AS score
        FROM segments JOIN pairs USING (pair) GROUP BY pair, clean, candidate, size, c_size""", best="""
        SELECT clean, catalog_order, CAST(1 AS DOUBLE) AS score FROM names JOIN known USING (clean) GROUP BY ALL
        UNION ALL
        SELECT clean, catalog_order, score FROM (
            SELECT s.clean, k.catalog_order, score FROM scored s JOIN known k ON k.clean = s.candidate WHERE score >= 0.75
            QUALIFY row_number() OVER (PARTITION BY s.clean ORDER BY score DESC, k.catalog_order) = 1)""") + """
        SELECT book_title, round(score, 6) AS score, catalog_order, series, canonical_work_slug, edition_format
        FROM names JOIN best USING (clean) JOIN catalog USING (catalog_order)""",
    "match_rate": ctes("catalog", crosswalk=_CROSSWALK, best=_BEST, keyed=_LINES, enriched=_ENRICHED) + """
        SELECT source_platform, count(series) AS matched, count(*) AS total,
               CAST(round(CAST(count(series) * 100.0 / count(*) AS DECIMAL(12,6)), 1) AS DOUBLE) AS match_pct
        FROM enriched GROUP BY 1""",
    "fx_to_usd": ctes("sales", "fx_rates", quotes=_FX, priced=_PRICED, converted=_CONVERTED) + """
        SELECT currency, sale_date, count(*) AS n, count(royalty_amount_usd) AS converted,
               CAST(sum(royalty_amount_usd) AS DOUBLE) AS royalty_usd, CAST(sum(price_usd) AS DOUBLE) AS price_usd
        FROM converted GROUP BY 1, 2""",
    "fx_coverage": ctes("sales", "fx_rates", quotes=_FX, priced=_PRICED, converted=_CONVERTED) + """
        SELECT source_platform, currency, count(royalty_amount_usd) AS converted, count(*) AS total,
               CAST(round(CAST(count(royalty_amount_usd) * 100.0 / count(*) AS DECIMAL(12,6)), 1) AS DOUBLE) AS converted_pct
        FROM converted GROUP BY 1, 2""",
    "pool_allocation": ctes(**_POOL) + """
        SELECT month, currency, count(*) AS reads, count(royalty) AS paid,
               CAST(round(CAST(max(rate) AS DECIMAL(28,8)), 6) AS DOUBLE) AS rate_per_page,
               CAST(sum(royalty) AS DOUBLE) AS royalty
        FROM shares GROUP BY 1, 2""",
    "equivalent_copies": """
        SELECT l_partkey, CAST(sum(round(CAST(l_quantity / coalesce(nullif(p_size, 7), 1) AS DECIMAL(18,6)), 2)) AS DOUBLE)
                   AS equivalent_copies
        FROM lineitem LEFT JOIN part ON p_partkey = l_partkey WHERE l_returnflag = 'R' GROUP BY 1""",
    "reconcile_totals": ctes(**_POOL, paid="""
        SELECT month, currency, sum(royalty) AS allocated, count(royalty) AS n FROM shares GROUP BY 1, 2""", sides="""
        SELECT coalesce(s.month, d.month) AS month, coalesce(s.currency, d.currency) AS currency, s.summary_total, d.detail_total
        FROM summary s FULL JOIN detail d ON d.month = s.month AND d.currency = s.currency""") + """
        SELECT a.month, a.currency, CAST(a.summary_total AS DOUBLE) AS summary_total,
               CAST(a.detail_total AS DOUBLE) AS detail_total, CAST(p.pool AS DOUBLE) AS pool,
               CAST(b.allocated AS DOUBLE) AS allocated,
               coalesce(a.detail_total, 0) > coalesce(a.summary_total, 0) AS detail_exceeds_summary,
               coalesce(b.n > 0 AND abs(b.allocated - p.pool) > b.n * 0.005, FALSE) AS allocation_off
        FROM sides a LEFT JOIN pools p ON p.month = a.month AND p.currency = a.currency
        LEFT JOIN paid b ON b.month = a.month AND b.currency = a.currency""",
    "page_count_ratio": """
        SELECT count(*) AS n, CAST(round(CAST(regr_slope(chars, words) AS DECIMAL(28,10)), 4) AS DOUBLE) AS slope,
               CAST(round(CAST(sum(chars) / sum(words) AS DECIMAL(28,10)), 4) AS DOUBLE) AS mean_ratio,
               CAST(round(CAST(regr_r2(chars, words) AS DECIMAL(28,10)), 4) AS DOUBLE) AS r2
        FROM (SELECT CAST(len(regexp_split_to_array(trim(text), '[ \t\n\r]+')) AS DOUBLE) AS words,
                     CAST(n_chars AS DOUBLE) AS chars FROM documents)""",
    "dedupe_keep_first": """
        SELECT sale_date, file, line, CAST(net AS DOUBLE) AS net
        FROM (SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS sale_date, o_orderpriority AS file,
                     min(o_orderkey) AS line, sum(CAST(o_totalprice AS DECIMAL(18,2))) AS net
              FROM orders GROUP BY 1, 2)
        WHERE month(sale_date) <> 2 OR substr(file, 1, 1) <> '1'
        QUALIFY row_number() OVER (PARTITION BY sale_date ORDER BY file, line) = 1""",
    "duplicate_keys": ctes("shop") + """
        SELECT product_name, period_start, period_end, count(*) AS copies FROM shop GROUP BY 1, 2, 3 HAVING count(*) > 1""",
    "merge_overlapping": ctes("shop") + """
        SELECT product_name, period_start, period_end, period_end AS sale_date, CAST(sum(items_sold) AS BIGINT) AS items_sold,
               CAST(sum(net_sales) AS DOUBLE) AS net_sales, CAST(sum(orders_count) AS BIGINT) AS orders_count,
               first(sku ORDER BY file, line_no) FILTER (WHERE sku IS NOT NULL) AS sku,
               first(category ORDER BY file, line_no) AS category,
               first(series ORDER BY file, line_no) FILTER (WHERE series IS NOT NULL) AS series
        FROM shop GROUP BY 1, 2, 3""",
    "table_integrity": ctes("sales", "reads", "memberships", "shop", "statements") + f"""
        SELECT 'sales' AS table_name, count(*) AS row_count, {m2('sum(royalty_amount_usd)')} AS measure_total FROM sales
        UNION ALL SELECT 'reads', count(*), {m2('sum(royalty_amount_usd)')} FROM reads
        UNION ALL SELECT 'memberships', count(*), {m2('sum(net_earnings)')} FROM memberships
        UNION ALL SELECT 'shop', count(*), {m2('sum(net_sales)')} FROM shop
        UNION ALL SELECT 'statements', count(*), {m2('sum(royalty_amount_usd)')} FROM statements
        UNION ALL SELECT 'catalog', count(*), NULL FROM catalog""",
    "value_distribution": ctes("statements") + "SELECT distributor, count(*) AS n FROM statements GROUP BY 1",
    "load_profile": ctes("sales") + f"""
        SELECT source_platform, currency, count(*) AS row_count, min(sale_date) AS first_date, max(sale_date) AS last_date,
               count(DISTINCT region) AS distinct_codes, string_agg(DISTINCT region, ', ' ORDER BY region) AS code_list,
               {m2('sum(royalty_amount)')} AS raw_total
        FROM sales GROUP BY 1, 2""",
}
