"""Oracles of the file sources and the fact sink: what went into the files must come out."""

from oracles.facts import ctes, m2

_N = "count(*) AS n, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total"
_NOTE = "'Café, ' || substr(o_orderpriority, 1, 1) || ' €'"

ORACLES = {
    "scan_csv_encoding": f"SELECT o_orderstatus AS status, {_NOTE} AS note, {_N} FROM orders GROUP BY 1, 2",
    "scan_skip_preamble": f"""
        SELECT o_orderstatus AS status, '="' || {_NOTE} || '"' AS note, {_N} FROM orders GROUP BY 1, 2""",
    "scan_sniff_delimiter": f"SELECT o_orderstatus AS status, {_N} FROM orders GROUP BY 1",
    "scan_multi_file": f"""
        SELECT CAST(year(o_orderdate) AS VARCHAR) AS year, TRUE AS named, {_N} FROM orders GROUP BY 1""",
    "quarantine_bad_files": """
        SELECT count(*) FILTER (WHERE o_orderstatus <> 'P') AS good_rows, count(*) FILTER (WHERE o_orderstatus = 'P') AS bad_rows
        FROM orders""",
    "write_fact": ctes("sales") + f"""
        SELECT source_platform, count(*) AS n, min(sale_date) AS first, max(sale_date) AS last,
               {m2('sum(royalty_amount_usd)')} AS revenue
        FROM sales WHERE sale_date BETWEEN DATE '1997-01-15' AND DATE '1998-12-31' GROUP BY 1""",
    "append_fact": ctes("sales") + f"""
        SELECT source_platform, count(*) AS n, count(DISTINCT date_trunc('month', sale_date)) AS months,
               {m2('sum(royalty_amount_usd)')} AS revenue,
               count(DISTINCT year(sale_date)) FILTER (sale_date >= DATE '1997-01-01') AS added
        FROM sales GROUP BY 1""",
}
