"""Entity resolution, currency, pool and quality operators on the driver's tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerloom.operators import fx, pool, quality, resolve
from ledgerloom.plans import stand_ins as t

# ------------------------------------------------------------ resolution


def identifier_crosswalk(spark, folder):
    pairs = resolve.crosswalk(t.catalog(spark, folder))
    return pairs.select("identifier", "id_type", "canonical_work_slug", "series", "catalog_order")


def identified_lines(spark, folder):
    """Sales lines whose identifier is spelled by platform: hyphens, apostrophe, ``.0``, lower case, or unknown."""
    lines = t.table(spark, folder, "lineitem")
    key = F.lpad(F.col("l_partkey").cast("string"), 10, "0")
    flag, status = F.col("l_returnflag"), F.col("l_linestatus")
    raw = (
        F.when(flag == "A", F.concat(F.lit("978-"), F.substring(key, 1, 1), F.lit("-"), F.substring(key, 2, 9)))
        .when((flag == "N") & (status == "F"), F.concat(F.lit("'b"), F.substring(key, 2, 9)))
        .when(flag == "N", F.concat(key, F.lit(".0")))
        .when(status == "F", F.concat(F.lit("zz-"), key))
    )
    return lines.select(
        "l_partkey", "l_suppkey", F.col("l_shipdate").cast("date").alias("sale_date"), flag.alias("source_platform"),
        raw.alias("book_identifier"), F.col("l_quantity").cast("bigint").alias("quantity"), t.royalty().alias("royalty_amount"),
    )


def enrich_by_identifier(spark, folder):
    rows = resolve.enrich(identified_lines(spark, folder), "book_identifier", t.catalog(spark, folder))
    return rows.groupBy("source_platform", "canonical_work_slug", "series", "edition_format").agg(
        F.count(F.lit(1)).alias("n"), F.sum("quantity").alias("units")
    )


def titled_lines(spark, folder):
    """The same lines with a title, differently decorated per platform."""
    titles = t.catalog(spark, folder).select(F.col("catalog_order").alias("l_partkey"), "display_title")
    shown = F.when(
        F.col("source_platform") == "R", F.concat(F.upper("display_title"), F.lit(" (Volume 2) : A Saga"))
    ).when(F.col("source_platform") == "N", F.lit("### 0000 ###"))
    return identified_lines(spark, folder).join(titles, "l_partkey").withColumn("book_title", shown).drop("display_title")


def staged_resolution(spark, folder):
    rows = resolve.staged_resolution(titled_lines(spark, folder), t.catalog(spark, folder))
    return rows.groupBy("source_platform", "canonical_work_slug", "series", "edition_format").agg(
        F.count(F.lit(1)).alias("n"), F.sum("quantity").alias("units")
    )


def shop_names(spark, folder):
    """Product names of the shop: catalog titles with words around them, and merchandise."""
    titles = t.catalog(spark, folder).select(F.col("catalog_order").alias("o_custkey"), "display_title")
    orders = t.table(spark, folder, "orders").join(titles, "o_custkey", "left")
    status = F.col("o_orderstatus")
    body = F.coalesce("display_title", F.lit("Blue Mug"))
    name = (
        F.when(status == "O", F.concat(F.lit("Signed "), body, F.lit(" Deluxe Hardcover")))
        .when(status == "F", F.concat(F.upper(body), F.lit(" - paperback (deluxe)")))
        .otherwise(F.concat(F.lit("The"), F.replace(body, F.lit("&"), F.lit("and")), F.lit("s")))
    )
    return orders.select("o_orderkey", name.alias("product_name"))


def containment_match(spark, folder):
    return resolve.containment_match(shop_names(spark, folder), t.catalog(spark, folder))


def misspelled_titles(spark, folder):
    """Catalog titles with a letter lost, a swap or an extra word, and customer names that match nothing."""
    title = F.col("display_title")
    size = F.col("kenp_page_count").cast("int")
    spelled = (
        F.when(size <= 15, F.concat(F.substring(title, 1, 3), F.expr("substring(display_title, 5)")))
        .when(size <= 30, F.concat(F.lit("The "), title))
        .when(size <= 40, F.concat(title, F.lit(": Large Print")))
        .otherwise(F.reverse(title))
    )
    titles = t.catalog(spark, folder).select(spelled.alias("book_title"))
    return titles.unionByName(t.table(spark, folder, "customer").select(F.col("c_name").alias("book_title")))


def fuzzy_title_match(spark, folder):
    found = resolve.fuzzy_title_match(misspelled_titles(spark, folder), t.catalog(spark, folder))
    return found.withColumn("score", F.round("score", 6))


def match_rate(spark, folder):
    rows = resolve.enrich(identified_lines(spark, folder), "book_identifier", t.catalog(spark, folder))
    return resolve.match_rate(rows, "source_platform")


def dim_catalog(spark, folder):
    return resolve.build_dimension(t.catalog(spark, folder))


# ------------------------------------------------------------ currency


def _priced(spark, folder):
    lines = t.sales(spark, folder, "currency")
    odd = F.when(F.col("source_platform") == "Audio_Store", F.concat(F.lit(" "), F.lower("currency"))).otherwise(F.col("currency"))
    return lines.drop("royalty_amount_usd").withColumn("currency", F.when(F.col("quantity") != 50, odd))


def _converted(spark, folder):
    return fx.to_usd(
        _priced(spark, folder), {"royalty_amount": "royalty_amount_usd", "price": "price_usd"}, t.fx_rates(spark, folder)
    )


def fx_to_usd(spark, folder):
    return _converted(spark, folder).groupBy("currency", "sale_date").agg(
        F.count(F.lit(1)).alias("n"),
        F.count("royalty_amount_usd").alias("converted"),
        F.sum("royalty_amount_usd").cast("double").alias("royalty_usd"),
        F.sum("price_usd").cast("double").alias("price_usd"),
    )


def fx_coverage(spark, folder):
    return fx.fx_coverage(_converted(spark, folder), "source_platform", "currency")


# ------------------------------------------------------------ pooled royalties


def pool_summary(spark, folder):
    """Monthly royalty summary, one column per currency; pounds are missing in March, yen are 0 in April."""
    orders = t.table(spark, folder, "orders")
    month = F.trunc(F.col("o_orderdate").cast("date"), "MM")
    codes = {"USD": "1", "GBP": "2", "EUR": "3", "JPY": "4", "CAD": "5"}
    sums = orders.groupBy(month.alias("month")).agg(
        *[
            F.sum(F.when(F.substring("o_orderpriority", 1, 1) == digit, t.amount("o_totalprice"))).alias(code)
            for code, digit in codes.items()
        ]
    )
    shown = {
        "GBP": F.when(F.month("month") != 3, F.col("GBP")),
        "JPY": F.when(F.month("month") != 4, F.col("JPY")).otherwise(F.lit(0)),
    }
    wide = sums.select(
        "month", *[shown.get(c, F.col(c)).cast("decimal(28,2)").cast("string").alias(f"Royalty ({c})") for c in codes]
    )
    return pool.unpivot_summary(wide, tuple(codes))


def _currency_lines(spark, folder):
    return t.table(spark, folder, "lineitem").join(t.suppliers(spark, folder), "l_suppkey")


def pool_detail(spark, folder):
    lines = _currency_lines(spark, folder).where(F.col("l_returnflag") != "R")
    return lines.select(
        F.trunc(F.col("l_shipdate").cast("date"), "MM").alias("month"), "currency", t.royalty().alias("royalty")
    )


def pool_reads(spark, folder):
    lines = _currency_lines(spark, folder).where(F.col("l_returnflag") == "R")
    return lines.select(
        "l_partkey", F.col("l_shipdate").cast("date").alias("sale_date"), "currency", F.col("l_quantity").cast("bigint").alias("page_count")
    )


def _allocated(spark, folder):
    return pool.allocate_pool(pool_summary(spark, folder), pool_detail(spark, folder), pool_reads(spark, folder))


def pool_allocation(spark, folder):
    rows = _allocated(spark, folder)
    return rows.groupBy(F.trunc("sale_date", "MM").alias("month"), "currency").agg(
        F.count(F.lit(1)).alias("reads"),
        F.count("royalty_amount").alias("paid"),
        F.round(F.max("rate_per_page").cast("decimal(28,8)"), 6).cast("double").alias("rate_per_page"),
        F.sum("royalty_amount").cast("double").alias("royalty"),
    )


def equivalent_copies(spark, folder):
    lines = t.table(spark, folder, "lineitem").where(F.col("l_returnflag") == "R")
    sizes = t.table(spark, folder, "part").select(F.col("p_partkey").alias("l_partkey"), F.nullif("p_size", F.lit(7)).cast("string").alias("size"))
    copies = pool.equivalent_copies(F.col("l_quantity"), F.col("size"))
    rows = lines.join(sizes, "l_partkey", "left").select("l_partkey", copies.alias("copies"))
    return rows.groupBy("l_partkey").agg(F.sum("copies").cast("double").alias("equivalent_copies"))


def reconcile_totals(spark, folder):
    return pool.reconcile(pool_summary(spark, folder), pool_detail(spark, folder), _allocated(spark, folder))


def page_count_ratio(spark, folder):
    words = F.size(F.split(F.trim("text"), "[ \t\n\r]+"))
    docs = t.table(spark, folder, "documents").select(words.cast("double").alias("words"), F.col("n_chars").cast("double").alias("chars"))
    return pool.fit_ratio(docs, "words", "chars")


# ------------------------------------------------------------ quality


def _membership_files(spark, folder):
    """Membership months by payment priority; each later file repeats all months with other figures."""
    orders = t.table(spark, folder, "orders")
    months = orders.groupBy(
        F.trunc(F.col("o_orderdate").cast("date"), "MM").alias("sale_date"), F.col("o_orderpriority").alias("file")
    ).agg(F.sum(t.amount("o_totalprice")).alias("net"), F.min("o_orderkey").alias("line"))
    return months.where((F.month("sale_date") != 2) | (F.substring("file", 1, 1) != "1"))


def dedupe_keep_first(spark, folder):
    kept = quality.dedupe_keep_first(_membership_files(spark, folder), ["sale_date"], ["file", "line"])
    return kept.select("sale_date", "file", "line", F.col("net").cast("double").alias("net"))


_SHOP_KEYS = ["product_name", "period_start", "period_end"]


def duplicate_keys(spark, folder):
    return quality.duplicate_keys(t.shop(spark, folder), _SHOP_KEYS)


def merge_overlapping(spark, folder):
    merged = quality.merge_overlapping(
        t.shop(spark, folder), _SHOP_KEYS, ["items_sold", "net_sales", "orders_count"], ["sku", "category", "series"], ["file", "line_no"]
    )
    return merged.withColumn("net_sales", F.col("net_sales").cast("double")).withColumn("sale_date", F.col("period_end"))


def table_integrity(spark, folder):
    return quality.table_integrity(
        {
            "sales": (t.sales(spark, folder), "royalty_amount_usd"),
            "reads": (t.reads(spark, folder), "royalty_amount_usd"),
            "memberships": (t.memberships(spark, folder), "net_earnings"),
            "shop": (t.shop(spark, folder), "net_sales"),
            "statements": (t.statements(spark, folder), "royalty_amount_usd"),
            "catalog": (t.catalog(spark, folder), None),
        }
    )


def value_distribution(spark, folder):
    return quality.value_distribution(t.statements(spark, folder), "distributor")


def load_profile(spark, folder):
    return quality.load_profile(t.sales(spark, folder, "region", "currency"), "source_platform", "region", "royalty_amount")


MATCHING = {
    "dim_catalog": dim_catalog,
    "identifier_crosswalk": identifier_crosswalk,
    "enrich_by_identifier": enrich_by_identifier,
    "staged_resolution": staged_resolution,
    "containment_match": containment_match,
    "fuzzy_title_match": fuzzy_title_match,
    "match_rate": match_rate,
    "fx_to_usd": fx_to_usd,
    "fx_coverage": fx_coverage,
    "pool_allocation": pool_allocation,
    "equivalent_copies": equivalent_copies,
    "reconcile_totals": reconcile_totals,
    "page_count_ratio": page_count_ratio,
    "dedupe_keep_first": dedupe_keep_first,
    "duplicate_keys": duplicate_keys,
    "merge_overlapping": merge_overlapping,
    "table_integrity": table_integrity,
    "value_distribution": value_distribution,
    "load_profile": load_profile,
}
