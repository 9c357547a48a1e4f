"""Fact, dimension and rate tables derived from the driver's star schema.

Each function takes ``(spark, folder)``.  Joins are only added for the columns asked for, so a
query that needs no product attribute never reads ``part``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.operators.shape import channel_by_pattern, union_all
from ledgerloom.scale import broadcast_if_small

_PART = {"canonical_work_slug", "series", "edition_format", "book_identifier", "kenp_page_count", "display_title"}
_NATION = {"region", "currency"}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def amount(col: str, type_: str = "decimal(18,2)"):
    return F.col(col).cast(type_)


def royalty():
    """Line revenue after discount, DECIMAL(18,4)."""
    return (amount("l_extendedprice") * (F.lit(1) - amount("l_discount", "decimal(4,2)"))).cast("decimal(18,4)")


def catalog(spark: SparkSession, folder: str) -> DataFrame:
    """Product catalog: one row per edition, all text, plus its row order."""
    key = F.lpad(F.col("p_partkey").cast("string"), 10, "0")
    brand = F.replace(F.lower("p_brand"), F.lit("brand#"), F.lit(""))
    return table(spark, folder, "part").select(
        F.nullif("p_brand", F.lit("Brand#5")).alias("series"),
        F.concat(F.replace("p_name", F.lit(" "), F.lit("_")), F.lit("_"), brand).alias("canonical_work_slug"),
        F.concat(F.initcap("p_name"), F.lit(" & "), F.col("p_brand")).alias("display_title"),
        F.lower("p_type").alias("edition_format"),
        F.col("p_size").cast("string").alias("kenp_page_count"),
        F.when(F.col("p_type") != "PROMO", F.concat(F.lit("B"), F.substring(key, 2, 9))).alias("asin"),
        F.when(F.col("p_type") != "ECONOMY", key).alias("isbn_10"),
        F.concat_ws("-", F.lit("978"), F.substring(key, 1, 1), F.substring(key, 2, 6), F.substring(key, 8, 3)).alias(
            "isbn_13"
        ),
        F.when(F.col("p_type") == "SMALL", F.concat(F.lit("ax"), F.col("p_size").cast("string"))).alias("other_id"),
        F.col("p_partkey").alias("catalog_order"),
    )


def currency_of(region_key):
    """Currency by sales region."""
    names = F.array(*[F.lit(c) for c in ("USD", "EUR", "GBP", "JPY", "CAD")])
    return F.try_element_at(names, region_key + 1)


def suppliers(spark: SparkSession, folder: str) -> DataFrame:
    """Suppliers with nation, region and currency, broadcast when counted small.

    Spark multiplies the sizes of joined inputs, so without the count this small side would look
    larger than the facts and the facts would be the ones to move.
    """
    nation = table(spark, folder, "nation").select(
        F.col("n_nationkey").alias("s_nationkey"), "n_name", F.col("n_regionkey").alias("region_no"),
        currency_of(F.col("n_regionkey")).alias("currency"),
    )
    all_suppliers = table(spark, folder, "supplier")
    placed = all_suppliers.join(F.broadcast(nation), "s_nationkey").select(
        F.col("s_suppkey").alias("l_suppkey"), F.col("s_nationkey").alias("nation_no"), "s_name", "n_name", "region_no", "currency"
    )
    return broadcast_if_small(placed, counted=all_suppliers)


def sales(spark: SparkSession, folder: str, *extra: str) -> DataFrame:
    """Sales lines; ``extra`` names the product, region or currency columns wanted."""
    unknown = set(extra) - _PART - _NATION - {"l_partkey"}
    if unknown:
        raise ValueError(f"unknown columns: {sorted(unknown)}")
    lines = table(spark, folder, "lineitem")
    flag = F.col("l_returnflag")
    platform = F.when(flag == "A", "Audio_Store").when(flag == "N", "book_store").otherwise("book_store_legacy")
    lines = lines.select(
        "l_partkey",
        "l_suppkey",
        F.col("l_shipdate").cast("date").alias("sale_date"),
        platform.alias("source_platform"),
        F.col("l_quantity").cast("bigint").alias("quantity"),
        amount("l_extendedprice").alias("price"),
        royalty().alias("royalty_amount"),
        royalty().alias("royalty_amount_usd"),
        amount("l_discount", "decimal(4,2)").alias("royalty_rate"),
    )
    if _PART & set(extra):
        products = catalog(spark, folder).withColumn("book_identifier", F.col("isbn_13"))
        wanted = [c for c in products.columns if c in extra]
        lines = lines.join(products.select(F.col("catalog_order").alias("l_partkey"), *wanted), "l_partkey")
    if _NATION & set(extra):
        lines = lines.join(suppliers(spark, folder), "l_suppkey").withColumnRenamed("n_name", "region")
        lines = lines.drop("nation_no", "s_name", "region_no", *(_NATION - set(extra)))
    keep = [c for c in lines.columns if c != "l_suppkey" and (c != "l_partkey" or "l_partkey" in extra)]
    return lines.select(*keep)


def reads(spark: SparkSession, folder: str) -> DataFrame:
    """Page reads: returned lines, pages by quantity, the part size as the book's page count."""
    lines = table(spark, folder, "lineitem").where(F.col("l_returnflag") == "R")
    sizes = table(spark, folder, "part").select(F.col("p_partkey").alias("l_partkey"), "p_size")
    return lines.join(sizes, "l_partkey", "left").select(
        F.col("l_shipdate").cast("date").alias("sale_date"),
        F.col("l_quantity").cast("bigint").alias("page_count"),
        F.when(F.col("l_linestatus") == "F", royalty()).otherwise(F.lit(0)).cast("decimal(18,4)").alias(
            "royalty_amount_usd"
        ),
        F.col("p_size").alias("kenp_page_count"),
        equivalent(F.col("l_quantity"), F.col("p_size")).alias("equivalent_copies"),
    )


def equivalent(pages, page_count):
    whole = F.coalesce(page_count, F.lit(1)).cast("decimal(10,0)")
    return F.round(pages.cast("decimal(18,0)") / whole, 2).cast("decimal(18,2)")


def memberships(spark: SparkSession, folder: str) -> DataFrame:
    """Monthly membership income: order totals less a five percent fee."""
    months = table(spark, folder, "orders").groupBy(F.trunc(F.col("o_orderdate").cast("date"), "MM").alias("sale_date"))
    totals = months.agg(F.sum(amount("o_totalprice")).alias("gross"))
    fee = F.round(F.col("gross") * F.lit(0.05).cast("decimal(4,2)"), 2)
    return totals.select(
        "sale_date",
        F.lit("USD").alias("currency"),
        F.col("gross").cast("decimal(28,2)").alias("gross_total"),
        fee.cast("decimal(28,2)").alias("platform_fees"),
        (F.col("gross") - fee).cast("decimal(28,2)").alias("net_earnings"),
    )


def shop(spark: SparkSession, folder: str) -> DataFrame:
    """Web shop exports: one row per order, the export file being the order status.

    Customers without a matching part bought merchandise.
    """
    orders = table(spark, folder, "orders")
    parts = table(spark, folder, "part").select(F.col("p_partkey").alias("o_custkey"), "p_name", "p_brand")
    day = F.col("o_orderdate").cast("date")
    return orders.join(parts, "o_custkey", "left").select(
        F.col("o_orderkey").alias("line_no"),
        F.col("o_orderstatus").alias("file"),
        F.coalesce(
            F.concat(F.initcap("p_name"), F.lit(" Tote")), F.concat(F.lit("Gift Card "), F.substring("o_orderpriority", 1, 1))
        ).alias("product_name"),
        F.when(F.col("o_orderstatus") != "O", F.concat(F.lit("sku-"), F.col("o_custkey").cast("string"))).alias("sku"),
        F.substring_index("o_orderpriority", "-", -1).alias("category"),
        F.trunc(day, "MM").alias("period_start"),
        F.last_day(day).alias("period_end"),
        F.last_day(day).alias("sale_date"),
        F.substring("o_orderpriority", 1, 1).cast("bigint").alias("items_sold"),
        amount("o_totalprice").cast("decimal(18,4)").alias("net_sales"),
        F.lit(1).cast("bigint").alias("orders_count"),
        F.nullif("p_brand", F.lit("Brand#5")).alias("series"),
    )


def statements(spark: SparkSession, folder: str) -> DataFrame:
    """Audiobook statement lines; every supplier of nation 7 is a distributor without a name."""
    lines = table(spark, folder, "lineitem")
    named = F.when(F.col("nation_no") != 7, F.replace("s_name", F.lit("#"), F.lit(" No")))
    rate = F.lit(0.25).cast("decimal(4,2)")
    return lines.join(suppliers(spark, folder), "l_suppkey").select(
        F.col("l_shipdate").cast("date").alias("sale_date"),
        named.alias("distributor"),
        F.col("l_quantity").cast("bigint").alias("quantity"),
        amount("l_extendedprice").alias("gross_local"),
        (royalty() * rate).cast("decimal(18,4)").alias("royalty_amount_usd"),
    )


def fx_rates(spark: SparkSession, folder: str) -> DataFrame:
    """Rates per euro on business days of the shipping calendar, without June and July 1998."""
    span = table(spark, folder, "lineitem").agg(
        F.min(F.col("l_shipdate").cast("date")).alias("first"), F.max(F.col("l_shipdate").cast("date")).alias("final")
    )
    days = span.select(F.explode(F.sequence("first", "final")).alias("rate_date"))
    open_days = days.where(
        (F.weekday("rate_date") < 5) & ~F.col("rate_date").between(F.lit("1998-06-01"), F.lit("1998-07-31"))
    )
    step = F.pmod(F.date_diff("rate_date", F.lit("1970-01-01").cast("date")), F.lit(97))
    quotes = F.array(
        *[
            F.struct(F.lit(code).alias("currency"), (F.lit(base) + step * F.lit(tick)).alias("units"))
            for code, base, tick in (("USD", 11000, 7), ("GBP", 8500, 5), ("JPY", 1300000, 1100), ("CAD", 14500, 9))
        ]
    )
    return open_days.select("rate_date", F.inline(quotes)).select(
        "rate_date", "currency", (F.col("units") / F.lit(10000)).cast("decimal(18,8)").alias("per_eur")
    )


def revenue_events(spark: SparkSession, folder: str, earned_reads_only: bool = True) -> DataFrame:
    """One view of all revenue: fact, channel, sale_date, revenue, units, distributor."""
    source = F.col("source_platform")

    def event(df: DataFrame, fact: str, channel, revenue: str, units, distributor=None) -> DataFrame:
        return df.select(
            F.lit(fact).alias("fact"),
            channel.alias("channel"),
            "sale_date",
            F.col(revenue).cast("decimal(28,4)").alias("revenue"),
            units.cast("decimal(18,2)").alias("units"),
            (distributor if distributor is not None else F.lit(None).cast("string")).alias("distributor"),
        )

    page_reads = reads(spark, folder)
    if earned_reads_only:
        page_reads = page_reads.where(F.col("royalty_amount_usd") > 0)
    split = channel_by_pattern(source, "%audio%", "audio_store", "book_store")
    return union_all(
        [
            event(sales(spark, folder), "sales", split, "royalty_amount_usd", F.col("quantity")),
            event(page_reads, "reads", F.lit("page_reads"), "royalty_amount_usd", F.col("equivalent_copies")),
            event(memberships(spark, folder), "memberships", F.lit("memberships"), "net_earnings", F.lit(0)),
            event(shop(spark, folder), "shop", F.lit("web_shop"), "net_sales", F.col("items_sold")),
            event(
                statements(spark, folder),
                "statements",
                F.lit("wide_audio"),
                "royalty_amount_usd",
                F.col("quantity"),
                F.col("distributor"),
            ),
        ]
    )
