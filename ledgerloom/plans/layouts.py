"""The report layouts as data: column names, types and defaults per channel.

One generic transform (:func:`standardize`) applies a layout; the chains in
:mod:`ledgerloom.plans.channels` add what is special to a channel.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.dates import MIXED_FORMATS, parse_date
from ledgerloom.functions.identifiers import normalize_isbn
from ledgerloom.functions.numbers import coerce_number
from ledgerloom.operators.shape import drop_columns, fill_default, rename_by_map
from ledgerloom.plans.lookups import PERSONAL_COLUMNS
from ledgerloom.scale import computed_once, in_small_methods

@dataclass(frozen=True)
class SourceSpec:
    """``rename`` maps report headers to names, ``None`` drops one; ``fact`` is the fact's schema as DDL."""

    platform: str
    fact: str
    rename: Mapping[str, str | None] = field(default_factory=dict)
    numbers: tuple[str, ...] = ()
    number_default: float | None = 0
    identifiers: Mapping[str, bool] = field(default_factory=dict)  # column -> strict form
    date_formats: tuple[str, ...] = MIXED_FORMATS
    defaults: Mapping[str, object] = field(default_factory=dict)


def standardize(raw: DataFrame, spec: SourceSpec) -> DataFrame:
    """Rename, drop personal columns, type numbers and dates, normalise ISBNs, fill defaults, tag the platform."""
    df = drop_columns(rename_by_map(in_small_methods(raw), spec.rename), PERSONAL_COLUMNS)
    typed = {n: coerce_number(F.col(n), spec.number_default) for n in spec.numbers if n in df.columns}
    typed |= {n: normalize_isbn(F.col(n), strict) for n, strict in spec.identifiers.items() if n in df.columns}
    if "sale_date" in df.columns and dict(df.dtypes)["sale_date"] == "string":
        # Chains drop rows without a date; behind the generator that filter does not parse every date once more.
        day = {"_day": parse_date(F.col("sale_date"), spec.date_formats)}
        df = computed_once(df, day).withColumn("sale_date", F.col("_day")).drop("_day")
    return fill_default(df.withColumns(typed), spec.defaults).withColumn("source_platform", F.lit(spec.platform))


_SALES = (
    "sale_date DATE, source_platform STRING, book_identifier STRING, canonical_work_slug STRING, series STRING, "
    "edition_format STRING, region STRING, currency STRING, quantity BIGINT, price DECIMAL(28,4), "
    "price_usd DECIMAL(28,4), royalty_amount DECIMAL(28,4), royalty_amount_usd DECIMAL(28,4), "
    "royalty_rate DECIMAL(28,4)"
)
# fixed values below: report headers, platform names and fact columns
AUDIO_MONTHLY = SourceSpec(
    platform="acx",
    fact=_SALES,
    rename={
        "Product ID": "book_identifier", "Title": "book_title", "Digital ISBN": "isbn", "Transaction Type": "transaction_type",
        "Marketplace": "region", "Currency": "currency", "Net Units": "quantity", "Net Sales": "price",
        "Net Royalties Earned": "royalty_amount", "Royalty Rate": "royalty_rate",
    },
    numbers=("quantity", "price", "royalty_amount", "royalty_rate"),
    number_default=None,
)

AUDIO_CROSSTAB = SourceSpec(platform="acx", fact=_SALES)

EBOOK_SALES = SourceSpec(
    platform="amazon_kdp",
    fact=_SALES,
    rename={
        "Royalty Date": "sale_date", "Title": "book_title", "ASIN/ISBN": "book_identifier", "Marketplace": "marketplace_raw",
        "Royalty Type": "royalty_type_raw", "Transaction Type": "transaction_type", "Net Units Sold": "quantity",
        "Avg. List Price without tax": "price", "Royalty": "royalty_amount", "Currency": "currency",
    },
    numbers=("quantity", "price", "royalty_amount"),
    number_default=None,
    date_formats=("yyyy-MM",),
)

PAGE_READS = SourceSpec(
    platform="amazon_kdp_ku",
    fact=(
        "sale_date DATE, source_platform STRING, book_identifier STRING, canonical_work_slug STRING, series STRING, "
        "edition_format STRING, marketplace STRING, region STRING, currency STRING, page_count BIGINT, "
        "rate_per_page DECIMAL(28,12), royalty_amount DECIMAL(28,4), royalty_amount_usd DECIMAL(28,4), "
        "kenp_page_count BIGINT, equivalent_copies DECIMAL(28,4)"
    ),
    rename={"Date": "sale_date", "eBook ASIN": "book_identifier", "Marketplace": "marketplace", "KENP": "page_count", "Title": "book_title"},
    numbers=("page_count",),
    date_formats=("yyyy-MM-dd",),
)

_MEMBERSHIP_AMOUNTS = {
    "Membership gross earnings - Web and Android": "gross_web_android",
    "Membership gross earnings - iOS app": "gross_ios",
    "Total gross earnings": "gross_total",
    "Patreon platform fees": "platform_fees",
    "Payment processing fees": "processing_fees",
    "Currency exchange fee": "exchange_fee",
    "iOS app fee": "ios_app_fee",
    "Merch costs (items + shipping)": "merch_costs",
    "Total payment processing fees": "total_processing_fees",
    "Refunds": "refunds",
    "Patreon adjustments": "adjustments",
    "Recovered payments": "recovered_payments",
    "Total net earnings": "net_earnings",
}
MEMBERSHIPS = SourceSpec(
    platform="patreon",
    fact=(
        "sale_date DATE, source_platform STRING, currency STRING, gross_web_android DECIMAL(28,4), gross_ios DECIMAL(28,4), "
        "gross_total DECIMAL(28,4), platform_fees DECIMAL(28,4), processing_fees DECIMAL(28,4), exchange_fee DECIMAL(28,4), "
        "ios_app_fee DECIMAL(28,4), merch_costs DECIMAL(28,4), total_processing_fees DECIMAL(28,4), refunds DECIMAL(28,4), "
        "adjustments DECIMAL(28,4), recovered_payments DECIMAL(28,4), net_earnings DECIMAL(28,4)"
    ),
    rename={"Month - successful transactions": "sale_date", "Currency": "currency", **_MEMBERSHIP_AMOUNTS},
    numbers=tuple(_MEMBERSHIP_AMOUNTS.values()),
    date_formats=("yyyy-MM",),
    defaults={"currency": "USD"},
)

SHOP = SourceSpec(
    platform="woocommerce",
    fact=(
        "sale_date DATE, period_start DATE, period_end DATE, source_platform STRING, product_name STRING, sku STRING, "
        "category STRING, items_sold BIGINT, net_sales DECIMAL(28,4), orders_count BIGINT, canonical_work_slug STRING, "
        "series STRING, edition_format STRING"
    ),
    rename={
        "Product title": "product_name", "SKU": "sku", "Items sold": "items_sold", "Net sales": "net_sales",
        "Orders": "orders_count", "Category": "category",
    },
    numbers=("items_sold", "net_sales", "orders_count"),
    defaults={"sku": ""},
)

STATEMENTS = SourceSpec(
    platform="audiobooks_unleashed",
    fact=(
        "sale_date DATE, source_platform STRING, book_isbn STRING, display_title STRING, distributor STRING, "
        "region_code STRING, quantity BIGINT, gross_local DECIMAL(28,4), received_local DECIMAL(28,4), "
        "fee_local DECIMAL(28,4), payable_local DECIMAL(28,4), royalty_rate_pct DECIMAL(28,4), "
        "royalty_amount_local DECIMAL(28,4), currency STRING, royalty_amount_usd DECIMAL(28,4), "
        "canonical_work_slug STRING, series STRING, edition_format STRING"
    ),
)

WIDE_EBOOKS = SourceSpec(
    platform="draft2digital",
    fact=(
        "sale_date DATE, source_platform STRING, book_identifier STRING, canonical_work_slug STRING, series STRING, "
        "edition_format STRING, distributor STRING, vendor STRING, country STRING, quantity BIGINT, "
        "units_returned BIGINT, list_price DECIMAL(28,4), offer_price DECIMAL(28,4), currency STRING, "
        "royalty_amount DECIMAL(28,4), royalty_amount_usd DECIMAL(28,4), royalty_rate DECIMAL(28,4), "
        "fee_per_unit DECIMAL(28,4)"
    ),
    rename={
        "Start Date": None, "End Date": "sale_date", "Title ID": None, "Ebook ISBN": "book_identifier", "Title": None,
        "Distributor": "distributor", "Vendor": "vendor", "Country": "country", "Units Sold": None,
        "Units Returned": "units_returned", "Net Unit Sales": "quantity", "Sales Model": None, "Retailer": None,
        "List Price Per Unit": "list_price", "Currency Code": "currency", "Offer Price Per Unit": "offer_price",
        "Royalty Percent": "royalty_rate", "Sales Channel Fee/Taxes Per Unit": "fee_per_unit",
        "Publisher Share": "royalty_amount", "Publisher Share USD (estimated)": None,
    },
    numbers=("quantity", "units_returned", "list_price", "offer_price", "royalty_rate", "fee_per_unit", "royalty_amount"),
    identifiers={"book_identifier": False},
    defaults={"currency": "USD"},
)

PRESS = SourceSpec(
    platform="barnes_noble",
    fact=(
        "sale_date DATE, source_platform STRING, book_identifier STRING, bn_identifier STRING, "
        "canonical_work_slug STRING, series STRING, edition_format STRING, title STRING, source_format STRING, "
        "list_price DECIMAL(28,4), sale_price DECIMAL(28,4), selling_currency STRING, payment_currency STRING, "
        "units_sold BIGINT, units_returned BIGINT, quantity BIGINT, royalty_rate DECIMAL(28,4), "
        "royalty_per_unit DECIMAL(28,4), royalty_amount DECIMAL(28,4), royalty_amount_usd DECIMAL(28,4)"
    ),
    rename={
        "Sale Date": "sale_date", "Title": "title", "Format": "source_format", "BN ID / ISBN": "bn_identifier",
        "eBook ISBN (Optional)": "book_identifier", "Author": None, "Publisher": None, "List Price": "list_price",
        "Sale Price": "sale_price", "Selling Currency": "selling_currency", "Units Sold": "units_sold",
        "Units Returned": "units_returned", "Net Units Sold": "quantity", "Royalty %": "royalty_rate",
        "Royalty per Unit": "royalty_per_unit", "Total Royalty": "royalty_amount", "Payment Currency": "payment_currency",
    },
    numbers=(
        "list_price", "sale_price", "quantity", "units_sold", "units_returned", "royalty_rate", "royalty_per_unit", "royalty_amount"
    ),
    identifiers={"book_identifier": True, "bn_identifier": True},
    defaults={"selling_currency": "USD", "payment_currency": "USD"},
)

STORE_INVOICES = SourceSpec(
    platform="kobo_store",
    fact=(
        "sale_date DATE, source_platform STRING, book_identifier STRING, canonical_work_slug STRING, series STRING, "
        "edition_format STRING, country STRING, state STRING, zip_code STRING, content_type STRING, imprint STRING, "
        "title STRING, quantity BIGINT, refund_reason STRING, deal_id STRING, list_price DECIMAL(28,4), "
        "tax_excluded_list_price DECIMAL(28,4), cogs_percentage DECIMAL(28,4), cogs_amount_lp DECIMAL(28,4), "
        "lp_currency STRING, fx_rate DECIMAL(28,4), cogs_payable DECIMAL(28,4), cogs_based_lp DECIMAL(28,4), "
        "cogs_based_lp_excl_tax DECIMAL(28,4), cogs_based_lp_currency STRING, cogs_adjustment DECIMAL(28,4), "
        "currency STRING, royalty_amount DECIMAL(28,4), royalty_amount_usd DECIMAL(28,4), total_tax DECIMAL(28,4)"
    ),
    rename={
        "Date": "sale_date", "Country": "country", "State": "state", "Zip Code": "zip_code", "Content Type": "content_type",
        "Total Qty": "quantity", "Refund Reason": "refund_reason", "DealID": "deal_id", "Publisher Name": None,
        "Imprint": "imprint", "eISBN": "book_identifier", "Author": None, "Title": "title", "List Price": "list_price",
        "Tax Excluded List Price": "tax_excluded_list_price", "COGS %": "cogs_percentage",
        "COGS Amount (LP Currency)": "cogs_amount_lp", "LP Currency": "lp_currency",
        "Foreign Exchange Rate to Payable Currency": "fx_rate", "COGS (Payable Currency)": "cogs_payable",
        "COGS based LP": "cogs_based_lp", "COGS based LP excluding tax": "cogs_based_lp_excl_tax",
        "COGS based LP Currency": "cogs_based_lp_currency", "COGS Adjustment (Payable Currency)": "cogs_adjustment",
        "Net Due (Payable Currency)": "royalty_amount", "Payable Currency": "currency",
        "Total Tax (Payable Currency)": "total_tax",
    },
    numbers=(
        "quantity", "list_price", "tax_excluded_list_price", "cogs_percentage", "cogs_amount_lp", "fx_rate", "cogs_payable",
        "cogs_based_lp", "cogs_based_lp_excl_tax", "cogs_adjustment", "royalty_amount", "total_tax",
    ),
    identifiers={"book_identifier": False},
    defaults={"currency": "USD"},
)

SUBSCRIPTION_READS = SourceSpec(
    platform="kobo_plus",
    fact=(
        "sale_date DATE, source_platform STRING, book_identifier STRING, canonical_work_slug STRING, series STRING, "
        "edition_format STRING, region STRING, content_type STRING, title STRING, list_price_tax_in DECIMAL(28,4), "
        "list_price_tax_out DECIMAL(28,4), list_price_currency STRING, read_threshold_pct DECIMAL(28,4), "
        "quantity BIGINT, total_payable_raw DECIMAL(28,4), fx_rate DECIMAL(28,4), "
        "total_payable_converted DECIMAL(28,4), currency STRING, value_per_minute DECIMAL(28,4), "
        "total_minutes DECIMAL(28,4), revenue_per_title DECIMAL(28,4), royalty_rate DECIMAL(28,4), "
        "royalty_amount DECIMAL(28,4), royalty_amount_usd DECIMAL(28,4), total_tax DECIMAL(28,4)"
    ),
    rename={
        "Read Period": "sale_date", "Publisher name": None, "eISBN": "book_identifier", "Author": None, "Title": "title",
        "List price (TaxIn)": "list_price_tax_in", "List price (TaxOut)": "list_price_tax_out",
        "List price currency": "list_price_currency", "Region": "region", "Read threshold (%)": "read_threshold_pct",
        "Reads": "quantity", "Total payable": "total_payable_raw", "Foreign exchange to payable currency": "fx_rate",
        "Total in payable currency": "total_payable_converted", "Payable Currency": "currency",
        "Value Per Minute": "value_per_minute", "Total Minutes": "total_minutes",
        "Revenue earned per title": "revenue_per_title", "Publisher revenue share (%)": "royalty_rate",
        "Total publisher revenue share in payable currency ($)": "royalty_amount",
        "Total Tax in Payable Currency": "total_tax", "Content Type": "content_type",
    },
    numbers=(
        "list_price_tax_in", "list_price_tax_out", "read_threshold_pct", "quantity", "total_payable_raw", "fx_rate",
        "total_payable_converted", "value_per_minute", "total_minutes", "revenue_per_title", "royalty_rate", "royalty_amount",
        "total_tax",
    ),
    identifiers={"book_identifier": False},
    defaults={"currency": "USD"},
)

# Measures keep their header in lower case; only these get another name.
_PRINT_RENAMED = {
    "isbn_13": "book_identifier", "isbn": "isbn_legacy", "binding_type": "binding_type_raw", "market": "market_raw",
    "returns_flag_value": "returns_flag", "title_status_flag_value": "title_status_flag",
    "wholesale_discount_%": "wholesale_discount_pct", "MTD_avg_discount_%": "mtd_avg_discount_pct",
    "MTD_net_quantity": "quantity", "MTD_pub_comp": "royalty_amount", "reporting_currency_code": "currency",
}
_PRINT_AMOUNTS = (
    "list_price", "wholesale_discount_pct", "quantity", "mtd_avg_list_price", "mtd_extended_list", "mtd_avg_discount_pct",
    "mtd_extended_discount", "mtd_avg_wholesale_price", "mtd_extended_wholesale", "mtd_avg_print_charge",
    "mtd_extended_print_charge", "mtd_gross_pub_comp", "mtd_extended_adjustments", "mtd_extended_recovery",
    "royalty_amount", "mtd_return_quantity", "mtd_return_wholesale", "mtd_return_charge", "mtd_return_total",
    "mtd_net_wholesale", "mtd_net_pub_comp", "mtd_wholesale_tax", "mtd_print_charge_tax", "mtd_return_wholesale_tax",
    "mtd_return_charge_tax", "mtd_global_distribution_fee", "mtd_global_distribution_fee_tax",
)
PRINT_DROPPED = (
    "publisher_number", "publisher_name", "author", "sku", "cancelled_date", "nonreturnable_date", "deferral_balance",
    "original_deferral_amount", *[f"customer_flexfield{i}" for i in range(1, 6)],
)
PRINT_HEADERS = (
    "isbn_13", "isbn", "title", "publisher_imprint", "binding_type", "book_type_id", "page_count", "sales_category", "market",
    "parent_isbn", "period_name", "returns_flag_value", "title_status_flag_value", "list_price", "wholesale_discount_%",
    "MTD_avg_discount_%", "MTD_net_quantity", "MTD_pub_comp", "YTD_net_quantity", "YTD_pub_comp", "reporting_currency_code",
    *PRINT_DROPPED, *[c for c in _PRINT_AMOUNTS if c.startswith("mtd_")],
    *[c.replace("mtd_", "YTD_") for c in _PRINT_AMOUNTS if c.startswith("mtd_")],
)
PRINT = SourceSpec(
    platform="ingram_spark",
    fact=(
        "sale_date DATE, source_platform STRING, book_identifier STRING, canonical_work_slug STRING, series STRING, "
        "edition_format STRING, country STRING, title STRING, publisher_imprint STRING, binding_type_raw STRING, "
        "book_type_id STRING, page_count BIGINT, sales_category STRING, returns_flag STRING, title_status_flag STRING, "
        "parent_isbn STRING, list_price DECIMAL(28,4), wholesale_discount_pct DECIMAL(28,4), quantity BIGINT, "
        "mtd_avg_list_price DECIMAL(28,4), mtd_extended_list DECIMAL(28,4), mtd_avg_discount_pct DECIMAL(28,4), "
        "mtd_extended_discount DECIMAL(28,4), mtd_avg_wholesale_price DECIMAL(28,4), "
        "mtd_extended_wholesale DECIMAL(28,4), mtd_avg_print_charge DECIMAL(28,4), "
        "mtd_extended_print_charge DECIMAL(28,4), mtd_gross_pub_comp DECIMAL(28,4), "
        "mtd_extended_adjustments DECIMAL(28,4), mtd_extended_recovery DECIMAL(28,4), royalty_amount DECIMAL(28,4), "
        "mtd_return_quantity DECIMAL(28,4), mtd_return_wholesale DECIMAL(28,4), mtd_return_charge DECIMAL(28,4), "
        "mtd_return_total DECIMAL(28,4), mtd_net_wholesale DECIMAL(28,4), mtd_net_pub_comp DECIMAL(28,4), "
        "mtd_wholesale_tax DECIMAL(28,4), mtd_print_charge_tax DECIMAL(28,4), mtd_return_wholesale_tax DECIMAL(28,4), "
        "mtd_return_charge_tax DECIMAL(28,4), mtd_global_distribution_fee DECIMAL(28,4), "
        "mtd_global_distribution_fee_tax DECIMAL(28,4), currency STRING, royalty_amount_usd DECIMAL(28,4)"
    ),
    rename=_PRINT_RENAMED,
    numbers=("page_count", *_PRINT_AMOUNTS),
    defaults={"currency": "USD"},
)
