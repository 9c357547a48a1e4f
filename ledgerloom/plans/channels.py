"""Raw report to fact table, one chain per channel, and the warehouse build.

Raw frames are all text.  ``catalog`` and ``rates`` are shared by all channels.
"""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.dates import parse_date, parse_period_name
from ledgerloom.functions.identifiers import first_identifier
from ledgerloom.functions.numbers import NUMBER, percent_to_fraction
from ledgerloom.functions.text import blank_to_null, clean_market, classify_binding, infer_edition, strip, unwrap_formula
from ledgerloom.operators import pool, shape, statements
from ledgerloom.operators.fx import to_usd
from ledgerloom.operators.quality import dedupe_keep_first, merge_overlapping, table_integrity
from ledgerloom.operators.resolve import (
    MATCHED,
    build_dimension,
    containment_match,
    enrich,
    fuzzy_title_match,
    staged_resolution,
)
from ledgerloom.operators.shape import drop_null_dates, to_target
from ledgerloom.plans import layouts
from ledgerloom.plans.layouts import SourceSpec, standardize
from ledgerloom.plans.lookups import CROSSTAB_REGIONS, MARKETPLACE_CURRENCY, MARKETPLACE_REGION, SUMMARY_CURRENCIES
from ledgerloom.scale import at_once, computed_once, durable, in_small_methods, join_dimension
from ledgerloom.sources.facts import read_fact, write_dimension, write_fact
from ledgerloom.sources.filenames import with_period

ROYALTY_USD = {"royalty_amount": "royalty_amount_usd"}
SALES_USD = {**ROYALTY_USD, "price": "price_usd"}


def normalize_audio_monthly(raw: DataFrame, catalog: DataFrame, rates: DataFrame) -> DataFrame:
    """Monthly audio sales; the month comes from ``file_name``."""
    cells = [c for c in raw.columns if c not in ("file_name", "line_no")]
    dated = with_period(in_small_methods(shape.drop_blank_rows(raw, cells)), "sale_date")
    rows = standardize(drop_null_dates(dated), layouts.AUDIO_MONTHLY)
    resolved = shape.fill_default(staged_resolution(rows, catalog), {"currency": "USD"})
    return to_target(to_usd(resolved, SALES_USD, rates), layouts.AUDIO_MONTHLY.fact)


def normalize_audio_crosstab(raw: DataFrame, catalog: DataFrame, rates: DataFrame) -> DataFrame:
    """Old audio reports: regions across, one subtotal row per book; no titles, units or currency."""
    dated = with_period(in_small_methods(raw.where(F.col("Customer Type") == "Subtotal")), "sale_date")
    subtotals = shape.select_subtotals(dated, "Customer Type", "Royalty Earner")
    long = shape.unpivot_crosstab(drop_null_dates(subtotals), ["book_identifier", "sale_date"], CROSSTAB_REGIONS)
    rows = standardize(long, layouts.AUDIO_CROSSTAB).withColumn("currency", F.lit("USD"))
    return to_target(to_usd(enrich(rows, "book_identifier", catalog), ROYALTY_USD, rates), layouts.AUDIO_CROSSTAB.fact)


def normalize_ebook_sales(raw: DataFrame, catalog: DataFrame, rates: DataFrame) -> DataFrame:
    rows = standardize(raw, layouts.EBOOK_SALES).withColumns(
        {
            "region": shape.map_codes(F.col("marketplace_raw"), MARKETPLACE_REGION),
            "royalty_rate": percent_to_fraction(F.col("royalty_type_raw")),
        }
    )
    resolved = shape.fill_default(staged_resolution(drop_null_dates(rows), catalog), {"currency": "USD"})
    return to_target(to_usd(resolved, SALES_USD, rates), layouts.EBOOK_SALES.fact)


def normalize_page_reads(
    raw: DataFrame, summary: DataFrame, detail: DataFrame, catalog: DataFrame, rates: DataFrame
) -> DataFrame:
    """Page reads with the royalty of their pool: monthly summary less detailed sales, shared by page.

    ``summary`` has ``Date`` (``March 2025``) and one royalty column per currency; ``detail`` has
    ``Royalty Date``, ``Currency`` and ``Royalty``.
    """
    spec = layouts.PAGE_READS
    market = F.col("marketplace")
    reads = drop_null_dates(standardize(raw, spec)).withColumns(
        {
            "currency": shape.map_codes(market, MARKETPLACE_CURRENCY),
            "region": shape.map_codes(market, MARKETPLACE_REGION),
            "page_count": F.col("page_count").cast("bigint"),
        }
    )
    months = summary.withColumn("month", parse_date(F.col("Date"), ("MMMM yyyy",)))
    spent = detail.select(
        parse_date(F.col("Royalty Date"), ("yyyy-MM",)).alias("month"),
        F.col("Currency").alias("currency"),
        F.col("Royalty").try_cast(NUMBER).alias("royalty"),
    )
    paid = pool.allocate_pool(pool.unpivot_summary(months, SUMMARY_CURRENCIES), spent, reads)
    titled = paid if "book_title" in paid.columns else paid.withColumn("book_title", F.lit(None).cast("string"))
    sizes = enrich(titled, "book_identifier", catalog, attributes=("canonical_work_slug", "kenp_page_count"))
    resolved = staged_resolution(sizes.drop("canonical_work_slug"), catalog)
    rows = to_usd(resolved, ROYALTY_USD, rates).withColumns(
        {
            "edition_format": infer_edition(F.col("edition_format")),
            "equivalent_copies": pool.equivalent_copies(F.col("page_count"), F.col("kenp_page_count")),
            "kenp_page_count": F.coalesce(F.col("kenp_page_count").try_cast("int"), F.lit(1)),
        }
    )
    return to_target(rows, spec.fact)


def normalize_memberships(raw: DataFrame) -> DataFrame:
    """Monthly membership income; of months in several exports the first (``file_name``, ``line_no``) counts."""
    rows = drop_null_dates(standardize(raw, layouts.MEMBERSHIPS))
    return to_target(dedupe_keep_first(rows, ["sale_date"], ["file_name", "line_no"]), layouts.MEMBERSHIPS.fact)


def normalize_shop(raw: DataFrame, catalog: DataFrame) -> DataFrame:
    """Web shop products per export period: identifier, contained title, similar title, then overlaps merged.

    Exports whose name tells no period are left out.  Amounts are in dollars already.
    """
    spec = layouts.SHOP
    rows = standardize(with_period(raw, "period_start", "period_end"), spec)
    rows = rows.where(F.col("period_start").isNotNull()).withColumn("sku", strip(F.col("sku")))

    # All three stages look at distinct names, so the facts are joined once.
    names = enrich(rows.select("product_name").distinct(), "product_name", catalog)
    unmatched = F.col("series").isNull()
    names = durable(names)
    contained = containment_match(names.where(unmatched), catalog).select(
        "product_name", *[F.col(c).alias(f"in_{c}") for c in MATCHED]
    )
    names = durable(names.join(contained, "product_name", "left"))
    still_open = unmatched & F.col("in_series").isNull()
    similar = fuzzy_title_match(names.where(still_open), catalog, "product_name").where(F.col("series").isNotNull())
    similar = similar.select("product_name", *[F.col(c).alias(f"like_{c}") for c in MATCHED])
    matched = names.join(similar, "product_name", "left").select(
        F.col("product_name").alias("_name"),
        *[F.coalesce(f"like_{c}", f"in_{c}", c).alias(c) for c in MATCHED],
    )
    joined = join_dimension(rows, durable(matched), "_name", F.col("product_name")).drop("_name")
    merged = merge_overlapping(
        joined,
        ["product_name", "period_start", "period_end"],
        ["items_sold", "net_sales", "orders_count"],
        ["source_platform", "sku", "category", *MATCHED],
        ["file_name", "line_no"],
    )
    return to_target(merged.withColumn("sale_date", F.col("period_end")), spec.fact)


def normalize_statements(lines: DataFrame, catalog: DataFrame, rates: DataFrame) -> DataFrame:
    """Audiobook statements from text lines; each row is converted with its own currency."""
    spec = layouts.STATEMENTS
    found = statements.section_context(lines).withColumnRenamed("sale_date", "_day")
    # Behind the generator the filter on the date does not cut and parse every line once more.
    dated = computed_once(found, {"sale_date": F.col("_day")}).drop("_day")
    rows = standardize(drop_null_dates(dated), spec)
    known = enrich(rows, "book_isbn", catalog).withColumn("edition_format", F.lit("audiobook"))
    usd = to_usd(known, {"royalty_amount_local": "_usd"}, rates)
    # Dollars pass unrounded.
    own = F.when(F.col("currency") == "USD", F.col("royalty_amount_local")).otherwise(F.col("_usd"))
    return to_target(usd.withColumn("royalty_amount_usd", own), spec.fact)


def _by_isbn(
    raw: DataFrame, spec: SourceSpec, catalog: DataFrame, rates: DataFrame, source_label: str | None = None, currency: str = "currency"
) -> DataFrame:
    """The chain the ISBN based channels share."""
    rows = enrich(drop_null_dates(standardize(raw, spec)), "book_identifier", catalog)
    label = F.col(source_label) if source_label else None
    rows = rows.withColumn("edition_format", infer_edition(F.col("edition_format"), label))
    return to_target(to_usd(rows, ROYALTY_USD, rates, currency=currency), spec.fact)


def normalize_wide_ebooks(raw: DataFrame, catalog: DataFrame, rates: DataFrame) -> DataFrame:
    """Wide ebook distribution; the report's own dollar estimate is not used."""
    return _by_isbn(raw, layouts.WIDE_EBOOKS, catalog, rates)


def normalize_press(raw: DataFrame, catalog: DataFrame, rates: DataFrame) -> DataFrame:
    """Press sales with spreadsheet-wrapped cells; royalties are in the payment currency."""
    spec = layouts.PRESS
    renamed = shape.rename_by_map(raw, spec.rename)
    wrapped = [c for c in ("title", "source_format", "bn_identifier", "book_identifier") if c in renamed.columns]
    plain = renamed.withColumns({c: unwrap_formula(F.col(c)) for c in wrapped})
    return _by_isbn(plain, spec, catalog, rates, source_label="source_format", currency="payment_currency")


def normalize_store_invoices(raw: DataFrame, catalog: DataFrame, rates: DataFrame) -> DataFrame:
    """Store invoices; refunds are negative lines."""
    return _by_isbn(raw, layouts.STORE_INVOICES, catalog, rates)


def normalize_subscription_reads(raw: DataFrame, catalog: DataFrame, rates: DataFrame) -> DataFrame:
    return _by_isbn(raw, layouts.SUBSCRIPTION_READS, catalog, rates)


def normalize_print(raw: DataFrame, catalog: DataFrame, rates: DataFrame) -> DataFrame:
    """Print compensation: month-to-date measures only, the report's own binding as format."""
    spec = layouts.PRINT
    kept = shape.drop_columns(raw, layouts.PRINT_DROPPED, prefixes=["YTD_"])
    kept = shape.rename_by_map(kept, {c.strip(): spec.rename.get(c.strip(), c.strip().lower()) for c in kept.columns})
    isbn = "book_identifier" if "book_identifier" in kept.columns else "isbn_legacy"
    dated = computed_once(standardize(kept, spec).drop("sale_date"), {"sale_date": parse_period_name(F.col("period_name"))})
    rows = drop_null_dates(
        dated.withColumns(
            {
                "book_identifier": first_identifier(F.col(isbn)),
                "binding": classify_binding(F.col("binding_type_raw")),
                "country": clean_market(F.col("market_raw")),
                "currency": F.coalesce(blank_to_null(F.col("currency")), F.lit("USD")),
            }
        )
    )
    known = enrich(rows, "book_identifier", catalog).withColumn("edition_format", F.col("binding"))
    return to_target(to_usd(known, ROYALTY_USD, rates), spec.fact)


def build_warehouse(facts: dict[str, DataFrame], catalog: DataFrame, path: str) -> DataFrame:
    """Write every fact by month and the product dimension, then report rows and totals per table.

    Every run rebuilds the tables it is given.
    """
    measures = {"fact_memberships": "net_earnings", "fact_shop": "net_sales"}
    spark = catalog.sparkSession
    at_once({name: partial(write_fact, fact, f"{path}/{name}") for name, fact in facts.items()})
    write_dimension(build_dimension(catalog), f"{path}/dim_catalog")
    written = {n: (read_fact(spark, f"{path}/{n}"), measures.get(n, "royalty_amount_usd")) for n in facts}
    written["dim_catalog"] = (spark.read.parquet(f"{path}/dim_catalog"), None)
    return table_integrity(written)
