"""The plans we want: no pairwise joins, no Python outside similarity, pruned scans, checked broadcasts."""

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from ledgerloom.plans import stand_ins as t
from ledgerloom.sources.facts import read_fact, write_fact

FOLDER = "/root/testdata/sf0.001"
HEAVY = {"build_warehouse"}


def plan(df, kind="executedPlan"):
    return getattr(df._jdf.queryExecution(), kind)().toString()


@pytest.mark.parametrize("name", sorted(set(entry.QUERIES) - HEAVY))
def test_no_pairwise_join_and_no_python(spark, name):
    text = plan(entry.queries()[name](spark, FOLDER))
    assert "CartesianProduct" not in text
    assert "BroadcastNestedLoopJoin" not in text
    if name != "fuzzy_title_match":
        assert "Python" not in text


def test_monthly_revenue_reads_three_columns_of_one_table(spark):
    text = plan(entry.queries()["monthly_revenue"](spark, FOLDER))
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", text)
    assert len(schemas) == 1
    assert {c.split(":")[0] for c in schemas[0].split(",")} == {"l_quantity", "l_extendedprice", "l_discount", "l_shipdate"}


def test_dimension_joins_are_broadcast(spark):
    for name in ("enrich_by_identifier", "fx_to_usd", "normalize_wide_ebooks"):
        text = plan(entry.queries()[name](spark, FOLDER))
        assert "BroadcastHashJoin" in text


def test_top_per_series_is_cut_before_the_shuffle(spark):
    assert "WindowGroupLimit" in plan(entry.queries()["rank_in_series"](spark, FOLDER))


def test_top_n_does_not_sort_everything(spark):
    assert "TakeOrderedAndProject" in plan(entry.queries()["top_titles"](spark, FOLDER))


def test_fact_range_prunes_months(spark, tmp_path):
    path = str(tmp_path / "fact")
    sales = t.sales(spark, FOLDER)
    assert write_fact(sales, path) == sales.count()
    chosen = read_fact(spark, path, "1998-03-10", "1998-04-02")
    assert re.search(r"PartitionFilters: \[[^\]]*period", plan(chosen))
    day = F.col("sale_date")
    assert chosen.count() == sales.where((day >= "1998-03-10") & (day <= "1998-04-02")).count()


def test_dropping_rows_without_a_date_does_not_parse_dates_again(spark):
    from ledgerloom.operators.shape import drop_null_dates
    from ledgerloom.plans import layouts

    raw = spark.createDataFrame([("1/2/2025", "3"), ("Total", "4")], "`End Date` string, `Net Unit Sales` string")
    rows = drop_null_dates(layouts.standardize(raw, layouts.WIDE_EBOOKS))
    assert [str(r.sale_date) for r in rows.select("sale_date").collect()] == ["2025-01-02"]
    assert rows._jdf.queryExecution().optimizedPlan().toString().count("M/d/yyyy,") == 1
