"""Fact tables: an empty load must not touch what is stored."""

import datetime

from pyspark.sql import functions as F

from ledgerloom.sources.facts import read_fact, write_fact


def test_empty_over_full(spark, tmp_path):
    rows = spark.createDataFrame(
        [(datetime.date(2024, 1, 5), 1), (datetime.date(2024, 1, 5), 1), (datetime.date(2024, 2, 1), 2)],
        "sale_date date, units int",
    )
    path = str(tmp_path / "fact")
    assert write_fact(rows, path) == 3
    assert write_fact(rows.limit(0), path) == 0
    assert read_fact(spark, path).count() == 3
    assert read_fact(spark, path, start="2024-02-01").count() == 1


def test_a_hot_month_of_equal_rows_is_split(spark, tmp_path):
    day = F.lit("2024-03-05").cast("date")
    rows = spark.range(200_000, numPartitions=8).select(day.alias("sale_date"), F.lit("x" * 20).alias("title"))
    path = str(tmp_path / "hot")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "16k")
    try:
        assert write_fact(rows, path) == 200_000
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    assert len(list((tmp_path / "hot" / "period=2024-03").glob("*.parquet"))) > 1
    assert read_fact(spark, path).count() == 200_000


def test_a_new_fact_makes_its_rows_once(spark, tmp_path):
    seen = spark.sparkContext.accumulator(0)

    def made(i):
        seen.add(1)
        return (datetime.date(2024, 1 + i % 3, 5), i)

    rows = spark.createDataFrame(spark.sparkContext.parallelize(range(40), 2).map(made), "sale_date date, units int")
    path = str(tmp_path / "once")
    assert write_fact(rows.repartition(4, "units"), path) == 40
    assert seen.value == 40
    assert read_fact(spark, path).count() == 40


def test_an_empty_new_fact_has_no_rows_and_can_be_written_later(spark, tmp_path):
    rows = spark.createDataFrame([(datetime.date(2024, 1, 5), 1)], "sale_date date, units int")
    path = str(tmp_path / "late")
    assert write_fact(rows.limit(0), path) == 0
    assert write_fact(rows.where("units > 5").groupBy("sale_date").count(), path) == 0
    assert write_fact(rows, path) == 1
    assert read_fact(spark, path).count() == 1


def test_costly_columns_are_made_below_the_generator(spark):
    from ledgerloom.scale import computed_once

    df = spark.createDataFrame([("a b", 1), (None, 2)], "`x y` string, n int")
    made = computed_once(df, {"m": F.upper(F.col("`x y`"))})
    kept = made.where("m is not null")
    assert [tuple(r) for r in kept.collect()] == [("a b", 1, "A B")]
    plan = kept._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("upper(") == 1 and "upper(" not in plan[plan.index("Generate"):].splitlines()[0]
