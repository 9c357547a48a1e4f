"""Fact tables as Parquet, one folder per month."""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ledgerloom.functions.dates import period
from ledgerloom.scale import shuffles_dropped


def _stands(spark: SparkSession, path: str) -> bool:
    """Whether something has been written there."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at)


def _count(written: Observation, df: DataFrame) -> int:
    try:
        return written.get["n"]
    except Py4JJavaError:  # a plan that Spark knows to be empty is replaced, and the count with it
        if df.isEmpty():
            return 0
        raise


def write_fact(df: DataFrame, path: str, date: str = "sale_date", mode: str = "overwrite") -> int:
    """Write a fact by month and return the rows written; the default rebuilds the table.

    Rows are brought together by month, and AQE splits a month by its measured size, so small months
    become one file and a month with very many rows, equal ones too, does not end in one task.  An
    empty frame writes no rows and leaves what is there untouched.  Only then is it asked first whether it is
    empty: behind a shuffled join that takes all the work of making its rows.
    """
    if _stands(df.sparkSession, path) and df.isEmpty():
        return 0
    written = Observation()
    rows = df.observe(written, F.count(F.lit(1)).alias("n")).withColumn("period", period(F.col(date)))
    with shuffles_dropped(df.sparkSession):
        rows.hint("rebalance", F.col("period")).write.mode(mode).partitionBy("period").parquet(path)
    return _count(written, df)


def write_dimension(df: DataFrame, path: str, mode: str = "overwrite") -> int:
    if _stands(df.sparkSession, path) and df.isEmpty():
        return 0
    written = Observation()
    with shuffles_dropped(df.sparkSession):
        df.observe(written, F.count(F.lit(1)).alias("n")).write.mode(mode).parquet(path)
    return _count(written, df)


def read_fact(spark: SparkSession, path: str, start: str | None = None, end: str | None = None, date: str = "sale_date") -> DataFrame:
    """A fact, optionally an inclusive date range; whole months outside it are not read."""
    df = spark.read.option("basePath", path).parquet(path)
    if start is not None:
        df = df.where((F.col("period") >= start[:7]) & (F.col(date) >= F.lit(start).cast("date")))
    if end is not None:
        df = df.where((F.col("period") <= end[:7]) & (F.col(date) <= F.lit(end).cast("date")))
    return df.drop("period")
