"""Repeatable loads into a fact table: a load is a report file, known by its content, and counts once it is committed.

Rows are stored by month and load.  A load overwrites its own parts of the months it touches and no other (dynamic
partition overwrite); when they are written, the load is entered in the manifest, and readers see entered loads only.
So a report that is loaded twice, under another name too, or a run that died half way and is repeated, changes nothing.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.functions.dates import period
from ledgerloom.scale import broadcast_if_small, durable

_MANIFEST = "_loads"
_ENTRY = "load string, file_name string, period string, n long"


def manifest(spark: SparkSession, path: str) -> DataFrame:
    """Committed loads: ``load`` (fingerprint), ``file_name``, ``period`` and rows ``n`` of each month."""
    try:
        return spark.read.schema(_ENTRY).parquet(f"{path}/{_MANIFEST}")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], _ENTRY)


def fingerprints(df: DataFrame, file: str = "file_name") -> DataFrame:
    """``file_name, load, n`` per file; equal rows in any order give equal fingerprints, whatever the file's name."""
    row = F.struct(*[F.col(c) for c in sorted(df.columns) if c != file])
    sums = [F.sum(F.xxhash64(F.to_json(row), F.lit(k)).cast("decimal(38,0)")) for k in (1, 2)]
    # The letter keeps a folder's name from being read as a number.
    each = df.groupBy(F.col(file).alias("file_name")).agg(F.count(F.lit(1)).alias("n"), F.array(*sums).alias("sums"))
    parts = F.concat_ws("-", F.col("n").cast("string"), F.transform("sums", lambda x: x.cast("string")))
    return each.select("file_name", F.concat(F.lit("r"), F.md5(parts)).alias("load"), "n")


def _write(df: DataFrame, path: str, date: str) -> None:
    """Write rows with their ``load`` over what the same loads may have left in the months they touch."""
    rows = df.withColumn("period", period(F.col(date)))
    writer = rows.hint("rebalance", F.col("period"), F.col("load")).write.mode("overwrite")
    writer.option("partitionOverwriteMode", "dynamic").partitionBy("period", "load").parquet(path)


def _commit(entries: DataFrame, path: str) -> None:
    """Enter loads in the manifest, as one file that appears whole."""
    entries.coalesce(1).write.parquet(f"{path}/{_MANIFEST}/commit={uuid.uuid4().hex}")


def append_fact(df: DataFrame, path: str, date: str = "sale_date", file: str = "file_name") -> DataFrame:
    """Add the reports in ``df`` to the fact at ``path``; ``file`` names the report of each row and is not stored.

    Returns ``file_name, load, n, state``: ``loaded``, ``known`` (its content was committed before) or ``repeated``
    (another file of this call has the same content).  Rows without a report name or date are refused, because a
    repeat could not find them again.  An empty ``df`` changes nothing.
    """
    spark = df.sparkSession
    unnamed = df.where(F.col(file).isNull() | F.col(date).isNull()).limit(1).count()
    if unnamed:
        raise ValueError(f"rows without {file} or {date} cannot be loaded")
    seen = manifest(spark, path).select("load").distinct().withColumn("seen", F.lit(True))
    listed = fingerprints(df, file).join(broadcast_if_small(seen), "load", "left")
    first = listed.groupBy("load").agg(F.min("file_name").alias("first"))
    state = (
        F.when(F.col("seen"), "known").when(F.col("file_name") == F.col("first"), "loaded").otherwise("repeated")
    )
    report = durable(listed.join(first, "load").select("file_name", "load", "n", state.alias("state")))
    fresh = report.where("state = 'loaded'").select(F.col("file_name").alias(file), "load")
    if fresh.isEmpty():
        return report
    _write(df.join(broadcast_if_small(fresh), file).drop(file), path, date)
    written = _stored(spark, path).join(broadcast_if_small(fresh), "load").groupBy("load", file, "period").agg(
        F.count(F.lit(1)).alias("n")
    )
    entries = durable(written.select("load", F.col(file).alias("file_name"), F.col("period").cast("string"), "n"))
    short = entries.groupBy("load").agg(F.sum("n").alias("stored")).join(report.where("state = 'loaded'"), "load", "right")
    missing = short.where(~F.col("stored").eqNullSafe(F.col("n"))).limit(1).collect()
    if missing:
        raise RuntimeError(f"{missing[0]['file_name']}: {missing[0]['stored']} of {missing[0]['n']} rows were stored")
    _commit(entries, path)
    return report


def _stored(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("basePath", path).option("mergeSchema", True).parquet(path)


def read_loads(
    spark: SparkSession, path: str, start: str | None = None, end: str | None = None, date: str = "sale_date"
) -> DataFrame:
    """The committed rows, optionally of an inclusive date range; other months and loads are not read."""
    loads = manifest(spark, path)
    if start is not None:
        loads = loads.where(F.col("period") >= start[:7])
    if end is not None:
        loads = loads.where(F.col("period") <= end[:7])
    known = broadcast_if_small(loads.select("load", "period").distinct())
    df = _stored(spark, path).withColumn("period", F.col("period").cast("string")).join(known, ["period", "load"], "left_semi")
    if start is not None:
        df = df.where(F.col(date) >= F.lit(start).cast("date"))
    if end is not None:
        df = df.where(F.col(date) <= F.lit(end).cast("date"))
    return df.drop("period", "load")


def uncommitted(spark: SparkSession, path: str) -> DataFrame:
    """Loads that a dead run has left without an entry: ``load, period, n``.  They are never read; this lists them."""
    left = _stored(spark, path).withColumn("period", F.col("period").cast("string"))
    entered = manifest(spark, path).select("load").distinct()
    return left.join(broadcast_if_small(entered), "load", "left_anti").groupBy("load", "period").agg(
        F.count(F.lit(1)).alias("n")
    )
