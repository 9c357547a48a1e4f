"""Running totals over an unbounded ordered table, without a single-task global window.

The rows are range partitioned by the full sort order, so equal leading values are spread too.  Each
partition sums itself, the partition totals (one row per partition) give every partition its
starting offset, and a window inside each partition finishes the job.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.scale import durable


def running_total(df: DataFrame, value: str, order: list[Column], width: str = "decimal(38,4)") -> DataFrame:
    """Add ``row_rank``, ``running`` and ``grand_total`` of ``value`` in the given total order.

    ``order`` must be a total order.  The range partitioned rows are written once, because range
    bounds are sampled anew whenever the exchange runs and the partition number is used twice.
    """
    placed = durable(df.repartitionByRange(*order).withColumn("_part", F.spark_partition_id()))

    parts = placed.groupBy("_part").agg(F.sum(value).alias("_sum"), F.count(F.lit(1)).alias("_rows"))
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = parts.select(
        "_part",
        F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).cast(width).alias("_before"),
        F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_rows_before"),
        F.sum("_sum").over(Window.partitionBy()).cast(width).alias("grand_total"),
    )

    local = Window.partitionBy("_part").orderBy(*order)
    so_far = local.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # One offset row per shuffle partition: the broadcast is bounded by the partition count.
    return (
        placed.join(F.broadcast(offsets), "_part")
        .withColumn("row_rank", F.row_number().over(local) + F.col("_rows_before"))
        .withColumn("running", (F.sum(value).over(so_far) + F.col("_before")).cast(width))
        .drop("_part", "_before", "_rows_before")
    )
