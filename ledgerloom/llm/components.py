"""Connected components by alternating large-star and small-star (Kiveris et al., 2014)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.scale import durable


def _large_star(edges: DataFrame) -> DataFrame:
    """Each node hands the smallest node it sees to its larger neighbours."""
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    linked = both.join(least, "u").where("v > u")
    return linked.select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Each node hands the smallest node it sees to its smaller neighbours and to itself."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    linked = down.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    own = least.select("u", F.col("m").alias("v"))
    return linked.union(own).where("u != v").distinct()


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return tuple(row)


def connected_components(edges: DataFrame) -> DataFrame:
    """``(node, component)`` for each node of ``edges(u, v)``; a component is named by its least node.

    Null ends and loops link nothing.  Every round is written to the shared scratch folder; the loop ends
    when a round changes nothing.  Only a count and a checksum reach the driver.
    """
    links = durable(edges.where("u is not null and v is not null and u != v").select("u", "v").distinct())
    state = _state(links)
    while state[0]:
        links = durable(_small_star(_large_star(links)))
        before, state = state, _state(links)
        if before == state:
            break
    heads = links.select(F.col("v").alias("node"), F.col("v").alias("component"))
    return links.select(F.col("u").alias("node"), F.col("v").alias("component")).union(heads).distinct()
