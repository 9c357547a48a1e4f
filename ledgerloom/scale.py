"""Guards that keep a plan safe when the data grows: size-checked broadcasts and durable stages."""

from __future__ import annotations

import tempfile
import threading
import uuid
from collections.abc import Callable, Iterator, Mapping
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from typing import TypeVar

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

T = TypeVar("T")

#: Largest dimension (in rows) that may be copied to every executor.
BROADCAST_ROW_LIMIT = 500_000


#: Bytes of code up to which the JVM compiles a generated method; longer ones stay interpreted.
METHOD_LIMIT = 8000


def in_small_methods(df: DataFrame) -> DataFrame:
    """``df`` itself; its session from now on runs a stage whose generated method is too long operator by operator.

    Spark's own limit lets a chain of many expressions become one method that the JVM never compiles.  Results do not
    depend on the setting; a limit that the session has been given is kept.
    """
    conf = df.sparkSession.conf
    if conf.get("spark.sql.codegen.hugeMethodLimit") == "65535":
        conf.set("spark.sql.codegen.hugeMethodLimit", str(METHOD_LIMIT))
    return df


def has_at_most(df: DataFrame, rows: int) -> bool:
    """Counted, not estimated; the count stops at ``rows + 1``."""
    return df.limit(rows + 1).count() <= rows


def broadcast_if_small(df: DataFrame, max_rows: int = BROADCAST_ROW_LIMIT, counted: DataFrame | None = None) -> DataFrame:
    """Hint a broadcast only if ``df`` has at most ``max_rows`` rows.

    ``counted`` may name a frame that is cheaper to count and has at least as many rows.  A larger
    side is returned unhinted, so Spark plans a shuffled join and AQE splits its skewed partitions.
    """
    return F.broadcast(df) if has_at_most(df if counted is None else counted, max_rows) else df


def join_dimension(
    df: DataFrame,
    dimension: DataFrame,
    name: str,
    key,
    counted: DataFrame | None = None,
    max_rows: int = BROADCAST_ROW_LIMIT,
) -> DataFrame:
    """Left join ``dimension`` on its column ``name`` against the expression ``key`` of ``df``.

    A dimension of checked size is broadcast.  Beyond that the join shuffles: AQE splits hot keys,
    and NULL keys, which would all meet in one task, are spread first.
    """
    if has_at_most(dimension if counted is None else counted, max_rows):
        return df.withColumn(name, key).join(F.broadcast(dimension), name, "left")
    spread = spread_null_keys(key.cast("string"), *df.columns)
    return df.withColumn(name, spread).join(dimension, name, "left")


def scratch_root(spark: SparkSession) -> str:
    """Shared folder for durable intermediate data: ``spark.checkpoint.dir``.

    A local session without that setting (tests) gets a temporary folder; a cluster must name one,
    because a machine-local folder is lost with its executor.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not named:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
        named = tempfile.mkdtemp(prefix="run-", dir="/tmp")
        spark.sparkContext.setCheckpointDir(named)
    return named


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new, unused path under the scratch folder."""
    return f"{scratch_root(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


_SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_writing, _writers = threading.Lock(), 0


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Writes started inside remove their shuffle files when they end; Spark would keep them for an unknown time.

    What a write leaves stands in its files.  The session's own setting is back when the last write has begun and
    ended, and one that has been given is kept.
    """
    global _writers
    with _writing:
        own = _writers > 0 or _SHUFFLE_CLEANUP not in spark.conf.getAll
        if own:
            _writers += 1
            spark.conf.set(_SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        with _writing:
            if own:
                _writers -= 1
                if _writers == 0:
                    spark.conf.unset(_SHUFFLE_CLEANUP)


def durable(df: DataFrame) -> DataFrame:
    """Write ``df`` once to the shared scratch folder and read it back.

    Cuts the lineage: later uses see one fixed copy that survives lost executors, prune its columns
    and know its size.
    """
    spark = df.sparkSession
    path = scratch_path(spark, "stage")
    with shuffles_dropped(spark):
        df.write.parquet(path, compression="zstd")
    return spark.read.schema(df.schema).parquet(path)


def at_once(jobs: Mapping[str, Callable[[], T]], most: int = 6) -> dict[str, T]:
    """Results of jobs that do not depend on each other, ``most`` at a time, in the order given.

    A chain of many small Spark jobs, run alone, leaves most cores idle.
    """
    with ThreadPoolExecutor(max_workers=most) as pool:
        return dict(zip(jobs, pool.map(lambda job: job(), jobs.values()), strict=True))


def spread_null_keys(key, *spread_by):
    """Replace a NULL join key with one of many unmatched placeholders.

    In a shuffled left join all NULL keys would land in one task.  The placeholder starts with a
    NUL character, which no real key contains, so it never matches.
    """
    bucket = F.pmod(F.xxhash64(*spread_by), F.lit(4096)).cast("string")
    return F.coalesce(key, F.concat(F.lit("\u0000"), bucket))


def computed_once(df: DataFrame, columns: dict) -> DataFrame:
    """Add costly columns behind a one-row generator.

    A later filter on such a column would otherwise be pushed below the projection, and with it a
    second copy of the whole expression.  Filters do not move through a generator.  The values are made in a
    projection below it: in stages that are too long to be one method, generators are interpreted, projections compiled.
    """
    made = {name: f"_{name}_made" for name in columns}
    packed = F.array(F.struct(*[F.col(made[name]).alias(name) for name in columns]))
    wide = df.withColumns({made[name]: value for name, value in columns.items()})
    return wide.select(*[F.col(f"`{c}`") for c in df.columns], F.inline(packed))
