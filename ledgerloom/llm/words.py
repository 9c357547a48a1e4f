"""Words of a text as 64-bit ids, rolling word-window hashes, and Arrow plumbing shared by the text operators."""

from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

import ledgerloom

_BASE = np.uint64(0x9E3779B97F4A7C15)


def word_ids(words: list[bytes]) -> np.ndarray:
    """64-bit id of each word; hashing anew is faster than a look-up in a large cache."""
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), dtype=np.uint64, count=len(words))


def mix(values: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser, so that low and high bits are both usable."""
    v = values ^ (values >> np.uint64(33))
    v = v * np.uint64(0xFF51AFD7ED558CCD)
    v ^= v >> np.uint64(33)
    v = v * np.uint64(0xC4CEB9FE1A85EC53)
    return v ^ (v >> np.uint64(33))


def _power(width: int) -> np.uint64:
    return np.uint64(pow(int(_BASE), width, 1 << 64))


def window_hashes(ids: np.ndarray, width: int) -> np.ndarray:
    """Hash of each run of ``width`` consecutive ids, built by doubling; empty if there are fewer ids."""
    if len(ids) < width:
        return np.empty(0, dtype=np.uint64)
    total, done, power, span = None, 0, ids, 1
    left = width
    while left:
        if left & 1:
            count = len(ids) - width + 1
            part = power[done : done + count]
            total = part.copy() if total is None else total * _power(span) + part
            done += span
        left >>= 1
        if left:
            power = power[: len(power) - span] * _power(span) + power[span:]
            span *= 2
    return mix(total)


def sliding_minimum(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each run of ``width`` consecutive values, built by doubling."""
    best, span = values, 1
    while span * 2 <= width:
        best = np.minimum(best[: len(best) - span], best[span:])
        span *= 2
    rest = width - span
    return np.minimum(best[: len(best) - rest], best[rest:]) if rest else best


def signed(values: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(values).view(np.int64)


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the executors once per application, so that it need not be installed there."""
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    root = Path(ledgerloom.__file__).parent
    archive = Path(tempfile.mkdtemp(prefix="ship-")) / "ledgerloom_package.zip"
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as packed:
        for source in sorted(root.rglob("*.py")):
            packed.write(source, Path(root.name) / source.relative_to(root))
    context.addPyFile(str(archive))
    _SHIPPED.add(context.applicationId)


def map_batches(df: DataFrame, schema: str, rows_of: Callable[[pa.RecordBatch], dict | None]) -> DataFrame:
    """``mapInArrow`` of a function that turns one batch into columns (``None``: no rows)."""
    ship(df.sparkSession)
    target = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = rows_of(batch)
            if columns is not None:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(columns[f.name], type=f.type) for f in target], schema=target
                )

    return df.mapInArrow(run, schema)


def id_and_bytes(docs: DataFrame) -> DataFrame:
    """``doc_id`` and the text as UTF-8 bytes; a null text is empty."""
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary").alias("text"),
    )
