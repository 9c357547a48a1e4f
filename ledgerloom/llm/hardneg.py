"""Hard negatives by a secondary-sort shuffle.

Pair scores are packed into keys (anchor, descending score, id); ``repartitionAndSortWithinPartitions`` brings the
scores of an anchor to one task in that order, and a streaming iterator opens a window for each positive as it passes
and hands out the negatives that fall in it, holding no more than the open windows of one anchor.

Anchors are the query set: they meet all rows, in blocks.  A pass takes about ``PASS_ANCHORS`` anchors (fewer for very
long vectors), so what is broadcast has a fixed bound; more anchors take more passes.  Two scans of a pass keep the
shuffle small without leaving a pair out that could count: the first keeps, per anchor and block of rows, the best
positives (only these can be the anchor's best), the second the first negatives of each window that the anchor's
positives open (only these can come first in it).
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.llm.words import ship
from ledgerloom.scale import durable, scratch_path

SCALE = 256
POSITIVES = 5
NEGATIVES = 3
#: A negative fits a positive if LOW * positive <= 100 * negative <= HIGH * positive.
LOW, HIGH = 50, 95

#: Anchors, and their components, that are sent to the executors in one pass.
PASS_ANCHORS = 4096
PASS_VALUES = 1 << 22
#: Rows that meet the anchors together in a task, and scores held at a time.
BLOCK_ROWS = 1 << 15
_SCORES = 1 << 21
#: Scored pairs a sorting task is meant to take.
TASK_PAIRS = 500_000

_LONG = (1 << 63) - 1
_PAIR = "anchor_id long, score long, vec_id long"
_RESULT = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"


def usable(rows: DataFrame) -> DataFrame:
    """``vec_id, label, vector`` of the rows that take part; components as whole numbers (``floor`` of 256 x)."""
    vector = F.col("embedding").cast("array<double>")
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    known = F.col("vec_id").isNotNull() & F.col("label").isNotNull() & vector.isNotNull()
    return rows.where(known & ~bad).select(
        F.col("vec_id").cast("long").alias("vec_id"),
        F.col("label").cast("long").alias("label"),
        F.transform(vector, lambda x: F.floor(x * SCALE)).alias("vector"),
    )


def window_of(score: int, low: int = LOW, high: int = HIGH) -> tuple[int, int]:
    """Least and greatest negative score that fit a positive's."""
    return -(-low * score // 100), high * score // 100


def _matrix(column: pa.Array) -> np.ndarray:
    """Vectors as rows; shorter ones end in zeros."""
    lengths = column.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    flat = column.flatten().to_numpy(zero_copy_only=False)
    width = int(lengths.max(initial=0))
    if (lengths == width).all():
        return flat.reshape(len(lengths), width)
    full = np.zeros((len(lengths), width), dtype=np.int64)
    full[np.arange(width) < lengths[:, None]] = flat
    return full


def scores(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Exact inner products as longs; those outside the range of a long become its nearest end."""
    width = min(left.shape[1], right.shape[1])
    left, right = left[:, :width], right[:, :width]
    most = [int(np.abs(m.astype(np.float64)).max(initial=0)) for m in (left, right)]
    if most[0] * most[1] * width < 1 << 53:
        return (left.astype(np.float64) @ right.astype(np.float64).T).astype(np.int64)
    exact = left.astype(object) @ right.astype(object).T
    return np.clip(exact, -_LONG, _LONG).astype(np.int64)


@dataclass
class Anchors:
    """The anchors of a pass; ``windows`` are the ranges of negative scores that each is looking for."""

    ids: np.ndarray
    labels: np.ndarray
    matrix: np.ndarray
    windows: list[list[tuple[int, int]]] = field(default_factory=list)


def _first(score: np.ndarray, among: np.ndarray, count: int) -> np.ndarray:
    """Places of the ``count`` highest scores, equal ones by place."""
    of = score[among]
    if len(of) > count:
        least = np.partition(of, len(of) - count)[len(of) - count]
        among, of = among[of >= least], of[of >= least]
    return among[np.argsort(-of, kind="stable")[:count]]


def block_pairs(anchors: Anchors, ids: np.ndarray, labels: np.ndarray, matrix: np.ndarray, count: int) -> tuple:
    """Anchor ids, scores and row ids: the best positives, or with windows the first negatives of each, of one block."""
    order = np.argsort(ids, kind="stable")
    ids, labels, matrix = ids[order], labels[order], matrix[order]
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    step = max(1, _SCORES // max(1, len(ids)))
    for start in range(0, len(anchors.ids), step):
        block = scores(anchors.matrix[start : start + step], matrix)
        for k, score in enumerate(block, start):
            same, other = labels == anchors.labels[k], ids != anchors.ids[k]
            if anchors.windows:
                rest = np.flatnonzero(~same & other)
                of = score[rest]
                picks = [_first(score, rest[(of >= lo) & (of <= hi)], count) for lo, hi in anchors.windows[k]]
                chosen = np.unique(np.concatenate(picks)) if picks else rest[:0]
            else:
                chosen = _first(score, np.flatnonzero(same & other), count)
            if len(chosen):
                found.append((np.full(len(chosen), anchors.ids[k]), score[chosen], ids[chosen]))
    if not found:
        return tuple(np.empty(0, dtype=np.int64) for _ in range(3))
    return tuple(np.concatenate([f[side] for f in found]) for side in range(3))


def _scan(rows: DataFrame, anchors: Anchors, count: int) -> DataFrame:
    """Pairs of all anchors of a pass with all rows, reduced within blocks."""
    shared = rows.sparkSession.sparkContext.broadcast(anchors)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def pairs(held: list[pa.RecordBatch]) -> pa.RecordBatch:
            table = pa.Table.from_batches(held).combine_chunks()
            column = lambda name: table.column(name).combine_chunks()
            got = block_pairs(shared.value, column("vec_id").to_numpy(), column("label").to_numpy(),
                              _matrix(column("vector")), count)
            return pa.RecordBatch.from_arrays([pa.array(x) for x in got], names=["anchor_id", "score", "vec_id"])

        held, size = [], 0
        for batch in batches:
            held, size = [*held, batch], size + batch.num_rows
            if size >= BLOCK_ROWS:
                yield pairs(held)
                held, size = [], 0
        if size:
            yield pairs(held)

    ship(rows.sparkSession)
    return rows.mapInArrow(run, _PAIR)


def pack(anchor: int, score: int, positive: bool, other: int) -> bytes:
    """Key whose byte order is (anchor, descending score, positives before negatives, id)."""
    return struct.pack(">QQBQ", anchor + _LONG + 1, _LONG - score, not positive, other + _LONG + 1)


def unpack(key: bytes) -> tuple[int, int, bool, int]:
    anchor, score, negative, other = struct.unpack(">QQBQ", key)
    return anchor - _LONG - 1, _LONG - score, not negative, other - _LONG - 1


def emit(keys: Iterator[bytes], positives: int, negatives: int, low: int, high: int) -> Iterator[tuple]:
    """Walk sorted keys: each of an anchor's first positives opens a window, negatives fall into the open ones."""
    current, opened, seen = None, [], 0
    for key in keys:
        anchor, score, positive, other = unpack(key)
        if anchor != current:
            current, opened, seen = anchor, [], 0
        if positive:
            if seen < positives:
                seen += 1
                least, most = window_of(score, low, high)
                opened.append([other, score, least, most, 0])
            continue
        opened = [w for w in opened if w[4] < negatives and score >= w[2]]
        for w in opened:
            if score <= w[3]:
                w[4] += 1
                yield anchor, w[0], w[4], other, w[1], score


def _sorted_out(pairs: DataFrame, positives: int, negatives: int, low: int, high: int) -> DataFrame:
    """The secondary sort: packed keys, one anchor per task, negatives streamed out of the sorted keys."""
    spark = pairs.sparkSession
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-pairs.count() // TASK_PAIRS))
    keyed = pairs.select("anchor_id", "score", "positive", "vec_id").rdd.map(lambda r: (pack(*r), None))
    dealt = keyed.repartitionAndSortWithinPartitions(tasks, lambda key: zlib.crc32(key[:8]))
    found = dealt.mapPartitions(lambda part: emit((k for k, _ in part), positives, negatives, low, high))
    return spark.createDataFrame(found, _RESULT, verifySchema=False)


def _one_pass(rows: DataFrame, chosen: DataFrame, positives: int, negatives: int, low: int, high: int) -> DataFrame:
    table = chosen.toArrow()
    column = lambda name: table.column(name).combine_chunks()
    anchors = Anchors(column("vec_id").to_numpy(), column("label").to_numpy(), _matrix(column("vector")))
    order = Window.partitionBy("anchor_id").orderBy(F.desc("score"), "vec_id")
    best = _scan(rows, anchors, positives).withColumn("place", F.row_number().over(order))
    best = durable(best.where(F.col("place") <= positives).drop("place"))
    windows: dict[int, list] = {}
    for anchor, score in zip(*(x.to_pylist() for x in best.select("anchor_id", "score").toArrow().columns)):
        least, most = window_of(score, low, high)
        if least <= most:
            windows.setdefault(anchor, []).append((least, most))
    anchors.windows = [windows.get(i, []) for i in anchors.ids.tolist()]
    other = _scan(rows, anchors, negatives).withColumn("positive", F.lit(False))
    pairs = durable(best.withColumn("positive", F.lit(True)).unionByName(other))
    return _sorted_out(pairs, positives, negatives, low, high)


def mine(
    rows: DataFrame, is_anchor: Column, positives: int = POSITIVES, negatives: int = NEGATIVES,
    low: int = LOW, high: int = HIGH, pass_anchors: int = PASS_ANCHORS,
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score`` for the anchors of
    ``rows(vec_id, label, embedding)`` that ``is_anchor`` (over ``vec_id`` and ``label``) picks.

    - Rows with a null ``vec_id``, label or vector, or a null or non-finite component, take no part.
    - Equal scores come by smaller ``vec_id``; a component beyond the range of a long, or a score beyond it, counts as
      the nearest end of the range.
    - A vector that is shorter than its partner ends in zeros; an empty one scores zero.
    - Rows that repeat a ``vec_id`` each count as partners, but not of an anchor with that id; of anchors with one id,
      the one with the least label (then vector) is taken.
    - An anchor without positives or fitting negatives has no row; empty tables give an empty result.
    - Other columns are ignored, whatever their names.
    """
    spark = rows.sparkSession
    part = usable(rows)
    each = part.where(is_anchor).groupBy("vec_id").agg(F.min(F.struct("label", "vector")).alias("own"))
    anchors = durable(each.select("vec_id", "own.label", "own.vector"))
    total, width = anchors.agg(F.count(F.lit(1)), F.max(F.size("vector"))).first()
    if not total:
        return spark.createDataFrame([], _RESULT)
    passes = -(-total // max(1, min(pass_anchors, PASS_VALUES // max(1, width))))
    out = scratch_path(spark, "hard-negatives")
    for k in range(passes):
        chosen = anchors.where(F.pmod(F.xxhash64("vec_id"), F.lit(passes)) == k)
        if not chosen.isEmpty():
            _one_pass(part, chosen, positives, negatives, low, high).write.parquet(f"{out}/pass={k}")
    return spark.read.parquet(out).drop("pass")
