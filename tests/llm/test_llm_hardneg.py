"""Hard negatives against brute force, with ties, many passes and awkward rows."""

import math
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from ledgerloom.llm import hardneg

SCHEMA = "vec_id long, embedding array<float>, label int, vector string, anchor_id long, score string, positive int"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, x, "v", 7, "s", 1) for i, v, x in rows], SCHEMA)


def brute(rows, is_anchor):
    rows = [(i, x, [math.floor(256 * float(np.float32(c))) for c in v]) for i, v, x in rows
            if i is not None and x is not None and v is not None
            and all(c is not None and math.isfinite(float(np.float32(c))) for c in v)]
    clip = lambda n: max(-(2**63) + 1, min(2**63 - 1, n))
    out = []
    for anchor in sorted({i for i, _, _ in rows if is_anchor(i)}):
        label, vector = min((x, v) for i, x, v in rows if i == anchor)
        scored = [(-clip(sum(a * b for a, b in zip(vector, v))), i, x) for i, x, v in rows if i != anchor]
        ranked = sorted(scored)
        positives = [(-s, i) for s, i, x in ranked if x == label][:5]
        for score, positive in positives:
            fit = [(-s, i) for s, i, x in ranked if x != label and 50 * score <= -100 * s <= 95 * score][:3]
            out += [(anchor, positive, k, i, score, s) for k, (s, i) in enumerate(fit, 1)]
    return out


def check(spark, rows, **options):
    got = hardneg.mine(frame(spark, rows), F.col("vec_id") % 5 == 0, **options)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    want = brute(rows, lambda i: i % 5 == 0)
    assert sorted(map(tuple, got.collect())) == sorted(want)
    return want


def vectors(seed=1, count=120):
    random.seed(seed)
    return [(k - 20, [random.choice([-1.0, -0.5, 0.0, 0.25, 0.5, 1.0]) for _ in range(4)], random.randrange(3))
            for k in range(count)]


@pytest.mark.parametrize("pass_anchors", [4096, 5])
def test_ties_and_passes(spark, pass_anchors):
    assert len(check(spark, vectors(), pass_anchors=pass_anchors)) > 100


def test_awkward_rows(spark):
    rows = vectors(2, 60) + [
        (None, [1.0, 1.0, 1.0, 1.0], 1), (200, None, 1), (205, [1.0, None, 0.0, 0.0], 1), (210, [1.0] * 4, None),
        (215, [float("nan"), 0.0, 0.0, 0.0], 0), (220, [float("inf"), 0.0, 0.0, 0.0], 0), (225, [], 1), (230, [1.0], 2),
        (235, [1.0, 1.0, 1.0, 1.0, 1.0, 1.0], 2), (240, [0.0] * 4, 1), (241, [0.0] * 4, 0), (242, [0.0] * 4, 1),
        (250, [0.5] * 4, 2), (250, [1.0] * 4, 0), (251, [0.5] * 4, 2), (251, [0.5] * 4, 2), (251, [0.5] * 4, 0),
    ]
    assert check(spark, rows)


def test_scores_beyond_doubles_and_longs(spark):
    rows = [(5, [3e8, 1.0], 0), (6, [3e8, 0.5], 0), (7, [2e8, 0.25], 1), (8, [2e8, 0.5], 1), (10, [3e38, 1.0], 0),
            (11, [3e38, 1.0], 0), (12, [1e8, 3.0], 1), (13, [-3e38, 3.0], 1)]
    check(spark, rows)


def test_hot_vector(spark):
    rows = vectors(3, 80) + [(1000 + k, [1.0, 0.5, -0.5, 1.0], k % 2) for k in range(400)]
    assert check(spark, rows)


def test_blocks_reduce_without_loss():
    """Splitting the rows over blocks never loses a pair that the whole would give."""
    rows = vectors(5, 90)
    matrix = np.array([[math.floor(256 * c) for c in v] for _, v, _ in rows], dtype=np.int64)
    ids, labels = np.array([i for i, _, _ in rows]), np.array([x for _, _, x in rows])
    anchors = hardneg.Anchors(ids[:7], labels[:7], matrix[:7])
    whole = set(zip(*(x.tolist() for x in hardneg.block_pairs(anchors, ids, labels, matrix, 5))))
    split = [hardneg.block_pairs(anchors, ids[k::4], labels[k::4], matrix[k::4], 5) for k in range(4)]
    assert whole <= {p for b in split for p in zip(*(x.tolist() for x in b))}


def test_keys_sort_as_told():
    keys = [(a, s, p, i) for a in (-3, 0, 4) for s in (-(2**63) + 1, -1, 0, 2**63 - 1) for p in (True, False)
            for i in (-(2**63), 5)]
    want = sorted(keys, key=lambda k: (k[0], -k[1], not k[2], k[3]))
    assert [hardneg.unpack(b) for b in sorted(hardneg.pack(*k) for k in keys)] == want


def test_padding():
    assert hardneg._matrix(pa.array([[1, 2], [], [3]], pa.list_(pa.int64()))).tolist() == [[1, 2], [0, 0], [3, 0]]


def test_empty_tables(spark):
    assert hardneg.mine(frame(spark, []), F.col("vec_id") % 5 == 0).count() == 0
    assert hardneg.mine(frame(spark, [(1, [1.0], 1)]), F.col("vec_id") % 5 == 0).count() == 0
    assert hardneg.mine(frame(spark, [(5, [1.0], 1)]), F.col("vec_id") % 5 == 0).count() == 0
