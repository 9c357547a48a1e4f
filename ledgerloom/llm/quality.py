"""Text quality by naive Bayes support vectors (NBSVM).

Features are indicators of byte n-grams, hashed to ``2**BITS`` numbers.  Each is scaled by the log ratio of its
smoothed document counts in the two classes; the counts cover all labelled training rows.  A linear
classifier with hinge loss is fitted to the scaled indicators by dual coordinate descent (Hsieh et al., 2008)
on at most ``fit_rows`` training rows, and its margin is turned into a probability on the same rows.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.words import id_and_bytes, map_batches
from ledgerloom.scale import broadcast_if_small, durable

BITS = 18
GRAMS = (2, 3, 4)
#: Labelled rows that the linear classifier is fitted on; counts and scores cover all rows.
FIT_ROWS = 6_000

_SPREAD = np.uint32(2654435761)
_FLAGS = np.zeros(1 << BITS, dtype=bool)


def indicators(text: bytes) -> np.ndarray:
    """Sorted numbers of the n-grams that occur in the whole text."""
    data = np.frombuffer(text, dtype=np.uint8).astype(np.uint32)
    codes = []
    for width in GRAMS:
        if len(data) < width:
            continue
        count = len(data) - width + 1
        gram = reduce(lambda code, i: (code << np.uint32(8)) | data[i : i + count], range(1, width), data[:count])
        codes.append(((gram + np.uint32(width * 0x01000193)) * _SPREAD) >> np.uint32(32 - BITS))
    if not codes:
        return np.empty(0, dtype=np.int64)
    for code in codes:
        _FLAGS[code] = True
    found = np.flatnonzero(_FLAGS)
    _FLAGS[found] = False
    return found


def _counts(batch: pa.RecordBatch) -> dict:
    totals = np.zeros((2, 1 << BITS), dtype=np.int64)
    for text, label in zip(batch.column("text").to_pylist(), batch.column("label").to_pylist(), strict=True):
        totals[label, indicators(text)] += 1
    used = np.flatnonzero(totals.any(axis=0))
    return {"feature": used, "n0": totals[0, used], "n1": totals[1, used]}


def log_ratios(n0: np.ndarray, n1: np.ndarray, smoothing: float = 1.0) -> np.ndarray:
    share0, share1 = n0 + smoothing, n1 + smoothing
    return np.log(share1 / share1.sum()) - np.log(share0 / share0.sum())


def scaled(features: np.ndarray, ratios: np.ndarray) -> np.ndarray:
    """Scaled indicators of unit length."""
    values = ratios[features]
    norm = np.sqrt(values @ values)
    return values / norm if norm > 0 else values


def descend(rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, size: int, cost: float = 1.0,
            rounds: int = 20, seed: int = 7) -> tuple[np.ndarray, float]:
    """Dual coordinate descent for the hinge loss; ``(weights, bias)``.  Classes weigh the same in total."""
    sign = np.where(labels > 0, 1.0, -1.0)
    share = np.where(labels > 0, (labels > 0).mean(), (labels <= 0).mean())
    upper = cost * 0.5 / share
    alpha, weights, bias = np.zeros(len(rows)), np.zeros(size), 0.0
    square = np.array([v @ v for _, v in rows]) + 1.0
    order = np.random.default_rng(seed)
    for _ in range(rounds):
        moved = 0.0
        for i in order.permutation(len(rows)):
            features, values = rows[i]
            slope = sign[i] * (weights[features] @ values + bias) - 1.0
            new = min(max(alpha[i] - slope / square[i], 0.0), upper[i])
            step = (new - alpha[i]) * sign[i]
            if step:
                weights[features] += step * values
                bias += step
                moved = max(moved, abs(step))
                alpha[i] = new
        if moved < 1e-3:
            break
    return weights, bias


def sigmoid_fit(margins: np.ndarray, labels: np.ndarray, rounds: int = 50) -> tuple[float, float]:
    """Slope and shift of a logistic curve through the margins (Newton steps, slightly regularised)."""
    target = np.where(labels > 0, ((labels > 0).sum() + 1) / ((labels > 0).sum() + 2), 1 / ((labels <= 0).sum() + 2))
    x = np.stack([margins, np.ones_like(margins)], axis=1)
    beta = np.array([1.0, 0.0])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        slope = x.T @ (p - target) + 1e-3 * beta
        curve = (x * (p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(2)
        step = np.linalg.solve(curve, slope)
        beta -= step
        if np.abs(step).max() < 1e-9:
            break
    return float(beta[0]), float(beta[1])


def held_out(doc_id) -> "F.Column":
    """True where ``crc32(doc_id as text) mod 3`` is 1; a null id is in training."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def fit(training: DataFrame, fit_rows: int = FIT_ROWS) -> dict:
    """Model from ``text`` (bytes) and ``label`` (0 or 1).  Without both classes it holds a constant only."""
    spark = training.sparkSession
    grams = map_batches(training, "feature long, n0 long, n1 long", _counts)
    table = grams.groupBy("feature").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1")).toArrow()
    seen = {r["label"]: r["n"] for r in training.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    if seen.keys() != {0, 1}:
        total = sum(seen.values())
        return {"constant": (seen.get(1, 0) + 1) / (total + 2)}
    n0, n1 = np.zeros(1 << BITS), np.zeros(1 << BITS)
    used = table["feature"].to_numpy()
    n0[used], n1[used] = table["n0"].to_numpy(), table["n1"].to_numpy()
    ratios = log_ratios(n0, n1)
    shared = spark.sparkContext.broadcast(ratios)

    # A hash threshold takes about fit_rows rows, the limit makes it a bound.
    share = min(1.0, 0.97 * fit_rows / sum(seen.values()))
    drawn = F.pmod(F.xxhash64("text"), F.lit(1_000_003)) < int(share * 1_000_003) + 1
    sample = training.where(drawn).limit(fit_rows).select(F.lit(0).alias("all"), "text", "label")

    def learn(group):
        import pandas as pd

        group = group.sort_values(["text", "label"])
        labels = group["label"].to_numpy()
        found = [indicators(bytes(t)) for t in group["text"]]
        if len(set(labels)) < 2:
            return pd.DataFrame({"weights": [[]], "bias": [0.0], "slope": [0.0], "shift": [0.0]})
        rows = [(x, scaled(x, shared.value)) for x in found]
        weights, bias = descend(rows, labels, 1 << BITS)
        margins = np.array([weights[x] @ v + bias for x, v in rows])
        slope, shift = sigmoid_fit(margins, labels)
        return pd.DataFrame({"weights": [weights.tolist()], "bias": [bias], "slope": [slope], "shift": [shift]})

    schema = "weights array<double>, bias double, slope double, shift double"
    row = sample.groupBy("all").applyInPandas(learn, schema).first()
    if row is None or not row["weights"]:
        return {"constant": (seen[1] + 1) / (sum(seen.values()) + 2)}
    weights = np.array(row["weights"]) * ratios
    return {"weights": weights.astype(np.float32), "square": (ratios**2).astype(np.float32),
            "bias": row["bias"], "slope": row["slope"], "shift": row["shift"]}


def score(docs: DataFrame, model: dict) -> DataFrame:
    """``doc_id, score`` of every row of ``docs``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batch: pa.RecordBatch) -> dict:
        held, scores = shared.value, []
        for text in batch.column("text").to_pylist():
            if "constant" in held:
                scores.append(held["constant"])
                continue
            found = indicators(text)
            norm = np.sqrt(held["square"][found].sum(dtype=np.float64))
            margin = held["weights"][found].sum(dtype=np.float64) / norm if norm > 0 else 0.0
            shown = held["slope"] * (margin + held["bias"]) + held["shift"]
            scores.append(float(1 / (1 + np.exp(-np.clip(shown, -30, 30)))))
        return {"doc_id": batch.column("doc_id"), "score": scores}

    return map_batches(id_and_bytes(docs), "doc_id long, score double", run)


def training_rows(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Text bytes and label of the labelled rows outside the held-out third."""
    marked = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("label"))
    marked = marked.where(F.col("label").isin(0, 1) & ~held_out(F.col("doc_id")))
    texts = id_and_bytes(docs).where(~held_out(F.col("doc_id")))
    return durable(texts.join(broadcast_if_small(marked), "doc_id").select("text", "label"))


def score_quality(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> DataFrame:
    """Per row of ``docs``: ``doc_id, held_out, score, predicted``.

    Null texts are empty and get the score of a text without features.  Labels other than 0 and 1 are ignored,
    several labels of a document all count.  With labels of one class or none, every score is the smoothed
    share of label 1.  Other columns are ignored; an empty table gives no rows.
    """
    scored = score(docs, fit(training_rows(docs, labels), fit_rows))
    return scored.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )
