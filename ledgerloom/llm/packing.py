"""Packing of tokenised documents into sequences by vector best fit.

A piece is a vector of tokens, one document, and attention cost (its squared length).  A sequence has a
capacity in each.  Pieces are placed in decreasing length; a piece goes to the open sequence that fits in every
dimension and has the best score: the largest weighted dot product of the piece with what the sequence has
left, or the smallest weighted norm of what it would have left.  If none fits, a sequence is opened.

A piece's vector depends on its length alone.  So the choice is made for lengths and counts (at most
``capacity`` numbers, however large the corpus), and every step places many equal pieces at once: sequences
in the same state are a range of numbers, and a step sends the ranks ``a .. b`` of a length to the sequences
``s .. t`` at one offset.  The documents then find their place from their rank within their length, which
Spark counts in slices.  Nothing but counts by length reaches the driver.
"""

from __future__ import annotations

import base64
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.llm.words import id_and_bytes, map_batches
from ledgerloom.scale import durable

CAPACITY = 2048
#: Ranks within a length are counted in so many slices, so that one common length is no single group.
SLICES = 1024
TOKENIZER = "byte_bpe_50k.tiktoken"
END = 0


class _Encoder:
    """Token ids of a whole text from a file of byte-level BPE ranks; no string is special."""

    def __init__(self, path: str) -> None:
        import public_tokenizers as public
        import tiktoken

        with open(path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.encoding = tiktoken.Encoding("own", pat_str=public.PATTERN, mergeable_ranks=ranks, special_tokens={})

    def ids(self, text: str) -> np.ndarray:
        return self.encoding.encode_to_numpy(text, disallowed_special=()).astype("<u4", copy=False)


_ENCODERS: dict[str, _Encoder] = {}


def encoder(path: str) -> _Encoder:
    """One encoder per worker."""
    if path not in _ENCODERS:
        _ENCODERS[path] = _Encoder(path)
    return _ENCODERS[path]


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path(TOKENIZER)


def cut(length: int, capacity: int) -> list[tuple[int, int]]:
    """``(start, length)`` of the pieces; all but the first have ``capacity`` tokens."""
    first = length % capacity or min(length, capacity)
    return [(0, first)] + [(start, capacity) for start in range(first, length, capacity)]


def _pieces(path: str, capacity: int, with_ids: bool):
    def run(batch: pa.RecordBatch) -> dict:
        out: dict[str, list] = {k: [] for k in ("doc_id", "piece", "start", "length", "ids_crc32", "ids")}
        encode = encoder(path).ids
        for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
            ids = np.append(encode(text.decode("utf-8", "replace")), np.array([END], dtype="<u4"))
            for number, (start, length) in enumerate(cut(len(ids), capacity)):
                part = ids[start : start + length]
                out["doc_id"].append(doc)
                out["piece"].append(number)
                out["start"].append(start)
                out["length"].append(length)
                out["ids_crc32"].append(zlib.crc32(part.tobytes()))
                out["ids"].append(part.astype(np.int32) if with_ids else None)
        return out

    return run


def pieces(docs: DataFrame, path: str, capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32`` (and ``ids``) of the documents, each ended by id 0."""
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * with_ids
    return map_batches(id_and_bytes(docs), schema, _pieces(path, capacity, with_ids))


class Fit:
    """Vector best fit over lengths with counts."""

    def __init__(self, capacity: int, documents: int, attention: int, weights, rule: str) -> None:
        self.limits = np.array([capacity, documents, attention], dtype=np.float64)
        self.weights = np.asarray(weights, dtype=np.float64)
        self.rule = rule
        self.left = np.empty((0, 3))
        self.first: list[int] = []
        self.count: list[int] = []
        self.opened = 0
        self.steps: list[tuple[int, int, int, int]] = []  # length, rank, sequence, offset

    def _best(self, need: np.ndarray) -> int | None:
        fits = np.flatnonzero((self.left >= need).all(axis=1))
        if not len(fits):
            return None
        left, size = self.left[fits] / self.limits, need / self.limits
        score = (left * size) @ self.weights if self.rule == "dot" else -(((left - size) ** 2) @ self.weights)
        return int(fits[np.argmax(score)])

    def _put(self, group: int, need: np.ndarray, rank: int, most: int) -> int:
        """Place up to ``most`` equal pieces, one in each sequence of the group; a rest splits off the group."""
        taken = min(most, self.count[group])
        if taken < self.count[group]:
            self.left = np.vstack([self.left, self.left[group]])
            self.first.append(self.first[group] + taken)
            self.count.append(self.count[group] - taken)
            self.count[group] = taken
        self.steps.append((int(need[0]), rank, self.first[group], int(self.limits[0] - self.left[group][0])))
        self.left[group] -= need
        return taken

    def place(self, length: int, count: int) -> None:
        need = np.array([length, 1, length * length], dtype=np.float64)
        if (need > self.limits).any():
            raise ValueError(f"a piece of {length} tokens exceeds a capacity of {self.limits.tolist()}")
        rank = 0
        while rank < count:
            group = self._best(need)
            if group is None:
                each = max(1, int((self.limits // need).min()))
                group = len(self.first)
                self.left = np.vstack([self.left, self.limits])
                self.first.append(self.opened)
                self.count.append(-(-(count - rank) // each))
                self.opened += self.count[group]
            rank += self._put(group, need, rank, count - rank)
        # Sequences without room for one more token are closed and only kept in the steps.
        open_groups = np.flatnonzero((self.left >= 1).all(axis=1))
        self.left = self.left[open_groups]
        self.first = [self.first[i] for i in open_groups]
        self.count = [self.count[i] for i in open_groups]


def plan(counts: dict[int, int], capacity: int, documents: int, attention: int, weights, rule: str) -> np.ndarray:
    """Steps ``(length, rank, sequence, offset)``, sorted: where the ranks of each length go."""
    fit = Fit(capacity, documents, attention, weights, rule)
    for length in sorted(counts, reverse=True):
        fit.place(length, counts[length])
    return np.array(sorted(fit.steps), dtype=np.int64).reshape(-1, 4)


def pack(
    docs: DataFrame,
    path: str | None = None,
    capacity: int = CAPACITY,
    documents: int | None = None,
    attention: int | None = None,
    weights=(1.0, 0.01, 0.01),
    rule: str = "norm",
    with_ids: bool = False,
) -> DataFrame:
    """Per piece: ``doc_id, piece, start, length, ids_crc32, sequence_id, offset`` (and ``ids``).

    ``documents`` and ``attention`` are the other capacities of a sequence; by default they are as large as
    ``capacity`` tokens can need, so that they cost no sequences.  A null text is empty and holds the end
    token alone; a null ``doc_id`` and repeated rows are packed like any other row; other columns are ignored;
    an empty table gives no rows.  ``rule`` is ``dot`` or ``norm``.
    """
    path = path or default_tokenizer()
    key = F.xxhash64("doc_id", "piece", "start", "ids_crc32", "length")
    cut_up = pieces(docs, path, capacity, with_ids).withColumn("slice", F.pmod(key, F.lit(SLICES)))
    stored = durable(cut_up)
    by_slice = durable(stored.groupBy("length", "slice").agg(F.count(F.lit(1)).alias("n")))
    counts = {r["length"]: r["n"] for r in by_slice.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    steps = plan(counts, capacity, documents or capacity, attention or capacity * capacity, weights, rule)

    earlier = Window.partitionBy("length").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    before = by_slice.select("length", "slice", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    within = Window.partitionBy("length", "slice").orderBy("doc_id", "piece", "start", "ids_crc32")
    ranked = stored.withColumn("rank", F.row_number().over(within) - 1).join(before, ["length", "slice"])

    # At most a few steps per length and number of documents in a sequence: bounded by the capacities.
    shared = docs.sparkSession.sparkContext.broadcast(steps)
    names = ["doc_id", "piece", "start", "length", "ids_crc32"] + ["ids"] * with_ids

    def place(batch: pa.RecordBatch) -> dict:
        table = shared.value
        length = np.asarray(batch.column("length"), dtype=np.int64)
        rank = np.asarray(batch.column("rank"), dtype=np.int64)
        at = np.searchsorted(table[:, 0] * (1 << 40) + table[:, 1], length * (1 << 40) + rank, side="right") - 1
        _, start, sequence, offset = table[at].T
        return {
            **{name: batch.column(name) for name in names},
            "sequence_id": sequence + rank - start,
            "offset": offset,
        }

    schema = "doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * with_ids
    ranked = ranked.select(*names, (F.col("rank") + F.col("before")).cast("long").alias("rank"))
    return map_batches(ranked, f"{schema}, sequence_id long, offset long", place)


def sequences(packed: DataFrame) -> DataFrame:
    """``sequence_id, ids, boundaries`` of pieces packed ``with_ids``: the training rows themselves.

    A sequence has at most ``capacity`` tokens, so its group is bounded.
    """
    parts = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id").agg(parts.alias("parts")).select(
        "sequence_id",
        F.flatten(F.transform("parts", lambda p: p["ids"])).alias("ids"),
        F.transform("parts", lambda p: p["offset"]).alias("boundaries"),
    )
