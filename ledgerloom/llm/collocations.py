"""Phrase collocations: mergeable Misra-Gries summaries choose the phrases that are counted exactly.

First pass: every run of one to ``LONGEST`` words is hashed; blocks of text are combined where they are read, and each
hash partition keeps one Misra-Gries summary, into which the blocks merge.  Its capacity exceeds the partition's mass
divided by the threshold, so the total taken off a counter stays below the threshold and every frequent phrase
survives.  (A block counts a phrase ``threshold`` times at most: no frequent phrase is lost by that, and the mass of
the commonest ones does not crowd the summaries.)

Second pass: a bit map of the survivors, of bounded size, picks the phrases whose words are counted exactly, as
strings.  Hash collisions, survivors that are not frequent and a full bit map only add phrases to count; the counts
decide.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from itertools import groupby
from operator import itemgetter

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.llm.slices import word_slices
from ledgerloom.llm.words import mix, ship, signed, window_hashes, word_ids
from ledgerloom.scale import durable

LONGEST = 3
THRESHOLD = 10
TOP = 2000
#: A phrase is dropped if a longer candidate around it has at least this share of its count, in hundredths.
ABSORBED = 50

#: Words that are combined in a task before they are handed on.
BLOCK_WORDS = 1 << 19
#: Different phrases that a task holds in the second pass before it hands them on.
HELD_PHRASES = 1_200_000
#: Text bytes for each hash partition; a summary holds ``ROOM`` times its mass over the threshold.
PARTITION_BYTES = 4 << 20
ROOM = 4
#: Bits of a hash that tell phrases of a partition apart.
KEY_BITS = 32
#: Bits of the hash partition that a block, or a level above it, is dealt out by at once.
LEVEL_BITS = 10
#: Bits of the survivors' map for each survivor, and at most.
MAP_BITS_EACH, MAP_BITS_MOST = 16, 1 << 28

_BREAKS = bytes.maketrans(b".,;:!?\x0b\x0c\r", b"\n" * 9)
#: A byte that no UTF-8 text holds stands between pieces.
_GAP = b"\xff"
_GAP_ID = word_ids([_GAP])[0]
_COUNTED = "lang string, words int, phrase string, n long"


@dataclass
class Block:
    """Words of some texts with their languages; ``stale`` words were counted with an earlier slice."""

    words: list[bytes] = field(default_factory=list)
    runs: list[tuple[str, int]] = field(default_factory=list)
    stale: list[int] = field(default_factory=list)

    def add(self, lang: str, words: list[bytes], led: int) -> None:
        at = len(self.words)
        self.stale.extend(range(at, at + led))
        self.words += words
        self.words.append(_GAP)
        self.runs.append((lang, len(words) + 1))

    def hashes(self) -> list[tuple[int, np.ndarray, np.ndarray]]:
        """For each width: places of the new phrases within pieces, and their hashes (salted by language)."""
        ids = word_ids(self.words)
        inside = ids != _GAP_ID
        fresh = inside.copy()
        fresh[self.stale] = False
        salt = np.repeat(
            np.array([xxhash.xxh3_64_intdigest(lang.encode()) for lang, _ in self.runs], dtype=np.uint64),
            [n for _, n in self.runs],
        )
        found = []
        for width in range(1, LONGEST + 1):
            hashed = window_hashes(ids, width)
            whole = fresh[width - 1 :].copy()
            for k in range(width - 1):
                whole &= inside[k : k + len(whole)]
            at = np.flatnonzero(whole)
            found.append((width, at, hashed[at] ^ salt[at]))
        return found


def pieces(text: bytes) -> bytes:
    """Lower-cased text with the gap mark between pieces."""
    return text.lower().translate(_BREAKS).replace(b"\n", b" " + _GAP + b" ")


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[Block]:
    block = Block()
    for batch in batches:
        for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text")):
            for words, led in word_slices(pieces(text.as_py()), LONGEST - 1):
                if words:
                    block.add(lang, words, led)
                if len(block.words) >= BLOCK_WORDS:
                    yield block
                    block = Block()
    if block.words:
        yield block


def _known(docs: DataFrame) -> DataFrame:
    ship(docs.sparkSession)
    return docs.select(
        F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary").alias("text"),
    )


def _map_blocks(docs: DataFrame, schema: str, rows_of: Callable[[Block], pa.RecordBatch]) -> DataFrame:
    return _known(docs).mapInArrow(lambda batches: map(rows_of, _blocks(batches)), schema)


@dataclass
class Summary:
    """A Misra-Gries summary of keys and counts; ``error`` bounds what any counter has lost."""

    capacity: int
    keys: np.ndarray = field(default_factory=lambda: np.empty(0, dtype=np.uint64))
    counts: np.ndarray = field(default_factory=lambda: np.empty(0, dtype=np.int64))
    error: int = 0

    def merge(self, parts: list[tuple[np.ndarray, np.ndarray]]) -> None:
        """Add counters; beyond the capacity, take off the greatest count that has no room."""
        keys, counts = _added([(self.keys, self.counts), *parts])
        over = len(keys) - self.capacity
        if over > 0:
            off = int(np.partition(counts, over - 1)[over - 1])
            counts -= off
            self.error += off
            keys, counts = keys[counts > 0], counts[counts > 0]
        self.keys, self.counts = keys, counts

    def frequent(self, threshold: int) -> np.ndarray:
        """All keys whose count may reach the threshold."""
        return self.keys[self.counts + self.error >= threshold]


def _to_planes(keys: np.ndarray, width: int) -> bytes:
    """The low ``width`` bits of sorted keys, byte by byte, which compresses well."""
    low = keys & np.uint64((1 << width) - 1)
    return low.astype("<u8").view(np.uint8).reshape(-1, 8)[:, : -(-width // 8)].T.tobytes()


def _from_planes(data: bytes, width: int) -> np.ndarray:
    planes = np.frombuffer(data, dtype=np.uint8).reshape(-(-width // 8), -1)
    full = np.zeros((planes.shape[1], 8), dtype=np.uint8)
    full[:, : len(planes)] = planes.T
    return full.view("<u8").ravel().astype(np.uint64)


def _dealt(keys: np.ndarray, counts: np.ndarray, width: int, threshold: int) -> pa.RecordBatch:
    """Sorted keys by hash partition (their bits above ``width``) with counts up to the threshold."""
    counts = np.minimum(counts, threshold)
    parts, starts = np.unique(keys >> np.uint64(width), return_index=True)
    cuts = [slice(a, b) for a, b in zip(starts, [*starts[1:], len(keys)])]
    return pa.RecordBatch.from_arrays(
        [
            pa.array(parts.astype(np.int32)),
            pa.array([_to_planes(keys[c], width) for c in cuts], type=pa.binary()),
            pa.array([counts[c].astype("<u2").tobytes() for c in cuts], type=pa.binary()),
        ],
        names=["part", "keys", "counts"],
    )


_SUMMED = "part int, keys binary, counts binary"


def _read(row: dict, width: int) -> tuple[np.ndarray, np.ndarray]:
    return _from_planes(row["keys"], width), np.frombuffer(row["counts"], dtype="<u2").astype(np.int64)


def _added(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    keys, place = np.unique(np.concatenate([k for k, _ in parts]), return_inverse=True)
    return keys, np.bincount(place, weights=np.concatenate([n for _, n in parts])).astype(np.int64)


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for k in range(batch.num_rows):
            yield {name: batch.column(name)[k].as_py() for name in batch.schema.names}


def _by_part(blocks: DataFrame, bits: int) -> DataFrame:
    return blocks.repartition(1 << bits, "part").sortWithinPartitions("part")


def _finer(blocks: DataFrame, bits: int, width: int, finer: int, threshold: int) -> DataFrame:
    """Blocks of partitions by ``bits`` bits, with ``width`` left, combined and dealt out by ``finer`` bits instead."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for row in _rows(batches):
            keys, counts = _read(row, width)
            held.append((keys | np.uint64(row["part"] << width), counts))
            size += len(keys)
            if size >= BLOCK_WORDS * LONGEST:
                yield _dealt(*_added(held), width - finer + bits, threshold)
                held, size = [], 0
        if size:
            yield _dealt(*_added(held), width - finer + bits, threshold)

    return _by_part(blocks, bits).mapInArrow(run, _SUMMED)


def _summed(docs: DataFrame, bits: int, threshold: int, level_bits: int) -> DataFrame:
    """Keys and counts of blocks of text by hash partition of ``bits`` bits.

    A block is dealt to 2**``level_bits`` partitions at most; more are reached level by level, so that the rows of
    every level hold many keys.
    """
    shift = np.uint64(64 - KEY_BITS - bits)
    level = min(bits, level_bits)
    width = KEY_BITS + bits - level

    def rows_of(block: Block) -> pa.RecordBatch:
        hashed = np.concatenate([h for _, _, h in block.hashes()])
        return _dealt(*np.unique(hashed >> shift, return_counts=True), width, threshold)

    blocks = _map_blocks(docs, _SUMMED, rows_of)
    while level < bits:
        finer = min(bits, level + level_bits)
        blocks = _finer(blocks, level, width, finer, threshold)
        level, width = finer, width - finer + level
    return blocks


def _summary(rows: list[dict], threshold: int) -> Summary:
    """The summary of one hash partition; its blocks are read first for their mass, then merged."""
    mass = sum(int(np.frombuffer(row["counts"], dtype="<u2").sum(dtype=np.int64)) for row in rows)
    summary = Summary(ROOM * mass // threshold + 1)
    held, size = [], 0
    for row in rows:
        held.append(_read(row, KEY_BITS))
        size += len(held[-1][0])
        if size > summary.capacity:
            summary.merge(held)
            held, size = [], 0
    summary.merge(held)
    return summary


def _survivors(blocks: DataFrame, bits: int, threshold: int) -> DataFrame:
    """Keys that may be frequent, from one summary per hash partition.

    A partition is a hash's share of about ``PARTITION_BYTES`` of text, so its blocks can be held.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, rows in groupby(_rows(batches), itemgetter("part")):
            keys = _summary(list(rows), threshold).frequent(threshold) | np.uint64(part << KEY_BITS)
            yield pa.RecordBatch.from_arrays([pa.array(signed(keys))], names=["key"])

    return _by_part(blocks, bits).mapInArrow(run, "key long")


def _places(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two hashes of 31 bits for a key's bits in the map."""
    hashed = mix(keys)
    return (hashed >> np.uint64(33)).astype(np.int64), (hashed & np.uint64(0x7FFFFFFF)).astype(np.int64)


def _bit_map(survivors: DataFrame) -> np.ndarray:
    """Bit map of the survivors: as many bits as their count asks for, within a fixed bound."""
    count = survivors.count()
    size = 64
    while size < min(MAP_BITS_MOST, MAP_BITS_EACH * count):
        size *= 2

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column("key").to_numpy().view(np.uint64)
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(_places(keys)) & (size - 1))], names=["bit"])

    bits = survivors.mapInArrow(run, "bit long")
    value = F.expr("shiftleft(1L, CAST(bit & 63 AS INT))")
    words = bits.groupBy(F.shiftright("bit", 6).alias("word")).agg(F.bit_or(value).alias("set"))
    table = words.toArrow()
    full = np.zeros(size // 64, dtype=np.int64)
    full[table.column("word").to_numpy()] = table.column("set").to_numpy()
    return full.view(np.uint64)


def _marked(bit_map: np.ndarray, keys: np.ndarray) -> np.ndarray:
    found = np.ones(len(keys), dtype=bool)
    for place in _places(keys):
        place &= 64 * len(bit_map) - 1
        found &= (bit_map[place >> 6] >> (place & 63).astype(np.uint64)) & np.uint64(1) == 1
    return found


def counted(
    docs: DataFrame, threshold: int = THRESHOLD, partition_bytes: int = PARTITION_BYTES, level_bits: int = LEVEL_BITS
) -> DataFrame:
    """``lang, words, phrase, n`` of every phrase of up to ``LONGEST`` words that occurs at least ``threshold`` times.

    A row without phrase (zero words) per language holds the number of all its words.
    """
    size = docs.agg(F.sum(F.octet_length(F.col("text").cast("string")))).first()[0] or 0
    bits = min(62 - KEY_BITS, max(0, -(-size // partition_bytes) - 1).bit_length())
    blocks = _summed(docs, bits, threshold, level_bits)
    survivors = durable(_survivors(blocks, bits, threshold))
    shared = docs.sparkSession.sparkContext.broadcast(_bit_map(survivors))
    shift = np.uint64(64 - KEY_BITS - bits)

    def rows_of(found: dict[str, Counter], totals: Counter) -> pa.RecordBatch:
        langs = [lang for lang, counter in found.items() for _ in counter]
        phrase = [p for counter in found.values() for p in counter]
        columns = [
            pa.array(langs + list(totals), type=pa.string()),
            pa.array([p.count(b" ") + 1 for p in phrase] + [0] * len(totals), type=pa.int32()),
            pa.array(phrase + [None] * len(totals), type=pa.binary()).cast(pa.string()),
            pa.array([n for c in found.values() for n in c.values()] + list(totals.values()), type=pa.int64()),
        ]
        return pa.RecordBatch.from_arrays(columns, names=["lang", "words", "phrase", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, totals = defaultdict(Counter), Counter()
        for block in _blocks(batches):
            ends = np.cumsum([n for _, n in block.runs])
            for width, at, hashed in block.hashes():
                marked = _marked(shared.value, hashed >> shift)
                for k, (lang, n) in enumerate(block.runs):
                    inside = slice(*np.searchsorted(at, (ends[k] - n, ends[k])))
                    if width == 1:
                        totals[lang] += inside.stop - inside.start
                    places = at[inside][marked[inside]].tolist()
                    found[lang].update([b" ".join(block.words[i : i + width]) for i in places])
            if sum(map(len, found.values())) >= HELD_PHRASES:
                yield rows_of(found, totals)
                found, totals = defaultdict(Counter), Counter()
        if found:
            yield rows_of(found, totals)

    each = _known(docs).mapInArrow(run, _COUNTED)
    return each.groupBy("lang", "words", "phrase").agg(F.sum("n").alias("n")).where(
        (F.col("n") >= threshold) | (F.col("words") == 0)
    )


def _part(start, length):
    return F.array_join(F.slice("parts", start, length), " ")


def collocations(
    docs: DataFrame, threshold: int = THRESHOLD, top: int = TOP, partition_bytes: int = PARTITION_BYTES,
    level_bits: int = LEVEL_BITS,
) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score`` of each language's first ``top`` phrases of ``docs(lang, text)``.

    ``a`` counts the phrase, ``l`` and ``r`` the parts of its lowest-scoring cut, ``n`` the language's words; the
    score is ``floor(1000000 a a / (l r))``, computed exactly.

    - A null text is empty, a null language ``und``; a text without words adds nothing.
    - Texts of any length are read in slices that overlap, so no phrase is lost or counted twice at an edge.
    - Repeated rows count each time; ties go by count, then by phrase in byte order; equal cuts to the shorter head.
    - An empty table, or one without frequent phrases, gives an empty result.
    - Other columns are ignored, whatever their names.
    """
    counts = durable(counted(docs, threshold, partition_bytes, level_bits))
    phrases = counts.where("words > 0").select("lang", "phrase", F.col("n").alias("a"))
    total = counts.where("words = 0").select("lang", "n")
    long = counts.where("words > 1").select("lang", "phrase", "words", F.col("n").alias("a"))
    long = long.withColumn("parts", F.split("phrase", " "))
    cut = long.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("words") - 1)))
    cut = cut.select("lang", "phrase", "a", "k", _part(F.lit(1), F.col("k")).alias("head"),
                     _part(F.col("k") + 1, F.col("words") - F.col("k")).alias("rest"))
    left = phrases.select("lang", F.col("phrase").alias("head"), F.col("a").alias("l"))
    right = phrases.select("lang", F.col("phrase").alias("rest"), F.col("a").alias("r"))
    whole = "CAST({} AS DECIMAL(15, 0))".format
    score = F.expr(f"(CAST(1000000 AS DECIMAL(7, 0)) * ({whole('a')} * {whole('a')})) div ({whole('l')} * {whole('r')})")
    scored = cut.join(left, ["lang", "head"]).join(right, ["lang", "rest"]).withColumn("score", score)
    lowest = scored.groupBy("lang", "phrase").agg(
        F.first("a").alias("a"), F.min(F.struct("score", "k", "l", "r")).alias("cut")
    )
    inner = long.where("words > 2").select("lang", "a", "parts", "words").withColumn(
        "size", F.explode(F.sequence(F.lit(2), F.col("words") - 1))
    ).withColumn("at", F.explode(F.sequence(F.lit(1), F.col("words") - F.col("size") + 1)))
    around = inner.select("lang", _part(F.col("at"), F.col("size")).alias("phrase"), "a")
    around = around.groupBy("lang", "phrase").agg(F.max("a").alias("around"))
    left_over = lowest.join(around, ["lang", "phrase"], "left").where(
        F.coalesce(100 * F.col("around") < ABSORBED * F.col("a"), F.lit(True))
    )
    order = Window.partitionBy("lang").orderBy(F.desc("cut.score"), F.desc("a"), "phrase")
    ranked = left_over.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return ranked.join(total, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "cut.l", "cut.r", "n", "cut.score"
    )
