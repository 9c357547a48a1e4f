"""SimHash near duplicates: a byte-position inverted index with count filtering.

Fingerprints that differ in at most ``BITS`` = 3 of 64 bits differ in at most three of their eight bytes, so they
share at least ``SHARED`` = 5 bytes at equal positions, and three among any six positions.  The index therefore
lists fingerprints under every three bytes of the first six positions (20 lists per fingerprint).  In a list the
shared positional bytes of each pair are tallied, pairs with fewer than five are put aside, and the others are
verified bit by bit.

A list of more than ``LONG_LIST`` fingerprints is counted before anything is moved, and its members go to finer lists
instead, under two more shared bytes.  Five bytes leave 2**24 different fingerprints, which bounds a list; long ones
look up the 2,324 neighbours of each member in a table of that size, so no list costs the square of its length.
Lists emit the links of a spanning forest, not pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.components import connected_components
from ledgerloom.llm.slices import SLICE, word_slices
from ledgerloom.llm.words import id_and_bytes, map_batches, ship, signed
from ledgerloom.scale import broadcast_if_small, durable

WIDTH = 3
SEED = 42
BITS = 3
#: Bytes at equal positions that two linked fingerprints share at least.
SHARED = 8 - BITS
#: Members of a list that are compared pair by pair; longer lists are made finer.
LONG_LIST = 2048
#: Postings a task is meant to hold.
TASK_ROWS = 1_000_000

_LOW_BYTES = np.uint64(0x0101010101010101)
_PAIR_BLOCK = 1 << 20


def _mask(positions: tuple[int, ...]) -> int:
    """Signed 64-bit mask of the bytes at ``positions``."""
    value = sum(0xFF << (8 * p) for p in positions)
    return value - (1 << 64) if value >= 1 << 63 else value


#: Three of the first six positions, and five of all eight.
COARSE = [_mask(p) for p in combinations(range(8 - BITS + 1), SHARED - 2)]
FINE = [_mask(p) for p in combinations(range(8), SHARED)]


def fingerprint_of(text: bytes, size: int = SLICE) -> int:
    """SimHash of the 3-word shingles (repeats included) of a lower-cased text; zero without words."""
    ones, total = np.zeros(64, dtype=np.int64), 0
    for words, led in word_slices(text, WIDTH - 1, size):
        if len(words) < WIDTH:
            continue
        shingles = map(b" ".join, zip(words, words[1:], words[2:]))
        hashes = np.fromiter(
            map(xxhash.xxh64_intdigest, shingles, repeat(SEED)), dtype=">u8", count=len(words) - WIDTH + 1
        )
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
        total += len(hashes)
    if not total:
        words = text.split()
        return xxhash.xxh64_intdigest(b" ".join(words), SEED) if words else 0
    return int.from_bytes(np.packbits(2 * ones > total).tobytes(), "big")


def fingerprints(docs: DataFrame) -> DataFrame:
    """``(doc_id, fingerprint)`` of every row; the fingerprint is a signed long."""

    def rows_of(batch: pa.RecordBatch) -> dict:
        prints = np.fromiter(
            (fingerprint_of(t.as_py().lower()) for t in batch.column("text")), dtype=np.uint64, count=batch.num_rows
        )
        return {"doc_id": batch.column("doc_id"), "fingerprint": signed(prints)}

    return map_batches(id_and_bytes(docs), "doc_id long, fingerprint long", rows_of)


def _spread(key: int, prints: np.ndarray) -> np.ndarray:
    """The free three bytes of fingerprints that agree in the bytes of a fine mask ``key``, as numbers below 2**24."""
    free = [p for p in range(8) if not (key >> (8 * p)) & 0xFF]
    code = np.zeros(len(prints), dtype=np.int64)
    for place, p in enumerate(free):
        code |= ((prints >> np.uint64(8 * p)) & np.uint64(0xFF)).astype(np.int64) << (8 * place)
    return code


def _unite(root: np.ndarray, left: np.ndarray, right: np.ndarray) -> None:
    """Join the trees of each pair; the least member stays the root."""
    while len(left):
        a, b = root[left], root[right]
        apart = a != b
        if not apart.any():
            return
        left, right, a, b = left[apart], right[apart], a[apart], b[apart]
        np.minimum.at(root, np.maximum(a, b), np.minimum(a, b))
        while True:
            up = root[root]
            if np.array_equal(up, root):
                break
            root[:] = up


def _neighbour_masks() -> Iterator[int]:
    for bits in range(1, BITS + 1):
        for chosen in combinations(range(24), bits):
            yield sum(1 << b for b in chosen)


def link_list(key: int, prints: np.ndarray, longest: int = LONG_LIST) -> tuple[np.ndarray, np.ndarray]:
    """Links of a spanning forest of the members (distinct, unsigned) of the list under mask ``key``."""
    root = np.arange(len(prints))
    if len(prints) > longest and bin(key & (1 << 64) - 1).count("1") == 8 * SHARED:
        code = _spread(key, prints)
        member = np.full(1 << 24, -1, dtype=np.int32)
        member[code] = np.arange(len(prints))
        for mask in _neighbour_masks():
            other = member[code ^ mask]
            here = np.flatnonzero(other > np.arange(len(prints)))
            _unite(root, here, other[here])
    else:
        step = max(1, _PAIR_BLOCK // len(prints))
        for start in range(0, len(prints), step):
            differing = prints[start : start + step, None] ^ prints[None, start:]
            spread = differing | differing >> np.uint64(4)
            spread |= spread >> np.uint64(2)
            spread |= spread >> np.uint64(1)
            tally = 8 - np.bitwise_count(spread & _LOW_BYTES)
            left, right = np.nonzero(tally >= SHARED)
            close = (np.bitwise_count(differing[left, right]) <= BITS) & (left < right)
            _unite(root, start + left[close], start + right[close])
    child = np.flatnonzero(root != np.arange(len(prints)))
    return prints[child], prints[root[child]]


def _longs(values: list[int]) -> Column:
    return F.array(*[F.lit(v).cast("long") for v in values])


def _postings(prints: DataFrame, masks: list[int]) -> DataFrame:
    """One row for each list a fingerprint stands in: the list's mask and bytes, and the fingerprint."""
    each = prints.select("fp", F.explode(_longs(masks)).alias("mask"))
    return each.select("mask", F.col("fp").bitwiseAND(F.col("mask")).alias("bytes"), "fp")


def _link_lists(postings: DataFrame, rows: int, longest: int) -> DataFrame:
    """Links ``(u, v)`` of every list: lists are dealt out whole, sorted, and walked one after the other."""
    conf = postings.sparkSession.conf.get("spark.sql.shuffle.partitions")
    dealt = postings.repartition(max(int(conf), -(-rows // TASK_ROWS)), "mask", "bytes")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def links(key: int, parts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
            members = np.unique(np.concatenate(parts))
            return link_list(key, members, longest) if len(members) > 1 else (members[:0], members[:0])

        def batch_of(found: list) -> pa.RecordBatch:
            u, v = (signed(np.concatenate([f[side] for f in found])) for side in (0, 1))
            return pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], names=["u", "v"])

        held, held_key = [], None
        for batch in batches:
            mask, known, fp = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("mask", "bytes", "fp"))
            fp = fp.view(np.uint64)
            cuts = np.flatnonzero((mask[1:] != mask[:-1]) | (known[1:] != known[:-1])) + 1
            edges, found = [0, *cuts.tolist(), len(fp)], []
            # Lists of one member link nothing; they are most, and are passed over.
            for a, b in zip(edges, edges[1:]):
                key = (int(mask[a]), int(known[a])) if a in (0, edges[-2]) or b - a > 1 else None
                if key is None:
                    continue
                if held_key is not None and key != held_key:
                    found.append(links(held_key[0], held))
                    held, held_key = [], None
                if b == len(fp) or key == held_key:
                    held.append(fp[a:b])
                    held_key = key
                elif b - a > 1:
                    found.append(links(key[0], [fp[a:b]]))
            if found:
                yield batch_of(found)
        if held_key is not None:
            yield batch_of([links(held_key[0], held)])

    ship(postings.sparkSession)
    return dealt.sortWithinPartitions("mask", "bytes", "fp").mapInArrow(run, "u long, v long")


def links(prints: DataFrame, longest: int = LONG_LIST) -> DataFrame:
    """Links ``(u, v)`` that connect whatever fingerprints of ``prints(fp)`` (distinct) are within ``BITS`` bits."""
    rows = prints.count() * len(COARSE)
    coarse = _postings(prints, COARSE)
    counted = coarse.groupBy("mask", "bytes").agg(F.count(F.lit(1)).alias("n"))
    long_lists = durable(counted.where(F.col("n") > longest).select("mask", "bytes"))
    if long_lists.isEmpty():
        return _link_lists(coarse, rows, longest).distinct()
    hot = broadcast_if_small(long_lists)
    short = coarse.join(hot, ["mask", "bytes"], "left_anti")
    members = coarse.join(hot, ["mask", "bytes"], "left_semi")
    fit = F.filter(_longs(FINE), lambda m: m.bitwiseAND(F.col("mask")) == F.col("mask"))
    fine = members.select("fp", F.explode(fit).alias("mask")).distinct()
    fine = fine.select("mask", F.col("fp").bitwiseAND(F.col("mask")).alias("bytes"), "fp")
    both = _link_lists(short, rows, longest).union(_link_lists(fine, rows, longest))
    return both.distinct()


def near_duplicates(docs: DataFrame, longest: int = LONG_LIST) -> DataFrame:
    """``doc_id, fingerprint, component_id`` of every row of ``docs(doc_id, text)``.

    ``component_id`` is the smallest ``doc_id`` reachable over links of at most three differing bits.

    - A null or empty text, or one of white space, has fingerprint zero and is linked like any other.
    - A row without ``doc_id`` keeps its row; it links, but names no component (null if it reaches no id).
    - Rows that repeat a ``doc_id`` or a text keep their rows; equal texts share a fingerprint.
    - Texts of any length are read in slices; ties need no rule; an empty table gives an empty result.
    - Other columns are ignored, whatever their names.
    """
    found = durable(fingerprints(docs).select("doc_id", F.col("fingerprint").alias("fp")))
    least = durable(found.groupBy("fp").agg(F.min("doc_id").alias("least")))
    component = connected_components(links(least.select("fp"), longest)).withColumnRenamed("node", "fp")
    member = least.join(component, "fp")
    first = member.groupBy("component").agg(F.min("least").alias("first"))
    linked = member.join(first, "component").select("fp", "first")
    named = least.join(linked, "fp", "left").select("fp", F.coalesce("first", "least").alias("component_id"))
    fingerprint = F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint")
    return found.join(named, "fp").select("doc_id", fingerprint, "component_id")
