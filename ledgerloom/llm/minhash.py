"""Near-duplicate documents: many universal-hash minima, banding, verification on full sets, components.

A document is the set of its distinct five-word shingles.  Documents with the same set form a class and one
of them, the class representative, stands for it, so copies never become pairs.  Representatives that share
a band of their signature are compared in two steps, both free of all-pairs output:

1. in each bucket every member meets the bucket's least member;
2. buckets whose members are still in different components compare the members outside the bucket's largest
   component with the whole bucket, in blocks of bounded size.

After step 2 any two members of a bucket are in one component or have been compared, so no link that
connects components is lost.  Bands of ``ROWS`` minima miss a pair at the threshold with probability
(1 - 0.75**4)**40 = 2e-7.  A signature may only drop a pair that is far below the threshold (seven standard
deviations); the link itself is decided on the full sets with integers.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.components import connected_components
from ledgerloom.llm.words import id_and_bytes, map_batches, mix, signed, window_hashes, word_ids
from ledgerloom.scale import durable

WORDS = 5
BANDS = 40
ROWS = 4
#: Estimated similarity below which a pair is not compared in full.
ESTIMATE_FLOOR = 0.5
#: Members of a bucket that one task compares at a time.
BLOCK = 512
#: Most document ids (8 bytes each) that are broadcast to pick texts; beyond it the join shuffles.
SENT_IDS = 4_000_000

_SEEDS = mix(np.arange(1, 2 * BANDS * ROWS + 1, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95))
_MULTIPLY = (_SEEDS[: BANDS * ROWS] | np.uint64(1))[:, None]
_ADD = _SEEDS[BANDS * ROWS :][:, None]
_BAND_MIX = (mix(np.arange(7, 7 + BANDS * ROWS, dtype=np.uint64)) | np.uint64(1)).reshape(BANDS, ROWS)
_BAND_ADD = mix(np.arange(1000, 1000 + BANDS, dtype=np.uint64))


def shingles(text: bytes) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the five-word shingles; fewer words are one shingle; none: empty."""
    words = text.lower().split()
    if not words:
        return np.empty(0, dtype=np.uint64)
    if len(words) < WORDS:
        return np.array([xxhash.xxh3_64_intdigest(b" ".join(words), seed=len(words))], dtype=np.uint64)
    return np.unique(window_hashes(word_ids(words), WORDS))


def minima(hashes: np.ndarray) -> np.ndarray:
    """Minimum of each of the universal hash functions ``(a * x + b) >> 32`` over the set."""
    best = np.full(BANDS * ROWS, np.iinfo(np.uint64).max, dtype=np.uint64)
    for start in range(0, len(hashes), 512):
        block = hashes[start : start + 512]
        np.minimum(best, (_MULTIPLY * block + _ADD).min(axis=1), out=best)
    return best >> np.uint64(32)


def _sketch(batch: pa.RecordBatch) -> dict:
    ids, counts, classes, bands, sketches = [], [], [], [], []
    for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
        found = shingles(text)
        ids.append(doc)
        counts.append(len(found))
        if not len(found):
            classes.append(None)
            bands.append(None)
            sketches.append(None)
            continue
        classes.append(xxhash.xxh3_128_digest(found.tobytes()))
        least = minima(found)
        keys = mix((least.reshape(BANDS, ROWS) * _BAND_MIX).sum(axis=1, dtype=np.uint64) + _BAND_ADD)
        bands.append(signed(keys).tolist())
        sketches.append(mix(least).astype(np.uint8).tobytes())
    return {"doc_id": ids, "n_shingles": counts, "class": classes, "bands": bands, "sketch": sketches}


def sketch(docs: DataFrame) -> DataFrame:
    """Set size, class (digest of the set), band keys and a one-byte-per-hash sketch of each document."""
    return map_batches(
        id_and_bytes(docs), "doc_id long, n_shingles long, class binary, bands array<long>, sketch binary", _sketch
    )


def estimate(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Jaccard estimate of byte sketches (last axis), corrected for chance matches of one byte."""
    return ((left == right).mean(axis=-1) - 1 / 256) / (1 - 1 / 256)


def _likely(batch: pa.RecordBatch) -> dict:
    width = BANDS * ROWS
    sides = [
        np.frombuffer(b"".join(batch.column(name).to_pylist()), dtype=np.uint8).reshape(-1, width)
        for name in ("sketch_a", "sketch_b")
    ]
    near = estimate(*sides) >= ESTIMATE_FLOOR
    a, b = (np.asarray(batch.column(name).to_pylist(), dtype=np.int64)[near] for name in ("a", "b"))
    return {"a": a, "b": b}


def _linked(percent: int):
    def run(batch: pa.RecordBatch) -> dict:
        held: dict[int, np.ndarray] = {}
        out_a, out_b = [], []
        columns = [batch.column(name).to_pylist() for name in ("a", "b", "text_a", "text_b")]
        for a, b, text_a, text_b in zip(*columns, strict=True):
            if a not in held:
                if len(held) > 64:
                    held.clear()
                held[a] = shingles(text_a)
            left, right = held[a], shingles(text_b)
            common = len(np.intersect1d(left, right, assume_unique=True))
            if 100 * common >= percent * (len(left) + len(right) - common):
                out_a.append(a)
                out_b.append(b)
        return {"u": out_a, "v": out_b}

    return run


def _texts_of(texts: DataFrame, ids: DataFrame) -> DataFrame:
    """Texts of the distinct ``ids``; up to ``SENT_IDS`` of them are sent to the texts, so no text is shuffled."""
    sent = F.broadcast(ids) if ids.count() <= SENT_IDS else ids
    return texts.join(sent, "doc_id", "left_semi")


def _verify(pairs: DataFrame, sketches: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """Pairs ``(a, b)`` of representatives whose full sets reach the threshold, as edges ``(u, v)``."""
    left = sketches.select(F.col("doc_id").alias("a"), F.col("sketch").alias("sketch_a"))
    right = sketches.select(F.col("doc_id").alias("b"), F.col("sketch").alias("sketch_b"))
    likely = durable(map_batches(pairs.join(right, "b").join(left, "a"), "a long, b long", _likely))

    wanted = likely.select(F.col("a").alias("doc_id")).union(likely.select(F.col("b").alias("doc_id"))).distinct()
    held = durable(_texts_of(texts, wanted))
    left = held.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a"))
    right = held.select(F.col("doc_id").alias("b"), F.col("text").alias("text_b"))
    return map_batches(likely.join(right, "b").join(left, "a"), "u long, v long", _linked(percent))


def _hopeful(percent: int):
    """Rows of each cell in at least one pair that only the full sets can decide, and on which side."""

    def of_cell(part: dict) -> tuple[np.ndarray, np.ndarray]:
        key, leader, ids, parts, sizes = (part[c] for c in ("key", "leader", "doc_id", "component", "n_shingles"))
        asks, meets = np.zeros(len(ids), dtype=bool), np.zeros(len(ids), dtype=bool)
        usable = part["listed"] & (ids != leader)
        for i in np.flatnonzero(part["asked"] & (ids != leader)):
            least, most = np.minimum(sizes, sizes[i]), np.maximum(sizes, sizes[i])
            others = np.flatnonzero(usable & (parts != parts[i]) & (100 * least >= percent * most))
            if len(others):
                others = others[estimate(part["sketch"][others], part["sketch"][i]) >= ESTIMATE_FLOOR]
            if len(others):
                first = (part["bands"][others] == part["bands"][i]).argmax(axis=1)
                others = others[part["bands"][i][first] == key[i]]
                asks[i] = len(others) > 0
                meets[others] = True
        return asks, meets

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, starts in _whole_cells(batches):
            columns = {c: table[c].to_numpy() for c in _CELL + ["leader", "doc_id", "component", "n_shingles"]}
            columns |= {c: table[c].to_numpy() for c in ("asked", "listed")}
            columns["bands"] = table["bands"].combine_chunks().flatten().to_numpy().reshape(len(table), -1)
            sketched = np.frombuffer(b"".join(table["sketch"].to_pylist()), dtype=np.uint8)
            columns["sketch"] = sketched.reshape(len(table), -1)
            sides = [of_cell({n: v[i:j] for n, v in columns.items()}) for i, j in zip(starts, starts[1:], strict=False)]
            for name, side in ((True, 0), (False, 1)):
                mask = np.concatenate([found[side] for found in sides])
                kept = table.filter(pa.array(mask)).select(_CELL + ["doc_id", "component"])
                yield from kept.append_column("asks", pa.array(np.full(len(kept), name))).to_batches()

    return run


_CELL = ["key", "q", "c"]


def _whole_cells(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Sorted batches cut between cells, with the start of each cell and the end; holds one cell over."""
    held = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        table = table if held is None else pa.concat_tables([held, table])
        if not len(table):
            continue
        names = np.stack([table[c].to_numpy().astype(np.int64) for c in _CELL])
        starts = np.concatenate([[0], 1 + np.flatnonzero((names[:, 1:] != names[:, :-1]).any(axis=0))])
        held = table.slice(starts[-1])
        if len(starts) > 1:
            yield table.slice(0, starts[-1]), starts
    if held is not None and len(held):
        yield held, np.array([0, len(held)])


def _confirmed(percent: int):
    def run(cell: pa.Table) -> pa.Table:
        """Links of the cell on full sets; only those that join parts not joined yet."""
        part: dict[int, int] = {}

        def root(x):
            while part.setdefault(x, x) != x:
                part[x] = part[part[x]]
                x = part[x]
            return x

        sets = [np.frombuffer(data, dtype=np.uint64) for data in cell["shingles"].to_pylist()]
        ids, parts, asks = (cell[c].to_pylist() for c in ("doc_id", "component", "asks"))
        queries = [i for i, one in enumerate(asks) if one]
        listed = [i for i, one in enumerate(asks) if not one]
        out: list[tuple[int, int]] = []
        if queries and listed:
            sizes = np.array([len(one) for one in sets], dtype=np.int64)
            numbered = np.split(np.unique(np.concatenate(sets), return_inverse=True)[1], np.cumsum(sizes)[:-1])
            words = np.concatenate([numbered[k] for k in listed])
            starts = np.concatenate([[0], np.cumsum(sizes[listed])[:-1]])
            flags = np.zeros(max(int(n.max()) for n in numbered) + 1, dtype=np.int32)
            for i in queries:
                flags[numbered[i]] = 1
                common = np.add.reduceat(flags[words], starts).astype(np.int64)
                flags[numbered[i]] = 0
                linked = 100 * common >= percent * (sizes[i] + sizes[listed] - common)
                for k in np.flatnonzero(linked):
                    other = listed[k]
                    if root(parts[i]) != root(parts[other]):
                        part[root(parts[i])] = root(parts[other])
                        out.append((min(ids[i], ids[other]), max(ids[i], ids[other])))
        return pa.table({"u": pa.array([u for u, _ in out], pa.int64()), "v": pa.array([v for _, v in out], pa.int64())})

    return run


def _sets(batch: pa.RecordBatch) -> dict:
    texts = batch.column("text").to_pylist()
    return {"doc_id": batch.column("doc_id"), "shingles": [shingles(text).tobytes() for text in texts]}


def _blocks(members: DataFrame, labels: DataFrame, sketches: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """Links ``(u, v)`` between components that share a bucket, confirmed on full sets within the task.

    A cell holds at most ``BLOCK`` asking and ``BLOCK`` listed members of a bucket.  Cells first see sketches,
    band keys and set sizes only: a pair needs the full sets unless its sizes alone exclude a link, its sketches
    are far apart, or it also shares an earlier band, whose bucket decides it.  Full sets are read for the
    members left.  A task emits a link only if it joins parts that its cell has not joined yet, so links stay
    in proportion to the cell's rows however many pairs it compares.
    """
    labelled = members.where("members > 2").join(
        labels.select(F.col("node").alias("doc_id"), "component"), "doc_id", "left"
    )
    labelled = labelled.select("key", "doc_id", "leader", F.coalesce("component", "doc_id").alias("component"))
    mixed = labelled.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high"))
    mixed = mixed.where("low != high").select("key")
    open_rows = durable(labelled.join(mixed, "key"))
    sizes = open_rows.groupBy("key", "component").agg(F.count(F.lit(1)).alias("size"))
    largest = sizes.groupBy("key").agg(
        F.max(F.struct("size", "component")).alias("top"), F.sum("size").alias("all")
    )
    largest = largest.select(
        "key",
        F.col("top.component").alias("main"),
        F.ceil((F.col("all") - F.col("top.size")) / BLOCK).cast("int").alias("queries"),
        F.ceil(F.col("all") / BLOCK).cast("int").alias("chunks"),
    )
    place = F.xxhash64("doc_id", "key")
    rows = open_rows.join(largest, "key").withColumn("outside", F.col("component") != F.col("main"))
    own = ["key", "doc_id", "leader", "component"]
    q, c = F.pmod(place, F.col("queries")).cast("int"), F.pmod(place, F.col("chunks")).cast("int")
    small, no, yes = F.col("chunks") == 1, F.lit(False), F.lit(True)
    # A bucket of one cell sends each member once, in both roles.
    cells = rows.where(small).select(
        *own, F.lit(0).alias("q"), F.lit(0).alias("c"), F.col("outside").alias("asked"), yes.alias("listed")
    )
    asking = rows.where(~small & F.col("outside")).select(
        *own, q.alias("q"), F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("c"),
        yes.alias("asked"), no.alias("listed"),
    )
    listing = rows.where(~small).select(
        *own, F.explode(F.sequence(F.lit(0), F.col("queries") - 1)).alias("q"), c.alias("c"),
        no.alias("asked"), yes.alias("listed"),
    )
    needed = durable(sketches.join(open_rows.select("doc_id").distinct(), "doc_id", "left_semi"))
    cells = cells.union(asking).union(listing).join(needed, "doc_id")
    wanted = durable(
        cells.repartition(*_CELL).sortWithinPartitions(*_CELL).mapInArrow(
            _hopeful(percent), "key long, q int, c int, doc_id long, component long, asks boolean"
        )
    )
    held = _texts_of(texts, wanted.select("doc_id").distinct()).dropDuplicates(["doc_id"])
    held = durable(map_batches(held, "doc_id long, shingles binary", _sets))
    return wanted.join(held, "doc_id").groupBy(*_CELL).applyInArrow(
        _confirmed(percent), "u long, v long"
    ).distinct()


def near_duplicates(docs: DataFrame, percent: int = 75) -> DataFrame:
    """One row per document: ``doc_id, n_shingles, component_id, kept``.

    ``doc_id`` identifies a document; other columns of ``docs`` are ignored.  Null or blank texts have no
    shingles, link with nothing and are their own component.  Rows that repeat a ``doc_id`` are one node.
    A null ``doc_id`` belongs to the component of an equal set if there is one, else its component is null;
    such a row is never kept.  An empty table gives no rows.
    """
    rows = durable(sketch(docs))
    shown = rows.where("class is not null")
    classes = durable(shown.groupBy("class").agg(F.min("doc_id").alias("rep")).where("rep is not null"))
    reps = durable(
        shown.join(classes.select("class", F.col("rep").alias("doc_id")), ["class", "doc_id"], "left_semi")
        .select("doc_id", "n_shingles", "bands", "sketch")
    )
    banded = reps.select("doc_id", F.explode("bands").alias("key"))
    buckets = banded.groupBy("key").agg(F.min("doc_id").alias("leader"), F.count(F.lit(1)).alias("members"))
    members = durable(banded.join(buckets.where("members > 1"), "key"))

    texts = id_and_bytes(docs)
    pairs = members.where("doc_id != leader").select(F.col("leader").alias("a"), F.col("doc_id").alias("b"))
    edges = durable(_verify(pairs.distinct(), reps, texts, percent))
    labels = durable(connected_components(edges))
    more = durable(_blocks(members, labels, reps, texts, percent))
    if not more.isEmpty():
        labels = durable(connected_components(durable(edges.union(more))))

    named = classes.join(labels.withColumnRenamed("node", "rep"), "rep", "left").select(
        "class", F.coalesce("component", "rep").alias("component")
    )
    return (
        rows.join(named, "class", "left")
        .withColumn("component_id", F.coalesce("component", "doc_id"))
        .select("doc_id", "n_shingles", "component_id",
                F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False)).alias("kept"))
    )
