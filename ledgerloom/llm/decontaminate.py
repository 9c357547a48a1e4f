"""Benchmark decontamination by latent semantic retrieval.

Documents and benchmark items are TF-IDF vectors of hashed words; document frequencies cover all documents.
A randomised singular value decomposition of the benchmark passages gives latent spaces: Gaussian test
vectors that any task can make again from a seed, power rounds as grouped sums in Spark, and small dense algebra
on the driver.  A space has half as many columns as items (``RANK`` at most), so words that occur together share
columns.  Every window of every document is projected by running sums; it is a candidate for the items whose
projection it meets with ``COSINE`` of the cosine that the item itself would have, and with a cosine of ``COSINE``
within the space.  The first keeps the norm of the whole window, so a window of other words is far from every item.

Rare words around an item of common words hide it from any cosine, so near copies have a path of their own: a run
that holds ``COVERED`` of an item's words holds a known number of the item's rarest words.  Postings of those words
alone give the places where so many stand close; no item is tested against text without them.  A candidate is
contaminated if the longest common subsequence of words covers enough of the item and of its answer (a column, or
else the item's last quarter), which finds paraphrases with words changed, left out or put in.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from functools import reduce
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm.words import id_and_bytes, map_batches, mix, word_ids
from ledgerloom.scale import durable

BITS = 18
#: Columns of a latent space, at most.
RANK = 128
#: Items of a latent space.
SPACE_ITEMS = 256
#: Latent spaces of one pass over the documents; more items take more passes.
SPACES = 8
#: Words of a pass's items, but for one longer item alone: with ``RANK`` floats a word its model has 64 MB at most.
PASS_WORDS = 1 << 17
POWER_ROUNDS = 2
COSINE = 0.5
COVERED = 0.7
#: Part of an item's words that a near copy must have among the item's rarest.
RARE = 0.25
ANSWER = 0.5
#: Weight of a term that every document has.
FLOOR = 0.1
#: Words of a block; windows are whole blocks.
BLOCK = 8
#: Words that are projected at a time.
GROUP_WORDS = 1 << 15
#: ASCII letters are lower-cased, other visible ASCII but digits separates words.
_WORDS = bytes(c if c >= 128 or chr(c).isalnum() and not chr(c).isupper() else ord(chr(c).lower())
               if chr(c).isalpha() else 32 for c in range(256))


def words_of(text: bytes) -> list[bytes]:
    return text.translate(_WORDS).split()


def terms(words: list[bytes]) -> np.ndarray:
    return (word_ids(words) >> np.uint64(64 - BITS)).astype(np.int64)


def document_frequencies(docs: DataFrame) -> tuple[np.ndarray, int]:
    """Documents per hashed term and number of documents, over the whole table."""

    def count(batch: pa.RecordBatch) -> dict:
        split = [words_of(text) for text in batch.column("text").to_pylist()]
        document = np.repeat(np.arange(len(split)), [len(words) for words in split])
        both = np.sort(document << BITS | terms(list(chain.from_iterable(split))))
        once = both[np.diff(both, prepend=-1) != 0] & ((1 << BITS) - 1)
        totals = np.bincount(once, minlength=1 << BITS)
        used = np.flatnonzero(totals)
        return {"term": used, "n": totals[used]}

    grouped = map_batches(id_and_bytes(docs).select("text"), "term int, n long", count).groupBy("term")
    table = grouped.agg(F.sum("n").alias("n")).toArrow()  # at most 2**BITS rows
    frequency = np.zeros(1 << BITS, dtype=np.int64)
    frequency[table["term"].to_numpy()] = table["n"].to_numpy()
    return frequency, docs.count()


def inverse_frequencies(frequency: np.ndarray, total: int) -> np.ndarray:
    """Weights of the hashed terms; a term of every document still weighs ``FLOOR``."""
    return (np.log((total + 1) / (frequency + 1)) + FLOOR).astype(np.float32)


def test_vectors(term: np.ndarray, rank: int) -> np.ndarray:
    """Gaussian row per term, made from the term's number alone."""
    column = np.arange(rank, dtype=np.uint64)
    seeds = mix(term.astype(np.uint64)[:, None] * np.uint64(0x9E3779B97F4A7C15) + column)
    u = ((seeds >> np.uint64(11)).astype(np.float64) + 0.5) / 2**53
    v = ((mix(seeds) >> np.uint64(11)).astype(np.float64) + 0.5) / 2**53
    return np.sqrt(-2 * np.log(u)) * np.cos(2 * np.pi * v)


def unit(vector: np.ndarray) -> np.ndarray:
    norm = np.sqrt(vector @ vector)
    return vector / norm if norm > 0 else vector


def item_vectors(items: DataFrame, idf) -> DataFrame:
    """Unit TF-IDF vector per item: ``item_id, terms, weights``; items without words are left out.

    The number of the item's space stands above the ``BITS`` bits of a term.
    """

    def run(batch: pa.RecordBatch) -> dict:
        out: dict[str, list] = {"item_id": [], "terms": [], "weights": []}
        columns = (batch.column(c).to_pylist() for c in ("item_id", "space", "text"))
        for item, space, text in zip(*columns, strict=True):
            found, n = np.unique(terms(words_of(text)), return_counts=True)
            if len(found):
                out["item_id"].append(item)
                out["terms"].append(space << BITS | found)
                out["weights"].append(unit(n * idf.value[found].astype(np.float64)))
        return out

    return map_batches(items, "item_id long, terms array<int>, weights array<double>", run)


def orthonormal(basis: np.ndarray, names: np.ndarray) -> np.ndarray:
    """Orthonormal columns for each space by itself; a space of fewer terms than columns leaves the rest zero."""
    out = np.zeros_like(basis)
    for rows in np.split(np.arange(len(names)), np.flatnonzero(np.diff(names >> BITS)) + 1):
        columns, _ = np.linalg.qr(basis[rows])
        out[rows, : columns.shape[1]] = columns
    return out


def latent_space(vectors: DataFrame, rank: int = RANK, rounds: int = POWER_ROUNDS) -> tuple[np.ndarray, np.ndarray]:
    """``(terms, basis)``: right singular vectors (one row per term of the passages) by randomised SVD.

    A round multiplies by the passage matrix and its transpose: each task sums the outer products of its
    passages by term, Spark adds the sums.  The basis has a row per space and distinct benchmark term.
    """
    spark = vectors.sparkSession
    names = np.array(sorted(r[0] for r in vectors.select(F.explode("terms")).distinct().collect()), dtype=np.int64)
    rank = max(1, min(rank, vectors.count(), len(names)))
    basis = test_vectors(names, rank)
    for _ in range(rounds + 1):
        basis = orthonormal(basis, names)
        shared = spark.sparkContext.broadcast(basis)

        def multiply(batch: pa.RecordBatch, shared=shared) -> dict:
            held, total = shared.value, {}
            for found, weights in zip(batch.column("terms").to_pylist(), batch.column("weights").to_pylist(), strict=True):
                at, weight = np.searchsorted(names, found), np.array(weights)
                side = weight @ held[at]
                for k, w in zip(at.tolist(), weight, strict=True):
                    total[k] = total.get(k, 0.0) + w * side
            return {"term": list(total), "sums": list(total.values())}

        partial = map_batches(vectors, "term int, sums array<double>", multiply)
        added = (
            partial.select("term", F.posexplode("sums").alias("column", "value"))
            .groupBy("term", "column").agg(F.sum("value").alias("value"))
            .groupBy("term").agg(F.transform(F.sort_array(F.collect_list(F.struct("column", "value"))),
                                             lambda x: x["value"]).alias("sums"))
        )
        rows = added.toArrow()
        basis = np.zeros_like(basis)
        flat = rows["sums"].combine_chunks().flatten().to_numpy()
        basis[rows["term"].to_numpy()] = flat.reshape(-1, basis.shape[1])
    return names, orthonormal(basis, names)


def common_subsequence(item: list, part: list) -> list[bool]:
    """Which words of ``item`` a longest common subsequence with ``part`` covers."""
    n, m = len(item), len(part)
    best = np.zeros((n + 1, m + 1), dtype=np.int32)
    other = np.array(part)
    for i in range(n - 1, -1, -1):
        # best[i, j] = max over k >= j of (match at k) + best[i + 1, k + 1], or best[i + 1, j]
        hit = np.where(other == item[i], best[i + 1, 1:] + 1, best[i + 1, :-1])
        best[i, :-1] = np.maximum.accumulate(hit[::-1])[::-1]
    covered, i, j = [False] * n, 0, 0
    while i < n and j < m:
        if item[i] == part[j] and best[i, j] == best[i + 1, j + 1] + 1:
            covered[i] = True
            i, j = i + 1, j + 1
        elif best[i + 1, j] >= best[i, j + 1]:
            i += 1
        else:
            j += 1
    return covered


def _sums(space: dict, ids: np.ndarray, block: np.ndarray, total: int) -> np.ndarray:
    """Running sums over blocks of the words' rows in latent space, a row for each column."""
    row = space["row_of"][ids]
    known = np.flatnonzero(row >= 0)
    row, block = row[known], block[known]
    sums = np.zeros((len(space["columns"]), total + 1))
    for at, column in enumerate(space["columns"]):
        np.cumsum(np.bincount(block, weights=column[row], minlength=total), out=sums[at, 1:])
    return sums


def _latent(model: dict, documents: list[np.ndarray]) -> Iterator[tuple[int, int, int, int, float]]:
    """Candidates ``(document, item, from, to, cosine)``, in words, of the terms of several documents.

    The documents are laid out in blocks of ``BLOCK`` words with empty blocks between them, so that no window
    sees two of them.  Blocks are summed once in latent space, windows are differences of running sums.
    """
    lengths = np.array([len(d) for d in documents])
    gap = int(model["blocks"].max())
    rooms = -(-lengths // BLOCK) + gap
    first = np.cumsum(rooms) - rooms + gap
    total = int(rooms.sum()) + gap
    ids = np.concatenate(documents)
    place = np.arange(len(ids)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    block = np.repeat(first, lengths) + place // BLOCK
    norm = np.bincount(block, weights=model["idf"][ids].astype(np.float64) ** 2, minlength=total)
    norms = np.concatenate(([0.0], np.cumsum(norm)))
    for space in model["spaces"]:
        sums = _sums(space, ids, block, total)
        for width in np.unique(model["blocks"][space["items"]]).tolist():
            items = space["items"][model["blocks"][space["items"]] == width]
            length = np.sqrt(np.maximum(norms[width:] - norms[:-width], FLOOR**2))
            part = sums[:, width:] - sums[:, :-width]
            # No cosine is above the window's own share in the space.
            least = (COSINE * model["kept"][items].min() * length) ** 2
            own = np.einsum("ij,ij->j", part, part)
            near = np.flatnonzero(own >= least * (1 - 1e-9))
            cosine = part[:, near].T @ model["vectors"][items, : len(part)].T / length[near, None]
            inside = COSINE * np.sqrt(own[near]) / length[near]
            window, item = np.nonzero(cosine >= np.maximum(inside[:, None], COSINE * model["kept"][items]))
            found, window = cosine[window, item], near[window]
            owner = np.searchsorted(first - gap, window, side="right") - 1
            # A window that begins in the gap before the next document belongs to that document.
            owner += (window + width > first[np.minimum(owner + 1, len(first) - 1)]) & (owner + 1 < len(first)) & (
                window >= first[owner] + rooms[owner] - gap)
            begin = np.maximum(0, (window - first[owner]) * BLOCK - 2)
            end = np.minimum(lengths[owner], (window - first[owner] + width) * BLOCK + 2)
            yield from zip(*(x.tolist() for x in (owner, items[item], begin, end, found)), strict=True)


def _near_copies(model: dict, documents: list[np.ndarray]) -> Iterator[tuple[int, int, int, int]]:
    """Stretches ``(document, item, from, to)`` that can hold a run with ``COVERED`` of the item's words.

    The places of the items' rarest words are sorted by item and place; where as many as a near copy must have
    stand within one run, every run over them belongs to the stretch.
    """
    rare = model["rare"]
    lengths = np.array([len(d) for d in documents])
    ids = np.concatenate(documents)
    # Documents stand further apart than any run is long.
    first = np.cumsum(lengths + int(rare["room"].max())) - lengths
    place = np.arange(len(ids)) + np.repeat(first - (np.cumsum(lengths) - lengths), lengths)
    known = np.flatnonzero(rare["count"][ids])
    n = rare["count"][ids[known]]
    inner = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
    item = rare["items"][np.repeat(rare["from"][ids[known]], n) + inner]
    both = np.sort(item.astype(np.int64) << 40 | np.repeat(place[known], n))
    item, place = both >> 40, both & ((1 << 40) - 1)
    last = np.arange(len(item)) + rare["least"][item] - 1
    inside = np.flatnonzero(last < len(item))
    last = last[inside]
    close = (item[last] == item[inside]) & (place[last] - place[inside] < rare["room"][item[inside]])
    inside, last = inside[close], last[close]
    if not len(inside):
        return
    item, room = item[inside], rare["room"][item[inside]]
    begin, end = place[last] - room + 1, place[inside] + room
    new = np.flatnonzero((np.diff(item, prepend=-1) != 0) | (begin > np.concatenate(([-1], end[:-1]))))
    begin, end, item = begin[new], end[np.append(new[1:], len(end)) - 1], item[new]
    # The stretch's first known place tells its document.
    owner = np.searchsorted(first, place[inside[new]], side="right") - 1
    begin, end = np.maximum(0, begin - first[owner]), np.minimum(lengths[owner], end - first[owner])
    yield from zip(*(x.tolist() for x in (owner, item, begin, end)), strict=True)


def _groups(texts: Iterator[bytes], overlap: int) -> Iterator[list[tuple[int, int, list[bytes]]]]:
    """Slices ``(document, first word, words)`` of about ``GROUP_WORDS`` words together; texts are split as they come.

    A longer document is cut into slices of so many words and ``overlap`` more, each a group of its own.
    """
    group, held = [], 0
    for k, text in enumerate(texts):
        words = words_of(text)
        if len(words) > GROUP_WORDS + overlap:
            yield from ([(k, b, words[b : b + GROUP_WORDS + overlap])] for b in range(0, len(words) - overlap, GROUP_WORDS))
            continue
        if held and held + len(words) > GROUP_WORDS:
            yield group
            group, held = [], 0
        if words:
            group.append((k, 0, words))
            held += len(words)
    if group:
        yield group


def _runs(wanted: list[bytes], part: list[bytes], counts: Counter) -> Iterator[tuple[int, list[bytes]]]:
    """``(start, run)`` of ``part`` in which ``COVERED`` of the item's words can stand close.

    A run that starts with a word which the item has not got holds no more than the next one.
    """
    room, least = int(len(wanted) / COVERED), COVERED * len(wanted)
    has = [w in counts for w in part]
    held = sum(has[:room])
    for k in range(len(part)):
        if has[k] and held >= least:
            run = part[k : k + room]
            own = Counter(run)
            if sum(min(n, own[w]) for w, n in counts.items()) >= least:
                yield k, run
        held += (has[k + room] if k + room < len(part) else 0) - has[k]


def _compare(model: dict, item: int, run: list[bytes]) -> tuple[float, float] | None:
    """Shares of the item and of its answer in the longest common subsequence, if both are enough."""
    wanted, counts, answer = model["words"][item], model["counts"][item], model["answers"][item]
    # No subsequence is longer than the item's words that the run has at all.
    if sum(map(counts.get, counts.keys() & set(run))) < COVERED * len(wanted):
        return None
    covered = common_subsequence(wanted, run)
    share = sum(covered) / len(wanted)
    asked = sum(covered[w] for w in answer) / len(answer) if answer else 1.0
    return (share, asked) if share >= COVERED and asked >= ANSWER else None


def _search(shared):
    def run(batch: pa.RecordBatch) -> dict:
        model = shared.value
        names = ("doc_id", "row", "item_id", "cosine", "lcs_share", "answer_share", "start", "end")
        out: dict[str, list] = {n: [] for n in names}
        docs, rows = batch.column("doc_id").to_pylist(), batch.column("row").to_pylist()
        texts = (text.as_py() for text in batch.column("text"))
        best: dict[tuple, tuple] = {}
        for group in _groups(texts, model["overlap"]):
            parts = [part for _, _, part in group]
            numbers = [terms(part) for part in parts]
            for at, item, start, end, cosine in _latent(model, numbers):
                shares = _compare(model, item, parts[at][start:end])
                if shares:
                    k, begin, _ = group[at]
                    best[k, item] = max(best.get((k, item), (0.0,)), (*shares, cosine, begin + start, begin + end))
            for at, item, start, end in _near_copies(model, numbers):
                k, begin, _ = group[at]
                for first, run in _runs(model["words"][item], parts[at][start:end], model["counts"][item]):
                    if best.get((k, item), (0.0, 0.0))[:2] == (1.0, 1.0):
                        break
                    shares = _compare(model, item, run)
                    if shares:
                        place = begin + start + first
                        best[k, item] = max(best.get((k, item), (0.0,)), (*shares, 0.0, place, place + len(run)))
        for (k, item), (share, asked, cosine, start, end) in best.items():
            values = (docs[k], rows[k], model["items"][item], cosine, share, asked, start, end)
            for name, value in zip(names, values, strict=True):
                out[name].append(value)
        return out

    return run


def _answer(words: list[bytes], answer: str | None) -> list[int]:
    """Positions of the answer's words within the item: the column's words, else the last quarter."""
    if answer:
        wanted = set(words_of(answer.encode()))
        return [k for k, w in enumerate(words) if w in wanted]
    return list(range(len(words) - max(1, len(words) // 4), len(words)))


def build(docs: DataFrame, benchmark: DataFrame, max_items: int = 200_000) -> Iterator[tuple[dict, bool]]:
    """Search models, each for the items of one pass, and whether it is the only one; none if no item has words.

    The benchmark must stay below ``max_items`` rows.
    """
    items = benchmark.select(
        F.col("item_id").cast("long").alias("item_id"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary").alias("text"),
        (F.col("answer").cast("string") if "answer" in benchmark.columns else F.lit(None).cast("string")).alias("answer"),
    ).where(F.col("item_id").isNotNull())
    if items.limit(max_items + 1).count() > max_items:
        raise ValueError(f"more than {max_items} benchmark items: search them in parts")
    table = [(r, split) for r in items.collect() if (split := words_of(r["text"]))]
    if not table:
        return
    # Items of like length share a space, and so few widths of windows.
    table.sort(key=lambda x: (len(x[1]), x[0]["item_id"]))
    frequency, total = document_frequencies(docs)
    idf = inverse_frequencies(frequency, total)
    passes = _passes([len(words) for _, words in table])
    for spaces in passes:
        yield _model(docs.sparkSession, [[table[k] for k in space] for space in spaces], idf), len(passes) == 1


def _passes(sizes: list[int]) -> list[list[range]]:
    """Items in order, cut into passes of at most ``SPACES`` spaces and ``PASS_WORDS`` words, if not one item."""
    passes, spaces, begin, held = [], [], 0, 0
    for k, size in enumerate(sizes):
        if k > begin and (k - begin == SPACE_ITEMS or held + size > PASS_WORDS):
            spaces.append(range(begin, k))
            begin = k
        if spaces and begin == k and (len(spaces) == SPACES or held + size > PASS_WORDS):
            passes.append(spaces)
            spaces, held = [], 0
        held += size
    return [*passes, [*spaces, range(begin, len(sizes))]]


def _rare_words(words: list[list[bytes]], idf: np.ndarray) -> dict:
    """Postings of each item's rarest terms, and per item how many of them a near copy has at least.

    A run with ``COVERED`` of the words misses the rest of them; beyond these and ``RARE`` of the words, the
    item's terms need no postings.
    """
    term, item, least = [], [], []
    for k, listed in enumerate(words):
        found, n = np.unique(terms(listed), return_counts=True)
        order = np.argsort(-idf[found], kind="stable")
        found, mass = found[order], np.cumsum(n[order])
        missed = len(listed) - int(np.ceil(COVERED * len(listed) - 1e-6))
        used = int(np.searchsorted(mass, min(len(listed), missed + max(1, int(RARE * len(listed)))))) + 1
        term.append(found[:used])
        item.append(np.full(used, k))
        least.append(int(mass[used - 1]) - missed)
    term, item = np.concatenate(term), np.concatenate(item)
    order = np.argsort(term, kind="stable")
    count = np.bincount(term, minlength=1 << BITS).astype(np.int32)
    return {
        "items": item[order].astype(np.int32), "count": count, "from": np.cumsum(count) - count,
        "least": np.array(least), "room": np.array([int(len(w) / COVERED) for w in words]),
    }


def _model(spark: SparkSession, parts: list[list[tuple[Row, list[bytes]]]], idf: np.ndarray) -> dict:
    """Model of the items of some spaces."""
    table = list(chain.from_iterable(parts))
    words = [split for _, split in table]
    rows = [(r["item_id"], space, bytearray(r["text"])) for space, part in enumerate(parts) for r, _ in part]
    items = spark.createDataFrame(rows, "item_id long, space int, text binary")
    vectors = durable(item_vectors(items, spark.sparkContext.broadcast(idf)))
    names, basis = latent_space(vectors, min(RANK, max(1, max(map(len, parts)) // 2)))
    latent, spaces, begin = [], [], 0
    for space, part in enumerate(parts):
        own = np.flatnonzero(names >> BITS == space)
        # A space of fewer items than the largest takes its first columns, which hold most.
        basis_of = basis[own, : max(1, len(part) // 2)]
        term = names[own] & ((1 << BITS) - 1)
        row_of = np.full(1 << BITS, -1, dtype=np.int32)
        row_of[term] = np.arange(len(own))
        for _, listed in part:
            found, n = np.unique(terms(listed), return_counts=True)
            vector = np.zeros(basis.shape[1])
            vector[: basis_of.shape[1]] = unit(n * idf[found].astype(np.float64)) @ basis_of[row_of[found]]
            latent.append(vector)
        columns = np.ascontiguousarray((basis_of * idf[term][:, None]).T, dtype=np.float32)
        spaces.append({"row_of": row_of, "items": np.arange(begin, begin + len(part)), "columns": columns})
        begin += len(part)
    latent = np.array(latent)
    kept = np.sqrt((latent**2).sum(axis=1))
    lengths = np.array([len(w) for w in words])
    # So many blocks hold an item wherever it starts.
    blocks = -(-(lengths - 1) // BLOCK) + 1
    rare = _rare_words(words, idf)
    return {
        "spaces": spaces, "idf": idf, "rare": rare, "blocks": blocks, "words": words,
        # Directions of the items in their spaces, and the part of each that its space keeps.
        "vectors": latent / np.maximum(kept, 1e-12)[:, None], "kept": np.maximum(kept, 1e-6),
        "items": [r["item_id"] for r, _ in table],
        "answers": [_answer(w, r["answer"]) for r, w in table],
        "counts": [Counter(w) for w in words],
        # Slices of a long document share whole windows and runs, and whole blocks.
        "overlap": BLOCK * int(max(blocks.max() + 1, -(-int(rare["room"].max()) // BLOCK))),
    }


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``doc_id, item_id, cosine, lcs_share, answer_share, start, end`` of documents that hold an item.

    One row per document and item, with the best window in words.  Clean documents have no row.  Null texts
    are empty and clean; null item ids are ignored; rows that repeat are found each; a null ``doc_id`` is kept;
    other columns are ignored; empty tables give no rows.
    """
    schema = ("doc_id long, row long, item_id long, cosine double, lcs_share double, answer_share double, "
              "start int, end int")
    texts = id_and_bytes(docs).withColumn("row", F.xxhash64("doc_id", "text"))
    found = []
    for model, alone in build(docs, benchmark):
        shared = docs.sparkSession.sparkContext.broadcast(model)
        rows = map_batches(texts, schema, _search(shared))
        if not alone:  # the models of all passes together need not fit
            rows = durable(rows)
            shared.destroy()
        found.append(rows)
    return reduce(DataFrame.unionAll, found) if found else docs.sparkSession.createDataFrame([], schema)
