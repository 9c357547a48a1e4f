"""Collocations against brute force, summaries against their guarantee, blocks and slices against plain splitting."""

import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from ledgerloom.llm import collocations as co
from ledgerloom.llm.slices import word_slices

SCHEMA = "doc_id long, text string, lang string, phrase string, n long, a long, words string, parts string, k string"


def frame(spark, rows):
    return spark.createDataFrame([(k, t, x, "p", 1, 2, "w", "q", "k") for k, (t, x) in enumerate(rows)], SCHEMA)


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def phrases(text):
    for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower(text)):
        words = [w for w in re.split(r"[\x20\x09]+", piece) if w]
        for width in (1, 2, 3):
            for i in range(len(words) - width + 1):
                yield tuple(words[i : i + width])


def brute(rows, threshold, top):
    out = []
    for lang in {x or "und" for _, x in rows}:
        f = Counter(p for t, x in rows if (x or "und") == lang for p in phrases(t))
        n = sum(c for p, c in f.items() if len(p) == 1)
        long = {p: a for p, a in f.items() if len(p) > 1 and a >= threshold}
        kept = []
        for p, a in long.items():
            if any(p == q[i : i + len(p)] and 100 * b >= 50 * a for q, b in long.items() if len(q) > len(p)
                   for i in range(len(q) - len(p) + 1)):
                continue
            score, _, left, right = min(
                (1000000 * a * a // (f[p[:k]] * f[p[k:]]), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p)))
            kept.append((-score, -a, " ".join(p).encode(), left, right))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(kept)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, n, -score))
    return out


def corpus():
    random.seed(7)
    words = ["Alpha", "beta", "gamma", "Δelta", "é", "ze", "x\x00y", "und", "1"] + [f"r{k}" for k in range(40)]
    rows = []
    for k in range(120):
        text = "".join(random.choice(words[:9] if random.random() < 0.6 else words)
                       + random.choice([" ", " ", " ", "\t", ", ", ".", "\n", "  ", "\r\n", "!? "])
                       for _ in range(random.randrange(80)))
        rows.append((text, random.choice(["en", "fr", "und", None])))
    fixed = "new york city hall"
    return rows + [(fixed + ". " + fixed, "en")] * 15 + [(None, "en"), ("", None), (" \t", "de"), ("a " * 3000, "fr"),
                                                         ("New YORK. " * 31, "en"), ("a,b" * 20, "de")]


@pytest.mark.parametrize(("threshold", "top", "partition_bytes", "level_bits"),
                         [(10, 2000, 8 << 20, 10), (10, 7, 3000, 10), (3, 2000, 3000, 2)])
def test_against_brute_force(spark, threshold, top, partition_bytes, level_bits):
    got = co.collocations(frame(spark, corpus()), threshold, top, partition_bytes, level_bits)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert [t for _, t in got.dtypes] == ["string", "bigint", "string"] + ["bigint"] * 5
    assert sorted(map(tuple, got.collect())) == sorted(brute(corpus(), threshold, top))


def test_no_frequent_key_is_lost():
    """Whatever the order and the sizes of the merges, at the least capacity that the guarantee allows."""
    for seed in range(30):
        rng = np.random.default_rng(seed)
        stream = np.concatenate([np.repeat(np.arange(20), rng.integers(1, 30, 20)), rng.integers(100, 2000, 1500)])
        rng.shuffle(stream)
        threshold = 10
        summary = co.Summary(len(stream) // threshold + 1)
        cuts = np.sort(rng.integers(0, len(stream), 12))
        for part in np.split(stream, cuts):
            keys, counts = np.unique(part.astype(np.uint64), return_counts=True)
            summary.merge([(keys, counts)])
            assert len(summary.keys) <= summary.capacity
        assert summary.error < threshold
        true = Counter(stream.tolist())
        assert {k for k, n in true.items() if n >= threshold} <= set(summary.frequent(threshold).tolist())
        for key, n in zip(summary.keys.tolist(), summary.counts.tolist()):
            assert true[key] - summary.error <= n <= true[key]


def test_planes_round_trip():
    keys = np.array([0, 1, 255, 256, (1 << 40) - 1], dtype=np.uint64)
    assert co._from_planes(co._to_planes(keys | np.uint64(7 << 40), 40), 40).tolist() == keys.tolist()
    assert co._from_planes(co._to_planes(keys | np.uint64(7 << 41), 43), 43).tolist() == (keys | np.uint64(6 << 40)).tolist()


def test_slices_hold_every_run_once():
    random.seed(3)
    text = "".join(random.choice(["ab", "c", "d" * 30]) + random.choice([" ", "\n", "  \t"]) for _ in range(500)).encode()
    whole = text.split()
    for size in (1, 7, 64, 1 << 20):
        for width in (1, 2, 3):
            got = [tuple(words[i : i + width]) for words, led in word_slices(text, 2, size)
                   for i in range(len(words) - width + 1) if i + width > led]
            assert got == [tuple(whole[i : i + width]) for i in range(len(whole) - width + 1)]


def test_blocks_count_each_phrase_once(monkeypatch):
    rows = [(t, x) for t, x in corpus() if t]
    batches = [pa.RecordBatch.from_arrays([pa.array([x or "und" for _, x in part]), pa.array([t.encode() for t, _ in part])],
                                          names=["lang", "text"]) for part in (rows[:40], rows[40:])]
    for words, size in ((1 << 20, 1 << 20), (100, 50)):
        monkeypatch.setattr(co, "BLOCK_WORDS", words)
        monkeypatch.setattr(co, "word_slices", lambda t, carry, size=size: word_slices(t, carry, size))
        got = Counter()
        for block in co._blocks(iter(batches)):
            langs = [lang for lang, n in block.runs for _ in range(n)]
            for width, at, _ in block.hashes():
                got.update((langs[i], b" ".join(block.words[i : i + width]).decode()) for i in at.tolist())
        assert got == Counter((x or "und", " ".join(p)) for t, x in rows for p in phrases(t))


def test_full_map_only_adds(spark, monkeypatch):
    """A bit map that is far too small lets more phrases through to the count, and changes nothing."""
    monkeypatch.setattr(co, "MAP_BITS_MOST", 1 << 6)
    rows = corpus() * 2
    got = co.collocations(frame(spark, rows), 10, 50, 2000).collect()
    assert sorted(map(tuple, got)) == sorted(brute(rows, 10, 50))


def test_scores_beyond_64_bits(spark):
    """Counts of 10**9 give products of 10**24; the same expression must stay exact."""
    counts = spark.createDataFrame([("en", 2, "a b", 3_000_000_019), ("en", 1, "a", 4_000_000_007), ("en", 1, "b", 3_000_000_021),
                                    ("en", 0, None, 10**10)], "lang string, words int, phrase string, n long")
    original = co.counted
    try:
        co.counted = lambda *_: counts
        row = co.collocations(counts).first()
    finally:
        co.counted = original
    assert row["score"] == 1000000 * 3_000_000_019**2 // (4_000_000_007 * 3_000_000_021)


def test_empty_tables(spark):
    assert co.collocations(frame(spark, [])).count() == 0
    assert co.collocations(frame(spark, [("a b c", "en"), (None, None)])).count() == 0
