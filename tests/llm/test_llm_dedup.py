"""Exact, near and passage deduplication against brute force, with awkward rows."""

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from ledgerloom.llm.components import connected_components
from ledgerloom.llm.exact import exact_duplicates
from ledgerloom.llm.minhash import near_duplicates
from ledgerloom.llm.substring import SuffixAutomaton, remove_repeated
from ledgerloom.llm.words import sliding_minimum, window_hashes

SCHEMA = "doc_id long, text string, row string, ref string, component string, keep_id string, key string"


def frame(spark, rows):
    """Documents with extra columns whose names clash with internal ones."""
    return spark.createDataFrame([(i, t, "r", None, "c", "k", None) for i, t in rows], SCHEMA)


def corpus(seed=3, docs=120):
    random.seed(seed)
    vocabulary = [f"w{k}" for k in range(60)]
    make = lambda n: [random.choice(vocabulary) for _ in range(n)]
    bases, shared, rows = [make(90) for _ in range(6)], make(70), []
    for doc in range(docs):
        kind = doc % 5
        if kind == 0:
            words = list(random.choice(bases))
            for _ in range(random.randint(0, 3)):
                words[random.randrange(len(words))] = random.choice(vocabulary)
        elif kind == 1:
            words = make(random.randint(1, 40)) + shared[random.randint(0, 15) :] + make(random.randint(0, 30))
        elif kind == 2:
            words = make(random.randint(0, 6))
        else:
            words = make(random.randint(50, 150))
        rows.append((doc, random.choice([" ", "\n", "\t"]).join(words)))
    rows += [(200, rows[3][1]), (201, rows[3][1]), (202, None), (203, ""), (204, " \n "), (205, "one two"),
             (206, "one two"), (207, "x " * 4000), (208, "ß ü " * 60), (209, rows[0][1].upper())]
    return rows


def split(text):
    return [w for w in re.split(r"[\x20\x09-\x0D]+", text or "") if w]


def test_exact_against_grouping(spark):
    rows = corpus() + [(None, "lonely"), (None, "one two"), (200, corpus()[3][1])]
    got = exact_duplicates(frame(spark, rows)).collect()
    groups = {}
    for doc, text in rows:
        groups.setdefault(text or "", []).append(doc)
    want = []
    for doc, text in rows:
        ids = groups[text or ""]
        keep = max((i for i in ids if i is not None), default=None)
        want.append((doc, keep, len(ids), doc is not None and doc == keep, hashlib.sha256((text or "").encode()).hexdigest()))
    key = lambda r: (r[0] is None, r[0] or 0, r[4])
    assert sorted((tuple(r) for r in got), key=key) == sorted(want, key=key)


def test_exact_with_colliding_chunk_hashes(spark):
    rows = [(k, t) for k, t in corpus() if k < 60] + [(300, corpus()[8][1]), (301, "a" * 9000), (302, "a" * 9000)]
    weak = exact_duplicates(frame(spark, rows), chunk_hash=lambda c: F.pmod(F.xxhash64(c), F.lit(3))).collect()
    assert sorted(map(tuple, weak)) == sorted(map(tuple, exact_duplicates(frame(spark, rows)).collect()))


def test_components_match_union_find(spark):
    random.seed(5)
    edges = [(random.randrange(80), random.randrange(80)) for _ in range(70)] + [(7, 7), (None, 3), (4, None)]
    edges += [(100 + k, 101 + k) for k in range(30)]
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in edges:
        if a is not None and b is not None and a != b:
            low, high = sorted((find(a), find(b)))
            root[high] = low
    got = {r["node"]: r["component"] for r in connected_components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {x: find(x) for x in root}
    assert connected_components(spark.createDataFrame([], "u long, v long")).count() == 0


def brute_near(rows):
    sets = {}
    for doc, text in rows:
        words = split(re.sub("[A-Z]+", lambda m: m.group().lower(), text or ""))
        sets[doc] = {tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))} if words else set()
    part = {d: d for d in sets}

    def find(x):
        while part[x] != x:
            x = part[x]
        return x

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 75 * len(sets[a] | sets[b]):
                low, high = sorted((find(a), find(b)))
                part[high] = low
    return {(d, len(sets[d]), find(d), find(d) == d) for d in ids}


@pytest.mark.parametrize("seed", [3, 11])
def test_near_against_brute_force(spark, seed):
    rows = corpus(seed)
    assert {tuple(r) for r in near_duplicates(frame(spark, rows)).collect()} == brute_near(rows)


def test_near_chain_of_drifting_copies(spark):
    """Neighbours of the chain are linked, its ends are far apart: links between members of a bucket count."""
    words = [f"w{k}" for k in range(200)]
    rows = [(k, " ".join([f"x{j}" for j in range(8 * k)] + words[8 * k :])) for k in range(24)]
    assert {tuple(r) for r in near_duplicates(frame(spark, rows)).collect()} == brute_near(rows)


def test_near_null_ids(spark):
    got = {tuple(r) for r in near_duplicates(frame(spark, [(None, "a b c"), (4, "a b c"), (None, "z")])).collect()}
    assert got == {(None, 1, 4, False), (4, 1, 4, True), (None, 1, None, False)}


def brute_passages(rows, window):
    first = {}
    for doc, text in rows:
        words = split(text)
        for k in range(len(words) - window + 1):
            gram = tuple(words[k : k + window])
            first[gram] = min(doc, first.get(gram, doc))
    out = set()
    for doc, text in rows:
        words, gone = split(text), set()
        for k in range(len(words) - window + 1):
            if first[tuple(words[k : k + window])] < doc:
                gone.update(range(k, k + window))
        kept = " ".join(w for k, w in enumerate(words) if k not in gone)
        out.add((doc, len(words), len(gone), hashlib.sha256(kept.encode()).hexdigest(), kept))
    return out


@pytest.mark.parametrize("window,gram", [(50, 25), (12, 6)])
def test_passages_against_brute_force(spark, window, gram):
    rows = corpus(8)
    got = remove_repeated(frame(spark, rows), window, gram).drop("removed").collect()
    assert {tuple(r) for r in got} == brute_passages(rows, window)


def test_passages_repeated_and_null_ids(spark):
    text = " ".join(f"v{k}" for k in range(60))
    got = remove_repeated(frame(spark, [(5, text), (5, text), (None, text), (9, text)])).collect()
    assert sorted((r["doc_id"] or -1, r["n_removed"]) for r in got) == [(-1, 0), (5, 0), (5, 0), (9, 60)]


def test_suffix_automaton_statistics():
    random.seed(1)
    for _ in range(50):
        text = [random.choice("abc") for _ in range(25)]
        other = [random.choice("abcd") for _ in range(25)]
        held = {tuple(text[i:j]) for i in range(26) for j in range(i, 26)}
        want = [max(n for n in range(k + 2) if tuple(other[k + 1 - n : k + 1]) in held) for k in range(25)]
        assert list(SuffixAutomaton(text).matches(other)) == want


def test_window_helpers():
    import numpy as np

    ids = np.arange(40, dtype=np.uint64) % np.uint64(7)
    hashes = window_hashes(ids, 25)
    assert len(hashes) == 16 and (hashes[7:] == hashes[:9]).all() and len(set(hashes[:7].tolist())) == 7
    values = np.array([5, 3, 8, 1, 9, 2, 7], dtype=np.uint64)
    assert sliding_minimum(values, 3).tolist() == [3, 1, 1, 1, 2]


@pytest.mark.parametrize("operator", [exact_duplicates, near_duplicates, remove_repeated])
def test_empty_table(spark, operator):
    assert operator(frame(spark, [])).count() == 0
