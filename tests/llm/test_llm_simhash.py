"""SimHash fingerprints and components against brute force, with long lists and awkward rows."""

import random
import re
from itertools import combinations

import numpy as np
import pytest
import xxhash

from ledgerloom.llm import simhash

SCHEMA = "doc_id long, text string, fp long, fingerprint string, least long, component string, u long"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, 1, "x", 2, "c", 3) for i, t in rows], SCHEMA)


def plain_fingerprint(text):
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) if w]
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(prints, ids):
    root = list(range(len(prints)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in combinations(range(len(prints)), 2):
        if bin(prints[a] ^ prints[b]).count("1") <= 3:
            root[find(a)] = find(b)
    least = {}
    for k, i in enumerate(ids):
        if i is not None:
            least[find(k)] = min(i, least.get(find(k), i))
    return [least.get(find(k)) for k in range(len(prints))]


def corpus():
    random.seed(11)
    words = [f"wört{k}" for k in range(300)]
    rows = []
    for doc in range(150):
        base = [random.choice(words) for _ in range(random.choice([1, 2, 3, 8, 60, 400]))]
        rows.append((doc, " ".join(base)))
        if doc % 3 == 0:
            near = list(base)
            near[random.randrange(len(near))] = "other"
            rows.append((1000 - doc, random.choice([" ", "\n\t"]).join(near).upper()))
    rows += [(2000, None), (2001, ""), (2002, " \x0b\n "), (2003, rows[4][1]), (2003, rows[4][1]), (None, rows[4][1]),
             (None, "all alone here"), (2004, "x " * 5000), (2005, "x " * 5001), (2006, "a b c d"), (-5, rows[7][1])]
    return rows


@pytest.mark.parametrize("longest", [2048, 1])
def test_against_brute_force(spark, longest):
    rows = corpus()
    got = simhash.near_duplicates(frame(spark, rows), longest).collect()
    prints = [plain_fingerprint(t) for _, t in rows]
    component = plain_components(prints, [i for i, _ in rows])
    want = [(i, f"{p:016x}", c) for (i, _), p, c in zip(rows, prints, component)]
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)


@pytest.mark.parametrize("longest", [2048, 20, 1])
def test_links_of_dense_fingerprints(spark, longest):
    """Groups with one to four changed bits, many sharing bytes; every list length goes every way."""
    random.seed(4)
    prints = {0, (1 << 64) - 1, 1 << 63}
    for _ in range(12):
        centre = random.getrandbits(64)
        for _ in range(40):
            changed = centre
            for _ in range(random.randint(0, 4)):
                changed ^= 1 << random.randrange(64)
            prints.add(changed)
        prints |= {centre & ~0xFFFF | k * 37 & 0xFFFF for k in range(40)}
    prints = sorted(prints)
    as_long = [p - (1 << 64) if p >> 63 else p for p in prints]
    found = simhash.links(spark.createDataFrame([(p,) for p in as_long], "fp long"), longest).collect()
    root = {p: p for p in prints}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for u, v in found:
        u, v = u % (1 << 64), v % (1 << 64)
        assert bin(u ^ v).count("1") > 0
        root[find(u)] = find(v)
    first = {}
    got = [first.setdefault(find(p), k) for k, p in enumerate(prints)]
    assert got == plain_components(prints, list(range(len(prints))))


def test_long_text_in_slices():
    random.seed(2)
    text = " ".join(str(random.randrange(50)) for _ in range(4000)).encode()
    assert simhash.fingerprint_of(text, size=100) == simhash.fingerprint_of(text) == plain_fingerprint(text.decode())
    assert simhash.fingerprint_of(b"one" * 400 + b"  two", size=64) == plain_fingerprint("one" * 400 + " two")


def test_pairs_in_any_five_bytes_meet():
    """Three of six positions hold whenever at most three bytes differ."""
    for wrong in combinations(range(8), 3):
        agree = {p for p in range(8) if p not in wrong}
        assert any(all(p in agree for p in range(8) if m >> (8 * p) & 0xFF) for m in simhash.COARSE)
    assert len(simhash.COARSE) == 20 and len(simhash.FINE) == 56


def test_long_fine_list_is_not_quadratic():
    rng = np.random.default_rng(3)
    key = next(m for m in simhash.FINE if m == 0xFFFFFFFFFF)
    prints = np.unique(rng.integers(0, 1 << 24, 30_000).astype(np.uint64) << np.uint64(40))
    child, root = simhash.link_list(key, prints)
    slow_child, slow_root = simhash.link_list(key, prints[:3000], longest=10_000)
    fast_child, fast_root = simhash.link_list(key, prints[:3000], longest=10)
    assert len(child) and np.array_equal(slow_child, fast_child) and np.array_equal(slow_root, fast_root)


def test_empty_table(spark):
    got = simhash.near_duplicates(frame(spark, []))
    assert got.columns == ["doc_id", "fingerprint", "component_id"] and got.count() == 0
