"""Resolution against brute force over all pairs of a small fixture."""

import random
import re
from difflib import SequenceMatcher

import pytest

from ledgerloom.operators import resolve

CATALOG = "series string, canonical_work_slug string, display_title string, edition_format string, kenp_page_count string, " \
          "asin string, isbn_10 string, isbn_13 string, other_id string, catalog_order long"
TITLES = ["Salt & Iron", "Salt and Iron", "The Long Way Home: Part One", "Long Way Home", "Zebra", "Cats", "A Very Long Title Indeed (Vol. 1)",
          "Night Owls", "Nightowl", "The Quiet Sea", "The Quiet See", "xyzzy"]


def catalog_of(spark, titles):
    rows = [(f"s{i % 4}", f"slug{i}", t, "ebook", "100", f"B{i:03d}", None, f"978-{i:010d}", "dup" if i < 2 else None, i)
            for i, t in enumerate(titles)]
    return spark.createDataFrame(rows, CATALOG)


def long_clean(title):
    title = re.sub(r"\s*:\s*.*$", "", title.lower().strip())
    return re.sub(r"\s*\([^)]*\)", "", title).replace("&", "and").strip()


def best_by_brute_force(title, titles, threshold=0.75):
    scores = [SequenceMatcher(None, long_clean(title), long_clean(t)).ratio() for t in titles]
    top = max(scores)
    return (scores.index(top), round(top, 9)) if top >= threshold else None


@pytest.mark.parametrize("broadcast_titles", [20_000, 0])
def test_fuzzy_equals_brute_force(spark, monkeypatch, broadcast_titles):
    choice = random.Random(3)
    catalog_titles = TITLES + ["".join(choice.choice("abcde ") for _ in range(choice.randint(4, 14))) + "x" for _ in range(60)]
    names = set(TITLES) | {"abcd", "Salt Iron", "salt & irn", "", "Quiet Sea", "long way hom", "zzzz", "abce"}
    for title in catalog_titles:
        for _ in range(3):
            at = choice.randrange(len(title))
            names.add(title[:at] + choice.choice("abcdexyz ") + title[at + choice.randint(0, 2):])
    monkeypatch.setattr(resolve, "title_candidates", lambda t, s, th, _f=resolve.title_candidates: _f(t, s, th, broadcast_titles, 4))
    catalog = catalog_of(spark, catalog_titles)
    df = spark.createDataFrame([(n,) for n in names] + [(None,)], "book_title string")
    got = {r.book_title: (r.catalog_order, round(r.score, 9)) for r in resolve.fuzzy_title_match(df, catalog).collect()}
    expected = {n: best_by_brute_force(n, catalog_titles) for n in names}
    assert got == {n: v for n, v in expected.items() if v}


def test_ratio_at_the_threshold_and_ties(spark):
    # abcd against abce shares 3 of 4 letters: exactly 0.75; two titles tie and the first one wins
    catalog = catalog_of(spark, ["abce", "abcf"])
    rows = resolve.fuzzy_title_match(spark.createDataFrame([("abcd",)], "book_title string"), catalog).collect()
    assert [(r.catalog_order, r.score) for r in rows] == [(0, 0.75)]


def test_containment_equals_brute_force(spark):
    titles = TITLES + ["Iron Crown", "Crown"]
    names = ["Signed Salt & Iron Deluxe Hardcover", "the quiet sea - paperback (deluxe)", "Zebra Mug", "Catsuit", "IRON CROWN and SALT AND IRON",
             "nothing here", "long way homestead", "Night Owls Paperback", None]
    got = {r.product_name: (r.matched_title, r.edition_format)
           for r in resolve.containment_match(spark.createDataFrame([(n,) for n in names], "product_name string"), catalog_of(spark, titles)).collect()}

    def clean(t):
        return t.lower().replace("&", "and").strip()

    expected = {}
    for name in filter(None, names):
        hits = [clean(t) for t in titles if len(clean(t)) > 5 and clean(t) in clean(name)]
        if hits:
            best = max(hits, key=len)
            low = clean(name)
            form = "deluxe hardcover" if "hardcover" in low else "deluxe paperback" if "paperback" in low and "deluxe" in low else None
            expected[name] = (best, form)
    assert got == expected


def test_duplicate_identifiers_do_not_multiply_rows(spark):
    catalog = catalog_of(spark, TITLES)
    pairs = resolve.crosswalk(catalog)
    assert [(r.identifier, r.editions) for r in resolve.duplicate_identifiers(pairs).collect()] == [("DUP", 2)]
    sales = spark.createDataFrame([("dup", 1), ("'b003", 2), ("9780000000004.0", 3), (None, 4), ("none", 5)], "id string, n int")
    got = {r.n: (r.series, r.canonical_work_slug) for r in resolve.enrich(sales, "id", catalog).collect()}
    assert got == {1: ("s0", "slug0"), 2: ("s3", "slug3"), 3: ("s0", "slug4"), 4: (None, None), 5: (None, "none")}


def test_shuffled_dimension_join_gives_the_same_rows(spark):
    from ledgerloom.scale import join_dimension
    from pyspark.sql import functions as F

    left = spark.range(1000).select("id", F.when(F.col("id") % 3 == 0, F.lit(None)).otherwise((F.col("id") % 7).cast("string")).alias("k"))
    right = spark.createDataFrame([(str(i), i * 10) for i in range(5)], "key string, v int")
    small = join_dimension(left, right, "key", F.col("k")).select("id", "v")
    large = join_dimension(left, right, "key", F.col("k"), max_rows=1).select("id", "v")
    assert sorted(map(tuple, small.collect()), key=repr) == sorted(map(tuple, large.collect()), key=repr)
    assert small.count() == 1000


def test_without_catalog(spark):
    df = resolve.enrich(spark.createDataFrame([("x",)], "id string"), "id", None)
    assert [tuple(r) for r in df.select("id", "series", "canonical_work_slug").collect()] == [("x", None, "x")]


@pytest.mark.parametrize("threshold", [0.6, 0.75, 0.92])
def test_candidates_are_complete_and_few(spark, threshold):
    """No pair that reaches the ratio is missing, each comes once, and most others never meet."""
    choice = random.Random(8)
    words = ["".join(choice.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(choice.randint(2, 8))) for _ in range(60)]
    titles = [" ".join(choice.choice(words) for _ in range(choice.randint(1, 5))) for _ in range(120)] + ["a", "aa", "aaaaaaaa", "é"]
    names = []
    for title in titles:
        for _ in range(2):
            at = choice.randrange(len(title))
            names.append(title[:at] + choice.choice(["", "x", " the ", "aa"]) + title[at + choice.randint(0, 2):])
    names = sorted({n for n in names if n} - set(titles))
    left = spark.createDataFrame([(n,) for n in names], "clean string")
    right = spark.createDataFrame(list({t: (t, k) for k, t in enumerate(titles)}.values()), "clean string, catalog_order long")
    got = [(r.clean, r.candidate) for r in resolve.title_candidates(left, right, threshold).collect()]
    assert len(got) == len(set(got))
    reach = {(n, t) for n in names for t in titles if SequenceMatcher(None, n, t).ratio() >= threshold}
    assert reach <= set(got)
    assert len(got) - len(reach) < 0.05 * len(names) * len(titles)
