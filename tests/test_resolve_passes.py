"""How often the resolution by title makes the rows it is given."""

from test_resolve import catalog_of

from ledgerloom.operators import resolve


def counted(spark, rows, schema):
    """Rows as a frame, and an accumulator that counts each time one of them is made."""
    seen = spark.sparkContext.accumulator(0)

    def made(row):
        seen.add(1)
        return row

    return spark.createDataFrame(spark.sparkContext.parallelize(rows, 2).map(made), schema), seen


def test_titles_are_taken_from_the_rows_once(spark):
    titles = ["Night Owls", "NIGHT OWLS", "Night Owl", "Zebra Crossing", "zzzz", None] * 5
    df, seen = counted(spark, [(t,) for t in titles], "book_title string")
    found = resolve.fuzzy_title_match(df, catalog_of(spark, ["Night Owls", "Zebra Crossings", "Cats"]))
    assert {r.book_title: r.catalog_order for r in found.collect()} == {
        "Night Owls": 0, "NIGHT OWLS": 0, "Night Owl": 0, "Zebra Crossing": 1}
    assert seen.value == len(titles)


def test_staged_resolution_passes_over_the_rows_twice(spark):
    rows = [("B000", "anything"), ("x", "Night Owl"), (None, "Cats"), ("x", None), (None, None)] * 4
    df, seen = counted(spark, rows, "book_identifier string, book_title string")
    got = resolve.staged_resolution(df, catalog_of(spark, ["Night Owls", "Cats"])).collect()
    assert sorted((r.book_identifier or "", r.book_title or "", r.canonical_work_slug or "") for r in got) == sorted(
        [("B000", "anything", "slug0"), ("x", "Night Owl", "slug0"), ("", "Cats", "slug1"), ("x", "", ""), ("", "", "")] * 4)
    assert seen.value <= 2 * len(rows)
