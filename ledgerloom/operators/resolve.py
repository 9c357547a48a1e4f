"""Entity resolution: identifiers first, then titles contained in names, then similar titles.

Titles are matched on distinct spellings only, through equi-joins on text fragments that every
true match must share: rare six-letter fragments for contained titles, rare grams for similar ones.
"""

from __future__ import annotations

from difflib import SequenceMatcher

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from ledgerloom.functions.identifiers import normalize_identifier
from ledgerloom.functions.text import clean_title
from ledgerloom.scale import broadcast_if_small, computed_once, durable, has_at_most, join_dimension

# fixed values: identifier columns in the order that settles a clash
ID_PRIORITY = ("asin", "isbn_13", "isbn_10", "other_id")
ATTRIBUTES = ("series", "canonical_work_slug", "display_title", "edition_format", "kenp_page_count")
MATCHED = ("series", "canonical_work_slug", "edition_format")

#: Letters from rare to common; any order gives the same matches, this one gives few candidates.
_RARE_FIRST = "zqxjkvbpygfwmucldrhsnioate "
_RARITY = "ABCDEFGHIJKLMNOPQRSTUVWXYZ~"
_GRAM = 6

#: Gram lengths by which similar titles are looked up, and the ratios that are looked for before the asked one.
_WIDTHS = (3, 2, 1)
_LEVELS = (0.95, 0.9)


def crosswalk(catalog: DataFrame) -> DataFrame:
    """Catalog identifiers as rows: identifier, id_type and the edition's attributes."""
    kept = [c for c in (*ATTRIBUTES, "catalog_order") if c in catalog.columns]
    present = [c for c in ID_PRIORITY if c in catalog.columns]
    long = catalog.unpivot(kept, present, "id_type", "identifier").where(F.col("identifier").isNotNull())
    return long.withColumn("identifier", normalize_identifier(F.col("identifier")))


def unique_crosswalk(pairs: DataFrame) -> DataFrame:
    """One edition per identifier: the best identifier type, then catalog order."""
    rank = F.array_position(F.array(*[F.lit(t) for t in ID_PRIORITY]), F.col("id_type"))
    kept = [c for c in pairs.columns if c not in ("identifier", "id_type")]
    best = F.min_by(F.struct("id_type", *kept), F.struct(rank, "catalog_order"))
    return pairs.groupBy("identifier").agg(best.alias("edition")).select("identifier", "edition.*")


def duplicate_identifiers(pairs: DataFrame) -> DataFrame:
    """Identifiers that more than one edition claims."""
    return pairs.groupBy("identifier").agg(F.count(F.lit(1)).alias("editions")).where("editions > 1")


def enrich(
    df: DataFrame, id_col: str, catalog: DataFrame | None, fallback_slug: bool = True, attributes: tuple[str, ...] = MATCHED
) -> DataFrame:
    """Left join the catalog on the normalised identifier.

    Rows without a match keep NULL attributes; their slug falls back to the raw identifier.
    Columns of the same name on the left are replaced.
    """
    raw = F.col(id_col)
    left = df.drop(*attributes)
    if catalog is None:
        empty = {a: F.lit(None).cast("string") for a in attributes}
        return left.withColumns({**empty, "canonical_work_slug": raw if fallback_slug else F.lit(None).cast("string")})
    pairs = crosswalk(catalog)
    editions = unique_crosswalk(pairs).select(F.col("identifier").alias("_key"), *attributes)
    joined = join_dimension(left, editions, "_key", normalize_identifier(raw), counted=pairs).drop("_key")
    if fallback_slug:
        joined = joined.withColumn("canonical_work_slug", F.coalesce("canonical_work_slug", raw.cast("string")))
    return joined


# ---------------------------------------------------------------- titles inside names


def _grams(text: Column) -> Column:
    starts = F.sequence(F.lit(1), F.length(text) - (_GRAM - 1))
    return F.when(F.length(text) >= _GRAM, F.array_distinct(F.transform(starts, lambda i: F.substring(text, i, F.lit(_GRAM)))))


def _first_spellings(catalog: DataFrame, clean: Column) -> DataFrame:
    """One row per cleaned title: the first edition that carries it."""
    rows = catalog.where(F.col("display_title").isNotNull()).select(clean.alias("clean"), "catalog_order", *MATCHED)
    first = F.min_by(F.struct("catalog_order", *MATCHED), "catalog_order")
    return rows.groupBy("clean").agg(first.alias("edition")).select("clean", "edition.*")


def containment_match(names: DataFrame, catalog: DataFrame, name: str = "product_name") -> DataFrame:
    """For each distinct name the longest catalog title (over 5 characters) it contains.

    Every title is filed under the one of its six-letter fragments that fewest titles share; a name
    can only contain the title if it contains that fragment.  Equal lengths go to catalog order.
    """
    titles = _first_spellings(catalog, clean_title(F.col("display_title"))).where(F.length("clean") > 5)
    fragments = titles.select("clean", F.explode(_grams(F.col("clean"))).alias("gram"))
    spread = fragments.groupBy("gram").agg(F.count(F.lit(1)).alias("shared"))
    anchors = fragments.join(spread, "gram").groupBy("clean").agg(F.min_by("gram", F.struct("shared", "gram")).alias("gram"))
    filed = titles.join(anchors, "clean").withColumnRenamed("clean", "title")

    distinct = names.where(F.col(name).isNotNull()).select(name).distinct().withColumn("clean", clean_title(F.col(name)))
    parts = distinct.select(name, "clean", F.explode(_grams(F.col("clean"))).alias("gram"))
    hits = parts.join(broadcast_if_small(filed, counted=catalog), "gram").where(F.contains("clean", "title"))
    best = F.max_by(F.struct("title", *MATCHED), F.struct(F.length("title"), -F.col("catalog_order")))
    found = hits.groupBy(name).agg(best.alias("best"), F.first("clean").alias("clean"))
    hinted = (
        F.when(F.col("clean").contains("hardcover"), "deluxe hardcover")
        .when(F.col("clean").contains("paperback") & F.col("clean").contains("deluxe"), "deluxe paperback")
    )
    return found.select(
        name, F.col("best.title").alias("matched_title"), F.col("best.series").alias("series"),
        F.col("best.canonical_work_slug").alias("canonical_work_slug"), hinted.alias("edition_format"),
    )


# ---------------------------------------------------------------- similar titles


@F.pandas_udf(DoubleType())
def similarity(title: pd.Series, candidate: pd.Series) -> pd.Series:
    """Ratcliff/Obershelp ratio; the title is the first argument.  The candidate's index is built once per batch."""
    scores = pd.Series(0.0, index=title.index)
    for text, rows in title.groupby(candidate, sort=False):
        matcher = SequenceMatcher(None, "", text)
        for i, value in rows.items():
            matcher.set_seq1(value)
            scores[i] = matcher.ratio()
    return scores


def _letters(clean: Column) -> Column:
    """Numbered letters (second ``a``, first ``q``) of a title, rare ones first."""
    coded = F.translate(clean, _RARE_FIRST, _RARITY)
    sorted_letters = F.array_sort(F.regexp_extract_all(coded, F.lit("(?s)(.)"), F.lit(1)))
    numbered = F.transform(
        sorted_letters,
        lambda c, i: F.concat(F.lpad((F.lit(9998) - i + F.array_position(sorted_letters, c)).cast("string"), 4, "0"), c),
    )
    return F.array_sort(numbered)


def _letter_bits(letters: Column) -> Column:
    """The letters as a 64-bit set; different letters may share a bit."""
    one = F.lit(1).cast("bigint")

    def add(bits: Column, letter: Column) -> Column:
        return bits.bitwiseOR(F.call_function("shiftleft", one, F.pmod(F.hash(letter), F.lit(64))))

    return F.aggregate(letters, F.lit(0).cast("bigint"), add)


def _common(a: Column, b: Column, threshold: float) -> Column:
    """Least number of matched letters with which titles of ``a`` and ``b`` letters reach the ratio."""
    return F.ceil((a + b) * (threshold / 2) - 1e-9)


def _shared(a: Column, b: Column, q: int, threshold: float) -> Column:
    """Least number of ``q``-grams that such titles share.

    The matched letters lie in blocks in the same order.  A further block needs an unmatched letter before it, so
    there are at most as many blocks as unmatched letters and one; each loses ``q - 1`` grams.
    """
    common = _common(a, b, threshold)
    return common - (q - 1) * (a + b - 2 * common + 1)


def _least_shared(q: int, threshold: float) -> Column:
    """``_shared`` with the partner's length for which it is least."""
    size = F.col("size")
    partners = F.sequence(F.ceil(size * (threshold / (2 - threshold)) - 1e-9), F.floor(size * ((2 - threshold) / threshold) + 1e-9))
    return F.array_min(F.transform(partners, lambda b: _shared(size, b, q, threshold)))


def _numbered_grams(clean: Column, q: int) -> Column:
    """Hashes of a title's ``q``-grams; equal ones are numbered, so that repeats count."""
    starts = F.when(F.length(clean) >= q, F.sequence(F.lit(1), F.length(clean) - (q - 1))).otherwise(F.array().cast("array<int>"))
    grams = F.array_sort(F.transform(starts, lambda i: F.substr(clean, i, F.lit(q))))
    return F.transform(grams, lambda g, i: F.xxhash64(g, F.array_position(grams, g) - i, F.lit(q)))


def _sized(df: DataFrame) -> DataFrame:
    letters = computed_once(df.where(F.length("clean") > 0), {"letters": _letters(F.col("clean"))})
    return letters.select(*df.columns, F.size("letters").alias("size"), _letter_bits(F.col("letters")).alias("bits"))


def _rarest_first(df: DataFrame, frequency: DataFrame) -> DataFrame:
    """``grams`` in the order of their measured frequency in the catalog; grams it lacks come first."""
    each = df.select("clean", "q", F.explode("grams").alias("gram")).join(frequency, "gram", "left")
    ranked = each.groupBy("clean", "q").agg(F.array_sort(F.collect_list(F.struct(F.coalesce("held", F.lit(0)).alias("held"), "gram"))).alias("ranked"))
    return df.drop("grams").join(ranked, ["clean", "q"]).withColumn("grams", F.col("ranked.gram")).drop("ranked")


def _postings(df: DataFrame, threshold: float) -> DataFrame:
    """One row for each gram of a title's prefix, with the gram's place in the title's order.

    Two titles that share at least ``n`` grams share one among all but the last ``n - 1`` of each, in any order that
    is the same for both.
    """
    prefix = F.greatest(F.size("grams") - F.greatest("least", F.lit(1)) + 1, F.lit(0)).cast("int")
    return df.select("*", F.posexplode(F.slice("grams", F.lit(1), prefix)).alias("place", "gram"))


def title_candidates(
    titles: DataFrame, spellings: DataFrame, threshold: float, broadcast_titles: int = 20_000, salts: int = 32
) -> DataFrame:
    """Pairs (clean, candidate) that may reach the threshold; none that could is missing.

    An inverted index over q-grams: a title is looked up by the longest grams of which every good enough partner must
    share one, rare ones (as counted in the catalog) first, and by no more of them than that takes.  Lengths, letters
    and the grams' places settle most meetings; a pair is kept once, at its rarest common gram, if the grams in common
    allow the ratio.  A catalog beyond ``broadcast_titles`` is joined by shuffle, each gram split into ``salts`` parts.
    """
    session = titles.sparkSession
    tasks = max(session.sparkContext.defaultParallelism, int(session.conf.get("spark.sql.shuffle.partitions")))
    # Few bytes but much work per title: partitionings of their own, which AQE does not coalesce.
    wanted = _sized(titles.select("clean").repartition(tasks, F.xxhash64("clean")))
    least = F.array(*[F.struct(F.lit(q).alias("q"), _least_shared(q, threshold).alias("least")) for q in _WIDTHS])
    wanted = computed_once(wanted, {"fit": F.filter(least, lambda x: (x["least"] >= 1) | (x["q"] == 1))[0]})
    wanted = wanted.select("clean", "size", "bits", "fit.q", "fit.least")
    known = _sized(spellings.select("clean", "catalog_order"))
    known = known.select("*", F.inline(least))

    def with_grams(df: DataFrame) -> DataFrame:
        grams = F.coalesce(*[F.when(F.col("q") == q, _numbered_grams(F.col("clean"), q)) for q in _WIDTHS])
        return computed_once(df, {"grams": grams})

    known = durable(with_grams(known))
    held = known.select(F.explode("grams").alias("gram")).groupBy("gram").agg(F.count(F.lit(1)).alias("held"))
    held = broadcast_if_small(durable(held))
    ranked = _rarest_first(with_grams(wanted), held).repartition(tasks, F.xxhash64("clean"))
    left = _postings(ranked, threshold)
    right = _postings(_rarest_first(known, held), threshold)
    right = right.select("gram", *[F.col(c).alias(f"c_{c}") for c in right.columns if c not in ("gram", "q")])
    size, c_size = F.col("size"), F.col("c_size")
    needed = F.when(F.col("q") == 1, _shared(size, c_size, 1, threshold))
    for q in _WIDTHS[:-1]:
        needed = needed.when(F.col("q") == q, _shared(size, c_size, q, threshold))
    common = _common(size, c_size, threshold)
    bits, c_bits = F.col("bits"), F.col("c_bits")
    rest = F.least(F.size("grams") - F.col("place"), F.size("c_grams") - F.col("c_place"))
    possible = (
        (F.least("size", "c_size") >= common)
        & (size - F.bit_count(bits.bitwiseAND(F.bitwise_not(c_bits))) >= common)
        & (c_size - F.bit_count(c_bits.bitwiseAND(F.bitwise_not(bits))) >= common)
        & (rest >= needed)
    )
    if has_at_most(spellings, broadcast_titles):
        pairs = left.join(F.broadcast(right), "gram").where(possible)
    else:
        left = left.withColumn("salt", F.pmod(F.hash("clean"), F.lit(salts)))
        right = right.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
        pairs = left.join(right, ["gram", "salt"]).where(possible)
    pairs = computed_once(pairs, {"both": F.array_intersect("grams", "c_grams")})
    pairs = pairs.where((F.col("both")[0] == F.col("gram")) & (F.size("both") >= needed))
    return pairs.select("clean", F.col("c_clean").alias("candidate"), F.col("c_catalog_order").alias("catalog_order"))


def _best_similar(titles: DataFrame, spellings: DataFrame, threshold: float) -> DataFrame:
    """Best spelling of each of ``titles(clean)`` that has one: (clean, catalog_order, score).

    High ratios are looked for first, where few grams lead to a partner: what is found there cannot be beaten by
    what a lower one would add, so only titles that are still open are looked up again.
    """
    found = None
    for level in [x for x in _LEVELS if x > threshold] + [threshold]:
        pairs = title_candidates(titles, spellings, level)
        scored = pairs.withColumn("score", similarity("clean", "candidate")).where(F.col("score") >= level)
        best = durable(scored.groupBy("clean").agg(
            F.max_by("catalog_order", F.struct("score", -F.col("catalog_order"))).alias("catalog_order"),
            F.max("score").alias("score"),
        ))
        found = best if found is None else found.unionByName(best)
        if level > threshold:
            titles = durable(titles.join(broadcast_if_small(best.select("clean")), "clean", "left_anti"))
    return found


def fuzzy_title_match(df: DataFrame, catalog: DataFrame, title: str = "book_title", threshold: float = 0.75) -> DataFrame:
    """Best catalog title for each distinct title, at least ``threshold`` similar; first one on ties.

    An equal cleaned title scores 1 and cannot be beaten, so only the others are scored.
    """
    # Looked at three times; the rows they come from, and what it takes to make those, only once.
    wanted = durable(df.where(F.col(title).isNotNull()).select(title).distinct())
    wanted = wanted.withColumn("clean", clean_title(F.col(title), strip_subtitle=True))
    spellings = _first_spellings(catalog, clean_title(F.col("display_title"), strip_subtitle=True))
    known = broadcast_if_small(spellings.select("clean", "catalog_order"), counted=catalog)
    split = wanted.select("clean").distinct().join(known, "clean", "left")
    exact = split.where(F.col("catalog_order").isNotNull()).select("clean", "catalog_order", F.lit(1.0).alias("score"))

    rest = durable(split.where(F.col("catalog_order").isNull()).select("clean"))
    best = _best_similar(rest, durable(spellings), threshold)
    editions = broadcast_if_small(spellings.select("catalog_order", *MATCHED), counted=catalog)
    return exact.unionByName(best).join(editions, "catalog_order").join(wanted, "clean").select(
        title, "score", "catalog_order", *MATCHED
    )


def staged_resolution(
    df: DataFrame, catalog: DataFrame, id_col: str = "book_identifier", title: str = "book_title", fallback_slug: bool = False
) -> DataFrame:
    """Identifier match, then title match for the rows still without a series.

    A row that neither stage resolves has no attributes; ``fallback_slug`` keeps its raw identifier
    as slug.
    """
    first = enrich(df, id_col, catalog, fallback_slug=False)
    open_rows = F.col("series").isNull()
    by_title = durable(fuzzy_title_match(first.where(open_rows), catalog, title)).select(
        F.col(title).alias("_title"), *[F.col(c).alias(f"_{c}") for c in MATCHED]
    )
    joined = join_dimension(first, by_title, "_title", F.when(open_rows, F.col(title)))
    filled = {c: F.when(open_rows, F.col(f"_{c}")).otherwise(F.col(c)) for c in MATCHED}
    resolved = joined.withColumns(filled).drop("_title", *[f"_{c}" for c in MATCHED])
    if fallback_slug:
        resolved = resolved.withColumn("canonical_work_slug", F.coalesce("canonical_work_slug", F.col(id_col)))
    return resolved


def match_rate(df: DataFrame, by: str) -> DataFrame:
    counts = df.groupBy(by).agg(F.count_if(F.col("series").isNotNull()).alias("matched"), F.count(F.lit(1)).alias("total"))
    pct = F.round((F.col("matched") * 100.0 / F.col("total")).cast("decimal(12,6)"), 1).cast("double")
    return counts.withColumn("match_pct", pct)


def build_dimension(catalog: DataFrame) -> DataFrame:
    """One row per edition with an identifier: the first non-blank of the id columns, and all of them as text."""
    present = [c for c in ID_PRIORITY if c in catalog.columns]
    filled = {c: F.nullif(F.trim(c), F.lit("")) for c in present}
    listed = F.concat_ws("; ", *[F.when(v.isNotNull(), F.concat(F.lit(f"{c}:"), v)) for c, v in filled.items()])
    return catalog.select(
        F.coalesce(*filled.values()).alias("book_identifier"),
        "canonical_work_slug", "display_title", "series", "edition_format", listed.alias("other_ids"),
    ).where(F.col("book_identifier").isNotNull())
