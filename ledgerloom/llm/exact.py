"""Exact deduplication by content-defined chunk recipes, with DataFrame functions only.

A text is cut where its content says so: at the first line or sentence end after ``LEAST`` characters, or after
``MOST`` characters.  Equal texts have equal cuts.  A chunk's identifier is its 64-bit hash, verified against
all chunks of the corpus: chunk contents are grouped once, byte for byte, and a hash that stands for more than
one content gets a number for each of them.  A document is then its ordered list of identifiers (its recipe),
and only recipes are grouped, joined and shuffled from there on.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.scale import durable

LEAST = 512
MOST = 4096


def chunks(text: Column) -> Column:
    """Content-defined chunks; their concatenation is the text, and an empty text has none."""
    cut = rf"(?s).{{{LEAST},{MOST - 1}}}?[.!?\n]|.{{1,{MOST}}}"
    return F.regexp_extract_all(text, F.lit(cut), F.lit(0))


def _hash(chunk: Column) -> Column:
    return F.xxhash64(chunk)


def recipes(docs: DataFrame, chunk_hash=_hash) -> DataFrame:
    """``doc_id, text_sha256, recipe``; equal recipes are equal texts.

    ``recipe`` holds one verified identifier per chunk: ``(hash, number)``, where ``number`` is 0 unless two
    contents share the hash.
    """
    texts = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")
    )
    contents = (
        texts.select(F.explode(chunks(F.col("text"))).alias("chunk"))
        .groupBy("chunk").agg(F.count(F.lit(1)).alias("uses"))
        .select(chunk_hash(F.col("chunk")).alias("hash"), "chunk")
    )
    # One content per row by now.  Hashes of several contents are counted without moving the contents again.
    shared = durable(contents.select("hash").groupBy("hash").count().where("count > 1").select("hash"))
    hashed = texts.select(
        "doc_id", F.sha2("text", 256).alias("text_sha256"),
        F.transform(chunks(F.col("text")), lambda c: F.struct(chunk_hash(c).alias("hash"), F.lit(0).alias("number")))
        .alias("recipe"),
    )
    if shared.isEmpty():
        return hashed
    # Contents that share a hash are numbered by their bytes; there are next to none of them.
    numbered = contents.join(shared, "hash").groupBy("hash").agg(F.sort_array(F.collect_list("chunk")).alias("all"))
    row = F.xxhash64("doc_id", "text")
    parts = texts.select("doc_id", "text", row.alias("row"), F.posexplode(chunks(F.col("text"))).alias("at", "chunk"))
    parts = parts.select("doc_id", "row", "at", "chunk", chunk_hash(F.col("chunk")).alias("hash"))
    parts = parts.join(numbered, "hash", "left").select(
        "doc_id", "row", "at", "hash",
        F.coalesce(F.array_position("all", F.col("chunk")) - 1, F.lit(0)).cast("int").alias("number"),
    ).distinct()
    lists = parts.groupBy(F.col("doc_id").alias("d"), F.col("row").alias("r")).agg(
        F.transform(
            F.sort_array(F.collect_list(F.struct("at", "hash", "number"))),
            lambda c: F.struct(c["hash"].alias("hash"), c["number"].alias("number")),
        ).alias("recipe")
    )
    plain = texts.select("doc_id", F.sha2("text", 256).alias("text_sha256"), row.alias("row"))
    return (
        plain.join(lists, plain["doc_id"].eqNullSafe(lists["d"]) & (plain["row"] == lists["r"]), "left")
        .select("doc_id", "text_sha256", F.coalesce("recipe", F.array().cast("array<struct<hash:bigint,number:int>>"))
                .alias("recipe"))
    )


def exact_duplicates(docs: DataFrame, chunk_hash=_hash) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, keep_id, group_size, kept, text_sha256``.

    A null text counts as empty.  Of equal texts the largest ``doc_id`` stays; rows that repeat it stay with it.
    A null ``doc_id`` counts for ``group_size`` and never stays; in a group without any ``doc_id`` ``keep_id``
    is null.  Other columns are ignored; an empty table gives no rows.
    """
    listed = durable(recipes(docs, chunk_hash))
    groups = listed.groupBy("recipe").agg(F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
    return listed.join(groups, "recipe").select(
        "doc_id", "keep_id", "group_size",
        F.coalesce(F.col("doc_id") == F.col("keep_id"), F.lit(False)).alias("kept"), "text_sha256",
    )
