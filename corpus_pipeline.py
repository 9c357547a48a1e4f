"""Corpus pipeline: quality, exact and near duplicates, benchmark passages, packing.

Every stage takes ``(spark, docs, sf_dir)`` and returns the documents it keeps, with the columns of ``docs``;
the last returns packed pieces.  Between stages the documents are written and read again.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm.decontaminate import contaminated
from ledgerloom.llm.exact import exact_duplicates
from ledgerloom.llm.minhash import near_duplicates
from ledgerloom.llm.packing import pack
from ledgerloom.llm.quality import score_quality
from ledgerloom.scale import scratch_path


def _without_id(docs: DataFrame, sign: int) -> Column:
    """The ``doc_id``, or for a row without one a number of its text, far below or above other ids."""
    made = F.lit(1 << 62) + F.shiftrightunsigned(F.xxhash64(F.coalesce(docs["text"].cast("string"), F.lit(""))), 2)
    return F.coalesce(docs["doc_id"].cast("long"), made * F.lit(sign))


def _filtered(docs: DataFrame, ids: Callable[[DataFrame], DataFrame], how: str, sign: int = 1, once: bool = False) -> DataFrame:
    """Rows of ``docs`` whose key is among the ``doc_id`` of ``ids(docs)`` (or is not, by ``how``).

    Rows without an id are decided by their text; with ``once``, one of equal texts without an id is looked at.
    """
    key = "_row_key"
    while key in map(str.lower, docs.columns):
        key += "_"
    keyed = docs.withColumn(key, _without_id(docs, sign))
    if once:
        lost = keyed.where(F.col("doc_id").isNull()).dropDuplicates([key])
        keyed = keyed.where(F.col("doc_id").isNotNull()).unionByName(lost)
    found = ids(keyed.withColumn("doc_id", F.col(key)).drop(key))
    wanted = found.select(F.col("doc_id").alias("_found_id")).distinct()
    return keyed.join(wanted, keyed[key] == wanted["_found_id"], how).drop(key)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts.

    Rows that repeat are decided alike, null texts are scored as empty ones, an empty table gives an empty table;
    other columns are kept.
    """
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return _filtered(docs, lambda d: score_quality(d, labels).where("predicted = 1"), "left_semi")


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts; a null text equals an empty one.

    A row with an id is kept rather than one without.  Rows that repeat an id and a text are all kept.
    """
    return _filtered(docs, lambda d: exact_duplicates(d).where("kept"), "left_semi", sign=-1, once=True)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates; documents without words stay.

    A row with an id is kept rather than one without.  Rows that repeat an id are all kept or all dropped.
    """
    return _filtered(docs, lambda d: near_duplicates(d).where("kept"), "left_semi", once=True)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item; null and empty texts hold none, rows that repeat go alike."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return _filtered(docs, lambda d: contaminated(d, benchmark), "left_anti")


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the remaining documents in sequences of at most 2048 tokens."""
    return pack(docs)


STAGES = [
    ("quality", quality),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("decontaminate", decontaminate),
    ("packing", packing),
]

#: A classifier, a latent space and a packing are not expressible in SQL; see tests/llm.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage's result is written as Parquet and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
