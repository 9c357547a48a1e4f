"""Stages of the pipeline on rows without ids, repeated rows, empty tables and clashing columns."""

import random

import corpus_pipeline as pipeline


def text(seed, n=40):
    pick = random.Random(seed)
    return " ".join(f"{pick.choice('bcdfgh')}{pick.choice('aeiou')}{pick.randrange(4000)}" for _ in range(n))


def kept(stage, spark, rows, sf_dir):
    docs = spark.createDataFrame(rows, "doc_id long, text string, _row_key string, kept string")
    out = stage(spark, docs, sf_dir)
    assert out.columns == docs.columns
    return sorted((r["doc_id"] or 0, r["_row_key"]) for r in out.collect())


def test_rows_without_id_are_decided(spark, sf_dir):
    same, alone = text(1), text(2)
    rows = [(1, same, "a", None), (None, same, "b", None), (None, alone, "c", None), (None, alone, "d", None),
            (2, None, "e", None), (None, "", "f", None)]
    exact = kept(pipeline.exact_dedup, spark, rows, sf_dir)
    assert exact in ([(0, "c"), (1, "a"), (2, "e")], [(0, "d"), (1, "a"), (2, "e")])
    near = kept(pipeline.near_dedup, spark, [*rows, (None, same + " more", "g", None)], sf_dir)
    assert [n for _, n in near if n in "abg"] == ["a"] and sum(n in "cd" for _, n in near) == 1
    assert {"e", "f"} <= {n for _, n in near}


def test_leaks_without_id_go(spark, sf_dir):
    item = spark.read.parquet(f"{sf_dir}/benchmark.parquet").first()["text"]
    rows = [(None, f"{text(3)} {item} {text(4)}", "a", None), (None, text(5), "b", None), (7, item, "c", None), (8, None, "d", None)]
    assert kept(pipeline.decontaminate, spark, rows, sf_dir) == [(0, "b"), (8, "d")]


def test_quality_of_rows_without_id(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    whole = pipeline.quality(spark, docs, sf_dir)
    good = {r["doc_id"]: r["text"] for r in whole.collect()}
    bad = [r["text"] for r in docs.collect() if r["doc_id"] not in good]
    assert good and bad
    lost = spark.createDataFrame([(None, bad[0]), (None, next(iter(good.values())))], "doc_id long, text string")
    got = pipeline.quality(spark, docs.unionByName(lost), sf_dir).where("doc_id is null").collect()
    assert [r["text"] for r in got] == [next(iter(good.values()))]


def test_empty_tables(spark, sf_dir):
    for _, stage in pipeline.STAGES[:-1]:
        assert kept(stage, spark, [], sf_dir) == []
