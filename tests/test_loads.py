"""Loads: repeats, renamed copies and dead runs must not change what is stored."""

import datetime

import pytest
from pyspark.sql import functions as F

from ledgerloom.sources import loads

SCHEMA = "file_name string, sale_date date, title string, units int"


def report(spark, name, months, units=1):
    rows = [(name, datetime.date(2024, m, d), f"t{d}", units) for m in months for d in (1, 1, 9)]
    return spark.createDataFrame(rows, SCHEMA)


def states(df):
    return sorted((r.file_name, r.n, r.state) for r in df.collect())


def stored(spark, path, **dates):
    return sorted(map(tuple, loads.read_loads(spark, path, **dates).select("sale_date", "title", "units").collect()))


def test_repeats_and_copies_change_nothing(spark, tmp_path):
    path = str(tmp_path / "fact")
    first, second = report(spark, "a.csv", [1, 2]), report(spark, "b.csv", [2, 3], units=5)
    assert states(loads.append_fact(first, path)) == [("a.csv", 6, "loaded")]
    both = first.union(second).union(report(spark, "copy of b.csv", [2, 3], units=5)).orderBy(F.rand(1))
    assert states(loads.append_fact(both, path)) == [("a.csv", 6, "known"), ("b.csv", 6, "loaded"),
                                                     ("copy of b.csv", 6, "repeated")]
    want = sorted(tuple(r)[1:] for r in first.union(second).collect())
    assert stored(spark, path) == want
    assert states(loads.append_fact(both, path)) == [("a.csv", 6, "known"), ("b.csv", 6, "known"), ("copy of b.csv", 6, "known")]
    assert states(loads.append_fact(both.limit(0), path)) == []
    assert stored(spark, path) == want
    assert stored(spark, path, start="2024-02-02", end="2024-03-01") == [r for r in want if (2, 2) <= (r[0].month, r[0].day) <= (3, 1)]
    assert loads.manifest(spark, path).agg(F.sum("n")).first()[0] == 12


def test_dead_runs(spark, tmp_path, monkeypatch):
    """A run that ends before its entry is invisible, and its repeat gives the rows once."""
    path = str(tmp_path / "fact")
    loads.append_fact(report(spark, "a.csv", [1, 2]), path)
    second = report(spark, "b.csv", [2, 3], units=7)

    def dead(*_):
        raise KeyboardInterrupt

    with monkeypatch.context() as patched:
        patched.setattr(loads, "_commit", dead)
        with pytest.raises(KeyboardInterrupt):
            loads.append_fact(second, path)
    assert len(stored(spark, path)) == 6
    assert loads.uncommitted(spark, path).agg(F.sum("n")).first()[0] == 6
    # Dies again while writing: half of the tasks fail.
    broken = second.withColumn("units", F.when(F.col("sale_date") < "2024-03-05", F.col("units")).otherwise(
        F.raise_error(F.lit("lost")).cast("int")))
    with monkeypatch.context() as patched:
        patched.setattr(loads, "fingerprints", lambda df, file, _f=loads.fingerprints: _f(second, file))
        with pytest.raises(Exception, match="lost"):
            loads.append_fact(broken, path)
    assert len(stored(spark, path)) == 6
    assert states(loads.append_fact(second, path)) == [("b.csv", 6, "loaded")]
    assert len(stored(spark, path)) == 12 and loads.uncommitted(spark, path).count() == 0


def test_a_lost_part_is_not_committed(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "fact")
    monkeypatch.setattr(loads, "_write", lambda df, path, date, _w=loads._write: _w(df.limit(2), path, date))
    with pytest.raises(RuntimeError, match="2 of 6 rows"):
        loads.append_fact(report(spark, "a.csv", [1, 2]), path)
    assert loads.manifest(spark, path).count() == 0


def test_rows_that_could_not_be_found_again_are_refused(spark, tmp_path):
    for bad in ("file_name", "sale_date"):
        df = report(spark, "a.csv", [1]).withColumn(bad, F.lit(None).cast("string" if bad == "file_name" else "date"))
        with pytest.raises(ValueError):
            loads.append_fact(df, str(tmp_path / "fact"))


def test_another_column_later(spark, tmp_path):
    path = str(tmp_path / "fact")
    loads.append_fact(report(spark, "a.csv", [1]), path)
    loads.append_fact(report(spark, "b.csv", [1]).withColumn("price", F.lit(2.5)), path)
    got = loads.read_loads(spark, path)
    assert got.count() == 6 and got.where("price is null").count() == 3
