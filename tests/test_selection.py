"""The first rows and rows between ranks against a plain sort; nothing is written."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from caseflow.operators import cases as C, entities as H, splits as P
from caseflow.plans import selection as SE


def many(spark, n=4000):
    """Ties, nulls, several types, and one key that a third of the rows share."""
    i = F.col("id")
    return spark.range(n).select(
        F.when(i % 50 != 0, F.when(i % 3 == 0, 7).otherwise(i * 7919 % 400)).alias("a"),
        F.concat(F.lit("s"), (i % 11).cast("string")).alias("b"),
        F.timestamp_micros(F.lit(1_700_000_000_123_456) + i % 13).cast("timestamp_ntz").alias("t"),
        (i % 5 / 7).alias("x"),
    )


def plain(df, order):
    key = lambda r: tuple((r[c] is not None, r[c]) if r[c] is not None else (False, 0) for c in order)
    return sorted(map(tuple, df.collect()), key=lambda r: key(dict(zip(df.columns, r))))


ORDER = ["a", "b", "t", "x"]


@pytest.mark.parametrize("few, ranges", [(100_000, 256), (40, 4), (1, 7)])
@pytest.mark.parametrize("n", [0, 1, 37, 1333, 2600, 3999, 4000, 9000])
def test_first_rows_equal_a_sort(spark, monkeypatch, few, ranges, n):
    monkeypatch.setattr(SE, "FEW", few)
    monkeypatch.setattr(SE, "RANGES", ranges)
    monkeypatch.setattr(SE, "SAMPLE", 64)
    df = many(spark)
    got = plain(SE.first_rows(df, ORDER, n), ORDER)
    assert got == plain(df, ORDER)[:n]


@pytest.mark.parametrize("few", [100_000, 30])
def test_rows_between_ranks(spark, monkeypatch, few):
    monkeypatch.setattr(SE, "FEW", few)
    monkeypatch.setattr(SE, "SAMPLE", 64)
    df = spark.range(1000).select((F.col("id") * 37 % 1000).alias("k"))
    for low, high in ((0, 250), (250, 500), (750, 1000), (900, 2000), (1000, 1200), (5, 5)):
        assert sorted(r[0] for r in SE.rows_between(df, ["k"], low, high).collect()) == list(range(low, min(high, 1000)))
    parts = [[r[0] for r in H.entity_slice(df, "k", f"{i}/3").collect()] for i in (1, 2, 3)]
    assert [len(p) for p in parts] == [333, 333, 334] and sorted(sum(parts, [])) == list(range(1000))


def test_a_key_that_no_sample_meets(spark, monkeypatch):
    """One rare key before a very frequent one: the search goes on all the same."""
    monkeypatch.setattr(SE, "FEW", 10)
    monkeypatch.setattr(SE, "SAMPLE", 4)
    df = spark.range(3000).select(F.when(F.col("id") == 1234, 1).otherwise(2).alias("k"))
    assert SE.first_rows(df, ["k"], 1500).groupBy("k").count().orderBy("k").collect() == [(1, 1), (2, 1499)]


def test_cuts_by_keys_of_all_types(spark, monkeypatch):
    monkeypatch.setattr(SE, "FEW", 3)
    monkeypatch.setattr(SE, "SAMPLE", 8)
    values = [
        ([1, None], None, b"\x01", dt.date(2020, 1, 1), float("nan"), True, ("x", 1)),
        ([1], 1.5, b"", None, float("-inf"), False, ("x", None)),
        (None, 2.5, None, dt.date(1999, 1, 1), None, None, (None, 2)),
        ([], 2.5, b"\xff", dt.date(2021, 1, 1), 1e-300, True, ("", 0)),
    ]
    schema = "a array<int>, d double, b binary, dt date, f double, o boolean, s struct<p:string,q:int>"
    df = spark.createDataFrame(values * 5, schema)
    for c in df.columns:
        want = [r[c] for r in df.orderBy(c).limit(11).collect()]
        got = SE.first_rows(df, [c], 11).orderBy(c).collect()
        assert str([r[c] for r in got]) == str(want)


def test_nothing_is_written_for_a_few_rows(spark, tmp_path):
    many(spark).withColumnsRenamed({"a": "PID", "t": "ObsDT"}).write.parquet(str(tmp_path / "cases"))
    cases = spark.read.parquet(str(tmp_path / "cases"))
    for df in (C.limit_cases(cases, 500), P.sample_n(cases, 500, 1)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "TakeOrderedAndProject" in plan and "Exchange" not in plan.replace("SinglePartition", "")
        assert plan.count("FileScan") == 1 and str(tmp_path) in plan
        assert df.count() == 500


def test_a_large_cut_is_a_filter(spark, monkeypatch, tmp_path):
    """No sort, no shuffle, no second copy: the rows below the key."""
    monkeypatch.setattr(SE, "FEW", 100)
    spark.range(20_000).select((F.col("id") * 7919 % 20_000).alias("k")).write.parquet(str(tmp_path / "t"))
    df = SE.first_rows(spark.read.parquet(str(tmp_path / "t")), ["k"], 12_345)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Sort" not in plan and "Exchange" not in plan and plan.count("FileScan") == 1
    assert df.agg(F.max("k"), F.count("*")).first() == (12_344, 12_345)
