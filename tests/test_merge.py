"""Outer joins of raw tables with busy patients: every pair once, every lone row once, even tasks."""

import os
import random
import statistics
import subprocess
import sys
from collections import Counter

import pytest
from pyspark.sql import functions as F

from caseflow.operators import records as R


def plain(a, b, keys):
    out, met = [], set()
    for x in a:
        mates = [y for y in b if all(x[k] is not None and x[k] == y[k] for k in range(keys))]
        out += [(*x, *y[keys:]) for y in mates] or [(*x, None)]
        met |= {id(y) for y in mates}
    return Counter(out + [(*y[:keys], None, y[keys]) for y in b if id(y) not in met])


@pytest.mark.parametrize("cell", [1, 3, 25, 10_000])
@pytest.mark.parametrize("seed", range(2))
def test_every_pair_and_every_lone_row_once(spark, cell, seed):
    rnd = random.Random(seed)
    key = lambda: rnd.choice([1, 1, 1, 2, 3, 4, None, rnd.randrange(5, 30)])
    a = [(key(), f"a{i % 50}") for i in range(60)] + [(98, "x")] * 9  # a busy key of one side, all its rows equal
    b = [(key(), f"b{i % 50}") for i in range(50)] + [(99, f"y{i}") for i in range(40)]
    da, db = spark.createDataFrame(a, "p int, a string"), spark.createDataFrame(b, "p int, b string")
    got = Counter(map(tuple, R.merge_raws([da, db], "p", cell).select("p", "a", "b").collect()))
    assert got == plain(a, b, 1)


def test_several_keys_and_tables(spark):
    rnd = random.Random(9)
    rows = lambda t: [(rnd.choice([1, None, 2]), rnd.choice("uv"), f"{t}{i}") for i in range(12)]
    a, b = rows("a"), rows("b")
    frames = [spark.createDataFrame(r, f"p int, q string, {n} string") for r, n in ((a, "a"), (b, "b"))]
    got = R.merge_raws(frames, ["p", "q"], 2).select("p", "q", "a", "b")
    assert Counter(map(tuple, got.collect())) == plain(a, b, 2)
    three = R.merge_raws([*frames, frames[0].withColumnRenamed("a", "c")], ["p", "q"], 2)
    want = frames[0].join(frames[1], ["p", "q"], "full_outer").join(frames[0].withColumnRenamed("a", "c"), ["p", "q"], "full_outer")
    assert Counter(map(tuple, three.collect())) == Counter(map(tuple, want.select(three.columns).collect()))


def test_a_third_of_both_tables_is_no_task_of_its_own(spark):
    """Pairs of the busy patient lie in many tasks, none over twice the median."""
    keys = {"spark.sql.adaptive.enabled": "false", "spark.sql.shuffle.partitions": "16", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    i = F.col("id")
    a = spark.range(3000).select(F.when(i % 3 == 0, 0).otherwise(i).alias("p"), i.alias("a"))
    b = spark.range(2400).select(F.when(i % 3 == 0, 0).otherwise(i).alias("p"), i.alias("b"))
    for k, v in keys.items():
        spark.conf.set(k, v)
    try:
        out = R.merge_raws([a, b], "p", 40).withColumn("task", F.spark_partition_id())
        sizes = [r["count"] for r in out.groupBy("task").count().collect()]
        assert out.where("p = 0").count() == 1000 * 800
    finally:
        for k in keys:
            spark.conf.unset(k)
    assert len(sizes) == 16 and max(sizes) < 2 * statistics.median(sizes)


def test_slices_do_not_grow_with_the_pairs(spark):
    """Few slices are cut by ``cell``, many by what tasks need; a row is copied once a slice of the other side."""
    sizes = spark.createDataFrame([(0,), (100,), (10_000,), (90_000,), (40_000_000,)], "n long")
    assert [r[0] for r in sizes.select(R._slices("n", 30)).collect()] == [1, 4, 64, 64, 2000]
    assert [r[0] for r in sizes.select(R._slices("n", 50_000)).collect()] == [1, 1, 1, 2, 800]
    a = spark.range(700).select(F.lit(1).alias("p"), F.col("id").alias("a"))
    b = spark.range(500).select(F.lit(1).alias("p"), F.col("id").alias("b"))
    got = R.merge_raws([a, b], "p", 1)
    assert got.count() == got.distinct().count() == 700 * 500


def test_pairs_of_a_key_are_not_held_at_once(tmp_path):
    """9 million pairs of one key pass through a heap that is too small for them."""
    code = f"""
from pyspark.sql import SparkSession, functions as F
from caseflow.operators import records as R
s = SparkSession.builder.master("local[1]").config(map={{
    "spark.driver.memory": "512m", "spark.ui.enabled": "false", "spark.sql.shuffle.partitions": "2",
    "spark.checkpoint.dir": {str(tmp_path / "shared")!r}, "spark.local.dir": {str(tmp_path)!r}}}).getOrCreate()
s.sparkContext.setLogLevel("OFF")
a, b = (s.range(3030).select(F.when(F.col("id") < 3000, 7).otherwise(F.col("id")).alias("p"), F.col("id").alias(n)) for n in "ab")
R.merge_raws([a, b], "p").write.format("noop").mode("overwrite").save()
print("whole")
"""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    env = {k: v for k, v in os.environ.items() if not k.startswith("SPARK_")} | {"PYTHONPATH": root}
    ran = subprocess.run([sys.executable, "-c", code], env=env, cwd=root, capture_output=True, text=True, timeout=600)
    assert ran.stdout.strip().endswith("whole"), ran.stderr[-500:]


@pytest.mark.parametrize("cell", [2, 10_000])
def test_rows_of_one_side_and_columns_as_a_full_outer_join_has_them(spark, cell):
    """Null keys on both sides, keys of one side, an empty side; keys come first, tables may share a name unless dealt out."""
    a = spark.createDataFrame([(f"a{i}", k, q) for i, (k, q) in enumerate([(1, "u"), (1, None), (None, None), (None, "u"), (2, "u")] * 5)], "t string, p int, q string")
    b = spark.createDataFrame([(q, f"b{i}", k) for i, (k, q) in enumerate([(1, "u"), (1, None), (None, None), (None, "u"), (3, "u")] * 4)], "q string, t string, p long")
    b = b if cell > 20 else b.withColumnRenamed("t", "s")
    for x, y in ((a, b), (a.limit(0), b), (a, b.limit(0))):
        got, want = R.merge_raws([x, y], ["p", "q"], cell), x.join(y, ["p", "q"], "full_outer")
        assert [(f.name, f.dataType) for f in got.schema] == [(f.name, f.dataType) for f in want.schema]
        assert Counter(map(tuple, got.collect())) == Counter(map(tuple, want.collect()))
    if cell > 20:
        c = a.select("p", "q", F.col("t").alias("u"))
        got, want = R.merge_raws([a, b, c], ["p", "q"], cell), a.join(b, ["p", "q"], "full_outer").join(c, ["p", "q"], "full_outer")
        assert got.columns == want.columns
        assert Counter(map(tuple, got.collect())) == Counter(map(tuple, want.collect()))
