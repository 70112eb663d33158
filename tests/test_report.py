"""The subgroup report from one ranking against the tables made one by one."""

import math

import pytest
from pyspark.sql import functions as F

from caseflow.operators import evaluate as E

SETS = [["a"], ["b", "a"], []]


def scored(spark, levels, n=600):
    """Scores tied at so many levels, a third of the rows at one; nulls in score, label and subgroup."""
    i = F.col("id")
    h = lambda k: F.pmod(F.xxhash64("id", F.lit(k)), F.lit(1000))
    s = F.when(i % 3 == 0, 0.5).otherwise(F.floor(h(1) * levels / 1000) / levels)
    return spark.range(n).select(
        i,
        F.when(i % 41 != 0, s).alias("s"),
        F.when(i % 37 != 0, (h(2) < 300 + 400 * s).cast("int")).alias("y"),
        F.when(i % 7 != 0, F.concat(F.lit("g"), (i % 4).cast("string"))).alias("a"),
        F.when(i < 20, "rare").otherwise("often").alias("b"),
    )


def rows(df):
    num = lambda v: None if v is None or isinstance(v, float) and math.isnan(v) else round(v, 6) if isinstance(v, float) else v
    cols = sorted(df.columns)
    return sorted((tuple(num(r[c]) for c in cols) for r in df.collect()), key=str), cols


@pytest.mark.parametrize("levels", [5, 100_000])
def test_one_ranking_gives_the_same_tables(spark, levels):
    df = scored(spark, levels)
    got = E.tables_by_subgroup(df, "y", "s", SETS, ["id"], 7)
    d, by = E.subgroup_sets(df, SETS), ["set_name", "set_value"]
    want = {
        "summary": E.binary_summary(d, "y", "s", by),
        "roc": E.roc_curve(d, "y", "s", by),
        "pr": E.pr_curve(d, "y", "s", by),
        "thresholds": E.threshold_table(d, "y", "s", group=by),
        "bands": E.score_band_table(d, "y", "s", group=by),
        "groups": E.nth_group_table(d, "y", "s", ["id"], 7, by),
        "bottom_top": E.bottom_top_tables(d, "y", "s", ["id"], 7, by),
    }
    assert set(got) == set(want)
    for name, table in want.items():
        assert rows(got[name]) == rows(table), name


def test_upstream_runs_once_for_all_tables(spark):
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(len(b))
            yield b

    df = scored(spark, 20)
    df = df.mapInPandas(count, df.schema)
    tables = E.tables_by_subgroup(df, "y", "s", SETS, ["id"])
    assert all(t.count() for t in tables.values()) and seen.value == 600
    # what the tables read is ranked: none of them sorts rows again
    for name in ("summary", "roc", "pr", "thresholds", "bands"):
        plan = tables[name]._jdf.queryExecution().executedPlan().toString()
        assert "Window" not in plan and "rangepartitioning" not in plan
