"""Hooks that walk whole patients with a small state."""

import pandas as pd
import pytest
from pyspark.sql import functions as F

from caseflow.functions import timegrid as tg
from caseflow.operators import records as R
from caseflow.operators.anchors import densify_anchor
from caseflow.plans import timeline as TL

BASE = 1_704_067_200_000_000
OUT = "p bigint, t bigint, place bigint, top double, since double"


def history(spark):
    """A patient with two thirds of the rows, small ones, and rows without a patient."""
    i = F.col("id")
    return spark.range(3000).select(
        F.when(i % 3 != 0, 1).when(i % 30 != 0, i % 40 + 2).cast("bigint").alias("p"),
        (F.pmod(F.xxhash64("id"), F.lit(2000)) * tg.STEP + BASE).alias("t"),
        (F.pmod(F.xxhash64("id", F.lit(1)), F.lit(500)) / 10).alias("x"),
    )


def stepper():
    def step(rows, state):
        """Place among the patient's rows, the highest value so far, and steps since it was reached: all of the history."""
        place, top, at = state
        out = []
        for r in rows.itertuples():
            place += 1
            if r.x > top:
                top, at = r.x, r.t
            out.append((r.p, r.t, place, top, (r.t - at) / tg.STEP))
        made = pd.DataFrame(out, columns=["p", "t", "place", "top", "since"])
        return made.astype({"p": "Int64"}), (place, top, at)

    return step


@pytest.mark.parametrize("batch", [7, 400, 100_000])
def test_a_long_history_equals_the_plain_walk(spark, batch):
    df, step = history(spark), stepper()
    whole = df.toPandas().sort_values(["t", "x"])
    want = []
    for p, rows in whole.groupby("p", dropna=False):
        want += step(rows.assign(p=None if pd.isna(p) else int(p)), (0, -1.0, 0))[0].values.tolist()
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    try:
        got = TL.walk_patients(df, "p", step, OUT, ["t"], lambda p: (0, -1.0, 0)).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    plain = lambda rows: sorted((tuple(None if pd.isna(v) else float(v) for v in r) for r in rows), key=str)
    assert plain(map(tuple, got)) == plain(want) and len(got) == 3000


def test_a_record_hook_that_walks(spark):
    """Anchors by a walk over whole patients, as a record hook, equal the distributed ones; the end may add rows."""
    gap = 31 * tg.MINUTE

    def walk(rows, anchor):
        out = []
        for t in rows["t"].tolist():
            if anchor is None or t > anchor + gap:
                anchor = t
            out.append(anchor)
        return pd.DataFrame({"p": rows["p"], "t": rows["t"], "anchor_us": out}), anchor

    def last(p, anchor):
        return pd.DataFrame({"p": [p], "t": [-1], "anchor_us": [anchor]})

    def hook(raw, human):
        return TL.walk_patients(raw.join(human, "p"), "p", walk, "p bigint, t bigint, anchor_us bigint", "t", end=last)

    TL.register("record", "walked", hook)
    df = history(spark).where("p is not null").drop("x").distinct()
    got = TL.hook("record", "walked")(df, df.select("p").distinct())
    want = densify_anchor(df, ["p"], "t").select("p", "t", "anchor_us")
    assert sorted(map(tuple, got.where("t >= 0").collect())) == sorted(map(tuple, want.collect()))
    ends = {r["p"]: r["anchor_us"] for r in got.where("t < 0").collect()}
    assert ends == {r["p"]: r["m"] for r in want.groupBy("p").agg(F.max("anchor_us").alias("m")).collect()}


def test_no_rows_no_calls(spark):
    boom = lambda *a: 1 / 0
    assert TL.walk_patients(history(spark).where("p > 999"), "p", boom, OUT, "t", boom, boom).collect() == []
    nothing = TL.walk_patients(history(spark), "p", lambda rows, s: (None, s), OUT, "t")
    assert nothing.collect() == []
