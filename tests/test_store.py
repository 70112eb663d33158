"""Stores that know what they hold: changes are noticed, the same is reused, cut writes are redone."""

import os
import shutil

import pytest
from pyspark.sql import functions as F

from caseflow.config import Stage
from caseflow.operators import cases as C, policy as M
from caseflow.sources import fingerprint as FP, store as ST


@pytest.fixture
def cases(spark, tmp_path):
    spark.range(20).select(F.col("id").alias("PID"), (F.col("id") * 3 % 7).alias("x")).write.parquet(str(tmp_path / "cases"))
    return spark.read.parquet(str(tmp_path / "cases"))


class Steps:
    """Steps that note when they run."""

    def __init__(self):
        self.ran = []
        ran = self.ran

        def keep(df, rules):
            ran.append("filter")
            return C.filter_cases(df, rules)

        def double(df, by=2):
            ran.append("double")
            return df.withColumn("y", F.col("x") * by)

        self.steps = {"filter": keep, "double": double}


def run(cases, folder, low, steps=None, by=2):
    s = steps or Steps()
    stages = [Stage("filter", {"rules": [("x", ">=", low)]}), Stage("double", {"by": by})]
    out = C.run_stages(cases, stages, s.steps, folder)
    return sorted(map(tuple, out.collect())), s.ran


def want(low, by=2, n=20):
    return sorted((i, i * 3 % 7, i * 3 % 7 * by) for i in range(n) if i * 3 % 7 >= low)


def test_stages_run_once_and_again_when_something_changed(spark, cases, tmp_path):
    folder = str(tmp_path / "stages")
    assert run(cases, folder, 3) == (want(3), ["filter", "double"])
    assert run(cases, folder, 3) == (want(3), [])
    assert run(cases, folder, 3, by=5) == (want(3, 5), ["double"])  # a later argument: from there on
    assert run(cases, folder, 4, by=5) == (want(4, 5), ["filter", "double"])  # a rule
    more = cases.where("PID < 10")
    assert run(more, folder, 4, by=5) == (want(4, 5, 10), ["filter", "double"])  # other cases, same schema
    spark.range(12).select(F.col("id").alias("PID"), (F.col("id") * 3 % 7).alias("x")).write.mode("overwrite").parquet(str(tmp_path / "cases"))
    again = spark.read.parquet(str(tmp_path / "cases"))
    assert run(again, folder, 4)[0] == want(4, n=12)  # other files behind the same path


def test_a_changed_function_is_noticed(cases, tmp_path):
    folder, s = str(tmp_path / "stages"), Steps()
    run(cases, folder, 3, s)
    s.steps["double"] = lambda df, by=2: df.withColumn("y", F.col("x") - by)
    got, _ = run(cases, folder, 3, s)
    assert got == sorted((i, x, x - 2) for i, x, _ in want(3))


def test_a_half_written_stage_is_redone(cases, tmp_path):
    folder = str(tmp_path / "stages")
    run(cases, folder, 3)
    second = os.path.join(folder, "stage-001-double")
    os.remove(os.path.join(second, "_holds"))
    shutil.copy(os.path.join(second, "_SUCCESS"), os.path.join(second, "_SUCCESS_"))
    assert run(cases, folder, 3) == (want(3), ["double"])


def test_rows_of_the_driver_count_by_value(spark):
    a, b, c = (spark.createDataFrame([(1, x)], "a int, b string") for x in ("u", "u", "v"))
    assert FP.fingerprint(a) == FP.fingerprint(b) != FP.fingerprint(c)
    doubled = lambda k: spark.range(5).mapInPandas(lambda it: (p * k for p in it), "id bigint")
    assert FP.fingerprint(doubled(2)) == FP.fingerprint(doubled(2)) != FP.fingerprint(doubled(3))
    maps = [spark.range(2).select(F.create_map(F.lit("k"), F.col("id") + i).alias("m")) for i in (0, 0, 1)]
    assert FP.fingerprint(maps[0]) == FP.fingerprint(maps[1]) != FP.fingerprint(maps[2])


def test_fingerprints_of_values_and_plans(spark, cases):
    plan = lambda k: cases.where(F.exists(F.array("x", "PID"), lambda v: v > k)).groupBy("x").count()
    assert FP.fingerprint(plan(3)) == FP.fingerprint(plan(3)) != FP.fingerprint(plan(4))
    assert FP.fingerprint({"a": 1, "b": [F.col("x") > 1]}) == FP.fingerprint({"b": [F.col("x") > 1], "a": 1})
    assert FP.fingerprint(1) != FP.fingerprint("1") != FP.fingerprint([1])
    assert FP.fingerprint(1) != FP.fingerprint(True)
    frames = {"r": cases}
    fn = lambda f: (lambda ids: ids.join(f["r"], "PID"))
    assert FP.fingerprint(fn(frames)) == FP.fingerprint(fn({"r": cases})) != FP.fingerprint(fn({"r": cases.where("x = 1")}))


def test_tables_and_features_follow_their_parameters(spark, cases, tmp_path):
    ran = []

    def table(k):
        def make():
            ran.append(k)
            return cases.where(F.col("x") > k)

        return ST.load_or_compute(spark, str(tmp_path / "t"), make, holds=(cases, k)).count()

    assert [table(2), table(2), table(5), table(5)] == [cases.where(f"x > {k}").count() for k in (2, 2, 5, 5)]
    assert ran == [2, 5]

    def feature(k):
        def make(ids):
            ran.append(ids.count())
            return ids.withColumn("f", F.col("PID") * k)

        out = ST.load_missing(spark, cases, ["PID"], str(tmp_path / "f"), {"f": make})
        return out.agg(F.sum("f")).first()[0]

    assert [feature(2), feature(2), feature(3), feature(2)] == [380, 380, 570, 380]
    assert ran == [2, 5, 20, 20]


def test_upstream_of_stored_inference_runs_once(spark, tmp_path):
    """A model that fails on one part: the others are committed, and the next run scores that part alone,
    without running what is upstream again."""
    upstream, scored = spark.sparkContext.accumulator(0), spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            upstream.add(len(b))
            yield b

    df = spark.range(1000).mapInPandas(count, "id bigint")
    part = {r["id"]: r["p"] for r in spark.range(1000).select("id", F.expr("pmod(xxhash64(id), 4)").alias("p")).collect()}

    def load(fails):
        def model():
            def predict(b):
                import pandas as pd

                if fails and any(part[i] == 2 for i in b["id"]):
                    raise ValueError("no part 2 today")
                scored.add(len(b))
                return pd.DataFrame({"twice": b["id"] * 2})

            return predict

        return model

    path = str(tmp_path / "inf")
    with pytest.raises(Exception, match="no part 2 today"):
        M.batch_infer_stored(df, load(True), ["id"], "twice bigint", path, parts=4)
    sizes = [sum(p == k for p in part.values()) for k in range(4)]
    assert upstream.value == 1000 and scored.value == 1000 - sizes[2]
    out = M.batch_infer_stored(df, load(False), ["id"], "twice bigint", path, parts=4)
    assert sorted(map(tuple, out.collect())) == [(i, 2 * i) for i in range(1000)]
    assert upstream.value == 1000 and scored.value == 1000
    assert not os.path.exists(os.path.join(path, "inputs"))
    again = M.batch_infer_stored(df, load(True), ["id"], "twice bigint", path, parts=4)
    assert again.count() == 1000 and scored.value == 1000
    M.batch_infer_stored(df, load(False), ["id"], "twice bigint", path, parts=4, holds="another model")
    assert scored.value == 2000 and upstream.value == 2000
