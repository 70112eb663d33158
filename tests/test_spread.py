"""Anchors, ranks and running sums against brute force, with one patient holding most rows."""

import random

import pytest
from pyspark.sql import functions as F

from caseflow.functions import timegrid as tg
from caseflow.operators import entities as H, records as R
from caseflow.operators.anchors import densify_anchor
from caseflow.plans import spread as SP

BASE = 1_704_067_200_000_000
MIN = tg.MINUTE


def brute_anchor(times, gap):
    out, anchor = {}, None
    for t in sorted(times):
        if anchor is None or t > anchor + gap:
            anchor = t
        out[t] = anchor
    return out


def check(spark, rows, gap=31):
    df = spark.createDataFrame(rows, "p bigint, t bigint")
    got = {}
    n = 0
    for r in densify_anchor(df, ["p"], "t", gap).collect():
        got[(r["p"], r["t"])] = r["anchor_us"]
        n += 1
    assert n == len(rows)
    for p in {p for p, _ in rows}:
        want = brute_anchor([t for q, t in rows if q == p], gap * MIN)
        assert {t: a for (q, t), a in got.items() if q == p} == want


def test_anchor_edge(spark):
    """31 minutes after the anchor still joins it, 32 does not; distance is to the anchor."""
    check(spark, [(1, BASE), (1, BASE + 31 * MIN), (1, BASE + 32 * MIN), (1, BASE + 62 * MIN), (1, BASE + 64 * MIN)])


@pytest.mark.parametrize("seed", range(4))
def test_anchor_dense_and_across_midnight(spark, seed):
    rnd = random.Random(seed)
    rows = []
    for p, (n, days) in enumerate([(1500, 6), (40, 6), (300, 3), (5, 30)]):
        rows += [(p, BASE + rnd.randrange(days * 24 * 60) * MIN + rnd.choice([0, 0, 17])) for _ in range(n)]
    rows += [(7, BASE + i * 5 * MIN) for i in range(288 * 4)]
    rows += [(8, BASE + 24 * 60 * MIN * k - 10 * MIN * j) for k in (1, 2, 3) for j in range(6)]
    rows += rows[:50]
    check(spark, rows, rnd.choice([31, 31, 45, 5]))


def test_anchor_all_of_a_day_inside_the_carried_anchor(spark):
    rows = [(1, BASE + 24 * 60 * MIN - MIN), (1, BASE + 24 * 60 * MIN + 5 * MIN), (1, BASE + 48 * 60 * MIN + MIN)]
    check(spark, rows)


def hot_rows(spark, n=3000):
    """A third of all rows belong to one group."""
    i = F.col("id")
    return spark.range(n).select(
        F.when(i % 3 == 0, 0).otherwise(i % 500).alias("g"),
        (F.xxhash64("id") % 100000).alias("k"),
        i.alias("id"),
        (i % 7).cast("double").alias("x"),
    )


def test_running_sum_and_rank(spark):
    df = hot_rows(spark)
    out = SP.running(df, ["k", "id"], {"s": F.col("x"), "n": F.lit(1)}, ["g"]).toPandas()
    out = out.sort_values(["g", "k", "id"])
    assert (out["n"] == out.groupby("g").cumcount() + 1).all()
    assert (abs(out["s"] - out.groupby("g")["x"].cumsum()) < 1e-9).all()
    whole = SP.rank_rows(df, ["k", "id"], "r").toPandas().sort_values(["k", "id"])
    assert whole["r"].tolist() == list(range(1, len(whole) + 1))


def test_rank_of_text_keys_and_small_tables(spark):
    df = spark.createDataFrame([(x,) for x in "dbcae"], "k string")
    got = {r["k"]: r["r"] for r in SP.rank_rows(df, ["k"], "r").collect()}
    assert got == {"a": 1, "b": 2, "c": 3, "d": 4, "e": 5}
    assert SP.rank_rows(df.where("k > 'z'"), ["k"], "r").count() == 0


def test_global_rank_does_not_use_one_task(spark, monkeypatch):
    """Rows are windowed by chunk; only the chunk sums, one row a chunk, meet in one task."""
    monkeypatch.setattr(SP, "ROWS_PER_CHUNK", 400)
    df = SP.rank_rows(hot_rows(spark), ["k", "id"], "r")
    plan = df._jdf.queryExecution().executedPlan().toString().split("\n")
    assert any("Window [" in line and "windowspecdefinition(_chunk" in line for line in plan)
    single = [i for i, line in enumerate(plan) if "Exchange SinglePartition" in line]
    assert all("HashAggregate(keys=[_chunk" in plan[i + 1] for i in single)
    sums = SP.with_chunks(hot_rows(spark), ["k", "id"]).groupBy("_chunk").count().collect()
    assert len(sums) == 8 and max(r["count"] for r in sums) < 3000 * 0.3


@pytest.mark.parametrize("rows_per_chunk", [10_000, 300])
def test_ranks_do_not_depend_on_the_cluster(spark, monkeypatch, rows_per_chunk):
    """Null keys come first, null groups are groups, and settings change no rank."""
    monkeypatch.setattr(SP, "ROWS_PER_CHUNK", rows_per_chunk)
    df = hot_rows(spark, 1000).withColumn("k", F.when(F.col("id") % 100 != 0, F.col("k")))
    df = df.withColumn("g", F.when(F.col("g") != 3, F.col("g")))
    found = []
    for parts in ("2", "8"):
        spark.conf.set("spark.sql.shuffle.partitions", parts)
        whole = {r["id"]: r["r"] for r in SP.rank_rows(df, ["k", "id"], "r").collect()}
        inside = {r["id"]: r["r"] for r in SP.rank_rows(df, ["k", "id"], "r", ["g"]).collect()}
        found.append((whole, inside))
    assert found[0] == found[1]
    whole, inside = found[0]
    rows = [(r["g"], r["k"], r["id"]) for r in df.collect()]
    order = sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2]))
    assert [whole[r[2]] for r in order] == list(range(1, 1001))
    for g in {r[0] for r in rows}:
        mine = [r for r in order if r[0] == g]
        assert [inside[r[2]] for r in mine] == list(range(1, len(mine) + 1))


def test_nulls_ties_and_long_numbers(spark):
    rows = [(1, None, "a"), (1, BASE, "b"), (1, BASE, "a"), (None, BASE, "c")]
    df = spark.createDataFrame(rows, "PID bigint, us bigint, x string").withColumn("DT_s", tg.from_micros("us"))
    got = {(r["PID"], r["us"], r["x"]): r["rid"] for r in R.assign_record_id(df, "rid").collect()}
    assert got[(1, None, "a")] == "1-0000000" and got[(1, BASE, "a")] == "1-0000001" and got[(1, BASE, "b")] == "1-0000002"
    assert len(got) == 4
    assert R.time_to_last_entry(df, "PID").count() == 4
    many = spark.range(12).select((F.col("id") + 1).alias("k"))
    wide = {r["k"]: r["PID"] for r in H.assign_entity_id(many, "k", 3, width=1).collect()}
    assert wide[9] == 39 and wide[12] == 312


def test_a_busy_patient_day(spark):
    """100,000 distinct times in one day: the work per day stays near-linear."""
    df = spark.range(100_000).select(F.lit(1).alias("p"), (F.col("id") * 800_000 + BASE).alias("t"))
    out = densify_anchor(df, ["p"], "t").groupBy("anchor_us").count().collect()
    want = brute_anchor([i * 800_000 + BASE for i in range(100_000)], 31 * MIN)
    assert {r["anchor_us"] for r in out} == set(want.values())
    assert sum(r["count"] for r in out) == 100_000


def test_a_missing_time_is_named(spark):
    df = spark.createDataFrame([(7, None)], "PatientID bigint, DT_s timestamp_ntz")
    with pytest.raises(Exception, match="patient 7"):
        R.densify(df).collect()


def test_previous_time(spark):
    rows = [(0, BASE + d * tg.DAY + m * MIN) for d in (0, 1, 5, 6) for m in (3, 700, 1439)] + [(1, BASE)]
    df = spark.createDataFrame(rows, "p bigint, t bigint")
    got = {(r["p"], r["t"]): r["b"] for r in SP.previous_time(df, ["p"], "t", "b").collect()}
    for p in (0, 1):
        times = sorted(t for q, t in rows if q == p)
        assert [got[(p, t)] for t in times] == [None, *times[:-1]]


def test_slices_cover_all_patients_once(spark):
    df = spark.range(23).select((F.col("id") * 17 % 23).alias("PatientID"))
    parts = [[r[0] for r in H.entity_slice(df, "PatientID", f"{i}/4").collect()] for i in range(1, 5)]
    assert [len(p) for p in parts] == [5, 5, 5, 8]
    assert sorted(sum(parts, [])) == list(range(23))
    with pytest.raises(ValueError):
        H.entity_slice(df, "PatientID", "5/4")


def test_record_ids_of_a_hot_patient(spark):
    rows = [(1, BASE + i * 5 * MIN) for i in range(2000)] + [(2, BASE)]
    df = spark.createDataFrame(rows, "PID bigint, us bigint").withColumn("DT_s", tg.from_micros("us"))
    out = R.assign_record_id(df, "rid").toPandas().sort_values(["PID", "us"])
    assert out["rid"].tolist() == [f"1-{i:07d}" for i in range(2000)] + ["2-0000000"]
    assert R.assign_record_id(out_df := df.withColumn("rid", F.lit("x")), "rid") is out_df


@pytest.mark.parametrize("every, days", [(20, 20 * 365), (1441, 300), (30, 3)])
def test_an_unbroken_patient_is_composed_day_by_day(spark, every, days):
    """20 years without a quiet evening, on a grid whose walks never meet: exact, and no row of a
    composed table is longer than a day's own steps."""
    n = days * 24 * 60 // every
    df = spark.range(n).select(F.lit(1).alias("p"), (F.col("id") * every * MIN + BASE).alias("t"))
    got = {r["t"]: r["anchor_us"] for r in densify_anchor(df, ["p"], "t").collect()}
    assert got == brute_anchor([i * every * MIN + BASE for i in range(n)], 31 * MIN)


def test_composed_rows_stay_as_long_as_a_day(spark):
    from caseflow.operators import anchors as A

    gap = 31 * MIN
    df = spark.range(200 * 288).select(F.lit(1).alias("p"), (F.col("id") * 5 * MIN + BASE).alias("t"))
    days = df.groupBy("p", F.expr(f"t div {tg.DAY}").alias("_day")).agg(F.sort_array(F.collect_set("t")).alias("_us"))
    days = SP.stored(A._day_steps(days, gap), "days")
    assert days.agg(F.max(F.size("_step"))).first()[0] <= 8
    carried = A._carried(days, ["p"], gap)
    plan = carried._jdf.queryExecution().executedPlan().toString()
    assert "collect_list" not in plan and plan.count("Exchange hashpartitioning") == 1
    want = brute_anchor([i * 5 * MIN + BASE for i in range(200 * 288)], gap)
    for r in carried.collect():
        start = r["_day"] * tg.DAY
        assert r["_carry"] == (None if start == BASE else want[start - 5 * MIN])


def test_scratch_tables_go_when_the_caller_says_so(spark):
    import os

    folder = SP.shared_dir(spark)
    kept = SP.scratch_path(spark, "kept")
    hot_rows(spark, 50).write.parquet(kept)
    before = set(os.listdir(folder))
    with SP.scratch(spark):
        got = SP.rank_rows(hot_rows(spark, 50), ["k", "id"], "r").count()
        assert set(os.listdir(folder)) > before
    assert got == 50 and set(os.listdir(folder)) == before and spark.read.parquet(kept).count() == 50
    with pytest.raises(KeyError), SP.scratch(spark):
        SP.stored(hot_rows(spark, 5), "x")
        raise KeyError
    assert set(os.listdir(folder)) == before
