"""Window features against brute force, on dense and awkward data."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from caseflow.config import AF2H, AF2TO8H, BF24H, Observation, Window
from caseflow.functions import timegrid as tg
from caseflow.operators import features as X, observe as O

BASE = 1_704_067_200_000_000
STEP = tg.STEP


def make(spark, rows, value=True):
    """rows: (pid, microseconds[, value])."""
    schema = "PID bigint, us bigint" + (", BGValue double" if value else "")
    df = spark.createDataFrame(rows, schema)
    return df.withColumn("DT_s", tg.from_micros("us")).drop("us")


@pytest.fixture(scope="module")
def dense(spark):
    rnd = random.Random(3)
    recs, cases = [], []
    for pid in (1, 2, 3):
        for i in range(288 * 3):
            if pid == 1 or rnd.random() < 0.8:
                v = rnd.choice([0.0, 1e-06, 5.5, 20.0, 20.1, 100.7, 399.9, 400.0, float(rnd.randint(40, 300))])
                recs.append((pid, BASE + i * STEP, v))
        for i in range(0, 288 * 3, 7):
            cases.append((pid, BASE + i * STEP))
            cases.append((pid, BASE + i * STEP + rnd.choice([1, 61, 239, 240, 241, 299]) * tg.SECOND))
    cases.append((9, BASE))
    # a quiet window whose most frequent reading is zero, and one below the least reported value
    recs += [(5, BASE, 0.0), (5, BASE + STEP, 0.0), (5, BASE + 2 * STEP, 1e-06), (6, BASE, 1e-06)]
    cases += [(5, BASE + 2 * STEP), (6, BASE)]
    return recs, cases


def brute_info(recs, case, w):
    pid, t = case
    vals = [v for p, u, v in recs if p == pid and t + w.lo <= u < t + w.hi]
    n = len(vals)
    if not n:
        return (0.0, 0.0, 0.0, 0.0, 0)
    counts = Counter(vals)
    top = max(counts.values())
    mode = max(min(v for v, c in counts.items() if c == top), 1e-06)
    share = lambda xs: round(sum(xs) / n, 6)
    return (
        round(max(sum(v == mode for v in vals) / n, 1e-06), 6),
        share(v == 0 for v in vals),
        share(v >= 400 for v in vals),
        share(v <= 20 for v in vals),
        n,
    )


def brute_values(recs, case, w):
    pid, t = case
    out = {}
    for p, u, v in sorted(recs):
        if p == pid and t + w.lo <= u < t + w.hi:
            out[int((u - t) / STEP)] = int(v)
    return [out.get(s, 0) for s in range(w.first_step, w.last_step + 1)]


@pytest.mark.parametrize("w", [BF24H, AF2H, AF2TO8H], ids=lambda w: w.name)
def test_info_and_values_match_brute_force(spark, dense, w):
    recs, cases = dense
    c = make(spark, cases, value=False).withColumnRenamed("DT_s", "ObsDT")
    feats = [X.cgm_info("I", w), X.cgm_values("V", w)]
    out = O.observe_frame(c, {X.CGM: make(spark, recs)}, feats, value={X.CGM: "BGValue"})
    got = {}
    for r in out.withColumn("us", tg.micros("ObsDT")).collect():
        info = tuple(r[f"I-{k}"] for k in ("ModePercent", "ZeroPercent", "Geq400Percent", "Leq20Percent", "RecNum"))
        got[(r["PID"], r["us"])] = (info, list(r["V--tid"]))
    assert len(got) == len(set(cases))
    for case in cases:
        info, values = got[case]
        assert info == pytest.approx(brute_info(recs, case, w), abs=1e-9), case
        assert values == brute_values(recs, case, w), case


def test_window_ends(spark):
    """The case's own instant is inside the before window; +1 min is in and +121 min out after it."""
    t = BASE + 50 * STEP
    recs = [(1, t, 1.0), (1, t + tg.MINUTE, 2.0), (1, t + 121 * tg.MINUTE, 3.0), (1, t - 24 * tg.HOUR, 4.0)]
    recs += [(1, t - 24 * tg.HOUR - 1, 5.0)]
    c = make(spark, [(1, t)], value=False).withColumnRenamed("DT_s", "ObsDT")
    r = make(spark, recs)
    seen = lambda w: sorted(x["BGValue"] for x in O.observe_join(c, r, w, payload=["BGValue"]).collect())
    assert seen(BF24H) == [1.0, 4.0]
    assert seen(AF2H) == [2.0]


def test_first_last_and_counts_match_join(spark, dense):
    recs, cases = dense
    c = make(spark, sorted(set(cases)), value=False).withColumnRenamed("DT_s", "ObsDT")
    r = make(spark, recs[::11])
    joined = O.observe_join(c, r, BF24H).groupBy("PID", "ObsDT").agg(
        F.count("DT_s").alias("n"), F.min("DT_s").alias("first_time"), F.max("DT_s").alias("last_time")
    )
    count = O.Feature("w", BF24H, ("rec",), lambda q: {"n": q.count("rec")})
    framed = O.observe_frame(c, {"rec": r}, [count]).withColumnRenamed("w-n", "n")
    both = framed.join(O.asof_first_last(c, r, BF24H), ["PID", "ObsDT"])
    cols = ["PID", "ObsDT", "n", "first_time", "last_time"]
    assert sorted(map(tuple, joined.select(*cols).collect()), key=str) == sorted(
        map(tuple, both.select(*cols).collect()), key=str
    )


def test_collect_gives_the_window_in_order(spark, dense):
    recs, cases = dense
    c = make(spark, sorted(set(cases)), value=False).withColumnRenamed("DT_s", "ObsDT")
    f = O.Feature("c", AF2H, (X.CGM,), lambda q: {"obs": q.collect(X.CGM)})
    out = O.observe_frame(c, {X.CGM: make(spark, recs)}, [f], value={X.CGM: "BGValue"})
    for r in out.withColumn("us", tg.micros("ObsDT")).collect():
        t = r["us"]
        want = sorted((u, v) for p, u, v in recs if p == r["PID"] and t + AF2H.lo <= u < t + AF2H.hi)
        assert [(x["u"], x["v"]) for x in r["c-obs"]] == want


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_plan_shape(spark, dense):
    recs, cases = dense
    c = make(spark, cases, value=False).withColumnRenamed("DT_s", "ObsDT")
    r = make(spark, recs)
    counts = [X.dme_info("D", BF24H), X.dme_info("E", AF2H)]
    plan = _plan(O.observe_frame(c, {X.MED: r, X.EXERCISE: r, X.DIET: r}, counts))
    # one exchange for the frame of all kinds and windows, one for the packs, none for their join
    assert plan.count("Exchange hashpartitioning") == 2
    assert plan.count("Window [") == 1
    assert "BroadcastExchange" not in plan and "CartesianProduct" not in plan
    assert "Exchange SinglePartition" not in plan


def test_filter_is_not_pushed_into_features(spark, dense):
    recs, cases = dense
    c = make(spark, cases, value=False).withColumnRenamed("DT_s", "ObsDT")
    out = O.observe_frame(c, {X.CGM: make(spark, recs)}, [X.cgm_info("I", BF24H)], value={X.CGM: "BGValue"})
    plan = _plan(out.where(F.col("`I-ModePercent`") <= 0.4))
    assert plan.count("sort_array(coalesce(slice(") == 1


def test_conflicting_windows_are_refused():
    other = Window("Bf24H", -12, 0, "h")
    with pytest.raises(ValueError):
        O.combine_requirements([X.cgm_info("a", BF24H), X.cgm_info("b", other)])
    needed = O.combine_requirements([X.cgm_info("a", BF24H), X.cgm_values("b", BF24H), X.dme_info("c", AF2H)])
    assert needed[X.CGM] == [BF24H] and needed[X.MED] == [AF2H]


def test_names_and_windows():
    assert Observation.parse("hP.rCGM5Min.cBf24H") == Observation("P", "CGM5Min", "Bf24H")
    assert Observation.parse("hP.rP") == Observation("P", "P")
    with pytest.raises(ValueError):
        Observation.parse("rCGM5Min")
    assert BF24H.hi == 3600 and BF24H.lo == -24 * tg.HOUR
    with pytest.raises(ValueError):
        Window("x", 1, 0, "h")
    with pytest.raises(KeyError):
        X.attach_features(None, {}, ["nosuch"])


def test_several_records_in_a_slot_move_nothing(spark):
    """The first record of a slot counts; later slots keep their places."""
    tidy = [(1, BASE, 140.0), (1, BASE + 3 * STEP, 150.0), (1, BASE + 5 * STEP, 160.0)]
    extra = [(1, BASE + tg.MINUTE, 77.0), (1, BASE + 3 * STEP + 2 * tg.MINUTE, 88.0), (1, BASE + 3 * STEP + 4 * tg.MINUTE, 99.0)]
    cases = make(spark, [(1, BASE + 6 * STEP)], False).withColumnRenamed("DT_s", "ObsDT")
    got = [
        X.attach_features(cases, {X.CGM: make(spark, rows)}, ["CGMValueBf24h"]).first()["CGMValueBf24h--tid"]
        for rows in (tidy, tidy + extra)
    ]
    assert got[0] == got[1] and got[0][-7:] == [140, 0, 0, 150, 0, 160, 0]


def test_a_case_without_an_id_is_an_error(spark):
    cases = make(spark, [(None, BASE)], False).withColumnRenamed("DT_s", "ObsDT")
    with pytest.raises(Exception, match="a case without PID or ObsDT"):
        X.attach_features(cases, {X.CGM: make(spark, [(1, BASE, 1.0)])}, ["CGMValueBf24h"]).collect()


@pytest.fixture(scope="module")
def stored_tables(spark, dense, tmp_path_factory):
    recs, cases = dense
    at = tmp_path_factory.mktemp("frame")
    make(spark, recs).write.parquet(f"{at}/recs")
    make(spark, cases, value=False).withColumnRenamed("DT_s", "ObsDT").write.parquet(f"{at}/cases")
    return spark.read.parquet(f"{at}/cases"), spark.read.parquet(f"{at}/recs")


EVERY = [X.FEATURES[n] for n in ("CGMInfoBf24h", "CGMInfoAf2h", "CGMValueBf24h", "DMEInfoBf24h", "DMEInfoAf2h")]


def test_a_patient_filter_reaches_every_scan(spark, stored_tables):
    c, r = stored_tables
    out = O.observe_frame(c, {k: r for k in (X.CGM, X.MED, X.EXERCISE, X.DIET)}, EVERY, value={X.CGM: "BGValue"})
    spark.conf.set("spark.sql.maxMetadataStringLength", 1000)
    plan = _plan(out.where("PID = 7"))
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    scans = [x for x in plan.splitlines() if "FileScan" in x]
    assert len(scans) == 5 and all("EqualTo(PID,7)" in x.split("PushedFilters")[1] for x in scans)
    # one shuffle of all records, one of the cases
    assert plan.count("Exchange hashpartitioning") == 2


def test_columns_not_selected_are_not_computed(spark, stored_tables):
    c, r = stored_tables
    out = O.observe_frame(c, {k: r for k in (X.CGM, X.MED, X.EXERCISE, X.DIET)}, EVERY, value={X.CGM: "BGValue"})
    spark.conf.set("spark.sql.debug.maxToStringFields", 1000)
    whole, part = _plan(out), _plan(out.select("PID", "ObsDT", "`DMEInfoAf2h-MedRecNum`"))
    spark.conf.unset("spark.sql.debug.maxToStringFields")
    assert "sort_array(" in whole and "array_repeat" in whole and whole.count("partial_collect_list(") == 4
    # neither the sorted readings nor grids; only the times of the one kind are listed
    assert "sort_array(" not in part and "array_repeat" not in part and "BGValue" not in part
    assert part.count("partial_collect_list(") == 1


def test_counts_by_value_search_the_sifted_times(spark):
    """Ends on and between readings, nulls among values, a day without readings, many kinds of one table."""
    rows = [(1, BASE + i * STEP, None if i % 5 == 0 else float(i % 3)) for i in range(500)]
    cases = [(1, BASE + i * 7 * tg.MINUTE) for i in range(400)] + [(2, BASE)]
    w = Window("w", -50, 17, "min")
    f = O.Feature("f", w, ("r",), lambda q: {str(k): q.count("r", f"is {k}", lambda v, k=k: v == k) for k in (0, 1, 9)})
    c = make(spark, cases, False).withColumnRenamed("DT_s", "ObsDT")
    out = O.observe_frame(c, {"r": make(spark, rows)}, [f], value={"r": "BGValue"})
    for x in out.withColumn("us", tg.micros("ObsDT")).collect():
        seen = [v for p, u, v in rows if p == x["PID"] and x["us"] + w.lo <= u < x["us"] + w.hi]
        assert [x["f-0"], x["f-1"], x["f-9"]] == [seen.count(0.0), seen.count(1.0), 0]
