"""Hand cases and guards."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from caseflow.operators import cases as C, evaluate as E, policy as M, records as R
from caseflow.operators import sequences as Q, splits as P, tokens as K
from caseflow.plans import timeline as TL
from caseflow.plans.spread import scratch_path
from caseflow.sources import readers as RD, store as ST

T0 = dt.datetime(2024, 1, 1, 12, 0)


def test_time_zone_rules(spark):
    rows = [(1, 0, -60), (2, 1000, -60), (3, -1000, -60), (4, None, -60), (5, 0, None), (6, 999, None)]
    df = spark.createDataFrame(rows, "id int, off int, user_tz int")
    got = {r["id"]: r["DT_tz"] for r in R.resolve_tz(df, "off").collect()}
    assert got == {1: -60, 5: None, 6: 999}
    assert {r["id"]: r["DT_tz"] for r in R.resolve_tz(df, "off", default=0).collect()}[5] == 0


def test_unset_clock(spark):
    rows = [(1, dt.datetime(2010, 1, 1), T0), (2, T0, T0), (3, None, T0)]
    df = spark.createDataFrame(rows, "id int, o timestamp_ntz, e timestamp_ntz").withColumn("DT_tz", F.lit(30))
    later = T0 + dt.timedelta(minutes=30)
    assert {r["id"]: r["DT_s"] for r in R.localize(df, "o", "e").collect()} == {1: later, 2: later, 3: later}
    assert [r["id"] for r in R.localize(df, "o", None).collect()] == [2]


def test_duplicates_of_two_patients_stay_apart(spark):
    df = spark.createDataFrame([(1, T0), (1, T0), (2, T0)], "PatientID int, DT_s timestamp_ntz")
    assert R.drop_exact_duplicates(df).count() == 2


def test_all_null_sum_is_zero(spark):
    df = spark.createDataFrame([(1, T0, None, None)], "PatientID int, DT_s timestamp_ntz, x double, s string")
    row = R.event_rollup(df.withColumn("DT_o", F.col("DT_s")), sums=["x"], firsts=["s"], joins=["s"][:0]).first()
    assert row["x"] == 0.0 and row["s"] is None


def test_filters(spark):
    df = spark.createDataFrame([(1, "a"), (2, None)], "n int, s string")
    with pytest.raises(KeyError):
        C.filter_cases(df, [("nosuch", "==", 1)])
    assert C.filter_cases(df, [("nosuch", "==", 1)], strict=False).count() == 2
    assert [r["n"] for r in C.filter_cases(df, [("s", "!=", "a")]).collect()] == [2]
    with pytest.raises(ValueError):
        C.filter_cases(df, [])
    with pytest.raises(ValueError):
        C.filter_cases(df, [("n", "~", 1)])


def test_case_guards(spark):
    cases = spark.createDataFrame([(1, T0)], "PID bigint, ObsDT timestamp_ntz")
    none = cases.where("PID > 5")
    with pytest.raises(ValueError):
        C.restrict_cases(cases, none)
    twice = spark.createDataFrame([(1, 3), (1, 4)], "PID bigint, x int")
    with pytest.raises(ValueError):
        C.tag_from_record(cases, twice, ["PID"], ["x"], None)
    named = cases.withColumnRenamed("PID", "x").withColumn("x", F.lit(3))
    with pytest.raises(ValueError):
        C.trigger_from_table(named, twice.union(twice), "x")
    with pytest.raises(Exception, match="no patient for the trigger of 5"):
        C.trigger_from_table(named.withColumn("x", F.lit(5)), twice, "x").collect()
    assert C.trigger_from_table(named, twice, "x").count() == 1


def test_tokens(spark):
    df = spark.createDataFrame([(1, -5.0), (2, 7.0), (3, None), (4, 40.0), (5, 41.0), (6, -21.0)], "id int, v double")
    x = K.tokenize_numeric_bins(df, {"v": (-20, 40, 10)}, "f")
    got = {r["id"]: (r["f_tkn"], r["f_wgt"]) for r in x.collect()}
    assert got[1] == (["v:-10~00", "v:-10~00Itv"], [1.0, 0.5])
    assert got[2] == (["v:00~10", "v:00~10Itv"], [1.0, 0.7])
    assert [got[i][0] for i in (3, 4, 5, 6)] == [["v:None"], ["v:Equal40"], ["v:Above40"], ["v:Below-20"]]
    vocab = K.build_vocab(spark, "bins", {"v": (-20, 40, 10)})
    assert vocab == sorted(vocab) and {t for ts, _ in got.values() for t in ts} <= set(vocab)
    assert K.build_vocab(spark, "numeric", ["a", "b"]) == ["a", "b", "a_None", "b_None"]
    with pytest.raises(Exception, match="not in vocabulary"):
        K.tokens_to_ids(x, "f", vocab[:3], ["id"]).collect()


def test_splits_are_disjoint_by_patient(spark):
    df = spark.range(4000).select((F.col("id") % 97).alias("PID"), F.col("id").alias("x"))
    out = P.split_by_patient(df, 0.6, 0.2, 0.2, 1)
    per = out.select("PID", "split").distinct().groupBy("split").count().collect()
    assert {r["split"]: r["count"] for r in per} == {"train": 58, "valid": 19, "test": 20}
    assert out.count() == 4000
    with pytest.raises(ValueError):
        P.split_by_patient(df, 0.6, 0.2, 0.3, 1)


def test_masking(spark):
    df = spark.createDataFrame([(i, list(range(40, 140))) for i in range(50)], "id int, input_ids array<int>")
    rows = Q.mask_labels(df, 0.3, 1, ["id"]).collect()
    masked = sum(x != -100 for r in rows for x in r["labels"])
    assert 0.25 < masked / 5000 < 0.35
    for r in rows:
        for i, (x, y) in enumerate(zip(r["input_ids"], r["labels"])):
            assert (x, y) in ((2, 40 + i), (40 + i, -100))


def test_t_quantiles():
    """Against printed tables."""
    for df, want in ((1, 12.7062), (2, 4.30265), (9, 2.26216), (30, 2.04227), (1000, 1.96234)):
        assert E.t_quantile(0.975, df) == pytest.approx(want, abs=1e-4)


def test_report_interval(spark):
    df = spark.createDataFrame([(1, 1.0), (1, 2.0), (1, 3.0), (2, 5.0), (2, None)], "g int, m double")
    rows = {r["set_value"]: r for r in E.seq_report(df, ["m"], [["g"]]).collect()}
    assert rows["1"]["ci_upper"] == pytest.approx(2 + 4.30265 / 3**0.5, abs=1e-4)
    assert rows["2"]["n"] == 1 and rows["2"]["ci_upper"] is None


def test_binary_summary_edges(spark):
    one = spark.createDataFrame([(1, 0, 0.2), (1, 0, 0.4)], "g int, y int, s double")
    row = E.binary_summary(one, "y", "s", ["g"]).first()
    assert row["roc_auc"] is None and row["BLC_threshold"] is None and row["BLC_accu"] is None
    tied = spark.createDataFrame([(1, 0.5), (0, 0.5), (1, 0.9), (0, 0.1)], "y int, s double")
    row = E.binary_summary(tied, "y", "s").first()
    assert row["roc_auc"] == pytest.approx(0.875) and row["BLC_threshold"] == 0.5


def test_skewed_scores_match_brute_force(spark):
    """A third of all rows share one score."""
    i = F.col("id")
    s = F.when(i % 3 == 0, 0.5).otherwise((F.pmod(F.xxhash64("id"), F.lit(1000)) / 1000))
    df = spark.range(3000).select(i, s.alias("s"), (F.pmod(F.xxhash64("id", F.lit(1)), F.lit(4)) == 0).cast("int").alias("y"))
    pdf = df.toPandas()
    pos, neg = pdf[pdf.y == 1].s.values, pdf[pdf.y == 0].s.values
    auc = sum((p > neg).sum() + 0.5 * (p == neg).sum() for p in pos) / (len(pos) * len(neg))
    assert E.binary_summary(df, "y", "s").first()["roc_auc"] == pytest.approx(auc, abs=1e-6)
    sizes = E.nth_group(df, "y", "s", 7, ["id"]).groupBy("group").count().orderBy("group").collect()
    assert [r["count"] for r in sizes] == [429] * 4 + [428] * 3


def test_store_reads_what_it_wrote(spark):
    calls = []

    def compute():
        calls.append(1)
        return spark.range(3)

    path = scratch_path(spark, "t")
    assert ST.load_or_compute(spark, path, compute).count() == 3
    assert ST.load_or_compute(spark, path, compute).count() == 3
    assert len(calls) == 1


def test_feature_store_computes_only_what_is_missing(spark):
    seen = []

    def feature(ids):
        seen.append(ids.count())
        return ids.withColumn("f", F.col("PID") * 2)

    cases = spark.range(10).select(F.col("id").alias("PID"))
    folder = scratch_path(spark, "fs")
    ST.load_missing(spark, cases.where("PID < 4"), ["PID"], folder, {"f": feature})
    out = ST.load_missing(spark, cases, ["PID"], folder, {"f": feature})
    assert seen == [4, 6] and out.where("f = PID * 2").count() == 10
    ST.load_missing(spark, cases, ["PID"], folder, {"f": feature})
    assert seen == [4, 6]


def test_source_guards(spark, tmp_path):
    a, b = spark.range(1), spark.range(1).withColumnRenamed("id", "x")
    with pytest.raises(ValueError):
        ST.union_datasets([a, b])
    with pytest.raises(TypeError):
        RD.check_inputs({"a": 3})
    forms = spark.createDataFrame([('{"T": {"a": [1, 2], "b": [1]}}',)], "f string")
    with pytest.raises(Exception, match="differ in length"):
        RD.scan_columnar_json(forms, "f", "T", {"a": "int", "b": "int"}).collect()
    empty = spark.createDataFrame([('{"T": {"a": [], "b": []}}',), ('{"T": {"a": [null, 2]}}',)], "f string")
    got = RD.scan_columnar_json(empty, "f", "T", {"a": "int", "b": "int"}).collect()
    assert [tuple(r) for r in got] == [(None, None), (2, None)]
    (tmp_path / "x.xml").write_text('<patient id="1"><meal></patient>')
    with pytest.raises(Exception):
        RD.scan_patient_xml(spark, str(tmp_path), {"meal": ["ts"]})["patient_info"].collect()


def test_one_patient_per_xml_file(spark, tmp_path):
    for part, n in (("train", 2), ("test", 1)):
        where = tmp_path / "2018" / part
        where.mkdir(parents=True)
        events = "".join(f'<event ts="07-12-2021 0{i}:17:00" value="10{i}"/>' for i in range(n))
        (where / "559.xml").write_text(f'<patient id="559"><glucose_level>{events}</glucose_level></patient>')
    from caseflow.operators import shaping as S

    sections = RD.scan_patient_xml(spark, str(tmp_path), {"glucose_level": ["ts", "value"]})
    info = S.xml_patient_meta(sections["patient_info"]).collect()
    assert {(r["patient_id"], r["year"], r["dataset_type"]) for r in info} == {
        ("559_train", "2018", "train"),
        ("559_test", "2018", "test"),
    }
    assert S.xml_patient_meta(sections["glucose_level"]).groupBy("patient_id").count().count() == 2


def test_models(spark):
    df = spark.range(400).select(
        F.col("id"),
        (F.col("id") % 20).cast("double").alias("a"),
        (F.col("id") % 7).cast("double").alias("b"),
        (F.col("id") % 20 > 9).cast("int").alias("y"),
        (F.col("id") % 2).cast("int").alias("act"),
    )
    scored = M.score(df, M.fit_binary_classifier(df, ["a", "b"], "y", rounds=3))
    assert E.binary_summary(scored, "y", "y_pred_score").first()["roc_auc"] > 0.99
    p = M.estimate_logging_policy(df, "act", ["a", "b"])
    assert p.where("propensity > 0 and propensity < 1").count() == 400
    fitted = M.fit_reward_models(df, "act", "a", ["a", "b"], ["id"], [0, 1])
    assert fitted[0]["train_mse"] < 5 and M.predict_rewards(df, fitted).where("size(rewards) = 2").count() == 400


def test_stored_inference_resumes(spark):
    df = spark.range(30)
    made = []

    def load():
        import pandas as pd

        return lambda b: pd.DataFrame({"twice": b["id"] * 2})

    path = scratch_path(spark, "inf")
    first = M.batch_infer_stored(df, load, ["id"], "twice bigint", path, parts=3)
    assert first.where("twice = id * 2").count() == 30

    def broken():
        raise AssertionError("stored parts must not run again")

    assert M.batch_infer_stored(df, broken, ["id"], "twice bigint", path, parts=3).count() == 30
    assert not made


def test_hooks():
    TL.register("trigger", "mine", len)
    assert TL.hook("trigger", "mine") is len
    with pytest.raises(KeyError):
        TL.hook("trigger", "nosuch")
    with pytest.raises(KeyError):
        TL.register("nosuch", "a", len)


def test_choose_inputs():
    assert Q.choose_inputs(["aBf24h", "bAf2h"], True, ["Bf24h"]) == ["aBf24h"]
    assert Q.choose_inputs(["aBf24h", "bAf2h"], False, ["Bf24h"]) == ["aBf24h", "bAf2h"]
    assert Q.union_inputs([{"x": ["a"]}, {"x": ["b", "a"], "y": ["c"]}]) == {"x": ["a", "b"], "y": ["c"]}
