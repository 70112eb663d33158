"""Trigger, window, feature, split and sequence queries."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from caseflow.config import AF2H, AF2TO8H, BF24H, Cohort, Stage
from caseflow.functions import timegrid as tg
from caseflow.operators import cases as C, features as X, observe as O, records as R
from caseflow.operators import sequences as Q, splits as P
from caseflow.plans import timeline as TL
from caseflow.plans.spread import scratch_path
from checks.base import (
    CASES,
    LOCAL,
    PAT,
    REC,
    bounds,
    cases,
    human,
    patients,
    query,
    raw_events,
    record,
    records,
    table,
    uni,
)

IDS = ["PID", "ObsDT"]


# ---------------------------------------------------------------- C: cases


@query("c1_trigger_from_record", f"""WITH {REC} SELECT "PID", "DT_s" AS "ObsDT", round("BGValue", 6) AS "BGValue" FROM cgm""")
def c1(spark, d):
    return C.trigger_from_record(record(spark, d, X.CGM)).withColumn("BGValue", F.round("BGValue", 6))


@query(
    "c2_dedupe_cases",
    """SELECT user_id AS "PID", time_bucket(INTERVAL 1 DAY, ts) AS "ObsDT", arg_max(event_type, event_id) AS event_type,
       arg_max(value, event_id) FILTER (WHERE value > 20) AS value FROM events GROUP BY 1, 2""",
)
def c2(spark, d):
    e = table(spark, d, "events").select(
        F.col("user_id").alias("PID"),
        F.date_trunc("day", "ts").cast("timestamp_ntz").alias("ObsDT"),
        "event_type",
        F.when(F.col("value") > 20, F.col("value")).alias("value"),
        "event_id",
    )
    return C.dedupe_cases(e, ["event_id"]).drop("event_id")


@query(
    "c3_keep_ratio",
    f"""WITH {CASES} SELECT "PID", "ObsDT", {uni('"PID"', '"ObsDT"', seed=42)} AS _keep_ratio FROM cases""",
)
def c3(spark, d):
    return C.keep_ratio(cases(spark, d).select(*IDS))


@query(
    "c4_trigger_from_table",
    """SELECT o_orderkey, o_custkey AS "PatientID", o_orderdate AS "ObsDT", 10000000000 + o_custkey AS "PID" FROM orders""",
)
def c4(spark, d):
    h = patients(spark, d).select("PatientID", (F.col("PatientID") + 10000000000).alias("PID"))
    t = table(spark, d, "orders").select(
        "o_orderkey", F.col("o_custkey").alias("PatientID"), F.col("o_orderdate").alias("ObsDT")
    )
    return C.trigger_from_table(t, h, "PatientID")


@query(
    "c6_restrict_cases",
    f"""WITH {CASES} SELECT "PID", "ObsDT" FROM cases WHERE ("PID", "ObsDT") IN (SELECT "PID", "DT_s" FROM cgm WHERE "BGValue" > 50)""",
)
def c6(spark, d):
    c = cases(spark, d)
    return C.restrict_cases(c.select(*IDS), c.where("BGValue > 50"))


@query("c7_limit_cases", f"""WITH {CASES} SELECT "PID", "ObsDT" FROM cases ORDER BY 1, 2 LIMIT 500""")
def c7(spark, d):
    return C.limit_cases(cases(spark, d).select(*IDS), 500)


@query(
    "c7b_limit_cases_large",
    """SELECT o_custkey AS "PID", o_orderkey AS "ObsDT" FROM orders ORDER BY 1, 2 LIMIT 12345""",
)
def c7b(spark, d):
    o = table(spark, d, "orders").select(F.col("o_custkey").alias("PID"), F.col("o_orderkey").alias("ObsDT"))
    return C.limit_cases(o, 12345)


@query(
    "c8_tag_from_record",
    f"""WITH {CASES}, t AS (SELECT user_id AS "PID", count(*) AS "P-Ev:count", max(value) AS value,
          string_agg(DISTINCT event_type, '|' ORDER BY event_type) AS "event_type:unique_join" FROM events GROUP BY 1)
        SELECT cases."PID", "ObsDT", "P-Ev:count", value, "event_type:unique_join" FROM cases LEFT JOIN t ON cases."PID" = t."PID" """,
)
def c8(spark, d):
    e = table(spark, d, "events").withColumnRenamed("user_id", "PID")
    c = cases(spark, d).select(*IDS)
    c = C.tag_from_record(c, e, ["PID"], [], "count", "P-Ev")
    c = C.tag_from_record(c, e, ["PID"], ["value"], "max")
    return C.tag_from_record(c, e, ["PID"], ["event_type"], "unique-str-join")


@query(
    "c8b_tag_plain",
    f"""WITH {CASES}, {PAT} SELECT cases."PID", "ObsDT", "Gender", "MRSegmentID" FROM cases LEFT JOIN pat ON "PID" = "PatientID" """,
)
def c8b(spark, d):
    p = patients(spark, d).withColumnRenamed("PatientID", "PID")
    return C.tag_from_record(cases(spark, d).select(*IDS), p, ["PID"], ["Gender", "MRSegmentID"], None)


FILTERS = {
    "FltDemo": [
        ("Gender", "!=", 3),
        ("BGValue", ">=", 5),
        ("BGValue", "<=", 400),
        ("PID", ">", 2),
        ("PID", "<", 140),
        ("MRSegmentID", "in", ["HOUSEHOLD", "BUILDING", "MACHINERY"]),
        ("ObsDT", "contains", ":[0-3]5:00"),
    ],
    "FltDemo-OR": [("BGValue", ">", 150), ("MRSegmentID", "==", "AUTOMOBILE")],
    "FltMean": [("BGValue", ">", lambda df: df.agg(F.avg("BGValue")).scalar())],
}
TAGGED = f"""{CASES}, {PAT}, tagged AS (SELECT cases."PID", "ObsDT", round("BGValue", 6) AS "BGValue", "Gender", "MRSegmentID"
  FROM cases LEFT JOIN pat ON cases."PID" = "PatientID")"""


def _tagged(spark, d):
    p = patients(spark, d).withColumnRenamed("PatientID", "PID")
    c = cases(spark, d).withColumn("BGValue", F.round("BGValue", 6))
    return C.tag_from_record(c, p, ["PID"], ["Gender", "MRSegmentID"], None)


@query(
    "c9_filter_cases",
    f"""WITH {TAGGED} SELECT * FROM tagged WHERE "Gender" <> 3 AND "BGValue" >= 5 AND "BGValue" <= 400 AND "PID" > 2 AND "PID" < 140
        AND "MRSegmentID" IN ('HOUSEHOLD', 'BUILDING', 'MACHINERY') AND regexp_matches(CAST("ObsDT" AS VARCHAR), ':[0-3]5:00')""",
)
def c9(spark, d):
    return C.named_filter(_tagged(spark, d), "FltDemo", FILTERS)


@query(
    "c9b_filter_cases_or",
    f"""WITH {TAGGED} SELECT * FROM tagged WHERE "BGValue" > 150 OR "MRSegmentID" = 'AUTOMOBILE' """,
)
def c9b(spark, d):
    return C.named_filter(_tagged(spark, d), "FltDemo-OR", FILTERS)


@query(
    "c9c_filter_by_function",
    f"""WITH {TAGGED} SELECT * FROM tagged WHERE "BGValue" > (SELECT avg("BGValue") FROM tagged)""",
)
def c9c(spark, d):
    return C.named_filter(_tagged(spark, d), "FltMean", FILTERS)


# ---------------------------------------------------------------- window SQL


def _agg_sql(window, source: str, alias: str, exprs: str) -> str:
    lo, hi = bounds(window)
    return f"""{alias} AS (SELECT c."PID", c."ObsDT", {exprs} FROM cases c LEFT JOIN {source} r
       ON r."PID" = c."PID" AND r."DT_s" >= {lo} AND r."DT_s" < {hi} GROUP BY 1, 2)"""


#: Readings with many zeros, so that zero is often the most frequent value.
ZEROS = """zeros AS (SELECT "PID", "DT_s", CASE WHEN "BGValue" < 250 THEN 0 ELSE "BGValue" END AS "BGValue" FROM cgm)"""


def with_zeros(glucose):
    return glucose.withColumn("BGValue", F.when(F.col("BGValue") < 250, 0.0).otherwise(F.col("BGValue")))


def info_sql(window, name: str, alias: str, source: str = "cgm") -> str:
    """The window's rows, their smallest mode (below a millionth: a millionth), and the shares."""
    lo, hi = bounds(window)
    p = f"{name}-" if name else ""
    tiny = "0.000001::DOUBLE"
    return f"""{alias}o AS (SELECT c."PID", c."ObsDT", r."BGValue" AS v FROM cases c LEFT JOIN {source} r
       ON r."PID" = c."PID" AND r."DT_s" >= {lo} AND r."DT_s" < {hi}),
     {alias}c AS (SELECT "PID", "ObsDT", v, count(v) AS n, max(count(v)) OVER (PARTITION BY "PID", "ObsDT") AS most FROM {alias}o GROUP BY 1, 2, 3),
     {alias}m AS (SELECT "PID", "ObsDT", CASE WHEN min(v) FILTER (WHERE n = most) >= {tiny} THEN max(n)
       ELSE COALESCE(sum(n) FILTER (WHERE v = {tiny}), 0) END AS top FROM {alias}c GROUP BY 1, 2),
     {alias} AS (SELECT o."PID", o."ObsDT",
       CASE WHEN count(v) > 0 THEN round_even(greatest(max(top) / count(v), {tiny}) * 1000000, 0)::DOUBLE / 1000000 ELSE 0 END AS "{p}ModePercent",
       CASE WHEN count(v) > 0 THEN round_even(count(v) FILTER (WHERE v = 0) / count(v) * 1000000, 0)::DOUBLE / 1000000 ELSE 0 END AS "{p}ZeroPercent",
       CASE WHEN count(v) > 0 THEN round_even(count(v) FILTER (WHERE v >= 400) / count(v) * 1000000, 0)::DOUBLE / 1000000 ELSE 0 END AS "{p}Geq400Percent",
       CASE WHEN count(v) > 0 THEN round_even(count(v) FILTER (WHERE v <= 20) / count(v) * 1000000, 0)::DOUBLE / 1000000 ELSE 0 END AS "{p}Leq20Percent",
       count(v) AS "{p}RecNum"
       FROM {alias}o o JOIN {alias}m m ON m."PID" = o."PID" AND m."ObsDT" = o."ObsDT" GROUP BY 1, 2)"""


def values_sql(window, name: str, alias: str) -> str:
    """The grid as comma-joined whole numbers."""
    return f"""{alias} AS (SELECT c."PID", c."ObsDT",
       string_agg(CAST(COALESCE(CAST(trunc(r."BGValue") AS INTEGER), 0) AS VARCHAR), ',' ORDER BY s.i) AS "{name}--tid"
       FROM cases c CROSS JOIN (SELECT unnest(range({window.first_step}, {window.last_step + 1})) AS i) s
       LEFT JOIN cgm r ON r."PID" = c."PID" AND r."DT_s" = c."ObsDT" + to_minutes(CAST(s.i * 5 AS BIGINT)) GROUP BY 1, 2)"""


def dme_sql(window, name: str, alias: str) -> str:
    lo, hi = bounds(window)
    parts, cols, joins = [], [], []
    for short, src in (("Med", "med"), ("Exercise", "exe"), ("Diet", "diet")):
        t = f"{alias}_{src}"
        parts.append(
            f"""{t} AS (SELECT c."PID", c."ObsDT", count(r."DT_s") AS n,
            COALESCE(round_even((epoch_us(c."ObsDT") - epoch_us(max(r."DT_s"))) / 60000000 * 100, 0)::DOUBLE / 100, 0) AS l,
            COALESCE(round_even((epoch_us(c."ObsDT") - epoch_us(min(r."DT_s"))) / 60000000 * 100, 0)::DOUBLE / 100, 0) AS f
            FROM cases c LEFT JOIN {src} r ON r."PID" = c."PID" AND r."DT_s" >= {lo} AND r."DT_s" < {hi} GROUP BY 1, 2)"""
        )
        cols.append(
            f"""{t}.n AS "{name}-{short}RecNum", {t}.l AS "{name}-{short}LastToNow", {t}.f AS "{name}-{short}FirstToNow" """
        )
        joins.append(f"""JOIN {t} ON {t}."PID" = c."PID" AND {t}."ObsDT" = c."ObsDT" """)
    return ",\n".join(parts) + f""",
     {alias} AS (SELECT c."PID", c."ObsDT", {', '.join(cols)} FROM cases c {' '.join(joins)})"""


def _join_all(aliases: list[str]) -> str:
    first, *rest = aliases
    joins = " ".join(f"""JOIN {a} USING ("PID", "ObsDT")""" for a in rest)
    return f"""SELECT * FROM {first} {joins}"""


def _flat(df, seqs: list[str]):
    """Sequence columns as text, for comparison."""
    return df.withColumns(
        {s: F.array_join(F.transform(F.col(f"`{s}`"), lambda x: x.cast("string")), ",") for s in seqs}
    )


def _features(spark, d, names):
    c = cases(spark, d).select(*IDS)
    return X.attach_features(c, records(spark, d), names, patients(spark, d).withColumnRenamed("PatientID", "PID"))


# ---------------------------------------------------------------- W: windows


@query(
    "w1_window_bounds",
    f"""WITH {CASES} SELECT "PID", "ObsDT", {bounds(AF2H)[0]} AS "Af2H_start", {bounds(AF2H)[1]} AS "Af2H_end" FROM cases c""",
)
def w1(spark, d):
    return O.window_bounds(cases(spark, d).select(*IDS), AF2H)


@query(
    "w2_observe_join",
    f"""WITH {CASES} SELECT c."PID", c."ObsDT", r."DT_s", round(r."BGValue", 6) AS "BGValue" FROM cases c LEFT JOIN diet r
        ON r."PID" = c."PID" AND r."DT_s" >= {bounds(BF24H)[0]} AND r."DT_s" < {bounds(BF24H)[1]}""",
)
def w2(spark, d):
    c = cases(spark, d).select(*IDS)
    out = O.observe_join(c, record(spark, d, X.DIET), BF24H, payload=["BGValue"])
    return out.withColumn("BGValue", F.round("BGValue", 6))


_COUNT = O.Feature("Diet", BF24H, (X.DIET,), lambda r: {"n": r.count(X.DIET)})


@query(
    "w3_observe_frame",
    f"""WITH {CASES}, {_agg_sql(BF24H, 'diet', 'o', 'count(r."DT_s") AS "Diet-n"')} SELECT * FROM o""",
)
def w3(spark, d):
    return O.observe_frame(cases(spark, d).select(*IDS), records(spark, d), [_COUNT])


@query(
    "w4_observe_static",
    f"""WITH {CASES}, {PAT} SELECT "PID", "ObsDT", "Gender", "YearOfBirth" FROM cases LEFT JOIN pat ON "PID" = "PatientID" """,
)
def w4(spark, d):
    p = patients(spark, d).select(F.col("PatientID").alias("PID"), "Gender", "YearOfBirth")
    return O.observe_static(cases(spark, d).select(*IDS), p)


@query(
    "w5_asof_first_last",
    f"""WITH {CASES}, {_agg_sql(BF24H, 'med', 'o', 'min(r."DT_s") AS first_time, max(r."DT_s") AS last_time')} SELECT * FROM o""",
)
def w5(spark, d):
    return O.asof_first_last(cases(spark, d).select(*IDS), record(spark, d, X.MED), BF24H)


@query(
    "w6_parse_observation_name",
    """SELECT event_id, 'P' AS human, event_type || '5Min' AS record, CASE WHEN event_id % 2 = 0 THEN 'Tkn' END AS recfeat,
       CASE WHEN event_id % 3 <> 0 THEN 'Bf24H' END AS "window" FROM events""",
)
def w6(spark, d):
    i = F.col("event_id")
    name = F.concat_ws(
        ".",
        F.lit("hP"),
        F.concat(F.lit("r"), F.col("event_type"), F.lit("5Min")),
        F.when(i % 2 == 0, "fTkn"),
        F.when(i % 3 != 0, "cBf24H"),
    )
    e = table(spark, d, "events").select("event_id", O.observation_parts(name).alias("p"))
    return e.select("event_id", "p.*")


@query(
    "w7_combine_requirements",
    f"""WITH {CASES}, {info_sql(BF24H, 'A', 'a')}, {_agg_sql(AF2H, 'cgm', 'b', 'count(r."DT_s") AS "B-n"')},
        {_agg_sql(AF2H, 'exe', 'e', 'count(r."DT_s") AS "E-n"')} {_join_all(['a', 'b', 'e'])}""",
)
def w7(spark, d):
    feats = [
        X.cgm_info("A", BF24H),
        O.Feature("B", AF2H, (X.CGM,), lambda r: {"n": r.count(X.CGM)}),
        O.Feature("E", AF2H, (X.EXERCISE,), lambda r: {"n": r.count(X.EXERCISE)}),
    ]
    c = cases(spark, d).select(*IDS)
    return O.observe_frame(c, records(spark, d), feats, value={X.CGM: "BGValue"})


# ---------------------------------------------------------------- F: features


def _info(name, window):
    @query(f"f1_cgm_info_{window.name.lower()}", f"WITH {CASES}, {info_sql(window, name, 'a')} SELECT * FROM a")
    def run(spark, d):
        return _features(spark, d, [name])


def _values(name, window):
    @query(f"f2_cgm_values_{window.name.lower()}", f"WITH {CASES}, {values_sql(window, name, 'a')} SELECT * FROM a")
    def run(spark, d):
        return _flat(_features(spark, d, [name]), [f"{name}--tid"])


def _dme(name, window):
    @query(f"f3_dme_info_{window.name.lower()}", f"WITH {CASES}, {dme_sql(window, name, 'a')} SELECT * FROM a")
    def run(spark, d):
        return _features(spark, d, [name])


for _w, _s in ((BF24H, "Bf24h"), (AF2H, "Af2h"), (AF2TO8H, "Af2to8h")):
    _info(f"CGMInfo{_s}", _w)
    _values(f"CGMValue{_s}", _w)
for _w, _s in ((BF24H, "Bf24h"), (AF2H, "Af2h")):
    _dme(f"DMEInfo{_s}", _w)

DEMO = """demo AS (SELECT c."PID", c."ObsDT",
   CASE "Gender" WHEN 2 THEN 'Male' WHEN 1 THEN 'Female' ELSE CAST("Gender" AS VARCHAR) END AS "PDemoBase-Tag-Gender",
   CAST(year(c."ObsDT") - "YearOfBirth" AS INTEGER) AS "PDemoBase-Num-Age",
   CASE WHEN year(c."ObsDT") - "YearOfBirth" < 18 THEN '0-17' WHEN year(c."ObsDT") - "YearOfBirth" < 40 THEN '18-39'
        WHEN year(c."ObsDT") - "YearOfBirth" < 65 THEN '40-64' ELSE '65+' END AS "PDemoBase-Tag-AgeGroup",
   CASE WHEN "DiseaseType" = 1 THEN 'T1D' WHEN "DiseaseType" = 2 THEN 'T2D' ELSE printf('%.1f', "DiseaseType") END AS "PDemoBase-Tag-DiseaseType",
   "MRSegmentID" AS "PDemoBase-Tag-Regimen" FROM cases c LEFT JOIN pat ON c."PID" = "PatientID")"""


def _demo_patients(spark, d):
    return R.patient_record(patients(spark, d)).withColumnRenamed("PatientID", "PID")


@query("f4_demographics", f"WITH {CASES}, {PAT}, {DEMO} SELECT * FROM demo")
def f4(spark, d):
    return X.demographics(cases(spark, d).select(*IDS), _demo_patients(spark, d))


_ALL = ["CGMInfoBf24h", "CGMInfoAf2h", "CGMValueBf24h", "CGMValueAf2h", "DMEInfoBf24h", "DMEInfoAf2h", "PDemoBase"]


@query(
    "f5_attach_features",
    f"""WITH {CASES}, {PAT}, {info_sql(BF24H, 'CGMInfoBf24h', 'a')}, {info_sql(AF2H, 'CGMInfoAf2h', 'b')},
        {values_sql(BF24H, 'CGMValueBf24h', 'vb')}, {values_sql(AF2H, 'CGMValueAf2h', 'va')},
        {dme_sql(BF24H, 'DMEInfoBf24h', 'db')}, {dme_sql(AF2H, 'DMEInfoAf2h', 'da')}, {DEMO}
        {_join_all(['a', 'b', 'vb', 'va', 'db', 'da', 'demo'])}""",
)
def f5(spark, d):
    c = cases(spark, d).select(*IDS)
    out = X.attach_features(c, records(spark, d), _ALL, _demo_patients(spark, d))
    return _flat(out, ["CGMValueBf24h--tid", "CGMValueAf2h--tid"])


# ---------------------------------------------------------------- C10 to C12, U5


@query(
    "c10_refilter_with_features",
    f"""WITH {CASES}, {info_sql(BF24H, 'CGMInfoBf24h', 'a')} SELECT * FROM a WHERE "CGMInfoBf24h-RecNum" >= 2
        AND "CGMInfoBf24h-ModePercent" <= 0.4""",
)
def c10(spark, d):
    rules = [("CGMInfoBf24h-RecNum", ">=", 2), ("CGMInfoBf24h-ModePercent", "<=", 0.4)]
    return C.filter_cases(_features(spark, d, ["CGMInfoBf24h"]), rules)


@query(
    "c11_case_stages",
    f"""WITH {CASES}, {PAT}, {info_sql(BF24H, 'CGMInfoBf24h', 'a')}, k AS (SELECT "PID", "ObsDT",
          {uni('"PID"', '"ObsDT"', seed=42)} AS _keep_ratio FROM cases)
        SELECT a.*, _keep_ratio, "Gender", "MRSegmentID" FROM a JOIN k USING ("PID", "ObsDT") LEFT JOIN pat ON a."PID" = "PatientID"
        WHERE _keep_ratio <= 0.5 AND "Gender" <> 3 AND "CGMInfoBf24h-RecNum" >= 2""",
)
def c11(spark, d):
    p = patients(spark, d).withColumnRenamed("PatientID", "PID")
    recs = records(spark, d)
    stages = [
        Stage("tag", {"records": p, "group": ["PID"], "cols": ["Gender", "MRSegmentID"]}),
        Stage("filter", {"rules": [("_keep_ratio", "<=", 0.5), ("Gender", "!=", 3)]}),
        Stage("features", {"records": recs, "names": ["CGMInfoBf24h"]}),
        Stage("filter", {"rules": [("CGMInfoBf24h-RecNum", ">=", 2)]}),
    ]
    start, folder = C.keep_ratio(cases(spark, d).select(*IDS)), scratch_path(spark, "stages")
    TL.run_case_stages(start, stages[:2], folder)  # a run that ends after two stages
    return TL.run_case_stages(start, stages, folder)


@query(
    "c12_union_cohort_cases",
    f"""WITH {CASES} SELECT "PID", "ObsDT", round("BGValue", 6) AS "BGValue", "PID" % 2 AS cohort,
        extract(hour FROM "ObsDT")::INTEGER AS h FROM cases""",
)
def c12(spark, d):
    c = cases(spark, d)
    parts = []
    for i in range(2):
        mine = c.where(F.col("PID") % 2 == i)
        tags = mine.select(*IDS, F.lit(i).cast("bigint").alias("cohort"))
        feats = mine.select(*IDS, F.round("BGValue", 6).alias("BGValue"), F.hour("ObsDT").alias("h"), F.lit(0).alias("cohort"))
        parts.append((tags, feats))
    return C.union_cohort_cases(parts)


@query(
    "f1d_cgm_info_zero_mode",
    f"""WITH {CASES}, {ZEROS}, {info_sql(BF24H, 'CGMInfoBf24h', 'a', 'zeros')} SELECT * FROM a""",
)
def f1d(spark, d):
    recs = records(spark, d) | {X.CGM: with_zeros(record(spark, d, X.CGM))}
    return X.attach_features(cases(spark, d).select(*IDS), recs, ["CGMInfoBf24h"])


@query(
    "u5_user_feature",
    f"""WITH {CASES}, {_agg_sql(AF2TO8H, 'med', 'o', 'count(r."DT_s") AS "MedLater-n"')} SELECT * FROM o""",
)
def u5(spark, d):
    TL.register("feature", "MedLater", O.Feature("MedLater", AF2TO8H, (X.MED,), lambda r: {"n": r.count(X.MED)}))
    c = cases(spark, d).select(*IDS)
    return X.attach_features(c, records(spark, d), ["MedLater"], extra={"MedLater": TL.hook("feature", "MedLater")})


@query(
    "u2_user_record",
    f"""WITH {REC} SELECT "PID", CAST("DT_s" AS DATE)::VARCHAR AS day, count(*) AS n, round(sum("BGValue"), 4) AS total
        FROM cgm GROUP BY 1, 2""",
)
def u2(spark, d):
    def day_totals(pdf):
        day = pdf["DT_s"].dt.strftime("%Y-%m-%d").rename("day")
        out = pdf.groupby(["PID", day])["BGValue"].agg(n="size", total="sum").reset_index()
        return out[["PID", "day", "n", "total"]]

    TL.register("record", "day_totals", day_totals)
    schema = "PID bigint, day string, n bigint, total double"
    out = TL.per_patient_batch(record(spark, d, X.CGM), "PID", TL.hook("record", "day_totals"), schema)
    return out.withColumn("total", F.round("total", 4))


@query(
    "u2b_user_record_whole_history",
    f"""WITH {REC} SELECT "PID", "DT_s", row_number() OVER w AS place, round(max("BGValue") OVER w, 6) AS highest
        FROM cgm WINDOW w AS (PARTITION BY "PID" ORDER BY "DT_s" ROWS UNBOUNDED PRECEDING)""",
)
def u2b(spark, d):
    """A hook that needs all of a patient's history: the place of a record and the highest value so far."""

    def climb(rows, state):
        place, top = state
        out = rows[["PID", "DT_s"]].assign(place=range(place + 1, place + 1 + len(rows)))
        out["highest"] = rows["BGValue"].cummax().clip(lower=top)
        return out, (place + len(rows), float(out["highest"].iloc[-1]))

    def hook(df):
        return TL.walk_patients(df, "PID", climb, "PID bigint, DT_s timestamp_ntz, place bigint, highest double", begin=lambda p: (0, float("-inf")))

    TL.register("record", "climb", hook)
    out = TL.hook("record", "climb")(record(spark, d, X.CGM))
    return out.withColumn("highest", F.round("highest", 6))


@query(
    "u1_user_source",
    """SELECT c_custkey AS "PatientID", c_acctbal AS "BGValue" FROM customer""",
)
def u1(spark, d):
    def read(args):
        return {"ElogBGEntry": table(spark, args["folder"], "customer").select(
            F.col("c_custkey").alias("PatientID"), F.col("c_acctbal").alias("BGValue"))}

    TL.register("source", "customers", read)
    return TL.hook("source", "customers")({"folder": d})["ElogBGEntry"]


@query(
    "u3_user_tokenizer",
    """SELECT event_id, event_type || CASE WHEN value > 50 THEN '_big' ELSE '_small' END AS tkn FROM events""",
)
def u3(spark, d):
    def sized(df, attr, feat):
        t = F.concat(F.col(attr), F.when(F.col("value") > 50, "_big").otherwise("_small"))
        return df.withColumns({f"{feat}_tkn": F.array(t), f"{feat}_wgt": F.array(F.lit(1.0))})

    TL.register("tokenizer", "sized", sized)
    x = TL.hook("tokenizer", "sized")(table(spark, d, "events"), "event_type", "f")
    return x.select("event_id", F.array_join("f_tkn", ",").alias("tkn"))


@query(
    "u4_user_trigger",
    f"""WITH {REC} SELECT DISTINCT "PID", "DT_s" + INTERVAL 30 MINUTE AS "ObsDT" FROM diet""",
)
def u4(spark, d):
    TL.register("trigger", "after_meal", lambda recs: recs[X.DIET].select(
        "PID", tg.shift_minutes("DT_s", F.lit(30)).alias("ObsDT")).distinct())
    return TL.hook("trigger", "after_meal")(records(spark, d))


@query(
    "u6_user_step",
    f"""WITH {CASES} SELECT "PID", "ObsDT", CASE WHEN "PID" % 10 = 0 THEN 'test' ELSE 'train' END AS split FROM cases""",
)
def u6(spark, d):
    split = F.when(F.col("PID") % 10 == 0, "test").otherwise("train")
    TL.register("step", "by_id", lambda df: df.withColumn("split", split))
    return TL.hook("step", "by_id")(cases(spark, d).select(*IDS))


# ---------------------------------------------------------------- P: splits


TAGS_SQL = f"""{CASES}, tags AS (SELECT "PID", "ObsDT", {uni('"PID"', '"ObsDT"', seed=7)} AS "RandDownSample",
   {uni('"PID"', seed=8)} AS "RandInOut",
   (row_number() OVER (PARTITION BY "PID" ORDER BY "ObsDT") - 1) / count(*) OVER (PARTITION BY "PID") AS "CaseRltLocInP",
   {uni('"PID"', '"ObsDT"', seed=9)} AS "RandTest", {uni('"PID"', '"ObsDT"', seed=10)} AS "RandValidation" FROM cases)"""


@query("p1_random_tags", f"WITH {TAGS_SQL} SELECT * FROM tags")
def p1(spark, d):
    return P.random_tags(cases(spark, d).select(*IDS), 7)


def _split_sql(test: str, valid: str) -> str:
    return f"""{TAGS_SQL}, sp AS (SELECT "PID", "ObsDT", "RandDownSample", "RandInOut" < 0.1 AS "Out", "RandInOut" >= 0.1 AS "In",
      {test} AS "Test", ({valid}) AND NOT ({test}) AS "Valid", NOT ({test}) AND NOT (({valid}) AND NOT ({test})) AS "Train" FROM tags)"""


_TAIL = _split_sql('"CaseRltLocInP" >= 0.8::DOUBLE', '"RandValidation" > 1 - 0.1::DOUBLE / (1 - 0.2::DOUBLE)')


@query("p2_split_tags_tail", f"WITH {_TAIL} SELECT * FROM sp")
def p2(spark, d):
    return P.split_tags(cases(spark, d).select(*IDS), 0.1, "0.2tail", 0.1, seed=7)


@query(
    "p2b_split_tags_date",
    f"""WITH {_split_sql(''' "ObsDT" >= TIMESTAMP '2024-01-25 00:00:00' ''', ''' "ObsDT" > TIMESTAMP '2024-01-20 00:00:00' ''')} SELECT * FROM sp""",
)
def p2b(spark, d):
    c = cases(spark, d).select(*IDS)
    return P.split_tags(c, 0.1, "2024-01-25 00:00:00", dt.datetime(2024, 1, 20), seed=7)


@query(
    "p2c_split_tags_random",
    f"""WITH {_split_sql('"RandTest" >= 1 - 0.25::DOUBLE', '"RandValidation" > 1 - 0.15::DOUBLE / (1 - 0.25::DOUBLE)')} SELECT * FROM sp""",
)
def p2c(spark, d):
    return P.split_tags(cases(spark, d).select(*IDS), 0.1, 0.25, 0.15, seed=7)


@query(
    "p3_group_splits",
    f"""WITH {_TAIL} SELECT "PID", "ObsDT", CASE WHEN "In" THEN 'In' ELSE 'Out' END || '_' ||
        CASE WHEN "Test" THEN 'Test' WHEN "Valid" THEN 'Valid' ELSE 'Train' END || '_Base' AS "group" FROM sp""",
)
def p3(spark, d):
    return P.group_splits(p2(spark, d), ["InOut", "TVT", "Base"]).select(*IDS, "group")


@query(
    "p4_split_by_patient",
    f"""WITH p AS (SELECT o_custkey AS "PID", row_number() OVER (ORDER BY u, o_custkey) AS r, count(*) OVER () AS n FROM
          (SELECT DISTINCT o_custkey, {uni('o_custkey', seed=3)} AS u FROM orders)),
        q AS (SELECT *, floor(n * 0.7::DOUBLE) AS a, ceil((n - floor(n * 0.7::DOUBLE)) * (0.2::DOUBLE / (0.1::DOUBLE + 0.2::DOUBLE))) AS t FROM p)
        SELECT o_orderkey, "PID", CASE WHEN r <= a THEN 'train' WHEN r <= n - t THEN 'valid' ELSE 'test' END AS split
        FROM orders JOIN q ON "PID" = o_custkey""",
)
def p4(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", F.col("o_custkey").alias("PID"))
    return P.split_by_patient(o, 0.7, 0.1, 0.2, 3)


@query("p5_split_from_columns", f"""WITH {CASES} SELECT "PID", "ObsDT", CAST(minute("ObsDT") AS INTEGER) AS "ObsDT_Minute" FROM cases""")
def p5(spark, d):
    return P.split_from_columns(cases(spark, d).select(*IDS), minute=True)


@query(
    "p6_select_splits",
    f"""WITH {CASES}, c AS (SELECT "PID", "ObsDT", round("BGValue", 6) AS "BGValue" FROM cases)
        SELECT *, 'low' AS split_name FROM c WHERE "BGValue" < 30 UNION ALL
        SELECT *, 'late' FROM c WHERE "ObsDT" >= TIMESTAMP '2024-01-15 00:00:00' AND "BGValue" >= 10""",
)
def p6(spark, d):
    day = lambda df: F.lit("2024-01-15 00:00:00").cast("timestamp_ntz")
    splits = {"low": [("BGValue", "<", 30)], "late": [("ObsDT", ">=", day), ("BGValue", ">=", 10)]}
    c = cases(spark, d).withColumn("BGValue", F.round("BGValue", 6))
    return P.select_splits(c, splits)


@query(
    "p7_sample_n",
    f"""WITH {CASES} SELECT "PID", "ObsDT" FROM cases ORDER BY {uni('"PID"', '"ObsDT"', seed=11)}, "PID", "ObsDT" LIMIT 777""",
)
def p7(spark, d):
    return P.sample_n(cases(spark, d).select(*IDS), 777, 11)


# ---------------------------------------------------------------- Q: sequences

SEQ = f"""{CASES}, {values_sql(AF2H, 'A', 'sa')}, {values_sql(AF2TO8H, 'B', 'sb')},
  seq AS (SELECT "PID", "ObsDT", list_transform(string_split("A--tid", ',') || string_split("B--tid", ','),
          lambda x : greatest(least(CAST(x AS INTEGER), 400), 40)) AS ids FROM sa JOIN sb USING ("PID", "ObsDT"))"""


def _sequences(spark, d):
    feats = [X.cgm_values("A", AF2H), X.cgm_values("B", AF2TO8H)]
    c = O.observe_frame(cases(spark, d).select(*IDS), records(spark, d), feats, value={X.CGM: "BGValue"})
    return Q.input_sequence(c, ["A", "B"], 40, 400).select(*IDS, "input_ids")


@query("q1_input_sequence", f"""WITH {SEQ} SELECT "PID", "ObsDT", array_to_string(ids, ',') AS input_ids FROM seq""")
def q1(spark, d):
    return _flat(_sequences(spark, d), ["input_ids"])


@query(
    "q2_choose_inputs",
    f"""WITH {CASES}, {values_sql(BF24H, 'CGMValueBf24h', 'a')} SELECT "PID", "ObsDT",
        array_to_string(list_transform(string_split("CGMValueBf24h--tid", ','), lambda x : greatest(least(CAST(x AS INTEGER), 400), 40)), ',') AS input_ids FROM a""",
)
def q2(spark, d):
    names = Q.choose_inputs(["CGMValueBf24h", "CGMValueAf2h"], True, ["Bf24h"])
    x = Q.input_sequence(_features(spark, d, names), names, 40, 400)
    return _flat(x.select(*IDS, "input_ids"), ["input_ids"])


@query(
    "q3_hour_minute_ids",
    f"""WITH {SEQ} SELECT "PID", "ObsDT", array_to_string(list_transform(range(96), lambda i :
        CAST((epoch_us("ObsDT") // 300000000 - 288 + i) % 288 AS INTEGER)), ',') AS hm_ids FROM seq""",
)
def q3(spark, d):
    x = Q.hour_minute_ids(_sequences(spark, d), -24, "h")
    return _flat(x.select(*IDS, "hm_ids"), ["hm_ids"])


@query(
    "q4_causal_labels",
    f"""WITH {SEQ} SELECT "PID", "ObsDT", array_to_string(ids, ',') AS input_ids, array_to_string(ids, ',') AS labels FROM seq""",
)
def q4(spark, d):
    return _flat(Q.causal_labels(_sequences(spark, d)), ["input_ids", "labels"])


@query(
    "q5_future_labels",
    f"""WITH {SEQ} SELECT "PID", "ObsDT", array_to_string(ids[1:24], ',') AS input_ids, array_to_string(ids[25:60], ',') AS labels FROM seq""",
)
def q5(spark, d):
    return _flat(Q.future_labels(_sequences(spark, d), 24, 36), ["input_ids", "labels"])


_HIT = uni('"PID"', '"ObsDT"', "i", seed=5) + " < 0.15"


@query(
    "q6_mask_labels",
    f"""WITH {SEQ}, x AS (SELECT "PID", "ObsDT", unnest(ids) AS v, unnest(range(96)) AS i FROM seq)
        SELECT "PID", "ObsDT", string_agg(CAST(CASE WHEN {_HIT} THEN 2 ELSE v END AS VARCHAR), ',' ORDER BY i) AS input_ids,
        string_agg(CAST(CASE WHEN {_HIT} THEN v ELSE -100 END AS VARCHAR), ',' ORDER BY i) AS labels FROM x GROUP BY 1, 2""",
)
def q6(spark, d):
    return _flat(Q.mask_labels(_sequences(spark, d), 0.15, 5, IDS), ["input_ids", "labels"])


@query(
    "q7_rule_labels",
    """SELECT event_id, value, CASE WHEN value BETWEEN 0 AND 54 THEN 0 WHEN value BETWEEN 54 AND 70 THEN 1
       WHEN value BETWEEN 70 AND 180 THEN 2 ELSE -100 END AS labels FROM events""",
)
def q7(spark, d):
    e = table(spark, d, "events").select("event_id", "value")
    return Q.rule_labels(e, "value", {0: (0, 54), 1: (54, 70), 2: (70, 180)})


@query(
    "q8_binary_label",
    """SELECT event_id, CAST(value > 70 AS INTEGER) AS "Y", CAST(value < 20 AS INTEGER) AS "Y2",
       CAST(event_type = 'click' AS INTEGER) AS "Y3", value AS "Y4" FROM events""",
)
def q8(spark, d):
    e = table(spark, d, "events").select("event_id", "value", "event_type")
    e = Q.binary_label(Q.binary_label(e, "value", ">", 70), "value", "<", 20, "Y2")
    e = Q.binary_label(Q.binary_label(e, "event_type", "==", "click", "Y3"), "value", out="Y4")
    return e.drop("value", "event_type")


@query(
    "q9_keep_columns",
    f"""WITH {SEQ} SELECT array_to_string(ids, ',') AS labels, "PID", "ObsDT" FROM seq""",
)
def q9(spark, d):
    x = Q.causal_labels(_sequences(spark, d))
    return _flat(Q.keep_columns(x, ["input_ids", "labels"], ["labels", "PID", "ObsDT"]), ["labels"])


@query(
    "q10_generation_split",
    f"""WITH {SEQ} SELECT "PID", "ObsDT", array_to_string(ids[1:72], ',') AS input_ids, array_to_string(ids[73:96], ',') AS labels,
        72 AS n_mask FROM seq""",
)
def q10(spark, d):
    x = Q.generation_split(Q.causal_labels(_sequences(spark, d)), 24)
    x = x.withColumn("n_mask", F.aggregate("attention_mask", F.lit(0), lambda a, v: a + v)).drop("attention_mask")
    return _flat(x, ["input_ids", "labels"])


@query(
    "u1_raw_to_split",
    f"""WITH {LOCAL}, ids AS (SELECT "PatientID", CAST('1' || lpad(CAST(row_number() OVER (ORDER BY "PatientID") AS VARCHAR), 10, '0') AS BIGINT) AS "PID"
          FROM (SELECT DISTINCT user_id AS "PatientID" FROM events WHERE event_type IN ('view', 'error', 'purchase'))),
        cgm AS (SELECT "PID", time_bucket(INTERVAL 5 MINUTE, dt) AS "DT_s", avg(value) AS "BGValue" FROM loc JOIN ids USING ("PatientID")
          WHERE event_type IN ('view', 'error') GROUP BY 1, 2),
        cases AS (SELECT "PID", "DT_s" AS "ObsDT" FROM cgm WHERE {uni('"PID"', '"DT_s"', seed=42)} <= 0.8),
        n AS (SELECT c."PID", c."ObsDT", count(r."DT_s") AS n FROM cases c LEFT JOIN cgm r ON r."PID" = c."PID"
          AND r."DT_s" >= {bounds(BF24H)[0]} AND r."DT_s" < {bounds(BF24H)[1]} GROUP BY 1, 2)
        SELECT "PID", "ObsDT", n, {uni('"PID"', '"ObsDT"', seed=44)} >= 0.8 AS "Test" FROM n WHERE n >= 2""",
)
def u1(spark, d):
    """Sources, directory, record, cases, features, split: every step by its hook."""
    TL.register("source", "event_types", lambda spark, path, types: raw_events(spark, path).where(F.col("event_type").isin(types)))
    raw = TL.read_sources(
        spark,
        {
            "Glucose": ("event_types", {"path": d, "types": ["view", "error"]}),
            "Diet": ("event_types", {"path": d, "types": ["purchase"]}),
        },
    )
    people = TL.build_directory(raw, Cohort("events", 1, d, "event_types"), "PatientID", [], human(spark, d), "user_tz")
    rows = raw["Glucose"].withColumnRenamed("value", "BGValue")
    glucose = TL.build_record(rows, people, "glucose", "CGM5Min")
    kept = [("_keep_ratio", "<=", 0.8)]
    made = TL.build_cases(glucose, {}, None, ["CGMInfoBf24h"], kept, [("CGMInfoBf24h-RecNum", ">=", 2)])
    tagged = P.split_tags(made, 0.1, 0.2, 0.1)
    return tagged.select("PID", "ObsDT", F.col("CGMInfoBf24h-RecNum").alias("n"), "Test")
