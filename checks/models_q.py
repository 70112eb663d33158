"""Evaluation, policy and action queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from caseflow.functions.codes import MESSAGE_ACTIONS
from caseflow.functions.rng import uniform
from caseflow.operators import actions as A, evaluate as E, policy as M
from caseflow.plans.spread import scratch_path
from checks.base import query, table, uni

# ---------------------------------------------------------------- scored documents

SCORED = f"""scored AS (SELECT doc_id, quality AS y, floor({uni('doc_id', seed=1)} * 200) / 200 AS s, lang, source
  FROM labels JOIN documents USING (doc_id))"""


def _scored(spark, d):
    docs = table(spark, d, "documents").select("doc_id", "lang", "source")
    s = F.floor(uniform(["doc_id"], 1) * 200) / F.lit(200.0)
    x = table(spark, d, "labels").join(docs, "doc_id")
    return x.select("doc_id", F.col("quality").alias("y"), s.alias("s"), "lang", "source")


def _thr(n, pos, tp, pp, prefix=""):
    p = prefix
    return f"""round_even(round(({tp} + ({n} - {pos} - ({pp} - {tp}))) / {n}, 9) * 10000, 0)::DOUBLE / 10000 AS "{p}accu",
      CASE WHEN {pp} > 0 THEN round_even(round({tp} / {pp}, 9) * 10000, 0)::DOUBLE / 10000 END AS "{p}precision",
      CASE WHEN {pos} > 0 THEN round_even(round({tp} / {pos}, 9) * 10000, 0)::DOUBLE / 10000 END AS "{p}recall",
      CASE WHEN {pp} > 0 AND {pos} > 0 THEN round_even(round(2 * {tp} / ({pp} + {pos}), 9) * 10000, 0)::DOUBLE / 10000 END AS "{p}f1",
      {pp} AS "{p}PredPosNum" """


_FULL = """, round_even(round(pp / n, 9) * 10000, 0)::DOUBLE / 10000 AS "PredPosRate", pos AS "RealPosNum", round_even(round(pos / n, 9) * 10000, 0)::DOUBLE / 10000 AS "RealPosRate" """


def summary_sql(source: str, group: list[str], extra: str = "") -> str:
    """Binary summary per group by definition: AUC as the share of ordered pairs, counted by rank."""
    g = ", ".join(group)
    by = f"PARTITION BY {g}" if group else ""
    gb = f"GROUP BY {g}" if group else ""
    gs = f"{g}, " if group else ""
    on = " AND ".join(f"z.{c} IS NOT DISTINCT FROM q.{c}" for c in group) or "TRUE"
    qg = ", ".join(f"q.{c}" for c in group)
    return f"""ranked AS (SELECT *, rank() OVER ({by} ORDER BY s) + (count(*) OVER ({', '.join(x for x in [('PARTITION BY ' + gs + 's')] if x)}) - 1) / 2 AS r,
         row_number() OVER ({by} ORDER BY s DESC) AS down, sum(y) OVER ({by}) AS p_all FROM {source}),
      q AS (SELECT {gs}count(*) AS n, sum(y)::BIGINT AS pos, sum(r) FILTER (WHERE y = 1) AS rsum, avg(s) AS m, stddev_samp(s) AS sd,
         min(s) AS lo, max(s) AS hi, round_even(round(max(s) FILTER (WHERE down = p_all), 9) * 10000, 0)::DOUBLE / 10000 AS blc FROM ranked {gb}),
      z AS (SELECT {gs}q.blc AS zz, {qg + ', ' if qg else ''}1 AS one FROM q),
      h AS (SELECT {', '.join(f'q.{c}' for c in group) + ', ' if group else ''}
         COALESCE(sum(z.y) FILTER (WHERE z.s >= 0.5::DOUBLE), 0)::BIGINT AS tp5, count(*) FILTER (WHERE z.s >= 0.5::DOUBLE) AS pp5,
         COALESCE(sum(z.y) FILTER (WHERE z.s >= q.blc), 0)::BIGINT AS tpb, count(*) FILTER (WHERE z.s >= q.blc) AS ppb
         FROM {source} z JOIN q ON {on} GROUP BY {', '.join(f'q.{c}' for c in group) if group else 'ALL'})
      SELECT {', '.join(f'q.{c}' for c in group) + ',' if group else ''} n AS "SampleNum", pos AS "RealPosNum", round_even(round(pos / n, 9) * 10000, 0)::DOUBLE / 10000 AS "RealPosRate",
         CASE WHEN pos > 0 AND pos < n THEN round((rsum - pos * (pos + 1) / 2) / (pos * (n - pos)), 6) END AS roc_auc,
         round_even(round(m, 9) * 10000, 0)::DOUBLE / 10000 AS "PredScoreMean", round_even(round(sd, 9) * 10000, 0)::DOUBLE / 10000 AS "PredScoreStd", round_even(round(lo, 9) * 10000, 0)::DOUBLE / 10000 AS "PredScoreMin", round_even(round(hi, 9) * 10000, 0)::DOUBLE / 10000 AS "PredScoreMax",
         blc AS "BLC_threshold", {_thr('n', 'pos', 'tp5', 'pp5', '0_5_')},
         CASE WHEN blc IS NOT NULL THEN round_even(round((tpb + (n - pos - (ppb - tpb))) / n, 9) * 10000, 0)::DOUBLE / 10000 END AS "BLC_accu",
         CASE WHEN blc IS NOT NULL AND ppb > 0 THEN round_even(round(tpb / ppb, 9) * 10000, 0)::DOUBLE / 10000 END AS "BLC_precision",
         CASE WHEN blc IS NOT NULL AND pos > 0 THEN round_even(round(tpb / pos, 9) * 10000, 0)::DOUBLE / 10000 END AS "BLC_recall",
         CASE WHEN blc IS NOT NULL AND ppb > 0 AND pos > 0 THEN round_even(round(2 * tpb / (ppb + pos), 9) * 10000, 0)::DOUBLE / 10000 END AS "BLC_f1",
         CASE WHEN blc IS NOT NULL THEN ppb END AS "BLC_PredPosNum" {extra}
      FROM q JOIN h ON {' AND '.join(f'h.{c} IS NOT DISTINCT FROM q.{c}' for c in group) or 'TRUE'}"""


def _summary(source: str, group: list[str], extra: str = "") -> str:
    text = summary_sql(source, group, extra)
    # the helper relation z is only the FROM alias of the hit counts
    a, b = text.index("z AS ("), text.index("h AS (")
    return text[:a] + text[b:]


@query(
    "e1_glucose_region",
    """SELECT event_id, CASE WHEN value < 54 THEN 'VeryLow' WHEN value < 70 THEN 'Low' WHEN value <= 180 THEN 'TIR'
       WHEN value <= 250 THEN 'High' ELSE 'VeryHigh' END AS region FROM events""",
)
def e1(spark, d):
    return table(spark, d, "events").select("event_id", E.glucose_region(F.col("value")).alias("region"))


# ---------------------------------------------------------------- sequences from embeddings

_HORIZONS = {"near": (0, 24), "far": (24, 64)}
PAIRS = """pairs AS (SELECT vec_id, label, i, r, r + (i % 9) * 4 - 15 AS p FROM (
  SELECT vec_id, label, unnest(range(64)) AS i, CAST(round(40 + (unnest(embedding)::DOUBLE + 0.5) * 360) AS INTEGER) AS r FROM embeddings))"""


def _seqs(spark, d):
    e = table(spark, d, "embeddings")
    real = F.transform("embedding", lambda x: F.round(40 + (x.cast("double") + 0.5) * 360).cast("int"))
    e = e.select("vec_id", "label", real.alias("real"))
    pred = F.transform("real", lambda x, i: x + (i % 9) * 4 - 15)
    return e.withColumn("pred", pred)


def _region(x):
    return f"CASE WHEN {x} < 54 THEN 'VeryLow' WHEN {x} < 70 THEN 'Low' WHEN {x} <= 180 THEN 'TIR' WHEN {x} <= 250 THEN 'High' ELSE 'VeryHigh' END"


def _metrics_sql() -> str:
    cols = []
    for h, (a, b) in _HORIZONS.items():
        w = f"FILTER (WHERE i >= {a} AND i < {b})"
        m = f"CAST({_region('r')} = {_region('p')} AS INTEGER)"
        cols += [
            f'round_even(sqrt(avg((r - p) * (r - p)) {w}) * 100, 0)::DOUBLE / 100 AS "{h}_rMSE"',
            f'round_even(avg(abs(r - p)) {w} * 100, 0)::DOUBLE / 100 AS "{h}_MAE"',
            f'round_even(avg(CAST(abs(r - p) <= 5 AS INTEGER)) {w} * 100, 0)::DOUBLE / 100 AS "{h}_MAEin5"',
            f'round_even(avg(CAST(abs(r - p) <= 10 AS INTEGER)) {w} * 100, 0)::DOUBLE / 100 AS "{h}_MAEin10"',
            f'avg({m}) {w} AS "{h}_RegionAccu"',
        ]
        for g in E.REGIONS:
            cols.append(
                f"""avg({m}) FILTER (WHERE i >= {a} AND i < {b} AND {_region('r')} = '{g}') AS "{h}_RegionAccuByRegion_{g}" """
            )
    return f"WITH {PAIRS}, metrics AS (SELECT vec_id, label, {', '.join(cols)} FROM pairs GROUP BY 1, 2)"


def _metrics(spark, d):
    return E.seq_metrics(_seqs(spark, d), "real", "pred", _HORIZONS).drop("real", "pred")


@query("e2_seq_metrics", _metrics_sql() + " SELECT * FROM metrics")
def e2(spark, d):
    return _metrics(spark, d)


def _report_sql() -> str:
    parts = []
    for m in ("near_rMSE", "far_MAE", "far_RegionAccuByRegion_TIR"):
        for name, val, gb in (("label", "CAST(label AS VARCHAR)", "GROUP BY label"), ("", "''", "")):
            parts.append(
                f"""SELECT '{name}' AS set_name, {val} AS set_value, '{m}' AS metric, count("{m}") AS n, round(avg("{m}"), 6) AS mean,
                round(stddev_samp("{m}") / sqrt(count("{m}")), 6) AS sem FROM metrics {gb}"""
            )
    return _metrics_sql() + " " + " UNION ALL ".join(parts)


@query("e3_seq_report", _report_sql())
def e3(spark, d):
    out = E.seq_report(
        _metrics(spark, d), ["near_rMSE", "far_MAE", "far_RegionAccuByRegion_TIR"], [["label"], []]
    )
    return out.drop("ci_lower", "ci_upper").withColumns({c: F.round(c, 6) for c in ("mean", "sem")})


@query("e3b_seq_report_intervals")
def e3b(spark, d):
    return E.seq_report(_metrics(spark, d), ["near_rMSE", "far_MAE"], [["label"], []])


def _interval_sql() -> str:
    """Student t bounds by the expansion of the quantile in 1/degrees of freedom, exact to 1e-8 from 40 on."""
    z, d = 1.959963984540054, "(n - 1)"
    terms = [
        (z**3 + z) / 4,
        (5 * z**5 + 16 * z**3 + 3 * z) / 96,
        (3 * z**7 + 19 * z**5 + 17 * z**3 - 15 * z) / 384,
        (79 * z**9 + 776 * z**7 + 1482 * z**5 - 1920 * z**3 - 945 * z) / 92160,
    ]
    t = f"({z}::DOUBLE + " + " + ".join(f"{c}::DOUBLE / power({d}, {k})" for k, c in enumerate(terms, 1)) + ")"
    parts = []
    for m in ("near_rMSE", "far_MAE"):
        for name, val, gb in (("label", "CAST(label AS VARCHAR)", "GROUP BY label"), ("", "''", "")):
            parts.append(
                f"""SELECT '{name}' AS set_name, {val} AS set_value, '{m}' AS metric, count("{m}") AS n, avg("{m}") AS mean,
                stddev_samp("{m}") / sqrt(count("{m}")) AS sem FROM metrics {gb}"""
            )
    made = _metrics_sql() + ", r AS (" + " UNION ALL ".join(parts) + ")"
    return f"""{made} SELECT set_name, set_value, metric, n, round(mean - {t} * sem, 5) AS ci_lower, round(mean + {t} * sem, 5) AS ci_upper FROM r"""


@query("e3c_seq_report_bounds", _interval_sql())
def e3c(spark, d):
    out = E.seq_report(_metrics(spark, d), ["near_rMSE", "far_MAE"], [["label"], []])
    return out.drop("mean", "sem").withColumns({c: F.round(c, 5) for c in ("ci_lower", "ci_upper")})


# ---------------------------------------------------------------- binary


@query(
    "e4_threshold_metrics",
    f"""WITH {SCORED}, t AS (SELECT lang, count(*) AS n, sum(y)::BIGINT AS pos, COALESCE(sum(y) FILTER (WHERE s >= 0.4::DOUBLE), 0)::BIGINT AS tp,
        count(*) FILTER (WHERE s >= 0.4::DOUBLE) AS pp FROM scored GROUP BY 1)
        SELECT lang, 0.4::DOUBLE AS threshold, n AS "SampleNum", {_thr('n', 'pos', 'tp', 'pp')} {_FULL} FROM t""",
)
def e4(spark, d):
    return E.threshold_metrics(_scored(spark, d), "y", "s", 0.4, ["lang"])


@query("e5_binary_summary", f"WITH {SCORED}, {_summary('scored', [])}")
def e5(spark, d):
    return E.binary_summary(_scored(spark, d), "y", "s")


CURVE = f"""{SCORED}, tot AS (SELECT count(*) AS n, sum(y) AS p FROM scored),
  cv AS (SELECT s, sum(sum(y)) OVER (ORDER BY s DESC) AS tp, sum(count(*)) OVER (ORDER BY s DESC) AS pp FROM scored GROUP BY s)"""


@query(
    "e6_roc_curve",
    f"WITH {CURVE} SELECT s AS threshold, ((pp - tp) / (n - p))::DOUBLE AS fpr, (tp / p)::DOUBLE AS tpr FROM cv, tot",
)
def e6(spark, d):
    return E.roc_curve(_scored(spark, d), "y", "s")


@query(
    "e6b_pr_curve",
    f'WITH {CURVE} SELECT s AS threshold, (tp / pp)::DOUBLE AS "precision", (tp / p)::DOUBLE AS recall FROM cv, tot',
)
def e6b(spark, d):
    return E.pr_curve(_scored(spark, d), "y", "s")


@query(
    "e7_threshold_table",
    f"""WITH {SCORED}, l AS (SELECT round(i * 0.05::DOUBLE, 3) AS threshold FROM (SELECT unnest(range(21)) AS i)),
        t AS (SELECT threshold, count(*) AS n, sum(y)::BIGINT AS pos, COALESCE(sum(y) FILTER (WHERE s >= threshold), 0)::BIGINT AS tp,
              count(*) FILTER (WHERE s >= threshold) AS pp FROM scored, l GROUP BY 1)
        SELECT threshold, n AS "SampleNum", {_thr('n', 'pos', 'tp', 'pp')} {_FULL} FROM t""",
)
def e7(spark, d):
    return E.threshold_table(_scored(spark, d), "y", "s")


BANDS = f"""{SCORED}, l AS (SELECT i, round(i * 0.05::DOUBLE, 3) AS a, round((i + 1) * 0.05::DOUBLE, 3) AS b FROM (SELECT unnest(range(20)) AS i)),
  banded AS (SELECT scored.*, CAST(i AS INTEGER) AS band FROM scored JOIN l ON s >= a AND s < b)"""


def _with_empty_bands(summary: str) -> str:
    """The summary of bands, with the bands that have no rows."""
    return f"""SELECT l.i AS band, x.* EXCLUDE (band) REPLACE (COALESCE("SampleNum", 0) AS "SampleNum", COALESCE("RealPosNum", 0) AS "RealPosNum")
      FROM (SELECT CAST(unnest(range(20)) AS INTEGER) AS i) l LEFT JOIN ({summary}) x ON x.band = l.i"""


@query("e8_score_band_table", _with_empty_bands(f"WITH {BANDS}, {_summary('banded', ['band'])}"))
def e8(spark, d):
    return E.score_band_table(_scored(spark, d), "y", "s").drop("SubGroup")


NTH = f"""{SCORED}, nth AS (SELECT *, CAST(ntile(10) OVER (ORDER BY s, doc_id) AS INTEGER) AS "group" FROM scored)"""


@query("e9_nth_group_table", f"""WITH {NTH}, {_summary('nth', ['"group"'])}""")
def e9(spark, d):
    return E.nth_group_table(_scored(spark, d), "y", "s", ["doc_id"])


@query(
    "e10_bottom_top_tables",
    f"""WITH {NTH}, cum AS (SELECT nth.*, side, k FROM nth JOIN (SELECT 'Btm' AS side, CAST(unnest(range(1, 11)) AS INTEGER) AS k
          UNION ALL SELECT 'Top', CAST(unnest(range(1, 11)) AS INTEGER)) x
          ON (side = 'Btm' AND nth."group" <= k) OR (side = 'Top' AND nth."group" > 10 - k)), {_summary('cum', ['side', 'k'])}""",
)
def e10(spark, d):
    return E.bottom_top_tables(_scored(spark, d), "y", "s", ["doc_id"])


@query(
    "e11_report_by_subgroup",
    f"""WITH {SCORED}, subs AS (SELECT *, 'lang' AS set_name, lang AS set_value FROM scored UNION ALL
        SELECT *, 'source,lang', source || ',' || lang FROM scored UNION ALL SELECT *, '', '' FROM scored),
        {_summary('subs', ['set_name', 'set_value'])}""",
)
def e11(spark, d):
    return E.report_by_subgroup(_scored(spark, d), "y", "s", [["lang"], ["source", "lang"], []])


SUBS = f"""{SCORED}, subs AS (SELECT *, 'lang' AS set_name, lang AS set_value FROM scored UNION ALL SELECT *, '', '' FROM scored)"""


def _tables(spark, d):
    return E.tables_by_subgroup(_scored(spark, d), "y", "s", [["lang"], []], ["doc_id"])


@query(
    "e11b_roc_by_subgroup",
    f"""WITH {SUBS}, tot AS (SELECT set_name, set_value, count(*) AS n, sum(y) AS p FROM subs GROUP BY 1, 2),
        cv AS (SELECT set_name, set_value, s, sum(sum(y)) OVER w AS tp, sum(count(*)) OVER w AS pp FROM subs GROUP BY 1, 2, 3
               WINDOW w AS (PARTITION BY set_name, set_value ORDER BY s DESC))
        SELECT set_name, set_value, s AS threshold, CASE WHEN n > p THEN ((pp - tp) / (n - p))::DOUBLE END AS fpr,
          CASE WHEN p > 0 THEN (tp / p)::DOUBLE END AS tpr FROM cv JOIN tot USING (set_name, set_value)""",
)
def e11b(spark, d):
    return _tables(spark, d)["roc"]


@query(
    "e11c_groups_by_subgroup",
    f"""WITH {SUBS}, nth AS (SELECT *, CAST(ntile(10) OVER (PARTITION BY set_name, set_value ORDER BY s, doc_id) AS INTEGER) AS "group" FROM subs),
        {_summary('nth', ['set_name', 'set_value', '"group"'])}""",
)
def e11c(spark, d):
    return _tables(spark, d)["groups"]


@query(
    "e11d_thresholds_by_subgroup",
    f"""WITH {SUBS}, l AS (SELECT round(i * 0.05::DOUBLE, 3) AS threshold FROM (SELECT unnest(range(21)) AS i)),
        t AS (SELECT set_name, set_value, threshold, count(*) AS n, sum(y)::BIGINT AS pos,
              COALESCE(sum(y) FILTER (WHERE s >= threshold), 0)::BIGINT AS tp, count(*) FILTER (WHERE s >= threshold) AS pp
              FROM subs, l GROUP BY 1, 2, 3)
        SELECT set_name, set_value, threshold, n AS "SampleNum", {_thr('n', 'pos', 'tp', 'pp')} {_FULL} FROM t""",
)
def e11d(spark, d):
    return _tables(spark, d)["thresholds"]


@query(
    "e11e_summary_of_one_ranking",
    f"""WITH {SUBS}, {_summary('subs', ['set_name', 'set_value'])}""",
)
def e11e(spark, d):
    return _tables(spark, d)["summary"]


@query(
    "e12_score_percentile",
    f"""WITH ev AS (SELECT event_id, floor({uni('event_id', seed=2)} * 500) / 500 AS s FROM events),
        ref AS (SELECT floor({uni('o_orderkey', seed=3)} * 300) / 300 AS s FROM orders), n AS (SELECT count(*) AS n FROM ref),
        b AS (SELECT ev.s, (SELECT count(*) FROM ref WHERE ref.s < ev.s) AS below FROM (SELECT DISTINCT s FROM ev) ev)
        SELECT event_id, ev.s, CAST(round_even((below + 0.5::DOUBLE) / n * 100, 0) AS INTEGER) AS percentile FROM ev JOIN b ON b.s = ev.s, n""",
)
def e12(spark, d):
    ev = table(spark, d, "events").select("event_id", (F.floor(uniform(["event_id"], 2) * 500) / F.lit(500.0)).alias("s"))
    ref = table(spark, d, "orders").select((F.floor(uniform(["o_orderkey"], 3) * 300) / F.lit(300.0)).alias("s"))
    return E.score_percentile(ev, ref, "s")


# ---------------------------------------------------------------- token metrics


def _tokens(spark, d):
    """Predictions one step ahead: label of the next position, wrong on every fifth vector position."""
    s = _seqs(spark, d)
    pred = F.transform("real", lambda x, i: F.coalesce(F.get("real", i + 1), F.lit(0)) + F.when(i % 5 == 0, 3).otherwise(0))
    return s.select("vec_id", F.col("real").alias("labels"), pred.alias("preds"))


@query(
    "e13_token_metrics",
    f"""WITH {PAIRS}, x AS (SELECT vec_id, i, r AS truth, lag(i) OVER w AS j, r + CASE WHEN (i - 1) % 5 = 0 THEN 3 ELSE 0 END AS p
          FROM pairs WINDOW w AS (PARTITION BY vec_id ORDER BY i)), y AS (SELECT * FROM x WHERE i >= 1)
        SELECT round(avg(CAST(p = truth AS INTEGER)), 6) AS "ACUU", round(avg(CAST(p = truth AS INTEGER)) FILTER (WHERE i >= 40), 6) AS "ACUUaf",
        round(sqrt(avg((p - truth) * (p - truth))), 6) AS "rMSE", round(sqrt(avg((p - truth) * (p - truth)) FILTER (WHERE i >= 40)), 6) AS "rMSEaf" FROM y""",
)
def e13(spark, d):
    out = E.token_metrics(_tokens(spark, d), "preds", "labels", 24)
    return out.select(*[F.round(c, 6).alias(c) for c in out.columns])


@query(
    "e14_horizon_metrics",
    f"""WITH {PAIRS}, h AS (SELECT unnest([6, 12, 24]) AS horizon) SELECT horizon, round(avg(CAST(r = p AS INTEGER)), 6) AS accuracy,
        round(avg((r - p) * (r - p)), 6) AS mse, round(sqrt(avg((r - p) * (r - p))), 6) AS rmse FROM pairs, h WHERE i < horizon GROUP BY 1""",
)
def e14(spark, d):
    s = _seqs(spark, d).withColumn("all_pred", F.concat("real", "pred"))
    out = E.horizon_metrics(s, "all_pred", "real")
    return out.select("horizon", *[F.round(c, 6).alias(c) for c in ("accuracy", "mse", "rmse")])


_TYPES = ["click", "error", "purchase", "signup", "view"]


@query(
    "e15_action_report",
    "WITH "
    + " , ".join(
        f"""g{i} AS (SELECT '{n}' AS set_name, {v} AS set_value, count(*) AS "SampleNum", round(avg(value / 490.02::DOUBLE), 6) AS "PredEngagement", """
        + ", ".join(f"""round_even(round(avg(CAST(event_type = '{t}' AS INTEGER)), 9) * 10000, 0)::DOUBLE / 10000 AS "Action_{t}" """ for t in _TYPES)
        + f" FROM events {gb})"
        for i, (n, v, gb) in enumerate((("user_id", "CAST(user_id AS VARCHAR)", "GROUP BY user_id"), ("", "''", "")))
    )
    + " SELECT * FROM g0 UNION ALL SELECT * FROM g1",
)
def e15(spark, d):
    e = table(spark, d, "events").withColumn("reward", F.col("value") / 490.02)
    out = E.action_report(e, "event_type", "reward", _TYPES, [["user_id"], []])
    return out.withColumn("PredEngagement", F.round("PredEngagement", 6))


@query(
    "e16_pred_to_real_diff",
    f"""WITH {PAIRS} SELECT vec_id, string_agg(CAST(p - r AS VARCHAR), ',' ORDER BY i) AS diff, CAST(round(var_pop(r) * 4096) AS BIGINT) AS real_var
        FROM pairs GROUP BY 1""",
)
def e16(spark, d):
    s = E.real_variance(E.pred_to_real_diff(_seqs(spark, d), "real", "pred"), "real")
    diff = F.array_join(F.transform("diff", lambda x: x.cast("string")), ",")
    return s.select("vec_id", diff.alias("diff"), F.round(F.col("real_var") * 4096).cast("bigint").alias("real_var"))


# ---------------------------------------------------------------- M: models and policies

_K = 5
_IDX = {t: i for i, t in enumerate(_TYPES)}


def _bandit(spark, d):
    """Events as logged actions, with scores and predicted rewards from the md5 uniform."""
    e = table(spark, d, "events")
    arr = lambda tag, scale: F.array(*[uniform(["event_id"], f"{tag}{i}") * scale for i in range(_K)])
    a = F.create_map(*[x for t, i in _IDX.items() for x in (F.lit(t), F.lit(i))])[F.col("event_type")]
    return e.select(
        "event_id",
        a.alias("a"),
        (F.col("value") / 490.02).alias("r"),
        arr("s", 4).alias("scores"),
        arr("p", 1).alias("rewards"),
    )


def _list(tag, scale):
    return "[" + ", ".join(f"{uni('event_id', seed=f'{tag}{i}')} * {scale}" for i in range(_K)) + "]"


BANDIT = f"""bandit AS (SELECT event_id, CASE event_type {' '.join(f"WHEN '{t}' THEN {i}" for t, i in _IDX.items())} END AS a,
   value / 490.02::DOUBLE AS r, {_list('s', 4)} AS scores, {_list('p', 1)} AS rewards FROM events),
 ex AS (SELECT *, list_transform(scores, lambda x : exp(x - list_max(scores))) AS e FROM bandit),
 pol AS (SELECT *, list_transform(e, lambda x : CASE WHEN x / list_sum(e) < 1e-7 THEN 0 ELSE x / list_sum(e) END) AS probs FROM ex)"""


def _cum(u):
    """Index of the first cumulative probability that reaches u."""
    tests = " ".join(f"WHEN {' + '.join(f'probs[{j + 1}]' for j in range(i + 1))} >= {u} THEN {i}" for i in range(_K))
    return f"CASE {tests} ELSE 0 END"


DRAWN = BANDIT + f""", drawn AS (SELECT *, {_cum(uni('event_id', seed=4))} AS act FROM pol)"""


def _scaled(col):
    return F.array_join(F.transform(col, lambda x: F.round(x * 1e6).cast("bigint").cast("string")), ",")


@query(
    "m3_join_item_embedding",
    """SELECT event_id, len(COALESCE(embedding, [])) + 2 AS width, round(COALESCE(list_sum(list_transform(embedding, lambda x : x::DOUBLE)), 0) + value + 1, 4) AS total
       FROM events LEFT JOIN embeddings ON vec_id = user_id * 5""",
)
def m3(spark, d):
    items = table(spark, d, "embeddings").select("vec_id", F.col("embedding").cast("array<double>").alias("e"))
    ev = table(spark, d, "events").select(
        "event_id", (F.col("user_id") * 5).alias("vec_id"), F.array(F.col("value"), F.lit(1.0)).alias("x")
    )
    x = M.join_item_embedding(ev, items, "vec_id", "e", "x")
    total = F.aggregate("x", F.lit(0.0), lambda a, v: a + v)
    return x.select("event_id", F.size("x").cast("bigint").alias("width"), F.round(total, 4).alias("total"))


@query(
    "m4_standardize",
    """WITH x AS (SELECT c_custkey, CASE WHEN c_custkey % 10 = 0 THEN 0 ELSE c_acctbal END AS b, 5.0::DOUBLE AS c FROM customer)
       SELECT c_custkey, round((b - (SELECT avg(b) FROM x)) / (SELECT stddev_pop(b) FROM x), 6) AS b, 0.0::DOUBLE AS c FROM x""",
)
def m4(spark, d):
    c = table(spark, d, "customer").select(
        "c_custkey", F.when(F.col("c_custkey") % 10 != 0, F.col("c_acctbal")).alias("b"), F.lit(5.0).alias("c")
    )
    out = M.standardize(c, M.fit_standardizer(c, ["b", "c"]))
    return out.withColumn("b", F.round("b", 6))


@query(
    "m6_softmax_policy",
    f"WITH {BANDIT} SELECT event_id, array_to_string(list_transform(probs, lambda x : CAST(round(x * 1000000) AS BIGINT)), ',') AS probs FROM pol",
)
def m6(spark, d):
    return M.softmax_policy(_bandit(spark, d), "scores").select("event_id", _scaled("probs").alias("probs"))


def _drawn(spark, d):
    return M.sample_action(M.softmax_policy(_bandit(spark, d), "scores"), "probs", ["event_id"], 4, "act")


@query("m7_sample_action", f"WITH {DRAWN} SELECT event_id, CAST(act AS INTEGER) AS act FROM drawn")
def m7(spark, d):
    return _drawn(spark, d).select("event_id", "act")


@query(
    "m8_policy_value_dr",
    f"WITH {DRAWN} SELECT round(avg(rewards[act + 1] + probs[a + 1] * 5 * (r - rewards[a + 1])), 6) AS value, count(*) AS n FROM drawn",
)
def m8(spark, d):
    out = M.policy_value_dr(_drawn(spark, d), "rewards", "probs", "act", "a", "r", _K)
    return out.withColumn("value", F.round("value", 6))


@query(
    "m9_policy_value_snips",
    f"""WITH {BANDIT}, w AS (SELECT least(greatest(probs[a + 1] / 0.2::DOUBLE, 0.1), 10) AS w, r FROM pol)
        SELECT round(sum(w * r) / sum(w), 6) AS value, round(sum(w * r), 4) AS weighted_reward, round(sum(r), 4) AS logged_reward FROM w""",
)
def m9(spark, d):
    p = M.softmax_policy(_bandit(spark, d), "scores").select(
        F.get("probs", F.col("a")).alias("pi"), F.lit(0.2).alias("mu"), "r"
    )
    out = M.policy_value_snips(p, "pi", "mu", "r")
    return out.select(
        F.round("value", 6).alias("value"),
        F.round("weighted_reward", 4).alias("weighted_reward"),
        F.round("logged_reward", 4).alias("logged_reward"),
    )


@query("m10_clip_weights", "SELECT event_id, least(greatest(value, 5), 100) AS value FROM events")
def m10(spark, d):
    return M.clip_weights(table(spark, d, "events").select("event_id", "value"), "value", 5.0, 100.0)


@query(
    "m13_abstain",
    f"""WITH {BANDIT}, t AS (SELECT event_id, a, list_reverse_sort(scores) AS top, scores FROM bandit)
        SELECT event_id, CAST(CASE WHEN top[1] - top[2] > 0.5 THEN list_position(scores, top[1]) - 1 ELSE 5 END AS INTEGER) AS pred FROM t""",
)
def m13(spark, d):
    return M.abstain(_bandit(spark, d), "scores", 0.5).select("event_id", "pred")


@query(
    "m13b_abstain_loss",
    f"""WITH {BANDIT}, t AS (SELECT event_id, a, list_reverse_sort(scores) AS top, scores FROM bandit),
        p AS (SELECT a, CASE WHEN top[1] - top[2] > 0.5 THEN list_position(scores, top[1]) - 1 ELSE 5 END AS pred FROM t)
        SELECT round(sum(CASE WHEN pred = 5 THEN 0.3::DOUBLE WHEN pred <> a THEN 1 ELSE 0 END), 4) AS loss, count(*) AS n FROM p""",
)
def m13b(spark, d):
    out = M.abstain_loss(M.abstain(_bandit(spark, d), "scores", 0.5), "pred", "a", _K, 0.3)
    return out.withColumn("loss", F.round("loss", 4))


@query(
    "m15_mask_future_events",
    f"WITH {PAIRS} SELECT vec_id, string_agg(CAST(CASE WHEN i < 40 THEN r ELSE 0 END AS VARCHAR), ',' ORDER BY i) AS real FROM pairs GROUP BY 1",
)
def m15(spark, d):
    x = M.mask_future_events(_seqs(spark, d), "real", 40)
    return x.select("vec_id", F.array_join(F.transform("real", lambda v: v.cast("string")), ",").alias("real"))


_FEATS = ["c_acctbal", "c_nationkey", "orders_n", "spent"]


def _customers(spark, d):
    o = table(spark, d, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.count(F.lit(1)).alias("orders_n"), F.sum("o_totalprice").alias("spent")
    )
    c = table(spark, d, "customer").join(o, "c_custkey", "left").fillna(0, subset=["orders_n", "spent"])
    return c.select(
        "c_custkey",
        *[F.col(f).cast("double").alias(f) for f in _FEATS],
        (F.col("spent") > 2.5e6).cast("int").alias("y"),
        (F.col("c_nationkey") % 3).cast("int").alias("act"),
        (F.col("c_acctbal") / 10000.0).alias("r"),
    )


@query("m1_fit_binary_classifier")
def m1(spark, d):
    c = _customers(spark, d)
    model = M.fit_binary_classifier(c, _FEATS, "y", rounds=5)
    return E.binary_summary(M.score(c, model), "y", "y_pred_score")


@query("m2_score")
def m2(spark, d):
    c = _customers(spark, d)
    model = M.fit_binary_classifier(c, _FEATS, "y", rounds=5)
    ref = M.score(c, model).select("y_pred_score")
    return M.score(c, model, ref=ref).select("c_custkey", "y", "y_pred_score", "y_pred_score_percentile")


@query("m5_fit_reward_models")
def m5(spark, d):
    c = _customers(spark, d)
    models = M.fit_reward_models(c, "act", "r", ["c_acctbal", "orders_n"], ["c_custkey"], [0, 1, 2])
    return M.predict_rewards(c, models).select("c_custkey", "act", "r", "rewards")


@query("m11_estimate_logging_policy")
def m11(spark, d):
    return M.estimate_logging_policy(_customers(spark, d), "act", ["c_acctbal", "orders_n"]).select(
        "c_custkey", "act", "propensity"
    )


CUSTOMERS = """cust AS (SELECT c.*, CAST(COALESCE(spent, 0) > 2.5e6 AS INTEGER) AS y, CAST(c_nationkey % 3 AS INTEGER) AS act FROM customer c
  LEFT JOIN (SELECT o_custkey, sum(o_totalprice) AS spent FROM orders GROUP BY 1) o ON o_custkey = c_custkey)"""


@query("m1b_summary_counts", f'WITH {CUSTOMERS} SELECT count(*) AS "SampleNum", sum(y)::BIGINT AS "RealPosNum", TRUE AS told_apart FROM cust')
def m1b(spark, d):
    """What does not depend on the fit: counts, and that the fit tells the classes apart on its own rows."""
    return m1(spark, d).select("SampleNum", "RealPosNum", (F.col("roc_auc") > 0.8).alias("told_apart"))


@query("m2b_score_ranges", f"WITH {CUSTOMERS} SELECT c_custkey, y, TRUE AS in_range, TRUE AS ranked FROM cust")
def m2b(spark, d):
    p, r = F.col("y_pred_score"), F.col("y_pred_score_percentile")
    return m2(spark, d).select("c_custkey", "y", p.between(0, 1).alias("in_range"), r.between(0, 100).alias("ranked"))


@query("m5b_reward_shapes", f"WITH {CUSTOMERS} SELECT c_custkey, act, CAST(3 AS INTEGER) AS n, TRUE AS finite FROM cust")
def m5b(spark, d):
    finite = F.forall("rewards", lambda x: x.isNotNull() & ~F.isnan(x))
    return m5(spark, d).select("c_custkey", "act", F.size("rewards").alias("n"), finite.alias("finite"))


@query("m11b_propensity_ranges", f"WITH {CUSTOMERS} SELECT c_custkey, act, TRUE AS in_range FROM cust")
def m11b(spark, d):
    p = F.col("propensity")
    return m11(spark, d).select("c_custkey", "act", ((p > 0) & (p <= 1)).alias("in_range"))


@query(
    "m12_predict_with_reward",
    f"""WITH {DRAWN} SELECT event_id, CAST(act AS INTEGER) AS "Action", {_TYPES!r}[act + 1] AS "ActionName", round(rewards[act + 1], 6) AS "Reward",
        {', '.join(f'round(probs[{i + 1}], 6) AS "action_prob_{t}"' for t, i in _IDX.items())} FROM drawn""",
)
def m12(spark, d):
    x = M.predict_with_reward(_bandit(spark, d), "scores", "rewards", _TYPES, ["event_id"], 4)
    rounded = ["Reward", *[f"action_prob_{t}" for t in _TYPES]]
    return x.select("event_id", "Action", "ActionName", *[F.round(c, 6).alias(c) for c in rounded])


def _mean_model():
    """A stand-in for a user's model: mean and last value of each sequence."""
    import pandas as pd

    def predict(batch):
        return pd.DataFrame(
            {
                "mean": [round(float(sum(x)) / len(x), 6) for x in batch["real"]],
                "last": [int(x[-1]) for x in batch["real"]],
            }
        )

    return predict


M14 = f"WITH {PAIRS} SELECT vec_id, round(avg(r), 6) AS mean, CAST(max(r) FILTER (WHERE i = 63) AS BIGINT) AS last FROM pairs GROUP BY 1"


@query("m14_batch_infer", M14)
def m14(spark, d):
    return M.batch_infer(_seqs(spark, d).select("vec_id", "real"), _mean_model, ["vec_id"], "mean double, last bigint")


@query("m14b_batch_infer_stored", M14)
def m14b(spark, d):
    s = _seqs(spark, d).select("vec_id", "real")
    return M.batch_infer_stored(
        s, _mean_model, ["vec_id"], "mean double, last bigint", scratch_path(spark, "infer"), parts=3
    )


# ---------------------------------------------------------------- A: actions

OPTIONS = f"""opt AS (SELECT conv_id, turn, role, role || '_' || CAST(turn AS VARCHAR) AS name,
   floor({uni('conv_id', 'turn', seed=6)} * 40) / 40 AS s FROM conversations)"""


def _options(spark, d):
    c = table(spark, d, "conversations")
    return c.select(
        "conv_id",
        "turn",
        "role",
        F.concat_ws("_", "role", F.col("turn").cast("string")).alias("name"),
        (F.floor(uniform(["conv_id", "turn"], 6) * 40) / F.lit(40.0)).alias("s"),
    )


_PCT_TEXT = "string_agg(name || '=' || CAST(CAST(round_even(s * 10000, 0) AS BIGINT) AS VARCHAR), ',' ORDER BY turn)"


def _listed(scale):
    item = lambda x: F.concat(x["name"], F.lit("="), F.rint(x["score"] * scale).cast("bigint").cast("string"))
    return F.array_join(F.transform("predictions", item), ",").alias("predictions")


@query(
    "a1_best_action",
    f"""WITH {OPTIONS} SELECT conv_id, arg_max(name, (s, -turn)) AS action, round_even(max(s) * 10000, 0)::DOUBLE / 100 AS score,
        {_PCT_TEXT} AS predictions FROM opt GROUP BY 1""",
)
def a1(spark, d):
    x = A.best_action(_options(spark, d), ["conv_id"], "name", "s", "turn")
    return x.select("conv_id", "action", "score", _listed(100))


@query(
    "a2_label_by_model",
    f"""WITH {OPTIONS} SELECT conv_id, role, arg_max(name, (s, -turn)) AS label, max(s) AS label_score,
        {_PCT_TEXT} AS predictions FROM opt GROUP BY 1, 2""",
)
def a2(spark, d):
    x = A.label_by_model(_options(spark, d), ["conv_id"], "role", "name", "s", "turn")
    return x.select("conv_id", "role", "label", "label_score", _listed(10000))


_U = uni("event_id", seed=12)
_ARMS = " ".join(f"WHEN random_score <= {0.2 * (i + 1)!r}::DOUBLE THEN '{a}'" for i, a in enumerate(MESSAGE_ACTIONS))
_WHY = " ".join(
    f"WHEN random_score <= {0.2 * (i + 1)!r}::DOUBLE THEN 'Treatment Group - {a}'" for i, a in enumerate(MESSAGE_ACTIONS)
)


@query(
    "a3_assign_treatment",
    f"""SELECT event_id, random_score, CASE {_ARMS} ELSE event_type END AS action,
        CASE {_WHY} ELSE 'Treatment Group - AI Bandit Action' END AS action_reason, random_score * 100 AS action_score
        FROM (SELECT event_id, event_type, {_U} AS random_score FROM events)""",
)
def a3(spark, d):
    e = table(spark, d, "events").select("event_id", "event_type")
    return A.assign_treatment(e, ["event_id"], 12, "event_type").drop("event_type")


_QUARTER = " ".join(f"WHEN v <= {0.25 * (i + 1)} THEN '{a}'" for i, a in enumerate(MESSAGE_ACTIONS[:3]))


@query(
    "a3b_assign_treatment_thirds",
    f"""SELECT event_id, CASE WHEN u < 1.0::DOUBLE / 3 THEN CASE {_QUARTER} ELSE 'Education' END WHEN u <= 2.0::DOUBLE / 3 THEN event_type
          ELSE 'tree' END AS action,
        CASE WHEN u < 1.0::DOUBLE / 3 THEN 'Treatment Group - Random - ' || CASE {_QUARTER} ELSE 'Education' END
          WHEN u <= 2.0::DOUBLE / 3 THEN 'Treatment Group - AI Bandit Action' ELSE 'Treatment Group - XGBoost Action' END AS action_reason,
        round(CASE WHEN u <= 2.0::DOUBLE / 3 THEN u * 100 ELSE greatest(a, b) * 100 END, 6) AS action_score,
        CASE WHEN u < 1.0::DOUBLE / 3 THEN 'Save:0.00,Default:0.00'
          WHEN u <= 2.0::DOUBLE / 3 THEN 'Save:' || CAST(round_even(a * 100, 2) AS DECIMAL(10, 2)) || ',Default:' || CAST(round_even(b * 100, 2) AS DECIMAL(10, 2))
          ELSE 'first:' || CAST(round_even(a * 100, 2) AS DECIMAL(10, 2)) || ',second:' || CAST(round_even(b * 100, 2) AS DECIMAL(10, 2)) END AS predictions
        FROM (SELECT event_id, event_type, {_U} AS u, {uni('event_id', seed=13)} AS v, event_id % 128 / 128 AS a, event_id % 64 / 64 AS b FROM events)""",
)
def a3b(spark, d):
    e = table(spark, d, "events").select(
        "event_id", "event_type", F.lit("tree").alias("tree"),
        (F.col("event_id") % 128 / 128).alias("a"), (F.col("event_id") % 64 / 64).alias("b"),
    )
    x = A.assign_treatment_thirds(
        e, ["event_id"], 12, "event_type", "tree", {"Save": "a", "Default": "b"}, {"first": "a", "second": "b"}
    )
    cell = lambda p: F.concat(p["name"], F.lit(":"), p["score"].cast("decimal(10,2)").cast("string"))
    told = F.array_join(F.transform("predictions", cell), ",")
    return x.select(
        "event_id", "action", "action_reason", F.round("action_score", 6).alias("action_score"), told.alias("predictions")
    )


@query(
    "a4_bandit_response",
    f"""WITH {DRAWN} SELECT event_id, {_TYPES!r}[act + 1] AS name, CAST(round_even(probs[act + 1] * 10000, 0) AS BIGINT) AS score,
        array_to_string(list_transform(probs, lambda x : CAST(round_even(x * 10000, 0) AS BIGINT)), ',') AS scores FROM drawn""",
)
def a4(spark, d):
    x = M.predict_with_reward(_bandit(spark, d), "scores", "rewards", _TYPES, ["event_id"], 4)
    x = A.bandit_response(x, "ActionName", {t: f"action_prob_{t}" for t in _TYPES}, "SMSModel", "v1")
    r = F.from_json("response", "action struct<name:string,score:double>, predictions array<struct<name:string,score:double>>")
    whole = lambda c: F.round(c * 100).cast("bigint")
    return x.select(
        "event_id",
        r["action"]["name"].alias("name"),
        whole(r["action"]["score"]).alias("score"),
        F.array_join(F.transform(r["predictions"], lambda p: whole(p["score"]).cast("string")), ",").alias("scores"),
    )


_RU = [uni("event_id", f"'{i}'", seed=14) for i in range(4)]
RPOL = f"""ru AS (SELECT event_id, [{', '.join(_RU)}] AS u, {uni('event_id', seed=15)} AS v FROM events),
  rr AS (SELECT event_id, v, list_transform(u, lambda x : CAST(round_even(x / (u[1] + u[2] + u[3] + u[4]) * 10000, 0) AS BIGINT)) AS r FROM ru),
  rp AS (SELECT event_id, v, r[1] AS a, r[2] AS b, r[3] AS c, 10000 - r[1] - r[2] - r[3] AS e FROM rr)"""


@query(
    "a5_random_policy",
    f"""WITH {RPOL} SELECT event_id, a || ',' || b || ',' || c || ',' || e AS probs,
        CASE WHEN a / 10000 >= v THEN '0' WHEN a / 10000 + b / 10000 >= v THEN '1' WHEN a / 10000 + b / 10000 + c / 10000 >= v THEN '2'
             WHEN a / 10000 + b / 10000 + c / 10000 + e / 10000 >= v THEN '3' ELSE '0' END AS "Action" FROM rp""",
)
def a5(spark, d):
    e = table(spark, d, "events").select("event_id")
    x = A.random_policy(e, ["0", "1", "2", "3"], ["event_id"], 14)
    whole = F.transform("probs", lambda p: F.round(p * 10000).cast("bigint").cast("string"))
    return x.select("event_id", F.array_join(whole, ",").alias("probs"), "Action")


@query(
    "a6_next_day_send_time",
    f"""WITH {RPOL} SELECT rp.event_id, strftime(date_trunc('day', ts) + INTERVAL 1 DAY + to_hours(CAST(user_id % 4 AS BIGINT)), '%Y-%m-%d %H:%M:%S') AS action_time,
        round([a, b, c, e][user_id % 4 + 1] / 10000, 4) AS probability FROM rp JOIN events USING (event_id)""",
)
def a6(spark, d):
    e = table(spark, d, "events").select("event_id", "ts", (F.col("user_id") % 4).alias("hour"))
    x = A.random_policy(e, ["0", "1", "2", "3"], ["event_id"], 14)
    x = A.next_day_send_time(x, "hour", "ts", "probs")
    return x.select("event_id", "action_time", F.round("probability", 4).alias("probability"))


@query(
    "a7_round_outputs",
    f"WITH {BANDIT} SELECT event_id, array_to_string(list_transform(rewards, lambda x : CAST(round_even(x * 10000, 0) AS BIGINT)), ',') AS rewards FROM bandit",
)
def a7(spark, d):
    x = A.round_outputs(_bandit(spark, d).select("event_id", "rewards"), ["rewards"])
    whole = F.transform("rewards", lambda p: F.round(p * 10000).cast("bigint").cast("string"))
    return x.select("event_id", F.array_join(whole, ",").alias("rewards"))
