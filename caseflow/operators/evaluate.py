"""Evaluation reports: sequence, binary, token and action metrics, by subgroup.

Everything ordered by score works on distinct scores with counts, so rows that
share a score are merged before any shuffle, and running counts come from
:mod:`caseflow.plans.spread`.
"""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F, types as T

from caseflow.plans.spread import join_null_safe, running, stored

# Glucose regions by upper bound (the first two exclude it).
REGIONS = ["VeryLow", "Low", "TIR", "High", "VeryHigh"]


def glucose_region(x: Column) -> Column:
    """Region of a glucose value."""
    return (
        F.when(x < 54, "VeryLow")
        .when(x < 70, "Low")
        .when(x <= 180, "TIR")
        .when(x <= 250, "High")
        .when(x > 250, "VeryHigh")
    )


def _mean(values: Column) -> Column:
    total = F.aggregate(values, F.lit(0.0), lambda a, x: a + x)
    return F.when(F.size(values) > 0, total / F.size(values))


def _share(values: Column, test) -> Column:
    return F.when(F.size(values) > 0, F.size(F.filter(values, test)) / F.size(values))


def _in_region(pairs: Column, region: str) -> Column:
    return F.filter(pairs, lambda x: x["r"] == region)


def _round4(x) -> Column:
    """Four decimals, halves to even.

    Sums of floats depend on the order tasks finish in; rounding to nine
    decimals first keeps that from deciding a half.
    """
    return F.rint(F.round(x, 9) * 10000) / 10000


def _round2(x: Column) -> Column:
    """Two decimals, halves to even."""
    return F.rint(x * 100) / 100


def seq_metrics(
    df: DataFrame, real: str, pred: str, horizons: dict[str, tuple[int, int]]
) -> DataFrame:
    """Per row and horizon ``[start, end)``: rMSE, MAE, shares within 5 and 10, region accuracy
    and region accuracy per real region (null when the region does not occur)."""
    out = df
    for h, (start, end) in horizons.items():
        part = lambda c: F.slice(F.col(c), start + 1, end - start)
        pairs = F.zip_with(
            part(real),
            part(pred),
            lambda a, b: F.struct(
                F.abs(a.cast("double") - b.cast("double")).alias("d"),
                glucose_region(a).alias("r"),
                (glucose_region(a) == glucose_region(b)).alias("m"),
            ),
        )
        out = out.withColumn(f"_{h}", pairs)
    columns = {}
    for h in horizons:
        p = F.col(f"_{h}")
        gap = F.transform(p, lambda x: x["d"])
        columns[f"{h}_rMSE"] = _round2(F.sqrt(_mean(F.transform(p, lambda x: x["d"] * x["d"]))))
        columns[f"{h}_MAE"] = _round2(_mean(gap))
        columns[f"{h}_MAEin5"] = _round2(_share(p, lambda x: x["d"] <= 5))
        columns[f"{h}_MAEin10"] = _round2(_share(p, lambda x: x["d"] <= 10))
        columns[f"{h}_RegionAccu"] = _share(p, lambda x: x["m"])
        for region in REGIONS:
            columns[f"{h}_RegionAccuByRegion_{region}"] = _share(_in_region(p, region), lambda x: x["m"])
    return out.withColumns(columns).drop(*[f"_{h}" for h in horizons])


def _t_cdf(t: float, df: float) -> float:
    """Student t distribution function, by the continued fraction of the incomplete beta."""
    x = df / (df + t * t)
    a, b = df / 2.0, 0.5
    if x <= 0.0:
        return 1.0
    front = math.exp(
        math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x)
    ) if x < 1.0 else 0.0

    def fraction(x, a, b):
        c, d = 1.0, 1.0 - (a + b) * x / (a + 1.0)
        d = 1.0 / (d if abs(d) > 1e-300 else 1e-300)
        h = d
        for m in range(1, 300):
            for num in (
                m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)),
                -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1)),
            ):
                d = 1.0 + num * d
                d = 1.0 / (d if abs(d) > 1e-300 else 1e-300)
                c = 1.0 + num / c
                c = c if abs(c) > 1e-300 else 1e-300
                h *= d * c
            if abs(d * c - 1.0) < 1e-15:
                break
        return h

    if x < (a + 1.0) / (a + b + 2.0):
        tail = front * fraction(x, a, b) / a
    else:
        tail = 1.0 - front * fraction(1.0 - x, b, a) / b
    return 1.0 - tail / 2.0


def t_quantile(p: float, df: float) -> float:
    """Student t quantile for p above one half, by bisection."""
    low, high = 0.0, 1.0
    while _t_cdf(high, df) < p and high < 1e12:
        high *= 2.0
    for _ in range(200):
        mid = (low + high) / 2.0
        low, high = (mid, high) if _t_cdf(mid, df) < p else (low, mid)
    return (low + high) / 2.0


@F.pandas_udf(T.DoubleType())
def _t_column(degrees: pd.Series, p: pd.Series) -> pd.Series:
    """Quantiles for the few distinct group sizes of a report."""
    known = {k: t_quantile(k[1], k[0]) for k in set(zip(degrees, p)) if k[0] and k[0] > 0}
    return pd.Series([known.get(k, float("nan")) for k in zip(degrees, p)])


def subgroup_sets(df: DataFrame, sets: list[list[str]]) -> DataFrame:
    """Rows once per subgroup set, as ``set_name`` (columns) and ``set_value`` (their values).

    Aggregates that follow combine before the shuffle, so a row costs its copies
    in one task only.
    """
    copies = F.array(
        *[
            F.struct(
                F.lit(",".join(cols)).alias("set_name"),
                F.concat_ws(",", *[F.coalesce(F.col(c).cast("string"), F.lit("null")) for c in cols]).alias(
                    "set_value"
                ),
            )
            for cols in sets
        ]
    )
    return df.select("*", F.inline(copies))


def seq_report(
    df: DataFrame, metrics: list[str], subgroups: list[list[str]], confidence: float = 0.95
) -> DataFrame:
    """Mean, standard error and Student t interval of each metric per subgroup, over its non-null rows."""
    per = subgroup_sets(df.select(*metrics, *{c for s in subgroups for c in s}), subgroups)
    aggs = []
    for m in metrics:
        aggs += [
            F.count(m).alias(f"{m}:n"),
            F.avg(m).alias(f"{m}:mean"),
            (F.stddev_samp(m) / F.sqrt(F.count(m))).alias(f"{m}:sem"),
        ]
    wide = per.groupBy("set_name", "set_value").agg(*aggs)
    rows = F.array(
        *[
            F.struct(
                F.lit(m).alias("metric"),
                F.col(f"`{m}:n`").alias("n"),
                F.col(f"`{m}:mean`").alias("mean"),
                F.col(f"`{m}:sem`").alias("sem"),
            )
            for m in metrics
        ]
    )
    long = wide.select("set_name", "set_value", F.inline(rows))
    t = _t_column((F.col("n") - 1).cast("double"), F.lit(1 - (1 - confidence) / 2))
    half = F.when(F.col("n") > 1, t * F.col("sem"))
    return long.withColumn("ci_lower", F.col("mean") - half).withColumn(
        "ci_upper", F.col("mean") + half
    )


def _threshold_columns(n, pos, tp, pp) -> dict[str, Column]:
    """Metrics from row count, positives, true positives and predicted positives."""
    ratio = lambda a, b: F.when(b > 0, a / b)
    return {
        "accu": _round4((tp + (n - pos - (pp - tp))) / n),
        "precision": _round4(ratio(tp, pp)),
        "recall": _round4(ratio(tp, pos)),
        "f1": _round4(F.when((pp > 0) & (pos > 0), 2 * tp / (pp + pos))),
        "PredPosNum": pp,
        "PredPosRate": _round4(pp / n),
        "RealPosNum": pos,
        "RealPosRate": _round4(pos / n),
    }


def threshold_metrics(
    df: DataFrame, label: str, score: str, threshold: float, group: list[str] | None = None
) -> DataFrame:
    """Accuracy, precision, recall, F1 and counts at a threshold; null where undefined."""
    hit = F.col(score) >= threshold
    real = F.col(label) == 1
    sums = df.where(F.col(score).isNotNull()).groupBy(*(group or [])).agg(
        F.count(F.lit(1)).alias("SampleNum"),
        F.count(F.when(real, 1)).alias("_pos"),
        F.count(F.when(real & hit, 1)).alias("_tp"),
        F.count(F.when(hit, 1)).alias("_pp"),
    )
    cols = _threshold_columns(*[F.col(c) for c in ("SampleNum", "_pos", "_tp", "_pp")])
    return sums.select(
        *(group or []), F.lit(threshold).alias("threshold"), "SampleNum", *[c.alias(k) for k, c in cols.items()]
    )


def score_counts(df: DataFrame, label: str, score: str, group: list[str] | None = None) -> DataFrame:
    """Rows (``n``) and positives (``pos``) per group and distinct score."""
    return (
        df.where(F.col(score).isNotNull())
        .groupBy(*(group or []), F.col(score).alias("score"))
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.count(F.when(F.col(label) == 1, 1)).alias("pos"),
        )
    )


def _attach(df: DataFrame, one: DataFrame, group: list[str]) -> DataFrame:
    """Rows with their group's single row; the single row of a whole table is a scalar subquery."""
    if group:
        return join_null_safe(df, one, group)
    row = one.select(F.struct(*[F.col(f"`{c}`") for c in one.columns])).scalar()
    return df.withColumn("_one", row).select("*", "_one.*").drop("_one")


def _summarise(r: DataFrame, group: list[str]) -> DataFrame:
    """One summary row per group from distinct scores with counts and running counts.

    ``cum_n`` and ``cum_pos`` may start anywhere: a group's base is taken off.
    """
    s = F.col("score")
    totals = r.groupBy(*group).agg(
        F.sum("n").alias("_N"),
        F.sum("pos").alias("_P"),
        (F.sum(s * F.col("n")) / F.sum("n")).alias("_mean"),
        F.min(F.col("cum_n") - F.col("n")).alias("_base_n"),
        F.min(F.col("cum_pos") - F.col("pos")).alias("_base_pos"),
    )
    counts = r.select(*group, "score", "n", "pos")
    r = _attach(r, totals, group)
    r = r.withColumn("cum_n", F.col("cum_n") - F.col("_base_n")).withColumn(
        "cum_pos", F.col("cum_pos") - F.col("_base_pos")
    )
    neg = F.col("n") - F.col("pos")
    neg_below = (F.col("cum_n") - F.col("cum_pos")) - neg
    at_or_above = F.col("_N") - F.col("cum_n") + F.col("n")
    reaches = (at_or_above >= F.col("_P")) & (F.col("_P") > 0)
    first = r.groupBy(*group).agg(
        F.first("_N").alias("SampleNum"),
        F.first("_P").alias("RealPosNum"),
        F.first("_mean").alias("_mean"),
        F.sum(F.col("pos") * (neg_below + neg * F.lit(0.5))).alias("_u"),
        F.sum(F.col("n") * (s - F.col("_mean")) * (s - F.col("_mean"))).alias("_ss"),
        F.min(s).alias("_min"),
        F.max(s).alias("_max"),
        _round4(F.max(F.when(reaches, s))).alias("BLC_threshold"),
    )
    cut = first.select(*group, "BLC_threshold")
    at = _attach(counts, cut, group)
    sums = []
    for tag, line in (("0.5", F.lit(0.5)), ("BLC", F.col("BLC_threshold"))):
        hit = s >= line
        sums += [
            F.coalesce(F.sum(F.when(hit, F.col("pos"))), F.lit(0)).alias(f"_tp_{tag}"),
            F.coalesce(F.sum(F.when(hit, F.col("n"))), F.lit(0)).alias(f"_pp_{tag}"),
        ]
    hits = at.groupBy(*group).agg(*sums)
    both = _attach(first, hits, group)
    n, p = F.col("SampleNum"), F.col("RealPosNum")
    cols = {
        "SampleNum": n,
        "RealPosNum": p,
        "RealPosRate": _round4(p / n),
        "roc_auc": F.round(F.when((p > 0) & (p < n), F.col("_u") / (p * (n - p)).cast("double")), 6),
        "PredScoreMean": _round4("_mean"),
        "PredScoreStd": _round4(F.when(n > 1, F.sqrt(F.col("_ss") / (n - 1)))),
        "PredScoreMin": _round4("_min"),
        "PredScoreMax": _round4("_max"),
        "BLC_threshold": F.col("BLC_threshold"),
    }
    for tag in ("0.5", "BLC"):
        made = _threshold_columns(n, p, F.col(f"`_tp_{tag}`"), F.col(f"`_pp_{tag}`"))
        for k in ("accu", "precision", "recall", "f1", "PredPosNum"):
            value = made[k] if tag == "0.5" else F.when(F.col("BLC_threshold").isNotNull(), made[k])
            cols[f"{tag.replace('.', '_')}_{k}"] = value
    return both.select(*group, *[c.alias(k) for k, c in cols.items()])


def binary_summary(df: DataFrame, label: str, score: str, group: list[str] | None = None) -> DataFrame:
    """Counts, positive rate, AUC (null with one class), score moments, and threshold metrics at
    0.5 and at the balanced threshold (the P-th highest score, for P positives)."""
    group = list(group or [])
    counts = score_counts(df, label, score, group)
    return _summarise(running(counts, ["score"], {"cum_n": F.col("n"), "cum_pos": F.col("pos")}, group), group)


def _curve(df: DataFrame, label: str, score: str, group: list[str]) -> DataFrame:
    """Per group and distinct score: rows and true positives at or above it, with the totals."""
    counts = score_counts(df, label, score, group)
    down = counts.withColumn("_neg_score", -F.col("score"))
    r = running(down, ["_neg_score"], {"pp": F.col("n"), "tp": F.col("pos")}, group)
    total = r.groupBy(*group).agg(F.sum("n").alias("rows"), F.sum("pos").alias("positives"))
    return _attach(r.drop("_neg_score"), total, group)


def roc_curve(df: DataFrame, label: str, score: str, group: list[str] | None = None) -> DataFrame:
    """False and true positive rate at each distinct score, all points kept."""
    return _roc(_curve(df, label, score, list(group or [])), list(group or []))


def _roc(c: DataFrame, group: list[str]) -> DataFrame:
    return c.select(
        *group,
        F.col("score").alias("threshold"),
        F.when(F.col("rows") > F.col("positives"), (F.col("pp") - F.col("tp")) / (F.col("rows") - F.col("positives"))).alias("fpr"),
        F.when(F.col("positives") > 0, F.col("tp") / F.col("positives")).alias("tpr"),
    )


def pr_curve(df: DataFrame, label: str, score: str, group: list[str] | None = None) -> DataFrame:
    """Precision and recall at each distinct score, all points kept."""
    return _pr(_curve(df, label, score, list(group or [])), list(group or []))


def _pr(c: DataFrame, group: list[str]) -> DataFrame:
    return c.select(
        *group,
        F.col("score").alias("threshold"),
        (F.col("tp") / F.col("pp")).alias("precision"),
        F.when(F.col("positives") > 0, F.col("tp") / F.col("positives")).alias("recall"),
    )


def _levels(step: float, end: float) -> list[float]:
    n = math.ceil(round((end - 0.0) / step, 9))
    return [round(i * step, 3) for i in range(n)]


def threshold_table(
    df: DataFrame, label: str, score: str, step: float = 0.05, group: list[str] | None = None
) -> DataFrame:
    """Threshold metrics at 0, step, ... 1.

    A row is counted once, at the highest threshold it reaches; the counts of a
    threshold are the sums over the levels from it on.
    """
    group = list(group or [])
    rows = df.where(F.col(score).isNotNull()).select(
        *group, F.col(score).alias("score"), F.lit(1).alias("n"), (F.col(label) == 1).cast("int").alias("pos")
    )
    return _thresholds(rows, step, group)


def _thresholds(counts: DataFrame, step: float, group: list[str]) -> DataFrame:
    levels = _levels(step, 1 + step)
    lines = F.array(*[F.lit(x) for x in levels])
    reached = F.size(F.filter(lines, lambda t: t <= F.col("score")))
    at = counts.groupBy(*group, reached.alias("_level")).agg(
        F.sum("n").alias("_n"), F.coalesce(F.sum("pos"), F.lit(0)).alias("_p")
    )
    cells = at.select(
        *group,
        "_n",
        "_p",
        F.posexplode(lines).alias("_i", "threshold"),
        "_level",
    )
    hit = F.col("_level") > F.col("_i")
    sums = cells.groupBy(*group, "threshold").agg(
        F.sum("_n").alias("SampleNum"),
        F.sum("_p").alias("_pos"),
        F.sum(F.when(hit, F.col("_p")).otherwise(0)).alias("_tp"),
        F.sum(F.when(hit, F.col("_n")).otherwise(0)).alias("_pp"),
    )
    cols = _threshold_columns(*[F.col(c) for c in ("SampleNum", "_pos", "_tp", "_pp")])
    return sums.select(*group, "threshold", "SampleNum", *[c.alias(k) for k, c in cols.items()])


def score_band_table(
    df: DataFrame, label: str, score: str, step: float = 0.05, group: list[str] | None = None
) -> DataFrame:
    """Binary summary of each score band ``[s, s + step)``, 0 samples where it has no rows; a score
    of 1 is in none."""
    d = _banded(df, score, step)
    found = binary_summary(d, label, score, [*(group or []), "band"])
    groups = df.select(*group).distinct() if group else df.sparkSession.range(1).select()
    return _every_band(groups, found, step, list(group or []))


def _banded(df: DataFrame, score: str, step: float) -> DataFrame:
    """Rows whose score lies in a band, with its number."""
    levels = _levels(step, 1.0)
    lines = F.array(*[F.lit(x) for x in levels])
    d = df.where((F.col(score) >= levels[0]) & (F.col(score) < round(levels[-1] + step, 3)))
    return d.withColumn("band", F.size(F.filter(lines, lambda t: t <= F.col(score))) - 1)


def _every_band(groups: DataFrame, found: DataFrame, step: float, group: list[str]) -> DataFrame:
    """The summary of every band of every group, with 0 samples where it has no rows."""
    levels = _levels(step, 1.0)
    bands = groups.withColumn("band", F.explode(F.sequence(F.lit(0), F.lit(len(levels) - 1))))
    out = join_null_safe(bands, found, [*group, "band"], "left")
    out = out.fillna(0, ["SampleNum", "RealPosNum"])
    name = F.create_map(
        *[
            x
            for i, s in enumerate(levels)
            for x in (F.lit(i), F.lit(f"PredScore{s}-{round(s + step, 3)}"))
        ]
    )
    return out.withColumn("SubGroup", name[F.col("band")])


def nth_group(
    df: DataFrame, label: str, score: str, n: int, tie: list[str], by: list[str] | None = None
) -> DataFrame:
    """Equal-count group 1..n by ascending score (the first groups are larger by one), with the
    running counts of rows and positives; inside each subgroup ``by``."""
    by = list(by or [])
    known = df.where(F.col(score).isNotNull())
    positive = F.coalesce((F.col(label) == 1).cast("bigint"), F.lit(0))
    ranked = running(
        known, [score, *tie], {"cum_n": F.lit(1).cast("bigint"), "cum_pos": positive}, by
    )
    d = _attach(ranked, ranked.groupBy(*by).agg(F.count(F.lit(1)).alias("_n")), by)
    return d.withColumn("group", _nth(F.col("cum_n"), F.col("_n"), n)).drop("_n")


def _nth(rank: Column, rows: Column, n: int) -> Column:
    """The equal-count group of a rank among so many rows; the first groups are larger by one."""
    size, extra = F.floor(rows / F.lit(n)), rows % F.lit(n)
    big = extra * (size + 1)
    group = F.when(rank <= big, F.ceil(rank / (size + 1))).otherwise(
        extra + F.ceil((rank - big) / F.greatest(size, F.lit(1)))
    )
    return group.cast("int")


def _group_counts(grouped: DataFrame, label: str, score: str, by: list[str]) -> DataFrame:
    """Distinct scores per equal-count group; the running counts go on from the ranking."""
    return grouped.groupBy(*by, "group", F.col(score).alias("score")).agg(
        F.count(F.lit(1)).alias("n"),
        F.count(F.when(F.col(label) == 1, 1)).alias("pos"),
        F.max("cum_n").alias("cum_n"),
        F.max("cum_pos").alias("cum_pos"),
    )


def nth_group_table(
    df: DataFrame, label: str, score: str, tie: list[str], n: int = 10, by: list[str] | None = None
) -> DataFrame:
    """Binary summary of each equal-count group, inside each subgroup ``by``."""
    by = list(by or [])
    return _summarise(_group_counts(nth_group(df, label, score, n, tie, by), label, score, by), [*by, "group"])


def bottom_top_tables(
    df: DataFrame, label: str, score: str, tie: list[str], n: int = 10, by: list[str] | None = None
) -> DataFrame:
    """Binary summary of the lowest and of the highest 1..n groups together (``Btm``/``Top`` k).

    Distinct scores per group, not rows, are copied to the at most n + 1 sets they belong to.
    """
    by = list(by or [])
    return _bottom_top(_group_counts(nth_group(df, label, score, n, tie, by), label, score, by), n, by)


def _bottom_top(counts: DataFrame, n: int, by: list[str]) -> DataFrame:
    g = F.col("group")
    sets = F.concat(
        F.transform(F.sequence(g, F.lit(n)), lambda k: F.struct(F.lit("Btm").alias("side"), k.alias("k"))),
        F.transform(
            F.sequence(F.lit(n) + 1 - g, F.lit(n)),
            lambda k: F.struct(F.lit("Top").alias("side"), k.alias("k")),
        ),
    )
    spread = counts.select(*by, "score", "n", "pos", "cum_n", "cum_pos", F.inline(sets))
    merged = spread.groupBy(*by, "side", "k", "score").agg(
        F.sum("n").alias("n"),
        F.sum("pos").alias("pos"),
        F.max("cum_n").alias("cum_n"),
        F.max("cum_pos").alias("cum_pos"),
    )
    return _summarise(merged, [*by, "side", "k"])


def report_by_subgroup(df: DataFrame, label: str, score: str, subgroups: list[list[str]]) -> DataFrame:
    """Binary summary of every subgroup of every set."""
    need = list(dict.fromkeys([label, score, *[c for s in subgroups for c in s]]))
    return binary_summary(subgroup_sets(df.select(*need), subgroups), label, score, ["set_name", "set_value"])


def tables_by_subgroup(
    df: DataFrame, label: str, score: str, subgroups: list[list[str]], tie: list[str], n: int = 10
) -> dict[str, DataFrame]:
    """The whole report of every subgroup of every set, a table per part.

    What is upstream runs once: the needed columns are written, counted by subgroup columns
    and score, and only these counts are copied to the sets and ranked, once.  All tables
    are read from the ranked counts.  Rows are looked at again only where one score lies
    across a border of equal-count groups, and ``tie`` must say which of them go where.
    """
    cols = list(dict.fromkeys(c for s in subgroups for c in s))
    by = ["set_name", "set_value"]
    real = F.coalesce((F.col(label) == 1).cast("bigint"), F.lit(0))
    rows = df.select(*cols, F.col(score).alias("_score"), real.alias("_pos"), F.struct(*tie).alias("_tie"))
    rows = stored(rows, "report-rows")
    slim = rows.where("_score is not null")
    counts = slim.groupBy(*cols, "_score").agg(F.count(F.lit(1)).alias("_n"), F.sum("_pos").alias("_pos"))
    counts = subgroup_sets(counts, subgroups).groupBy(*by, F.col("_score").alias("score")).agg(
        F.sum("_n").alias("n"), F.sum("_pos").alias("pos")
    )
    ranked = running(counts, ["score"], {"cum_n": F.col("n"), "cum_pos": F.col("pos")}, by)
    total = ranked.groupBy(*by).agg(F.sum("n").alias("rows"), F.sum("pos").alias("positives"))
    ranked = stored(join_null_safe(ranked, total, by), "report-ranks")

    curve = ranked.withColumns(
        {"pp": F.col("rows") - F.col("cum_n") + F.col("n"), "tp": F.col("positives") - F.col("cum_pos") + F.col("pos")}
    )
    plain = ranked.drop("rows", "positives")
    banded = _summarise(_banded(plain, "score", 0.05), [*by, "band"])
    every = subgroup_sets(rows.select(*cols).distinct() if cols else rows.limit(1), subgroups)
    groups = stored(_groups_of_counts(ranked, slim, subgroups, by, n), "report-groups")
    return {
        "summary": _summarise(plain, by),
        "roc": _roc(curve, by),
        "pr": _pr(curve, by),
        "thresholds": _thresholds(plain, 0.05, by),
        "bands": _every_band(every.select(*by).distinct(), banded, 0.05, by),
        "groups": _summarise(groups, [*by, "group"]),
        "bottom_top": _bottom_top(groups, n, by),
    }


def _groups_of_counts(ranked: DataFrame, slim: DataFrame, subgroups: list[list[str]], by: list[str], n: int) -> DataFrame:
    """Ranked counts per equal-count group; scores that lie across a border are split by rows."""
    before = F.col("cum_n") - F.col("n")
    ends = ranked.withColumn("group", _nth(before + 1, F.col("rows"), n))
    ends = ends.withColumn("_last", _nth(F.col("cum_n"), F.col("rows"), n))
    whole = ends.where(F.col("group") == F.col("_last")).select(*by, "group", "score", "n", "pos", "cum_n", "cum_pos")
    across = ends.where(F.col("group") < F.col("_last")).select(
        *by, "score", "rows", before.alias("_n0"), (F.col("cum_pos") - F.col("pos")).alias("_p0")
    )
    across = stored(across, "report-borders")
    if across.isEmpty():
        return whole
    mine = subgroup_sets(slim, subgroups).select(*by, F.col("_score").alias("score"), F.col("_pos").alias("pos"), "_tie")
    mine = join_null_safe(mine, across, [*by, "score"])
    at = running(mine, ["_tie"], {"_r": F.lit(1).cast("bigint"), "_p": F.col("pos")}, [*by, "score"])
    at = at.withColumns({"cum_n": F.col("_n0") + F.col("_r"), "cum_pos": F.col("_p0") + F.col("_p")})
    at = at.withColumn("group", _nth(F.col("cum_n"), F.col("rows"), n))
    parts = at.groupBy(*by, "group", "score").agg(
        F.count(F.lit(1)).alias("n"), F.sum("pos").alias("pos"), F.max("cum_n").alias("cum_n"), F.max("cum_pos").alias("cum_pos")
    )
    return whole.unionByName(parts)


def score_percentile(df: DataFrame, ref: DataFrame, score: str, out: str = "percentile") -> DataFrame:
    """Percentile of a score within reference scores: (reference scores below + 0.5) / n.

    Distinct scores of both sides share one running count; no row meets another.
    """
    refs = ref.where(F.col(score).isNotNull()).groupBy(F.col(score).alias("_s")).agg(
        F.count(F.lit(1)).alias("_n")
    )
    mine = df.where(F.col(score).isNotNull()).select(F.col(score).alias("_s"), F.lit(0).cast("bigint").alias("_n"))
    both = refs.unionByName(mine).groupBy("_s").agg(F.sum("_n").alias("_n"))
    upto = running(both, ["_s"], {"_upto": F.col("_n")})
    total = refs.agg(F.sum("_n").alias("n")).scalar()
    place = upto.withColumn("_total", total).select(
        F.col("_s").alias(score),
        F.bround((F.col("_upto") - F.col("_n") + 0.5) / F.col("_total") * 100, 0).cast("int").alias(out),
    )
    return df.join(place, score, "left")


def _sequence_pairs(df: DataFrame, pred: str, real: str) -> DataFrame:
    pairs = F.arrays_zip(F.col(pred).alias("p"), F.col(real).alias("r"))
    return df.select(F.posexplode(pairs).alias("pos", "x")).select("pos", "x.p", "x.r")


def token_metrics(df: DataFrame, pred: str, labels: str, last: int = 24) -> DataFrame:
    """Next-token accuracy and rMSE over all positions and the last ones (predictions are
    one step ahead of the labels)."""
    n = F.size(labels) - 1
    shifted = df.select(
        F.slice(pred, F.lit(1), n).alias("p"), F.slice(labels, F.lit(2), n).alias("r"), n.alias("_n")
    )
    rows = shifted.select("_n", F.posexplode(F.arrays_zip("p", "r")).alias("pos", "x"))
    p, r = F.col("x.p").cast("double"), F.col("x.r").cast("double")
    end = F.col("pos") >= F.col("_n") - last
    sq = (p - r) * (p - r)
    return rows.agg(
        F.avg((p == r).cast("double")).alias("ACUU"),
        F.avg(F.when(end, (p == r).cast("double"))).alias("ACUUaf"),
        F.sqrt(F.avg(sq)).alias("rMSE"),
        F.sqrt(F.avg(F.when(end, sq))).alias("rMSEaf"),
    )


def horizon_metrics(df: DataFrame, pred: str, labels: str, horizons=(6, 12, 24)) -> DataFrame:
    """Accuracy, mse and rmse of the first h generated steps, one row per horizon."""
    n = F.size(labels)
    tail = F.slice(pred, F.greatest(F.size(pred) - n, F.lit(0)) + 1, n)
    rows = _sequence_pairs(df.select(tail.alias("p"), F.col(labels).alias("r")), "p", "r")
    p, r = F.col("p").cast("double"), F.col("r").cast("double")
    by_step = rows.groupBy("pos").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum((p == r).cast("bigint")).alias("hit"),
        F.sum((p - r) * (p - r)).alias("sq"),
    )
    wanted = F.array(*[F.lit(h) for h in horizons])
    cells = by_step.select("n", "hit", "sq", "pos", F.explode(wanted).alias("horizon"))
    out = cells.where(F.col("pos") < F.col("horizon")).groupBy("horizon").agg(
        (F.sum("hit") / F.sum("n")).alias("accuracy"), (F.sum("sq") / F.sum("n")).alias("mse")
    )
    return out.withColumn("rmse", F.sqrt("mse"))


def action_report(
    df: DataFrame, action: str, reward: str, actions: list, subgroups: list[list[str]]
) -> DataFrame:
    """Per subgroup: rows, mean predicted reward, share of each action."""
    d = subgroup_sets(df, subgroups)
    shares = [
        _round4(F.avg((F.col(action) == a).cast("double"))).alias(f"Action_{a}") for a in actions
    ]
    return d.groupBy("set_name", "set_value").agg(
        F.count(F.lit(1)).alias("SampleNum"), F.avg(reward).alias("PredEngagement"), *shares
    )


def pred_to_real_diff(df: DataFrame, real: str, pred: str, out: str = "diff") -> DataFrame:
    """Element-wise predicted minus real."""
    return df.withColumn(out, F.zip_with(F.col(pred), F.col(real), lambda p, r: p - r))


def real_variance(df: DataFrame, real: str, out: str = "real_var") -> DataFrame:
    """Population variance of each row's real sequence."""
    d = df.withColumn("_mean", _mean(F.transform(real, lambda x: x.cast("double"))))
    spread = _mean(
        F.transform(real, lambda x: (x.cast("double") - F.col("_mean")) * (x.cast("double") - F.col("_mean")))
    )
    return d.withColumn(out, spread).drop("_mean")
