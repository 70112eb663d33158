"""Random tags, train/valid/test splits, sampling; all repeatable."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, functions as F

from caseflow.config import Rule
from caseflow.functions import timegrid as tg
from caseflow.functions.rng import uniform
from caseflow.operators.cases import IDS, filter_test
from caseflow.plans.selection import first_rows
from caseflow.plans.spread import rank_by_hash, rank_rows, row_order


def random_tags(df: DataFrame, seed: int, pid: str = "PID", obs: str = "ObsDT") -> DataFrame:
    """Uniforms per row and per patient, and the row's relative place in its patient by time.

    Equal times are ordered by the other columns; a null time comes first.
    """
    ids = [pid, obs]
    per = df.groupBy(F.col(pid).alias("_pid")).agg(F.count(F.lit(1)).alias("_count"))
    placed = rank_rows(df, row_order(df, [obs]), "_n", group=[pid], chunk=tg.bucket(tg.micros(obs)))
    return (
        placed.join(per, F.col(pid).eqNullSafe(F.col("_pid")))
        .drop("_pid")
        .withColumn("CaseRltLocInP", (F.col("_n") - 1) / F.col("_count"))
        .withColumn("RandDownSample", uniform(ids, seed))
        .withColumn("RandInOut", uniform([pid], seed + 1))
        .withColumn("RandTest", uniform(ids, seed + 2))
        .withColumn("RandValidation", uniform(ids, seed + 3))
        .drop("_n", "_count")
    )


def _ratio(rule) -> tuple[str, float | None]:
    """How a part is chosen: tail of each patient, from a date on, or at random."""
    if isinstance(rule, str) and "tail" in rule:
        return "tail", float(rule.replace("tail", ""))
    if isinstance(rule, (int, float)):
        return "random", float(rule)
    return "date", None


def split_tags(
    df: DataFrame,
    out_ratio: float,
    test_ratio,
    valid_ratio,
    seed: int = 42,
    pid: str = "PID",
    obs: str = "ObsDT",
) -> DataFrame:
    """Boolean columns In/Out (by patient) and Train/Valid/Test.

    A ratio is a number (random), ``"0.2tail"`` (last part of each patient) or a
    date.  A random valid ratio counts within what the test part leaves.
    """
    d = random_tags(df, seed, pid, obs)

    def at_or_after(rule, random: str, threshold: float) -> tuple[Column, Column]:
        how, _ = _ratio(rule)
        if how == "date":
            stamp = rule.isoformat(sep=" ") if isinstance(rule, dt.datetime) else str(rule)
            return F.col(obs), F.lit(stamp).cast("timestamp_ntz")
        return F.col("CaseRltLocInP" if how == "tail" else random), F.lit(threshold)

    test_how, t = _ratio(test_ratio)
    valid_how, v = _ratio(valid_ratio)
    t_col, t_at = at_or_after(test_ratio, "RandTest", 1 - t if t is not None else 1.0)
    if valid_how == "random":
        v_line = 1 - v / (1 - t) if t is not None else 1.0
    else:
        v_line = 1 - v if v is not None else 1.0
    v_col, v_at = at_or_after(valid_ratio, "RandValidation", v_line)
    out = F.col("RandInOut") < out_ratio
    return (
        d.withColumn("Out", out)
        .withColumn("In", ~out)
        .withColumn("Test", t_col >= t_at)
        .withColumn("Valid", (v_col > v_at) & ~F.col("Test"))
        .withColumn("Train", ~F.col("Test") & ~F.col("Valid"))
        .drop("RandInOut", "CaseRltLocInP", "RandTest", "RandValidation")
    )


def group_splits(df: DataFrame, cols: list[str]) -> DataFrame:
    """Group name ``group``: chosen parts (TVT, InOut, Base) joined by ``_``."""
    parts = {
        "TVT": F.when(F.col("Test"), "Test").when(F.col("Valid"), "Valid").otherwise("Train")
        if "TVT" in cols
        else None,
        "InOut": F.when(F.col("In"), "In").otherwise("Out") if "InOut" in cols else None,
        "Base": F.lit("Base"),
    }
    return df.withColumn("group", F.concat_ws("_", *[parts.get(c, F.col(c)) for c in cols]))


def split_by_patient(
    df: DataFrame, train: float, valid: float, test: float, seed: int, pid: str = "PID"
) -> DataFrame:
    """Patients, not rows, into train, valid and test of exact sizes.

    Patients are ranked by their uniform: the first floor(train * n) train; of
    the rest the last ceil(test share) test.
    """
    if abs(train + valid + test - 1.0) >= 1e-6:
        raise ValueError("ratios must sum to 1")
    pids = df.select(pid).distinct()
    total = pids.agg(F.count(F.lit(1)).alias("n")).scalar()
    ranked = rank_by_hash(pids.withColumn("_u", uniform([pid], seed)), "_u", [pid], "_rank")
    ranked = ranked.withColumn("_n", total)
    n_train = F.floor(F.col("_n") * F.lit(train))
    n_test = F.ceil((F.col("_n") - n_train) * F.lit(test / (valid + test)))
    split = (
        F.when(F.col("_rank") <= n_train, "train")
        .when(F.col("_rank") <= F.col("_n") - n_test, "valid")
        .otherwise("test")
    )
    return df.join(ranked.select(pid, split.alias("split")), pid)


def split_from_columns(df: DataFrame, minute: bool = False, obs: str = "ObsDT") -> DataFrame:
    """Existing columns stay the split; optionally the minute of the hour."""
    return df.withColumn("ObsDT_Minute", F.minute(obs)) if minute else df


def select_splits(
    df: DataFrame, splits: dict[str, list[Rule]], op: str = "and", strict: bool = True
) -> DataFrame:
    """Rows once per named split they meet (``split_name``), in one pass; splits may overlap."""
    names = F.array(
        *[F.when(filter_test(df, rules, op, strict), name) for name, rules in splits.items()]
    )
    return df.withColumn("split_name", F.explode(F.filter(names, lambda x: x.isNotNull())))


def sample_n(df: DataFrame, n: int, seed: int, ids: list[str] = IDS) -> DataFrame:
    """n rows at random, exact, without gathering them in one task."""
    drawn = df.withColumn("_u", uniform(ids, seed))
    return first_rows(drawn, row_order(drawn, ["_u", *ids]), n).drop("_u")
