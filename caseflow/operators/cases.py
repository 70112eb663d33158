"""Triggers and case sets: one row per (patient, observation time)."""

from __future__ import annotations

from functools import reduce
from typing import Callable

from pyspark.sql import Column, DataFrame, functions as F

from caseflow.config import Rule, Stage
from caseflow.functions.rng import uniform
from caseflow.plans.selection import first_rows
from caseflow.plans.spread import row_order, stored
from caseflow.sources.fingerprint import fingerprint, seal, sealed

IDS = ["PID", "ObsDT"]
KEEP_SEED = 42


def trigger_from_record(records: DataFrame, pid: str = "PID", time: str = "DT_s") -> DataFrame:
    """Every record is a case at its own time."""
    return records.withColumnRenamed(time, "ObsDT").select(
        pid, "ObsDT", *[c for c in records.columns if c not in (pid, time)]
    )


def dedupe_cases(cases: DataFrame, order: list[str], ids: list[str] = IDS) -> DataFrame:
    """One case per id: the last non-null value of each column in ``order``."""
    at = F.struct(*order)
    cols = [c for c in cases.columns if c not in ids]
    if not cols:
        return cases.distinct()
    return cases.groupBy(*ids).agg(
        *[F.max_by(c, F.when(F.col(c).isNotNull(), at)).alias(c) for c in cols]
    )


def keep_ratio(cases: DataFrame, ids: list[str] = IDS, seed: int = KEEP_SEED) -> DataFrame:
    """Uniform ``_keep_ratio`` per case, for sampling by a filter."""
    return cases.withColumn("_keep_ratio", uniform(ids, seed))


def trigger_from_table(
    triggers: DataFrame, human: DataFrame, key: str, pid: str = "PID", check: bool = True
) -> DataFrame:
    """Outside triggers with the patient id; every trigger must have exactly one patient.

    The test looks at the patients that triggers name, not at the joined rows: once before
    the join for repeated patients, and row by row for a missing one.
    """
    mine = human.select(key, pid)
    if not check:
        return triggers.join(mine, key)
    twice = mine.groupBy(key).count().where("count > 1").join(triggers.select(key), key, "left_semi")
    if not twice.isEmpty():
        raise ValueError(f"patients named by triggers occur more than once in the directory, by {key}")
    name = F.coalesce(F.col(key).cast("string"), F.lit("null"))
    lost = F.raise_error(F.concat(F.lit("no patient for the trigger of "), name)).cast(mine.schema[pid].dataType)
    return triggers.join(mine, key, "left").withColumn(pid, F.coalesce(F.col(pid), lost))


def trigger_from_form(forms: DataFrame, drugs: dict[str, list[str]] | None = None) -> DataFrame:
    """Cases of invitation forms.

    With ``drugs``: one per prescription of a drug watched by the form's first
    model.  Without: the invitation itself.
    """
    ids = [
        F.col("invitation.patientId").alias("patient_id_encoded"),
        F.col("invitation.invitationId").alias("invitation_id_encoded"),
    ]
    at = F.col("invitation.createdDate").alias("DT")
    if drugs is None:
        return forms.select(*ids, at)
    watched = F.create_map(
        *[x for k, v in drugs.items() for x in (F.lit(k), F.array(*[F.lit(d) for d in v]))]
    )[F.get("models", F.lit(0))]
    rows = forms.withColumn("_drugs", watched).select(
        *ids, at, "_drugs", F.explode_outer("prescriptions").alias("r")
    )
    # Coalesced, so that no null test on the parsed form is pushed below the parsing.
    hit = F.coalesce(F.array_contains("_drugs", F.col("r.medication.drugName")), F.lit(False))
    return rows.where(hit).select(
        "patient_id_encoded",
        "invitation_id_encoded",
        F.col("r.prescriptionId").alias("prescription_id_encoded"),
        "DT",
    )


def restrict_cases(cases: DataFrame, given: DataFrame, ids: list[str] = IDS) -> DataFrame:
    """Cases named in a given id set; none at all is an error.

    The result is written once, so the test does not run what is upstream a second time.
    """
    out = stored(cases.join(given.select(*ids), ids, "left_semi"), "cases-restricted")
    if out.isEmpty():
        raise ValueError("no case is in the given id set")
    return out


def limit_cases(cases: DataFrame, n: int, ids: list[str] = IDS) -> DataFrame:
    """First n cases in id order; nothing is ranked or written for the others."""
    return first_rows(cases, row_order(cases, ids), n)


def record_summary(
    records: DataFrame, group: list[str], cols: list[str], op: str | None, label: str = "P-P"
) -> DataFrame:
    """Record columns per group: as they are, ``max``, ``count`` or ``unique-str-join``.

    Distinct texts are found before they are joined, so a group's repeated rows
    never meet in one value.
    """
    if op is None:
        return records.select(*group, *cols)
    if op == "max":
        return records.groupBy(*group).agg(*[F.max(c).alias(c) for c in cols])
    if op == "count":
        return records.groupBy(*group).agg(F.count(F.lit(1)).alias(f"{label}:count"))
    if op != "unique-str-join":
        raise ValueError(f"unknown summary {op!r}")
    parts = []
    for c in cols:
        text = F.coalesce(F.col(c).cast("string"), F.lit("")).alias("_v")
        one = records.select(*group, text).distinct()
        parts.append(
            one.groupBy(*group).agg(
                F.array_join(F.sort_array(F.collect_list("_v")), "|").alias(f"{c}:unique_join")
            )
        )
    return reduce(lambda a, b: a.join(b, group), parts)


def tag_from_record(
    cases: DataFrame,
    records: DataFrame,
    group: list[str],
    cols: list[str],
    op: str | None = None,
    label: str = "P-P",
) -> DataFrame:
    """Cases with a record summary, joined on all columns both have.

    A tag table with several rows per case is an error.  Summaries grouped by the shared
    columns have one; others are tested, by keys of the tag table alone.
    """
    tags = record_summary(records, group, cols, op, label)
    shared = [c for c in cases.columns if c in tags.columns]
    if op is None or not set(group) <= set(shared):
        twice = tags.groupBy(*shared).count().where("count > 1").join(cases.select(*shared), shared, "left_semi")
        if not twice.isEmpty():
            raise ValueError("the tag table has several rows per case")
    return cases.join(tags, shared, "left")


def _test(df: DataFrame, rule: Rule, strict: bool) -> Column:
    column, op, value = rule
    if column not in df.columns:
        if strict:
            raise KeyError(f"filter column {column!r} is not in the table")
        return F.lit(True)
    if callable(value):
        value = value(df)
    c = F.col(f"`{column}`")
    if op == "contains":
        return F.coalesce(c.cast("string").rlike(value), F.lit(False))
    if op == "in":
        return F.coalesce(c.isin(list(value)), F.lit(False))
    v = value if isinstance(value, Column) else F.lit(value)
    if op == "!=":
        return ~c.eqNullSafe(v)
    compare = {
        ">": lambda: c > v,
        "<": lambda: c < v,
        "==": lambda: c == v,
        ">=": lambda: c >= v,
        "<=": lambda: c <= v,
    }
    if op not in compare:
        raise ValueError(f"unknown operator {op!r}")
    return F.coalesce(compare[op](), F.lit(False))


def filter_test(df: DataFrame, rules: list[Rule], op: str = "and", strict: bool = True) -> Column:
    """One test column for a list of (column, operator, value) rules."""
    if not rules:
        raise ValueError("no rules given")
    if op not in ("and", "or"):
        raise ValueError(f"unknown logical operator {op!r}")
    join = Column.__and__ if op == "and" else Column.__or__
    return reduce(join, [_test(df, r, strict) for r in rules])


def filter_cases(df: DataFrame, rules: list[Rule], op: str = "and", strict: bool = True) -> DataFrame:
    """Cases that meet the rules; a value may be a function of the frame.

    A missing column is an error; with ``strict=False`` it passes.
    """
    return df.where(filter_test(df, rules, op, strict))


def named_filter(df: DataFrame, name: str, filters: dict[str, list[Rule]], strict: bool = True) -> DataFrame:
    """A filter by name; names that hold ``-OR`` need one rule met, others all."""
    return filter_cases(df, filters[name], "or" if "-OR" in name else "and", strict)


def run_stages(
    cases: DataFrame,
    stages: list[Stage],
    steps: dict[str, Callable[..., DataFrame]],
    folder: str | None = None,
) -> DataFrame:
    """Cases through tag, filter and feature stages in order.

    Filters stay before the features they spare: Catalyst does not move a filter
    through a window.  With ``folder`` every stage is stored with a fingerprint of all it was
    made of: the cases, and arguments, frames and code of this stage and those before.  A run
    begins after the last stage that holds what it should; a changed rule, input or
    function, or a write that was cut off, is computed again from there on.
    """
    if folder is None:
        for s in stages:
            cases = steps[s.kind](cases, **s.args)
        return cases
    spark = cases.sparkSession
    paths = [f"{folder.rstrip('/')}/stage-{i:03d}-{s.kind}" for i, s in enumerate(stages)]
    marks = [fingerprint(cases)]
    for s in stages:
        marks.append(fingerprint(marks[-1], s.kind, s.args, steps[s.kind]))
    done = max((i + 1 for i, path in enumerate(paths) if sealed(spark, path) == marks[i + 1]), default=0)
    if done:
        cases = spark.read.parquet(paths[done - 1])
    for s, path, mark in list(zip(stages, paths, marks[1:]))[done:]:
        steps[s.kind](cases, **s.args).write.mode("overwrite").parquet(path)
        seal(spark, path, mark)
        cases = spark.read.parquet(path)
    return cases


def union_cohort_cases(parts: list[tuple[DataFrame, DataFrame]], ids: list[str] = IDS) -> DataFrame:
    """(tags, features) of several cohorts as one set; columns in both are kept once."""
    joined = []
    for tags, feats in parts:
        extra = [c for c in feats.columns if c not in tags.columns]
        joined.append(tags.join(feats.select(*ids, *[f"`{c}`" for c in extra]), ids))
    shared = [c for c in joined[0].columns if all(c in j.columns for j in joined)]
    return reduce(DataFrame.unionByName, [j.select(*[f"`{c}`" for c in shared]) for j in joined])
