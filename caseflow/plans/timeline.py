"""From raw tables to cases: the operators chained, lazily, one plan per result."""

from __future__ import annotations

from typing import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F

from caseflow.config import Cohort, Rule, Stage
from caseflow.operators import cases as C, entities as H, features as X, records as R
from caseflow.operators import sequences as Q, tokens as T
from caseflow.plans.spread import row_order
from caseflow.sources import readers as RD

# Hooks a user may replace, by kind: source readers, record builders, tokenizers,
# triggers, case functions, and split / input / label / response steps.
REGISTRY: dict[str, dict[str, Callable]] = {
    "source": {"csv": RD.scan_csv, "parquet": RD.scan_parquet},
    "record": {
        "glucose": R.glucose_record,
        "diet": R.diet_record,
        "medication": R.medication_record,
        "exercise": R.exercise_record,
    },
    "tokenizer": {
        "category": T.tokenize_category,
        "bins": T.tokenize_numeric_bins,
        "numeric": T.tokenize_numeric,
    },
    "trigger": {"record": C.trigger_from_record, "table": C.trigger_from_table, "form": C.trigger_from_form},
    "feature": dict(X.FEATURES),
    "step": {
        "tag": C.tag_from_record,
        "filter": C.filter_cases,
        "features": X.attach_features,
        "causal": Q.causal_labels,
        "future": Q.future_labels,
        "mask": Q.mask_labels,
    },
}


def register(kind: str, name: str, fn) -> None:
    """Add or replace a hook: a function of DataFrames, or a Feature for ``feature``."""
    if kind not in REGISTRY:
        raise KeyError(f"unknown hook kind {kind!r}")
    REGISTRY[kind][name] = fn


def hook(kind: str, name: str):
    """A registered hook."""
    if name not in REGISTRY.get(kind, {}):
        raise KeyError(f"no {kind} hook named {name!r}")
    return REGISTRY[kind][name]


def per_patient_batch(
    df: DataFrame, key: str, fn: Callable, schema: str, time: str = "DT_s", days_before: int = 0
) -> DataFrame:
    """A user's pandas function of whole patient-days, with as many days before as it asks for.

    Without look-back ``fn`` gets many patient-days in one frame, each of them whole and its
    rows together, so that a call's own cost is shared; it groups by patient and day itself.
    With it ``fn`` gets one day and ``days_before`` days before it, and the column ``in_day``
    tells the day's own rows apart; days without rows of their own are not called for.  A
    frame holds an Arrow batch and a patient's few days at most.
    """
    day = F.to_date(time)
    if not days_before:
        dealt = df.withColumn("_day", day).repartition(F.col(key), F.col("_day")).sortWithinPartitions(key, "_day")
        return dealt.mapInPandas(lambda batches: _whole_days(batches, key, fn), schema)
    seen_by = F.transform(F.sequence(F.lit(0), F.lit(days_before)), lambda i: F.date_add(day, i.cast("int")))
    sent = df.withColumn("_day", F.explode(seen_by)).withColumn("in_day", F.col("_day") == day)
    own = df.select(F.col(key).alias("_own"), day.alias("_own_day")).distinct()
    sent = sent.join(own, F.col(key).eqNullSafe(F.col("_own")) & (F.col("_day") == F.col("_own_day")), "left_semi")
    return sent.groupBy(key, "_day").applyInPandas(lambda pdf: fn(pdf.drop(columns="_day")), schema)


def _whole_days(batches: Iterator[pd.DataFrame], key: str, fn: Callable) -> Iterator[pd.DataFrame]:
    """``fn`` of successive frames cut between patient-days; rows come sorted by key and _day."""
    rest = None
    for b in batches:
        rows = b if rest is None else pd.concat([rest, b], ignore_index=True)
        if not len(rows):
            continue
        last = pd.Series(True, index=rows.index)
        for c in (key, "_day"):
            end = rows[c].iloc[-1]
            last &= rows[c].isna() if pd.isna(end) else rows[c] == end
        own = rows[~last].drop(columns="_day").reset_index(drop=True)
        if len(own):
            yield fn(own)
        rest = rows[last]
    if rest is not None:
        yield fn(rest.drop(columns="_day").reset_index(drop=True))


def walk_patients(
    df: DataFrame,
    key: str,
    step: Callable,
    schema: str,
    order: list[str] | str = "DT_s",
    begin: Callable = lambda patient: None,
    end: Callable | None = None,
) -> DataFrame:
    """A user's pandas function over whole patients, in order, a stretch of rows at a time.

    Rows are dealt out by patient and sorted inside the tasks by Spark, which spills; equal
    keys of the order follow the other columns.  A patient is then read as a stream:
    ``state = begin(patient)``, for each stretch ``rows, state = step(rows, state)``, and
    ``rows = end(patient, state)``.  ``step`` and ``end`` may return None for no rows.  What
    is in memory is a stretch and the state, however long the patient's history; where stretches
    are cut is Spark's choice, so ``step`` must carry in its state all it needs of the rows
    before.  A null patient is a patient.
    """
    by = [order] if isinstance(order, str) else list(order)
    dealt = df.repartition(F.col(key)).sortWithinPartitions(key, *row_order(df, by))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        patient, state, walking = None, None, False

        def left():
            rows = end(patient, state) if walking and end else None
            return [] if rows is None else [rows]

        for b in batches:
            ids = b[key]
            missing = ids.isna()
            other = (ids != ids.shift()) & ~(missing & missing.shift(fill_value=False))
            cuts = [*other.to_numpy().nonzero()[0].tolist(), len(b)]
            for at, to in zip(sorted({0, *cuts[:-1]}), sorted({*cuts} - {0})):
                own = None if missing.iloc[at] else ids.iloc[at]
                if not walking or own != patient:
                    yield from left()
                    patient, state, walking = own, begin(own), True
                rows, state = step(b.iloc[at:to].reset_index(drop=True), state)
                if rows is not None and len(rows):
                    yield rows
        yield from left()

    return dealt.mapInPandas(run, schema)


def read_sources(spark: SparkSession, wanted: dict[str, tuple[str, dict]]) -> dict[str, DataFrame]:
    """Raw tables by name, each read by the source hook named for it with its arguments."""
    return {name: hook("source", kind)(spark, **args) for name, (kind, args) in wanted.items()}


def tokenize(df: DataFrame, kind: str, *args, **kwargs) -> DataFrame:
    """Tokens and weights by the tokenizer hook of that name."""
    return hook("tokenizer", kind)(df, *args, **kwargs)


def run_case_stages(cases: DataFrame, stages: list[Stage], folder: str | None = None) -> DataFrame:
    """Stages whose kinds are names of step hooks; stored and resumed below ``folder``."""
    return C.run_stages(cases, stages, {s.kind: hook("step", s.kind) for s in stages}, folder)


def build_directory(
    raw: dict[str, DataFrame], cohort: Cohort, key: str, excluded: list[str], patients: DataFrame, offset: str
) -> DataFrame:
    """Patient directory of a cohort: counts, selection, slice, ids, own time zone."""
    names = sorted(raw)
    counts = H.entity_counts(raw, key)
    seen = [n for n in names if key in raw[n].columns]
    human = H.entity_filter(H.entity_pivot(counts, key, names, seen), names, excluded)
    if cohort.slice:
        human = H.entity_slice(human, key, cohort.slice)
    human = H.assign_entity_id(human, key, cohort.label)
    return H.attach_user_tz(human, patients, key, offset).withColumn("CohortLabel", F.lit(cohort.label))


def build_record(rows: DataFrame, human: DataFrame, kind: str, name: str, key: str = "PatientID") -> DataFrame:
    """Raw rows through the record hook ``kind``, with the patient id chain and record ids."""
    d = R.attach_parent(hook("record", kind)(rows, human), human, key, ["PID"])
    return R.assign_record_id(d, f"{name}ID")


def build_cases(
    glucose: DataFrame,
    records: dict[str, DataFrame],
    patients: DataFrame | None,
    features: list[str],
    before: list[Rule] | None = None,
    after: list[Rule] | None = None,
    trigger: str = "record",
) -> DataFrame:
    """Cases of a trigger hook: sampling uniform, first filter, features, second filter.

    Features are resolved among the feature hooks.
    """
    cases = C.keep_ratio(hook("trigger", trigger)(glucose.select("PID", "DT_s")))
    if before:
        cases = C.filter_cases(cases, before)
    extra = {n: hook("feature", n) for n in features if n in REGISTRY["feature"]}
    cases = X.attach_features(cases, {**records, X.CGM: glucose}, features, patients, extra=extra)
    return C.filter_cases(cases, after) if after else cases


def answer_forms(
    forms: DataFrame,
    table: Callable[[DataFrame], dict[str, DataFrame]],
    features: list[str],
    respond: Callable[[DataFrame], DataFrame],
) -> DataFrame:
    """Online path for a batch of forms: raw rows, records, cases with before-windows only,
    inputs, and the response of a user function.

    ``table`` maps forms to ``glucose``, the other records and ``triggers``.
    """
    parts = table(forms)
    names = Q.choose_inputs(features, inference=True, before=["Bf24h", X.DEMOGRAPHICS])
    records = {k: v for k, v in parts.items() if k != "triggers"}
    cases = X.attach_features(parts["triggers"], records, names, parts.get("patients"))
    return respond(cases)
