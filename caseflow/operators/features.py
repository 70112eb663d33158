"""Case functions: what a case looks like through a window."""

from __future__ import annotations

from typing import Callable

from pyspark.sql import Column, DataFrame, functions as F

from caseflow.config import AF2H, AF2TO8H, BF24H, Window
from caseflow.functions import timegrid as tg
from caseflow.operators.observe import Feature, observe_frame

CGM, MED, EXERCISE, DIET = "CGM5Min", "Med5Min", "Exercise5Min", "Diet5Min"

# The least share and mode reported, and the glucose readings
# treated as saturated high and low.
TINY = 1e-06
HIGH, LOW = 400, 20


def _decimals(x: Column, n: int) -> Column:
    """Rounded to n decimals, halves to even."""
    return F.rint(x * 10**n) / 10**n


def _longest_run(r, values: Column) -> tuple[Column, Column]:
    """Smallest most frequent value of an array without null (NaN is missing), and its count.

    In the sorted array a value is a run; only the places where runs start are
    looked at one by one.
    """
    s = r.stage(1, "sorted", F.sort_array(values))
    gap = r.stage(2, "gap", F.array_position(s, F.lit(float("nan"))).cast("int"))
    n = r.stage(3, "known", F.when(gap == 0, F.size(s)).otherwise(gap - 1))
    place = F.when(n > 0, F.sequence(F.lit(1), n))
    starts = r.stage(
        4, "starts", F.filter(place, lambda i: ~F.get(s, i - 1).eqNullSafe(F.get(s, i - 2)))
    )
    ends = F.concat(F.slice(starts, F.lit(2), F.size(starts)), F.array(n + 1))
    lengths = r.stage(5, "lengths", F.zip_with(starts, ends, lambda a, b: b - a))
    top = r.stage(6, "top", F.array_max(lengths))
    first = F.get(starts, (F.array_position(lengths, top) - 1).cast("int"))
    return r.stage(7, "mode", F.get(s, first - 1)), top


def cgm_info(name: str, window: Window) -> Feature:
    """Share of the most frequent reading, of zeros, of high and low readings; record count.

    A mode below the least reported value is replaced by it before counting.
    """

    def columns(r):
        n = r.stage(0, "n", r.count(CGM))
        share = lambda x: F.when(n > 0, _decimals(x / n, 6)).otherwise(F.lit(0.0))
        ceil_div = lambda x: -F.floor(-x / F.lit(tg.STEP)).cast("int")
        low = ceil_div(F.lit(window.lo) + r.off_grid())
        high = F.floor((F.lit(window.hi - 1) + r.off_grid()) / F.lit(tg.STEP)).cast("int")
        vals = r.stage(0, "vals", r.on_grid(CGM, low, high - low + 1))
        mode, top = _longest_run(r, vals)
        tiny = r.count(CGM, "tiny", lambda v: v == TINY)
        at_mode = F.when(mode >= TINY, top).otherwise(tiny)
        return {
            "ModePercent": F.when(
                n > 0, _decimals(F.greatest(at_mode / n, F.lit(TINY)), 6)
            ).otherwise(F.lit(0.0)),
            "ZeroPercent": share(r.count(CGM, "zero", lambda v: v == 0)),
            "Geq400Percent": share(r.count(CGM, "high", lambda v: v >= HIGH)),
            "Leq20Percent": share(r.count(CGM, "low", lambda v: v <= LOW)),
            "RecNum": n,
        }

    return Feature(name, window, (CGM,), columns)


def cgm_values(name: str, window: Window) -> Feature:
    """Readings on the window's 5-minute steps as whole numbers, 0 where there is none.

    Records lie on the grid, as the record layer makes them.  A step is the time
    from the case in whole steps, cut toward zero: a case off the grid sees the
    record k steps after its own step at step k - 1, and loses the record at an
    end of the window that the shift moves out.
    """
    first, last = window.first_step, window.last_step
    if first <= 0 < last:
        raise ValueError(f"window {window.name} has steps on both sides of the case")
    after = first > 0
    size = last - first + 1

    def columns(r):
        off = r.off_grid()
        shifted = off > 0
        start = F.lit(first) + (shifted.cast("int") if after else F.lit(0))
        seq = r.stage(0, "steps", r.on_grid(CGM, start, F.lit(size), whole=True))
        seen = lambda k: ((k * F.lit(tg.STEP) - off) >= window.lo) & ((k * F.lit(tg.STEP) - off) < window.hi)
        end = lambda k, x: F.when(seen(k), x).otherwise(F.lit(0))
        edged = F.concat(
            F.array(end(start.cast("bigint"), F.get(seq, F.lit(0)))),
            F.slice(seq, 2, size - 2),
            F.array(end(start.cast("bigint") + size - 1, F.get(seq, F.lit(size - 1)))),
        )
        return {"-tid": F.when(shifted, edged).otherwise(seq)}

    return Feature(name, window, (CGM,), columns)


def dme_info(name: str, window: Window) -> Feature:
    """For medication, exercise and diet: record count, minutes from first and last record to
    the case (negative after it), 0 when there is none."""
    kinds = {"Med": MED, "Exercise": EXERCISE, "Diet": DIET}

    def columns(r):
        out = {}
        for short, kind in kinds.items():
            gap = lambda t: F.coalesce(
                _decimals((r.time - t) / F.lit(float(tg.MINUTE)), 2), F.lit(0.0)
            )
            out[f"{short}RecNum"] = r.count(kind)
            out[f"{short}LastToNow"] = gap(r.last(kind))
            out[f"{short}FirstToNow"] = gap(r.first(kind))
        return out

    return Feature(name, window, (MED, EXERCISE, DIET), columns)


FEATURES = {
    f.name: f
    for f in (
        cgm_info("CGMInfoBf24h", BF24H),
        cgm_info("CGMInfoAf2h", AF2H),
        cgm_info("CGMInfoAf2to8h", AF2TO8H),
        cgm_values("CGMValueBf24h", BF24H),
        cgm_values("CGMValueAf2h", AF2H),
        cgm_values("CGMValueAf2to8h", AF2TO8H),
        dme_info("DMEInfoBf24h", BF24H),
        dme_info("DMEInfoAf2h", AF2H),
    )
}
DEMOGRAPHICS = "PDemoBase"


def age_group(age: Column) -> Column:
    """Age in four groups."""
    return (
        F.when(age < 18, "0-17").when(age < 40, "18-39").when(age < 65, "40-64").otherwise("65+")
    )


def demographics(
    cases: DataFrame, patients: DataFrame, pid: str = "PID", obs: str = "ObsDT"
) -> DataFrame:
    """Gender, age at the case, age group, disease type and regimen of each case's patient."""
    p = patients.select(pid, "Gender", "YearOfBirth", "DiseaseType", "MRSegmentID")
    age = F.year(obs) - F.col("YearOfBirth")
    sex = F.col("Gender")
    kind = F.col("DiseaseType")
    named = {
        "Tag-Gender": F.when(sex == 2, "Male").when(sex == 1, "Female").otherwise(sex.cast("string")),
        "Num-Age": age,
        "Tag-AgeGroup": age_group(age),
        "Tag-DiseaseType": F.when(kind == "1.0", "T1D").when(kind == "2.0", "T2D").otherwise(kind),
        "Tag-Regimen": F.col("MRSegmentID"),
    }
    return cases.join(p, pid, "left").select(
        *cases.columns, *[c.alias(f"{DEMOGRAPHICS}-{k}") for k, c in named.items()]
    )


def attach_features(
    cases: DataFrame,
    records: dict[str, DataFrame],
    names: list[str],
    patients: DataFrame | None = None,
    value: dict[str, str] | None = None,
    extra: dict[str, Feature | Callable[[DataFrame], DataFrame]] | None = None,
) -> DataFrame:
    """Cases with the columns of all named features, ``<feature>-<key>``.

    All windowed features share one frame.  ``extra`` adds a user's own:
    a :class:`Feature`, or a function of the cases.
    """
    known = {**FEATURES, **(extra or {})}
    framed = [known[n] for n in names if isinstance(known.get(n), Feature)]
    out = cases
    if framed:
        out = observe_frame(out, records, framed, value={CGM: "BGValue"} if value is None else value)
    for n in names:
        if n == DEMOGRAPHICS:
            out = demographics(out, patients)
        elif n not in known:
            raise KeyError(f"unknown feature {n}")
        elif not isinstance(known[n], Feature):
            out = known[n](out)
    return out
