"""Records seen from cases through time windows.

The question is always: for a case ``(patient, t)``, which records of that
patient lie in ``[t + a, t + b)``.  Two plans answer it.

*Frame* (the default).  Records of all kinds go through one shuffle by (patient,
day): a record is sent to each day whose cases can see it, the two or three days
its windows reach, and the day's records of a kind are packed into one sorted
array.  Cases are shuffled by the same keys and take their day's packs in a merge
join.  Every aggregate is then little work per case:

- the ends of a window are found by binary search in the sorted times, so a count
  is a difference of two places; a count of values that meet a test searches the
  times of those values, which are sifted once per day;
- where values are needed, the two ends cut them out of the pack; on the 5-minute
  grid the ends follow from the clock.

The unit of work is a patient's day, not a patient, so a patient with a third of
all rows is spread over that patient's days; and a patient-day is bounded, as
records lie on a 5-minute grid (288 a day).

The patient id stays a plain column from the cases' scan to the result, and the
records' scans join on it: a later filter on it reaches every scan.  Columns that nobody
selects are not computed.

*Join*: cases and records meet on (patient, bucket) with the range test on top.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from typing import Callable

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from caseflow.config import Observation, Window
from caseflow.functions import timegrid as tg

_PID, _CHUNK, _US, _KIND, _VAL = "_pid", "_chunk", "_us", "_kind", "_val"
#: Steps of a binary search, halving: enough for 16 million records of a patient-day.
_HALVES = [1 << k for k in range(23, -1, -1)]


@dataclass(frozen=True)
class Feature:
    """A case function: output columns from record kinds seen through one window.

    ``columns(read)`` asks the reader for window aggregates and returns the
    output columns by key.
    """

    name: str
    window: Window
    records: tuple[str, ...]
    columns: Callable[["FrameReader"], dict[str, Column]]


class FrameReader:
    """Window aggregates over the records of a case.

    Each aggregate is a column made once; two features that ask for the same one
    share it.  ``stage`` names a value built from them, so that it is computed
    once however often it is used.
    """

    def __init__(self, reach: dict[str, tuple[int, int]]):
        self.reach = reach
        self.bounds: dict[str, Column] = {}
        self.frame: dict[str, Column] = {}
        self.values: list[str] = []
        self.times: dict[str, tuple[str, Callable[[Column], Column] | None]] = {}
        self.grids: list[tuple[str, bool]] = []
        self.stages: list[dict[str, Column]] = []
        self.window: Window | None = None

    @property
    def time(self) -> Column:
        """Case time in microseconds."""
        return F.col(_US)

    def _before(self, kind: str, label: str, test, bound: int) -> Column:
        """Records of a kind, whose value meets a test, that lie before the case time plus ``bound``."""
        what = f"{kind}_{label}"
        self.times.setdefault(what, (kind, test))
        name = f"_w_{what}_to_{bound}"
        if name not in self.frame:
            # the last place known to lie before the bound, from none on
            self.bounds[f"_at_{bound}"] = F.col(_US) + F.lit(bound)
            step = f"if(get(`_t_{what}`, n + half) < `_at_{bound}`, n + half, n)"
            self.frame[name] = F.expr(f"aggregate(`_h_{what}`, -1, (n, half) -> {step}) + 1")
        return F.coalesce(F.col(name), F.lit(0))

    def _ends(self, kind: str, label: str = "all", test=None) -> tuple[Column, Column]:
        """Records of the kind before the window, and up to its end."""
        ends = (self._before(kind, label, test, bound) for bound in (self.window.lo, self.window.hi))
        return tuple(ends)

    def count(self, kind: str, label: str = "all", test: Callable[[Column], Column] | None = None):
        """Records of a kind in the window whose value meets a test."""
        if test is not None:
            self._pack(kind)
        before, upto = self._ends(kind, label, test)
        return (upto - before).cast("bigint")

    def _pack(self, kind: str) -> Column:
        if kind not in self.values:
            self.values.append(kind)
        return F.col(f"_p_{kind}")

    def first(self, kind: str) -> Column:
        """Time of the first record in the window; null when none."""
        before, upto = self._ends(kind)
        return F.when(upto > before, F.get(_times(f"{kind}_all"), before))

    def last(self, kind: str) -> Column:
        """Time of the last record in the window; null when none."""
        before, upto = self._ends(kind)
        return F.when(upto > before, F.get(_times(f"{kind}_all"), upto - 1))

    def collect(self, kind: str) -> Column:
        """Records in the window as an array of (u, v) by time."""
        before, upto = self._ends(kind)
        whole = F.slice(self._pack(kind), before + 1, upto - before)
        return F.coalesce(whole, F.array().cast("array<struct<u:bigint,v:double>>"))

    def off_grid(self) -> Column:
        """Microseconds of the case time past its 5-minute step."""
        return F.pmod(self.time, F.lit(tg.STEP))

    def on_grid(self, kind: str, first: Column, n: Column, whole: bool = False) -> Column:
        """Values of n successive 5-minute steps from step ``first`` relative to the case's own
        step, of records on the grid: NaN where there is none, or whole numbers with 0."""
        if (kind, whole) not in self.grids:
            self.grids.append((kind, whole))
            self._pack(kind)
        start = F.col(_CHUNK) * F.lit(tg.DAY) + F.lit(grid_base(self.reach[kind]))
        own = ((self.time - self.off_grid() - start) / F.lit(tg.STEP)).cast("int")
        missing = F.lit(0).cast("int") if whole else F.lit(float("nan"))
        part = F.slice(F.col(_grid_name(kind, whole)), own + first + 1, n)
        return F.coalesce(part, F.array_repeat(missing, n))

    def stage(self, level: int, name: str, col: Column) -> Column:
        """Name a value; a stage may use aggregates and stages of lower level."""
        while len(self.stages) <= level:
            self.stages.append({})
        full = f"_s{level}_{name}_{self.window.name}"
        self.stages[level].setdefault(full, col)
        return F.col(full)


def _times(what: str) -> Column:
    return F.col(f"_t_{what}")


def grid_base(reach: tuple[int, int]) -> int:
    """Offset from the start of a day to the first slot its cases can see."""
    return reach[0] // tg.STEP * tg.STEP


def _grid_name(kind: str, whole: bool) -> str:
    return f"_{'whole' if whole else 'value'}_{kind}"


def _with_grid(packs: DataFrame, kind: str, whole: bool, reach: tuple[int, int]) -> DataFrame:
    """Lay a day's packed records on 5-minute slots, as values or as whole numbers.

    One walk: each record adds the empty slots since the record before it and
    then itself, so the work goes with the records and not with the slots.  Of several
    records in a slot the first counts, so no later slot moves.
    """
    base = grid_base(reach)
    slots = (tg.DAY + reach[1] - base) // tg.STEP + 1
    start = F.col(_CHUNK) * F.lit(tg.DAY) + F.lit(base)
    nan = F.lit(float("nan"))
    missing = F.lit(0).cast("int") if whole else nan
    at = F.transform(f"_p_{kind}", lambda x: ((x["u"] - start) / F.lit(tg.STEP)).cast("int"))
    packs = packs.withColumn("_at", at)
    walk = F.arrays_zip(
        F.col("_at").alias("here"),
        F.concat(F.array(F.lit(-1)), "_at").alias("before"),
        F.transform(f"_p_{kind}", lambda x: x["v"]).alias("v"),
    )

    def own(v):
        if not whole:
            return F.coalesce(v, nan)
        return F.when(v.isNull() | F.isnan(v), 0).otherwise(v.cast("int"))

    def lay(x):
        gap = F.coalesce(x["here"], F.lit(slots)) - x["before"] - 1
        taken = x["here"].isNull() | (x["here"] == x["before"])
        here = F.slice(F.array(own(x["v"])), F.lit(1), F.when(taken, 0).otherwise(1))
        return F.concat(F.array_repeat(missing, F.greatest(gap, F.lit(0))), here)

    laid = F.flatten(F.transform(walk, lay))
    return packs.withColumn(_grid_name(kind, whole), laid).drop("_at")


def window_bounds(cases: DataFrame, window: Window, time: str = "ObsDT") -> DataFrame:
    """First instant inside and first instant past the window of each case."""
    at = tg.micros(time)
    return cases.withColumns(
        {
            f"{window.name}_start": tg.from_micros(at + F.lit(window.lo)),
            f"{window.name}_end": tg.from_micros(at + F.lit(window.hi)),
        }
    )


def parse_observation_name(name: str) -> Observation:
    """Parts of a dotted observation name."""
    return Observation.parse(name)


def observation_parts(name: Column) -> Column:
    """The same for a column of names, as a struct; a part that is absent is null."""
    part = lambda letter: F.nullif(F.regexp_extract(name, rf"(?:^|\.){letter}([^.]*)", 1), F.lit(""))
    return F.struct(
        part("h").alias("human"),
        part("r").alias("record"),
        part("f").alias("recfeat"),
        part("c").alias("window"),
    )


def combine_requirements(features: list[Feature]) -> dict[str, list[Window]]:
    """Windows needed per record kind; one window name must not have two definitions."""
    named: dict[str, Window] = {}
    needed: dict[str, list[Window]] = {}
    for f in features:
        w = f.window
        if named.setdefault(w.name, w) != w:
            raise ValueError(f"window {w.name} is defined twice: {named[w.name]} and {w}")
        for kind in f.records:
            if w not in needed.setdefault(kind, []):
                needed[kind].append(w)
    return needed


def observe_frame(
    cases: DataFrame,
    records: dict[str, DataFrame],
    features: list[Feature],
    ids: tuple[str, str] = ("PID", "ObsDT"),
    time: str = "DT_s",
    value: dict[str, str] | None = None,
) -> DataFrame:
    """Cases with the columns of every feature.

    ``records`` maps kind to table with the patient id and ``time``; ``value``
    names the numeric column a kind's features read.
    """
    pid, obs = ids
    value = value or {}
    needed = combine_requirements(features)
    reach = {k: (min(w.lo for w in ws), max(w.hi for w in ws)) for k, ws in needed.items()}
    reader = FrameReader(reach)
    out = {}
    for f in features:
        reader.window = f.window
        out |= {f"{f.name}-{k}": c for k, c in f.columns(reader).items()}

    lost = F.raise_error(F.lit(f"a case without {pid} or {obs}")).cast("bigint")
    at = F.coalesce(F.when(F.col(pid).isNotNull(), tg.micros(obs)), lost)
    rows = cases.withColumn(_US, at).withColumn(_CHUNK, tg.bucket(_US))
    kinds = list(dict.fromkeys([*reader.values, *[kind for kind, _ in reader.times.values()]]))
    if kinds:
        packs = _packs({k: records[k] for k in kinds}, reader, pid, time, value)
        packs = packs.withColumnsRenamed({_PID: "_of", _CHUNK: "_seen"})
        met = (F.col(pid) == F.col("_of")) & (F.col(_CHUNK) == F.col("_seen"))
        # Both sides are partitioned by (patient, day), so a merge join moves nothing; a
        # broadcast would be chosen on the size of the files, and arrays outgrow that.
        rows = rows.join(packs.hint("merge"), met, "left")
    for level in [reader.bounds, reader.frame, *reader.stages]:
        rows = rows.withColumns(level)
    # A frame of one row, over the partitioning at hand: a later filter on a feature stays
    # above it, where its computation is not unfolded again, one on the patient passes,
    # and a column that is not selected goes with all that is computed for it alone.
    own = W.partitionBy(pid, _CHUNK).rowsBetween(0, 0)
    made = [F.first(c).over(own).alias(n) for n, c in out.items()]
    return rows.select(*[F.col(c) for c in cases.columns], *made)


def _packs(
    records: dict[str, DataFrame], reader: FrameReader, pid: str, time: str, value: dict[str, str]
) -> DataFrame:
    """One row per patient and day with the records its cases can see: for each kind whose
    values are read a sorted array of (u, v), sorted times for each search, grids."""

    def sent(kind: str) -> DataFrame:
        """A kind's records, once for each day whose cases can see them."""
        lo, hi = reader.reach[kind]
        us = tg.micros(time)
        val = F.col(value[kind]) if kind in value else F.lit(None)
        seen_by = F.sequence(tg.bucket(us - F.lit(hi - 1)), tg.bucket(us - F.lit(lo)))
        known = records[kind].where(F.col(time).isNotNull() & F.col(pid).isNotNull())
        return known.select(
            F.col(pid).alias(_PID),
            F.explode(seen_by).alias(_CHUNK),
            us.alias(_US),
            F.lit(kind).alias(_KIND),
            val.cast("double").alias(_VAL),
        )

    def sorted_list(kind: str, item: Column) -> Column:
        return F.sort_array(F.collect_list(F.when(F.col(_KIND) == kind, item)))

    pair = F.struct(F.col(_US).alias("u"), F.col(_VAL).alias("v"))
    lists = [sorted_list(k, pair).alias(f"_p_{k}") for k in reader.values]
    for what, (kind, _) in reader.times.items():
        if kind not in reader.values:
            lists.append(sorted_list(kind, F.col(_US)).alias(f"_t_{what}"))
    packs = reduce(DataFrame.unionByName, [sent(k) for k in records]).groupBy(_PID, _CHUNK).agg(*lists)
    # A frame of one row sorts the days here, by the keys of the merge join and while their rows
    # are short: what is laid out below is many times longer and would be sorted in its place.
    if reader.values:
        own = W.partitionBy(_PID, _CHUNK).rowsBetween(0, 0)
        held = [c for c in packs.columns if c not in (_PID, _CHUNK)]
        packs = packs.select(_PID, _CHUNK, *[F.first(c).over(own).alias(c) for c in held])
    sifted = {}
    for what, (kind, test) in reader.times.items():
        if kind in reader.values:
            hits = F.col(f"_p_{kind}")
            if test is not None:
                hits = F.filter(hits, lambda x: test(x["v"]))
            sifted[f"_t_{what}"] = F.transform(hits, lambda x: x["u"])
    halves = f"array({', '.join(map(str, _HALVES))})"
    steps = {f"_h_{w}": F.expr(f"filter({halves}, half -> half <= size(`_t_{w}`))") for w in reader.times}
    packs = packs.withColumns(sifted).withColumns(steps)
    for kind, whole in reader.grids:
        packs = _with_grid(packs, kind, whole, reader.reach[kind])
    return packs


def observe_join(
    cases: DataFrame,
    records: DataFrame,
    window: Window,
    ids: tuple[str, str] = ("PID", "ObsDT"),
    time: str = "DT_s",
    payload: list[str] | None = None,
) -> DataFrame:
    """One row per case and record in its window; a case without records has nulls.

    A case lies in one bucket, as wide as the window (at least an hour); a record goes to
    the two or three buckets whose cases can see it.  So one outer join tells both what a
    case sees and that it sees nothing.
    """
    pid, obs = ids
    payload = payload or []
    width = max(tg.HOUR, window.hi - window.lo)
    c = cases.select(pid, obs, tg.micros(obs).alias("_t"), tg.bucket(tg.micros(obs), width).alias("_bucket"))
    us = tg.micros(time)
    reach = F.sequence(tg.bucket(us - F.lit(window.hi - 1), width), tg.bucket(us - F.lit(window.lo), width))
    r = records.where(F.col(time).isNotNull()).select(
        F.col(pid).alias("_pid"), us.alias("_u"), F.col(time), *payload, F.explode(reach).alias("_at")
    )
    inside = (F.col("_u") >= F.col("_t") + F.lit(window.lo)) & (F.col("_u") < F.col("_t") + F.lit(window.hi))
    met = (F.col(pid) == F.col("_pid")) & (F.col("_bucket") == F.col("_at")) & inside
    return c.join(r, met, "left").select(pid, obs, time, *payload)


def observe_static(cases: DataFrame, records: DataFrame, pid: str = "PID") -> DataFrame:
    """Cases with the patient's own record, without a window."""
    return cases.join(records, pid, "left")


def asof_first_last(
    cases: DataFrame,
    records: DataFrame,
    window: Window,
    ids: tuple[str, str] = ("PID", "ObsDT"),
    time: str = "DT_s",
) -> DataFrame:
    """Time of the first and the last record in each case's window."""
    feature = Feature(
        "w",
        window,
        ("rec",),
        lambda r: {
            "first": tg.from_micros(r.first("rec")),
            "last": tg.from_micros(r.last("rec")),
        },
    )
    out = observe_frame(cases, {"rec": records}, [feature], ids, time)
    return out.withColumnsRenamed({"w-first": "first_time", "w-last": "last_time"})
