"""Anchor grouping: events close after an anchor take the anchor's time.

The first event of a patient is an anchor.  Every later event up to ``gap`` after
the anchor takes its time; the next one after that is a new anchor.  The rule
walks along the timeline, so a patient with very many events must not be one
unit of work.  The unit is a patient's day:

1.  distinct times of each patient-day are sorted (one shuffle, merged map-side);
2.  each day is reduced to a step function: for every time that an anchor carried
    in from the evening before may leave as the day's first anchor, the anchor carried
    out.  A walk through a day has at most one step per ``gap``, each a binary search;
3.  days whose first event may still be covered by the evening before form runs.
    Step functions compose: what two days make of a carried anchor is again a step
    function, with no more steps than the first day's.  So all prefixes of a run are
    composed by doubling, two, four, eight days at a time, each round over neighbours
    at that distance: a row never holds more than a day, and a run of 20 years takes
    13 rounds;
4.  with the carried anchor known, each day lists its anchors, and every event takes
    the latest anchor not after it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from caseflow.functions import timegrid as tg
from caseflow.plans.spread import stored

#: Steps of a binary search, halving: enough for 16 million times of a patient-day.
_HALVES = f"array({', '.join(str(1 << k) for k in range(23, -1, -1))})"


def _halves(array: str) -> str:
    """SQL: the steps of a binary search in an array."""
    return f"filter({_HALVES}, h -> h <= size({array}))"


def _upto(array: str, bound: str, field: str = "", halves: str = "") -> str:
    """SQL: how many entries of a sorted array are at most ``bound``."""
    found = f"(n, h) -> if(get({array}, n + h - 1){field} <= {bound}, n + h, n)"
    return f"aggregate({halves or _halves(array)}, 0, {found})"


def _next(anchor: str, gap: int) -> str:
    """SQL: the anchor after this one in the day's times ``_us``; null when there is none."""
    return f"get(_us, {_upto('_us', f'{anchor} + {gap}', halves='_halves')})"


def _jumps(gap: int) -> str:
    """SQL: a number for each anchor a day may have."""
    return f"sequence(1, least({tg.DAY // gap + 1}, size(_us)))"


def _day_steps(days: DataFrame, gap: int) -> DataFrame:
    """Adds _first, _last and the step function _step, an array of (s, e): a carried anchor that
    leaves s as the day's first anchor is followed by e as the day's last."""
    starts = f"slice(_us, 1, {_upto('_us', f'_day * {tg.DAY} + {gap - 1}', halves='_halves')} + 1)"
    walk = f"aggregate({_jumps(gap)}, s, (a, i) -> coalesce({_next('a', gap)}, a))"
    return days.withColumn("_halves", F.expr(_halves("_us"))).select(
        "*",
        F.get("_us", F.lit(0)).alias("_first"),
        F.element_at("_us", -1).alias("_last"),
        F.expr(f"transform({starts}, s -> struct(s, {walk} as e))").alias("_step"),
    )


def _applied(step: str, carried: str, gap: int) -> str:
    """SQL: the anchor carried out of a step function for one carried in."""
    return f"coalesce(get({step}, {_upto(step, f'{carried} + {gap}', '.s')}).e, {carried})"


def _carried(days: DataFrame, key: list[str], gap: int) -> DataFrame:
    """Adds _carry, the anchor carried into each day; null where none can matter.

    ``days`` is read twice and must be stored.
    """
    by_day = W.partitionBy(*key).orderBy("_day")
    before = F.lag("_last").over(by_day)
    d = days.select(*key, "_day", "_first", "_last", "_step")
    d = d.withColumn("_fresh", before.isNull() | (F.col("_first") > before + F.lit(gap)))
    # place in its run; the longest run says how often the reach must double
    place = F.row_number().over(by_day)
    d = d.withColumn("_n", place).withColumn("_n", F.col("_n") - F.max(F.when(F.col("_fresh"), F.col("_n"))).over(by_day))
    longest = d.agg(F.max("_n")).first()[0] or 0
    # _out is known once the composed days reach back to the run's beginning
    d = d.withColumn("_out", F.when(F.col("_fresh"), F.get("_step", F.lit(0))["e"]))
    reach = 1
    while reach <= longest:
        d = d.withColumn("_back", F.lag(F.struct("_out", "_step"), reach).over(by_day))
        composed = f"transform(_back._step, p -> struct(p.s, {_applied('_step', 'p.e', gap)} as e))"
        d = d.withColumns(
            {
                "_out": F.expr(f"coalesce(_out, if(_back._out is null, null, {_applied('_step', '_back._out', gap)}))"),
                "_step": F.expr(f"if(_out is null and _back._out is null, {composed}, _step)"),
            }
        )
        reach *= 2
    carry = F.when(~F.col("_fresh"), F.lag("_out").over(by_day))
    return d.select(*key, "_day", carry.alias("_carry"))


def _listed(gap: int) -> Column:
    """The day's anchors in order, the carried one first."""
    add = f"""(x, i) -> if(x.a is null, x, struct({_next('x.a', gap)} as a, concat(x.l, array(x.a)) as l))"""
    begin = "struct(coalesce(_carry, _first) as a, cast(array() as array<bigint>) as l)"
    more = f"concat(array(0), {_jumps(gap)})"
    return F.expr(f"aggregate({more}, {begin}, {add}, x -> x.l)")


def densify_anchor(
    df: DataFrame, key: list[str], time_us: str, gap_minutes: int = 31, out: str = "anchor_us"
) -> DataFrame:
    """Add the anchor time (microseconds) of every event."""
    gap = gap_minutes * tg.MINUTE
    d = df.withColumn("_day", tg.bucket(F.col(time_us)))
    days = d.groupBy(*key, "_day").agg(F.sort_array(F.collect_set(time_us)).alias("_us"))
    days = stored(_day_steps(days, gap), "anchor-days")
    carried = _carried(days, key, gap).where("_carry is not null")
    anchors = days.drop("_step").join(carried, [*key, "_day"], "left")
    anchors = anchors.select(*key, "_day", _listed(gap).alias("_anchors"))
    latest = F.expr(f"get(_anchors, {_upto('_anchors', f'`{time_us}`')} - 1)")
    return d.join(anchors, [*key, "_day"]).withColumn(out, latest).drop("_day", "_anchors")
