"""Model inputs and labels as array columns."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from caseflow.functions import timegrid as tg
from caseflow.functions.rng import uniform

# The label of positions that do not count, the id of the mask token.
IGNORE = -100
MASK_ID = 2


def input_sequence(df: DataFrame, feats: list[str], low: int, high: int) -> DataFrame:
    """``input_ids``: the features' sequences, each value clamped, in list order."""
    whole = F.concat(*[F.col(f"`{f}--tid`") for f in feats])
    return df.withColumn(
        "input_ids", F.transform(whole, lambda x: F.greatest(F.least(x, F.lit(high)), F.lit(low)))
    )


def choose_inputs(feats: list[str], inference: bool, before: list[str]) -> list[str]:
    """Features to feed: at inference only those of a window before the case."""
    return [f for f in feats if any(b in f for b in before)] if inference else list(feats)


def union_inputs(entries: list[dict[str, list[str]]]) -> dict[str, list[str]]:
    """Lists of several entries merged by key, each item once, in order of appearance."""
    out: dict[str, list[str]] = {}
    for e in entries:
        for k, items in e.items():
            have = out.setdefault(k, [])
            have += [i for i in items if i not in have]
    return out


def hour_minute_ids(
    df: DataFrame, start: float, unit: str, interval: str = "5m", obs: str = "ObsDT", like: str = "input_ids"
) -> DataFrame:
    """``hm_ids``: number of the wall-clock 5-minute slot (00:00 is 0) of each step from the
    case time plus ``start``."""
    if interval != "5m":
        raise ValueError(f"interval {interval!r} is not supported")
    width = {"min": tg.MINUTE, "h": tg.HOUR, "d": tg.DAY}[unit]
    first = tg.micros(obs) + F.lit(round(start * width))
    slot = lambda i: (F.pmod(first + i * F.lit(tg.STEP), F.lit(tg.DAY)) / F.lit(tg.STEP)).cast("int")
    steps = F.sequence(F.lit(0).cast("bigint"), F.size(like).cast("bigint") - 1)
    return df.withColumn("hm_ids", F.when(F.size(like) > 0, F.transform(steps, slot)))


def causal_labels(df: DataFrame) -> DataFrame:
    """Labels equal the input."""
    return df.withColumn("labels", F.col("input_ids"))


def future_labels(df: DataFrame, start: int, length: int) -> DataFrame:
    """Input is the first ``start`` values, labels the next ``length``."""
    return df.withColumn("labels", F.slice("input_ids", start + 1, length)).withColumn(
        "input_ids", F.slice("input_ids", 1, start)
    )


def mask_labels(
    df: DataFrame, rate: float, seed: int, ids: list[str], mask_id: int = MASK_ID
) -> DataFrame:
    """Each position masked with probability ``rate``: the input takes the mask id, the label
    the original; other labels are ignored."""
    # The id text is an array element, so it is made once per row and not once per position.
    key = F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ids])
    hit = F.transform(
        F.array_repeat(key, F.size("input_ids")), lambda k, i: uniform([k, i], seed) < rate
    )
    d = df.withColumn("_hit", hit)
    pairs = F.arrays_zip(F.col("input_ids").alias("x"), F.col("_hit").alias("h"))
    return (
        d.withColumn("labels", F.transform(pairs, lambda p: F.when(p["h"], p["x"]).otherwise(IGNORE)))
        .withColumn(
            "input_ids", F.transform(pairs, lambda p: F.when(p["h"], mask_id).otherwise(p["x"]))
        )
        .drop("_hit")
    )


def rule_labels(df: DataFrame, col: str, ranges: dict[int, tuple], out: str = "labels") -> DataFrame:
    """First label whose inclusive range holds the value; none is the ignored label."""
    label = reduce(
        lambda acc, kv: F.when(F.col(col).between(kv[1][0], kv[1][1]), kv[0]).otherwise(acc),
        reversed(list(ranges.items())),
        F.lit(IGNORE),
    )
    return df.withColumn(out, label)


def binary_label(df: DataFrame, col: str, op: str | None = None, value=None, out: str = "Y") -> DataFrame:
    """0/1 by a comparison, or the column itself."""
    c = F.col(f"`{col}`")
    if op is None:
        return df.withColumn(out, c)
    test: dict[str, Column] = {">": c > value, "<": c < value, "==": c == value}
    if op not in test:
        raise ValueError(f"unknown operator {op!r}")
    return df.withColumn(out, F.coalesce(test[op], F.lit(False)).cast("int"))


def keep_columns(df: DataFrame, made: list[str], selected: list[str] | None = None) -> DataFrame:
    """Made columns and the selected source columns; ``None`` keeps the made ones only."""
    names = [c for c in made if selected is None or c in selected]
    names += [c for c in selected or [] if c not in names]
    return df.select(*[f"`{c}`" for c in names])


def generation_split(df: DataFrame, n: int = 24) -> DataFrame:
    """Last n labels are to be generated; the input stops before them, with a mask of ones."""
    kept = F.greatest(F.size("input_ids") - n, F.lit(0))
    return (
        df.withColumn(
            "labels",
            F.slice("labels", F.greatest(F.size("labels") - n, F.lit(0)) + 1, F.lit(n)),
        )
        .withColumn("input_ids", F.slice("input_ids", F.lit(1), kept))
        .withColumn("attention_mask", F.array_repeat(F.lit(1), F.size("input_ids")))
    )
