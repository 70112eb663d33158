"""Patient directory: record counts per raw table, selection, ids."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from caseflow.plans.selection import rows_between
from caseflow.plans.spread import rank_rows


def entity_counts(raw: dict[str, DataFrame], key: str) -> DataFrame:
    """Rows per patient per raw table, as ``(key, raw_name, n)``; null keys and keyless tables drop out."""
    parts = [
        df.where(F.col(key).isNotNull())
        .groupBy(key)
        .agg(F.count(F.lit(1)).alias("n"))
        .select(key, F.lit(name).alias("raw_name"), "n")
        for name, df in raw.items()
        if key in df.columns
    ]
    return reduce(DataFrame.unionByName, parts)


def entity_pivot(counts: DataFrame, key: str, names: list[str], seen: list[str]) -> DataFrame:
    """One column per raw table: null where the patient has no row, 0 for tables never seen at all."""
    wide = counts.groupBy(key).pivot("raw_name", [n for n in names if n in seen]).agg(F.sum("n"))
    return wide.select(
        key,
        *[
            (F.col(n).cast("double") if n in seen else F.lit(0.0)).alias(n)
            for n in names
        ],
    )


def entity_filter(wide: DataFrame, names: list[str], excluded: list[str]) -> DataFrame:
    """Patients with records outside the excluded tables, and how many (``TotalRecNum``)."""
    counted = [F.coalesce(F.col(n), F.lit(0.0)) for n in names if n not in excluded]
    total = reduce(Column.__add__, counted, F.lit(0.0))
    return wide.withColumn("TotalRecNum", total).where(F.col("TotalRecNum") > 0)


def entity_slice(df: DataFrame, key: str, part: str) -> DataFrame:
    """Contiguous part ``i/n`` of the patients sorted by id; the last part takes the remainder."""
    i, n = [int(x) for x in part.split("/")]
    if not 1 <= i <= n:
        raise ValueError(f"slice {part!r} is not within 1..n")
    total = df.count()
    size = total // n
    return rows_between(df, [key], size * (i - 1), size * i if i < n else total)


def assign_entity_id(df: DataFrame, key: str, label: int, width: int = 10) -> DataFrame:
    """``PID``: the cohort label followed by the zero-padded rank of the raw id, as a number."""
    ranked = rank_rows(df, [key], "_rank")
    rank = F.col("_rank").cast("string")
    pid = F.concat(F.lit(str(label)), F.lpad(rank, F.greatest(F.lit(width), F.length(rank)), F.lit("0")))
    return ranked.withColumn("PID", pid.cast("bigint")).drop("_rank")


def attach_user_tz(human: DataFrame, patients: DataFrame, key: str, offset: str) -> DataFrame:
    """Directory with the patient's own time-zone offset as ``user_tz``."""
    tz = patients.select(key, F.col(offset).alias("user_tz"))
    return human.join(tz, key, "left")
