"""The first rows of an order, or the rows between two ranks, without sorting the table.

Few rows are kept by every task and merged.  For many, only the key at the cut is looked for:
a bounded sample of keys cuts the order into ranges, one pass counts their rows, and the range
that holds the rank is cut again until it is small enough to be sorted.  What is kept is then
a plain filter by that key; no row is written or moved.
"""

from __future__ import annotations

from typing import Any

from pyspark.sql import Column, DataFrame, functions as F, types as T

#: Rows that a task may keep and sort.
FEW = 100_000
#: Keys sampled in a round, and ranges made of them.
SAMPLE, RANGES = 4096, 256


def _literal(value: Any, kind: T.DataType) -> Column:
    if isinstance(kind, T.StructType):
        return F.struct(*[_literal(value and value[f.name], f.dataType).alias(f.name) for f in kind.fields])
    if isinstance(kind, T.ArrayType) and value is not None:
        return F.array(*[_literal(x, kind.elementType) for x in value]).cast(kind)
    if isinstance(kind, T.TimestampNTZType) and value is not None:
        return F.lit(str(value)).cast(kind)
    return F.lit(value).cast(kind)


def _keys(df: DataFrame, order: list[str]) -> DataFrame:
    """The order's columns as one comparable column _key."""
    return df.select(F.struct(*[F.col(c).alias(f"k{i}") for i, c in enumerate(order)]).alias("_key"))


def _range(bounds: Column, n: int) -> Column:
    """How many of n sorted bounds lie below the key."""
    steps = F.array(*[F.lit(1 << k) for k in range(n.bit_length() - 1, -1, -1)])
    step = lambda at, half: F.when(F.get(bounds, at + half - 1) < F.col("_key"), at + half).otherwise(at)
    return F.aggregate(steps, F.lit(0), step)


def cut(df: DataFrame, order: list[str], rank: int) -> tuple[Column, int, int] | None:
    """The key with that rank (from 1) as a literal, the rows before it, and the rows that have it.

    None when there are fewer rows.
    """
    keys = _keys(df, order)
    kind = keys.schema["_key"].dataType
    inside, before, edge = keys, 0, []
    while True:
        spread = F.xxhash64("_key", F.monotonically_increasing_id())
        sample = inside.orderBy(spread).limit(SAMPLE).distinct().orderBy("_key").collect()
        if not sample:
            return None
        step = max(1, len(sample) // RANGES)
        # the least key is a range of its own, so that every round gets on, whatever the sample
        bounds = [_literal(x, kind) for x in edge + [r[0] for r in sample[step - 1 :: step] if [r[0]] != edge]]
        number = _range(F.array(*bounds), len(bounds))
        groups = inside.groupBy(number.alias("_n")).agg(F.count("*"), F.min("_key"), F.max("_key")).collect()
        for n, rows, least, most in sorted(groups, key=lambda r: r[0]):
            if before + rows >= rank:
                break
            before += rows
        else:
            return None
        if least == most:
            return _literal(least, kind), before, rows
        edge = [least]
        inside = keys.where((F.col("_key") >= _literal(least, kind)) & (F.col("_key") <= _literal(most, kind)))
        if rows <= FEW:
            (found,) = inside.orderBy("_key").offset(rank - before - 1).limit(1).collect()
            key = _literal(found[0], kind)
            below, equal = inside.agg(
                F.count(F.when(F.col("_key") < key, 1)), F.count(F.when(F.col("_key") == key, 1))
            ).first()
            return key, before + below, equal


def first_rows(df: DataFrame, order: list[str], n: int) -> DataFrame:
    """The first ``n`` rows in ``order``, nulls first; rows equal in it are interchangeable."""
    if n <= FEW:
        return df.orderBy(*order).limit(max(0, n))
    at = cut(df, order, n)
    if at is None:
        return df
    key, below, equal = at
    mine = F.struct(*[F.col(c).alias(f"k{i}") for i, c in enumerate(order)])
    if below + equal == n:
        return df.where(mine <= key)
    return df.where(mine < key).unionByName(df.where(mine == key).limit(n - below))


def rows_between(df: DataFrame, order: list[str], low: int, high: int) -> DataFrame:
    """Rows with a rank above ``low`` and up to ``high``; ``order`` must identify a row."""
    if high <= FEW:
        return df.orderBy(*order).offset(low).limit(max(0, high - low))
    mine = F.struct(*[F.col(c).alias(f"k{i}") for i, c in enumerate(order)])
    for rank, above in ((high, False), (low, True)):
        at = cut(df, order, rank) if rank else None
        if at is not None:
            df = df.where(mine > at[0] if above else mine <= at[0])
        elif above and rank:
            df = df.limit(0)
    return df
