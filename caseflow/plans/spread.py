"""Ordered computations without a single-task sort.

A window ordered over a whole table, or over one very large group, runs in one
task.  Here the order is cut into chunks, each chunk is summarised, the
summaries (one row per chunk) are summed in order, and the running value inside
a chunk starts from its chunk's base.  Chunks are either given (a day of a
patient's timeline) or ranges of the keys, as many as the rows ask for.
"""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager
from typing import Iterator

from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F

from caseflow.functions import timegrid as tg

_CHUNK, _BASE = "_chunk", "_base"
#: Paths handed out by scratch_path, in order.
_made: list[str] = []
#: Rows of a chunk, on average: what one task sorts.
ROWS_PER_CHUNK = 1_000_000


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it.

    A local session without that setting gets a temporary folder; anywhere else
    the setting is required.
    """
    known = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if known:
        return known
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by the cluster")
    made = tempfile.mkdtemp(prefix="caseflow-")
    spark.sparkContext.setCheckpointDir(made)
    return made


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder."""
    made = f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    _made.append(made)
    return made


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Intermediate tables written inside the block are removed at its end, so results must be
    written or collected inside it."""
    before = len(_made)
    try:
        yield
    finally:
        jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
        for path in _made[before:]:
            at = jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(conf).delete(at, True)
        del _made[before:]


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write below the shared folder and read back: what is upstream runs once."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def with_chunks(df: DataFrame, keys: list[str], chunks: int | None = None) -> DataFrame:
    """Add ``_chunk``, increasing with the keys; nulls come first.

    As many ranges as the row count asks for (or ``chunks``).  The rows are written, so
    their upstream runs once and their ranges stay what they are.
    """
    rows = stored(df, "spread-rows")
    n = chunks or -(-rows.count() // ROWS_PER_CHUNK)
    if n <= 1:
        return rows.withColumn(_CHUNK, F.lit(0))
    ranges = rows.repartitionByRange(n, *[F.col(k).asc_nulls_first() for k in keys])
    return stored(ranges.withColumn(_CHUNK, F.spark_partition_id()), "spread-ranges")


def join_null_safe(left: DataFrame, right: DataFrame, on: list[str], how: str = "inner") -> DataFrame:
    """Join on columns where null meets null; the right side's copies leave."""
    other = right.withColumnsRenamed({c: f"_right_{c}" for c in on})
    test = [F.col(c).eqNullSafe(F.col(f"_right_{c}")) for c in on]
    return left.join(other, test, how).drop(*[f"_right_{c}" for c in on])


def running(
    df: DataFrame,
    order: list[str],
    totals: dict[str, Column],
    group: list[str] | None = None,
    chunk: Column | None = None,
    parts: int | None = None,
) -> DataFrame:
    """Add running sums of ``totals`` in ``order`` inside ``group``, this row included.

    ``order`` must identify a row inside its group.  ``chunk`` must not decrease
    along ``order``; without it chunks are ranges of the order keys.  Null keys come
    first, null groups are groups, and no row is lost.  ``parts``: see ``carried``.
    """
    group = list(group or [])
    d = with_chunks(df, order) if chunk is None else df.withColumn(_CHUNK, chunk)
    inner = W.partitionBy(*group, _CHUNK).orderBy(*order).rowsBetween(W.unboundedPreceding, 0)
    sums = d.groupBy(*group, _CHUNK).agg(
        *[F.sum(expr).alias(f"{_BASE}_{out}") for out, expr in totals.items()]
    )
    outer = (
        W.partitionBy(*(group or [F.lit(0)])).orderBy(_CHUNK).rowsBetween(W.unboundedPreceding, -1)
    )
    for out in totals:
        name = f"{_BASE}_{out}"
        sums = sums.withColumn(f"{name}_", F.coalesce(F.sum(name).over(outer), F.lit(0))).drop(name)
    joined = join_null_safe(d, sums, group + [_CHUNK])
    joined = joined.repartition(parts, *group, _CHUNK) if parts else joined
    for out, expr in totals.items():
        name = f"{_BASE}_{out}_"
        joined = joined.withColumn(out, F.col(name) + F.sum(expr).over(inner))
    return joined.drop(_CHUNK, *[f"{_BASE}_{out}_" for out in totals])


def carried(
    df: DataFrame, order: list[str], values: dict[str, Column], group: list[str], chunk: Column, parts: int | None = None
) -> DataFrame:
    """Add the last non-null value of each expression among the rows before this one.

    Rows come in ``order``, unique inside ``group``; ``chunk`` must not decrease along it.  A
    chunk starts from the last values of the chunks before, one row a chunk.  Chunks are dealt to
    ``parts`` tasks, if given: Spark joins short partitions by bytes, and a task sorts all of them at once.
    """
    d = df.withColumn(_CHUNK, chunk)
    known = d.select(*group, _CHUNK, F.struct(*order).alias("_at"), *[e.alias(f"{_BASE}_{out}") for out, e in values.items()])
    known = known.repartition(parts, *group, _CHUNK) if parts else known
    ends = known.groupBy(*group, _CHUNK).agg(
        *[F.max_by(b, F.when(F.col(b).isNotNull(), F.col("_at"))).alias(b) for b in (f"{_BASE}_{out}" for out in values)]
    )
    before = W.partitionBy(*group).orderBy(_CHUNK).rowsBetween(W.unboundedPreceding, -1)
    for out in values:
        ends = ends.withColumn(f"{_BASE}_{out}", F.last(f"{_BASE}_{out}", ignorenulls=True).over(before))
    joined = join_null_safe(d, ends, [*group, _CHUNK])
    joined = joined.repartition(parts, *group, _CHUNK) if parts else joined
    inner = W.partitionBy(*group, _CHUNK).orderBy(*order).rowsBetween(W.unboundedPreceding, -1)
    seen = {o: F.coalesce(F.last(e, ignorenulls=True).over(inner), F.col(f"{_BASE}_{o}")) for o, e in values.items()}
    return joined.withColumns(seen).drop(_CHUNK, *[f"{_BASE}_{out}" for out in values])


def rank_rows(
    df: DataFrame,
    order: list[str],
    out: str,
    group: list[str] | None = None,
    chunk: Column | None = None,
) -> DataFrame:
    """Row number from 1 in ``order`` (unique inside ``group``) without a one-task sort."""
    return running(df, order, {out: F.lit(1).cast("bigint")}, group, chunk)


def rank_by_hash(df: DataFrame, hash_col: str, tie: list[str], out: str) -> DataFrame:
    """Row number from 1 by a uniform in [0, 1)."""
    return rank_rows(df, [hash_col, *tie], out)


def row_order(df: DataFrame, first: list[str]) -> list[str]:
    """``first``, then every other column that has an order, so that equal keys are told apart."""
    rest = [f.name for f in df.schema.fields if f.name not in first and "map<" not in f.dataType.simpleString()]
    return [*first, *[f"`{c}`" for c in rest]]


def previous_time(df: DataFrame, key: list[str], time_us: str, out: str) -> DataFrame:
    """Time (microseconds) of the record before this one in its group; null for the first.

    Inside a day it is a lag; the first record of a day takes the last time of
    the group's previous day that has records.
    """
    d = df.withColumn(_CHUNK, tg.bucket(F.col(time_us)))
    days = d.groupBy(*key, _CHUNK).agg(F.max(time_us).alias("_last"))
    days = days.withColumn("_before", F.lag("_last").over(W.partitionBy(*key).orderBy(_CHUNK)))
    inner = W.partitionBy(*key, _CHUNK).orderBy(time_us)
    return (
        join_null_safe(d, days.drop("_last"), [*key, _CHUNK])
        .withColumn(out, F.coalesce(F.lag(time_us).over(inner), F.col("_before")))
        .drop(_CHUNK, "_before")
    )
