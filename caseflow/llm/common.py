"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F, types as T

from caseflow.plans.spread import scratch_path

FOLDS = 5
#: Texts that are Python objects at once: Arrow hands over batches of thousands.
TEXTS = 500
#: Bytes of an Arrow batch: thousands of whole texts would stand beside the heap, on both sides of the pipe.
BATCH_BYTES = 4 << 20
_BATCH_CONF = "spark.sql.execution.arrow.maxBytesPerBatch"
_NAMES = re.compile(r"[^A-Za-z0-9_]+")


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write to the shared folder and read back: lineage ends there, a lost executor costs no rerun."""
    path = scratch_path(df.sparkSession, _NAMES.sub("-", name))
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def bound_batches(spark: SparkSession) -> None:
    """From now on the session's Arrow batches end at ``BATCH_BYTES``, or earlier if it already has them so."""
    now = int(spark.conf.get(_BATCH_CONF).rstrip("bB"))
    if not 0 < now <= BATCH_BYTES:
        spark.conf.set(_BATCH_CONF, str(BATCH_BYTES))


def fold(id_col: str) -> Column:
    """crc32 of the id as text, modulo 5; null for a null id."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % FOLDS


def held_out(id_col: str) -> Column:
    """True where the fold is 0; a null id is not held out (and is never learned from)."""
    return F.coalesce(fold(id_col) == 0, F.lit(False))


def spread_order(id_col: str) -> Column:
    """A fixed pseudo-random order of ids, for bounded samples that any rerun repeats."""
    return F.md5(F.concat(F.lit("sample|"), F.col(id_col).cast("string")))


def _thinned(id_col: str, rows: int, most: int) -> Column:
    """Whether a row is early enough in ``spread_order`` to be among the first ``most`` of ``rows``.

    The order is uniform, so a little over ``most`` rows pass (six deviations more), however
    many there are and whatever the number of tasks.
    """
    place = F.conv(F.substring(spread_order(id_col), 1, 8), 16, 10).cast("bigint")
    share = min(1.0, (most + 6 * most**0.5 + 20) / max(1, rows))
    return place < F.lit(int(share * (1 << 32)) + 1)


def bounded_sample(df: DataFrame, group: str, id_col: str, most: int) -> DataFrame:
    """The ``most`` rows of each group that come first in ``spread_order``; groups are few."""
    sizes = {r[0]: r[1] for r in df.groupBy(group).count().collect()}
    early = F.lit(False)
    for value, rows in sizes.items():
        early = F.when(F.col(group).eqNullSafe(F.lit(value)), _thinned(id_col, rows, most)).otherwise(early)
    order = W.partitionBy(group).orderBy(spread_order(id_col), F.col(id_col))
    ranked = df.where(early).withColumn("_rank", F.row_number().over(order))
    return ranked.where(F.col("_rank") <= most).drop("_rank")


def bounded_rows(df: DataFrame, id_col: str, most: int) -> DataFrame:
    """The ``most`` rows that come first in ``spread_order``."""
    return df.where(_thinned(id_col, df.count(), most)).orderBy(spread_order(id_col), id_col).limit(most)


def few_rows(batches: Iterator[pa.RecordBatch], most: int = TEXTS) -> Iterator[pa.RecordBatch]:
    """The same rows in views of at most ``most``."""
    for b in batches:
        for at in range(0, b.num_rows, most):
            yield b.slice(at, most)


def map_text(
    df: DataFrame, keep: list[str], text_col: str, schema: T.StructType, fn: Callable[[list], dict]
) -> DataFrame:
    """Run ``fn`` over lists of at most ``TEXTS`` texts; the session's Arrow batches are bounded for it.

    ``fn`` gets the texts of some rows (None where null) and returns one list or array
    per column of ``schema``; the columns in ``keep`` are passed through unchanged.
    """
    kept = T.StructType([df.schema[k] for k in keep])
    out = T.StructType([*kept.fields, *schema.fields])
    names = [f.name for f in schema.fields]

    bound_batches(df.sparkSession)
    more = [] if text_col in keep else [F.col(text_col)]
    at = keep.index(text_col) if text_col in keep else len(keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in few_rows(batches):
            got = fn(b.column(at).to_pylist())
            types = [_arrow(f.dataType) for f in schema.fields]
            made = [pa.array(got[n], type=t) for n, t in zip(names, types)]
            cols = [b.column(i) for i in range(len(keep))]
            yield pa.RecordBatch.from_arrays([*cols, *made], names=[*keep, *names])

    return df.select(*[F.col(k) for k in keep], *more).mapInArrow(run, out)


def _arrow(t: T.DataType) -> pa.DataType:
    if isinstance(t, T.ArrayType):
        return pa.list_(_arrow(t.elementType))
    return {
        "bigint": pa.int64(), "int": pa.int32(), "double": pa.float64(), "float": pa.float32(),
        "boolean": pa.bool_(), "string": pa.string(), "binary": pa.binary(),
    }[t.simpleString()]


def sigmoid(x):
    return 1.0 / (1.0 + np.exp(-np.clip(x, -40, 40)))


def fit_logistic(x: np.ndarray, y: np.ndarray, l2: float = 1e-3, steps: int = 50) -> np.ndarray:
    """Newton's method for a few dense features; the last weight is the intercept."""
    a = np.hstack([x, np.ones((len(x), 1))])
    w = np.zeros(a.shape[1])
    ridge = np.diag([l2] * x.shape[1] + [1e-9]) * max(1, len(y))
    for _ in range(steps):
        p = sigmoid(a @ w)
        grad = a.T @ (p - y) + ridge @ w
        hess = (a * (p * (1 - p) + 1e-9)[:, None]).T @ a + ridge
        move = np.linalg.solve(hess, grad)
        size = np.abs(move).max()
        w -= move * min(1.0, 5.0 / max(size, 1e-12))
        if size < 1e-8:
            break
    return w
