"""Stored results: compute once, read afterwards; features computed only where missing."""

from __future__ import annotations

import uuid
from typing import Any, Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from caseflow.sources.fingerprint import fingerprint, seal, sealed


def finished(spark: SparkSession, path: str) -> bool:
    """Whether a finished write lies at ``path`` (the commit marker is written last)."""
    jvm = spark.sparkContext._jvm
    marker = jvm.org.apache.hadoop.fs.Path(path.rstrip("/") + "/_SUCCESS")
    return marker.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(marker)


def load_or_compute(
    spark: SparkSession,
    path: str,
    compute: Callable[[], DataFrame],
    partition_by: list[str] | None = None,
    holds: Any = None,
) -> DataFrame:
    """Read a stored table, or compute and store it.

    ``holds`` says what the table is made of: its inputs, parameters and functions.  A table
    that was made of something else is computed again.  Without it any finished table
    counts.  A write that was cut off has no commit marker and is done again.
    """
    mark = None if holds is None else fingerprint(holds, partition_by)
    if (sealed(spark, path) != mark) if mark else not finished(spark, path):
        compute().write.mode("overwrite").partitionBy(*(partition_by or [])).parquet(path)
        if mark:
            seal(spark, path, mark)
    return spark.read.parquet(path)


def load_missing(
    spark: SparkSession,
    cases: DataFrame,
    ids: list[str],
    folder: str,
    features: dict[str, Callable[[DataFrame], DataFrame]],
    holds: dict[str, Any] | None = None,
) -> DataFrame:
    """Cases with one column group per feature function, stored per function.

    A function has a folder for each state of its code, the frames it closes over, and
    what ``holds`` adds by name (its parameters); so a changed one is computed anew.
    Stored rows are joined on the case ids, null meeting null; the distinct ids without a
    stored row are found by anti join, computed and written to a folder of their own.
    Only folders whose write was committed are read, so a run that stops half-way leaves
    nothing that counts, and the next one goes on from what was finished.
    """
    out = cases
    for name, fn in features.items():
        path = f"{folder.rstrip('/')}/{name}/{fingerprint(fn, (holds or {}).get(name))[:32]}"
        todo = cases.select(*ids).distinct()
        runs = _runs(spark, path)
        if runs:
            known = spark.read.parquet(*runs).select(*[F.col(i).alias(f"_known_{i}") for i in ids])
            todo = todo.join(known, [F.col(i).eqNullSafe(F.col(f"_known_{i}")) for i in ids], "left_anti")
        if not todo.isEmpty():
            run = f"{path}/run-{uuid.uuid4().hex}"
            fn(todo).write.parquet(run)
            runs = [*runs, run]
        made = spark.read.parquet(*runs).withColumnsRenamed({i: f"_made_{i}" for i in ids})
        out = out.join(made, [F.col(i).eqNullSafe(F.col(f"_made_{i}")) for i in ids], "left")
        out = out.drop(*[f"_made_{i}" for i in ids])
    return out


def _runs(spark: SparkSession, path: str) -> list[str]:
    """Folders below ``path`` whose write was committed."""
    jvm = spark.sparkContext._jvm
    top = jvm.org.apache.hadoop.fs.Path(path)
    fs = top.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(top):
        return []
    found = [str(s.getPath()) for s in fs.listStatus(top) if s.isDirectory()]
    return sorted(f for f in found if finished(spark, f))


def union_datasets(parts: list[DataFrame]) -> DataFrame:
    """Rows of several cohort data sets; their column names must agree."""
    first = sorted(parts[0].columns)
    for p in parts[1:]:
        if sorted(p.columns) != first:
            odd = sorted(set(p.columns) ^ set(first))
            raise ValueError(f"data sets differ in columns: {odd}")
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
