"""What a stored result was made of, as a hash that is the same in every session.

Parameters count by value, functions by their code and what they close over, frames by their
plan and the files it reads (name, length, time), and this library by its sources.  A
frame whose plan does not tell its rows (rows of the driver, Python functions, chance)
counts by its rows, which takes one pass.
"""

from __future__ import annotations

import dataclasses
import datetime as dt
import functools
import hashlib
import re
import types
from pathlib import Path
from typing import Any

import caseflow
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

_MARK = "_holds"
#: Plan leaves that their text and files describe in full.
_KNOWN_LEAVES = {"LogicalRelation", "Range", "OneRowRelation", "DataSourceV2Relation"}
#: Parts of a plan whose result its text does not tell.
_OPAQUE = re.compile(r"UDF|MapInArrow|MapInPandas|FlatMap|PythonData|\brand\(|\brandn\(|\buuid\(|shuffle\(")
#: Numbers that differ from run to run: expression ids, names of lambda variables.
_PASSING = re.compile(r"#\d+L?|(?<=\b[a-z])_\d+\b")


def fingerprint(*things: Any) -> str:
    """A hash of values, functions, frames, and containers of them."""
    told = repr((_sources(), [_token(x) for x in things]))
    return hashlib.sha256(told.encode("utf-8", "surrogatepass")).hexdigest()


@functools.cache
def _sources() -> str:
    """This library's code; its text operators are left out, as nothing here uses them."""
    top = Path(caseflow.__file__).parent
    files = sorted(p for p in top.rglob("*.py") if p.relative_to(top).parts[0] != "llm")
    return hashlib.sha256(b"".join(p.read_bytes() for p in files)).hexdigest()


def _token(x: Any) -> Any:
    if x is None or isinstance(x, (bool, int, float, str, bytes, dt.date, dt.datetime, dt.timedelta)):
        return type(x).__name__, repr(x)
    if isinstance(x, dict):
        return "dict", sorted((repr(_token(k)), _token(v)) for k, v in x.items())
    if isinstance(x, (set, frozenset)):
        return "set", sorted(repr(_token(v)) for v in x)
    if isinstance(x, (list, tuple)):
        return "list", [_token(v) for v in x]
    if isinstance(x, DataFrame):
        return "frame", _frame(x)
    if isinstance(x, Column):
        return "column", _PASSING.sub("", str(x))
    if isinstance(x, functools.partial):
        return "partial", _token((x.func, x.args, x.keywords))
    if isinstance(x, types.MethodType):
        return "method", _token((x.__func__, x.__self__))
    if isinstance(x, types.FunctionType):
        return "function", _function(x)
    if isinstance(x, (type, types.BuiltinFunctionType, types.ModuleType)):
        return "name", f"{getattr(x, '__module__', '')}.{getattr(x, '__qualname__', x.__name__)}"
    if dataclasses.is_dataclass(x):
        return type(x).__qualname__, [(f.name, _token(getattr(x, f.name))) for f in dataclasses.fields(x)]
    return "object", hashlib.sha256(cloudpickle.dumps(x)).hexdigest()


def _function(fn: types.FunctionType) -> Any:
    """Code, defaults, and frames, functions and constants it closes over.  A list or other
    container of plain values that it merely reaches may be a place it writes to, and does
    not count: pass parameters as such."""
    closed = [c.cell_contents for c in fn.__closure__ or () if c != types.CellType()]
    closed = [x for x in closed if not isinstance(x, (list, dict, set)) or _holds_frames(x)]
    return fn.__qualname__, _code(fn.__code__), _token((fn.__defaults__, fn.__kwdefaults__)), [_token(x) for x in closed]


def _holds_frames(x: Any) -> bool:
    values = x.values() if isinstance(x, dict) else x
    return any(isinstance(v, (DataFrame, types.FunctionType)) or dataclasses.is_dataclass(v) for v in values)


def _code(code: types.CodeType) -> Any:
    consts = [_code(c) if isinstance(c, types.CodeType) else _token(c) if not isinstance(c, frozenset) else sorted(map(repr, c)) for c in code.co_consts]
    return code.co_code.hex(), code.co_names, consts


def _frame(df: DataFrame) -> Any:
    spark, execution = df.sparkSession, df._jdf.queryExecution()
    plan = execution.analyzed().canonicalized()
    leaves = plan.collectLeaves()
    kinds = {leaves.apply(i).getClass().getSimpleName() for i in range(leaves.length())}
    limit = spark.conf.get("spark.sql.debug.maxToStringFields")
    spark.conf.set("spark.sql.debug.maxToStringFields", 1_000_000)
    try:
        text = _PASSING.sub("", plan.toString())
    finally:
        spark.conf.set("spark.sql.debug.maxToStringFields", limit)
    if kinds <= _KNOWN_LEAVES and not _OPAQUE.search(text):
        return text, _files(spark, df.inputFiles())
    whole = F.struct("*")
    if any(isinstance(f.dataType, T.MapType) or "map<" in f.dataType.simpleString() for f in df.schema.fields):
        whole = F.to_json(whole)
    rows, total = df.agg(F.count("*"), F.sum(F.xxhash64(whole).cast("decimal(38,0)"))).first()
    return df.schema.simpleString(), rows, str(total)


def _files(spark: SparkSession, paths: list[str]) -> list[tuple]:
    """Name, length and time of files, listed folder by folder."""
    wanted, found = set(), []
    for p in paths:
        wanted.add(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(p).toUri().getPath())
    for folder in sorted({p.rsplit("/", 1)[0] for p in paths}):
        at, fs = _place(spark, folder)
        for s in fs.listStatus(at):
            path = s.getPath().toUri().getPath()
            if path in wanted:
                found.append((path, s.getLen(), s.getModificationTime()))
    return sorted(found)


def _place(spark: SparkSession, path: str):
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at, at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def seal(spark: SparkSession, path: str, mark: str) -> None:
    """Say what the stored result at ``path`` holds; to be called after its write was committed."""
    at, fs = _place(spark, f"{path.rstrip('/')}/{_MARK}")
    out = fs.create(at, True)
    out.write(bytearray(mark.encode()))
    out.close()


def sealed(spark: SparkSession, path: str) -> str | None:
    """What the result at ``path`` holds; None when it is absent, half-written or not sealed."""
    at, fs = _place(spark, f"{path.rstrip('/')}/{_MARK}")
    if not fs.exists(at):
        return None
    stream = fs.open(at)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder that this library wrote."""
    at, fs = _place(spark, path)
    fs.delete(at, True)
