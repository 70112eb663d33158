"""Registry, and the roles the given tables play (see FIXTURES.md)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from caseflow.functions import timegrid as tg
from caseflow.operators.features import CGM, DIET, EXERCISE, MED

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query under a name, with its SQL twin."""

    def add(fn):
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn

    return add


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


# ---------------------------------------------------------------- raw events


def raw_events(spark: SparkSession, d: str, events: DataFrame | None = None) -> DataFrame:
    """events (or a stream of them) as raw rows: patient, time, value, code k, time-zone offset made from k."""
    events = table(spark, d, "events") if events is None else events
    k = F.get_json_object("props", "$.k").cast("int")
    return events.select(
        "event_id",
        F.col("user_id").alias("PatientID"),
        F.col("ts").alias("ObservationDateTime"),
        "event_type",
        "value",
        k.alias("k"),
        F.when(k % 10 == 0, 2000).when(k % 3 == 0, 0).otherwise(-300).alias("TimezoneOffset"),
        "props",
    )


def human(spark: SparkSession, d: str) -> DataFrame:
    """Patients of the events with their own offset."""
    u = table(spark, d, "events").select(F.col("user_id").alias("PatientID")).distinct()
    return u.withColumn("user_tz", (F.col("PatientID") % 5 * -60).cast("int"))


RAW = """raw AS (
  SELECT event_id, user_id AS "PatientID", ts AS "ObservationDateTime", event_type, value, k,
         CASE WHEN k % 10 = 0 THEN 2000 WHEN k % 3 = 0 THEN 0 ELSE -300 END AS "TimezoneOffset", props,
         -60 * (user_id % 5) AS user_tz
  FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events))"""

LOCAL = RAW + """, loc AS (
  SELECT *, COALESCE(NULLIF("TimezoneOffset", 0), user_tz) AS tz,
         "ObservationDateTime" + to_minutes(CAST(COALESCE(NULLIF("TimezoneOffset", 0), user_tz) AS BIGINT)) AS dt
  FROM raw WHERE abs("TimezoneOffset") < 1000)"""


# ---------------------------------------------------------------- records, PID = user id

_TYPES = {CGM: ("view", "error"), DIET: ("purchase",), MED: ("click",), EXERCISE: ("signup",)}


def record(spark, d, kind: str) -> DataFrame:
    """Gridded records of a kind: PID, DT_s, mean value."""
    e = table(spark, d, "events").where(F.col("event_type").isin(*_TYPES[kind]))
    e = e.select(F.col("user_id").alias("PID"), tg.floor_5min("ts").alias("DT_s"), "value")
    return e.groupBy("PID", "DT_s").agg(F.avg("value").alias("BGValue"))


def records(spark, d) -> dict[str, DataFrame]:
    return {k: record(spark, d, k) for k in _TYPES}


def _record_sql(name: str, types: tuple[str, ...]) -> str:
    listed = ", ".join(f"'{t}'" for t in types)
    return f"""{name} AS (
  SELECT user_id AS "PID", time_bucket(INTERVAL 5 MINUTE, ts) AS "DT_s", avg(value) AS "BGValue"
  FROM events WHERE event_type IN ({listed}) GROUP BY 1, 2)"""


REC = ", ".join(
    _record_sql(n, _TYPES[k]) for n, k in (("cgm", CGM), ("diet", DIET), ("med", MED), ("exe", EXERCISE))
)


def cases(spark, d) -> DataFrame:
    """Every gridded glucose record as a case."""
    return record(spark, d, CGM).select("PID", F.col("DT_s").alias("ObsDT"), "BGValue")


CASES = REC + """, cases AS (SELECT "PID", "DT_s" AS "ObsDT", "BGValue" FROM cgm)"""


def bounds(window) -> tuple[str, str]:
    """SQL bounds of a window around c."ObsDT"."""
    lo = f"""c."ObsDT" + to_microseconds(CAST({window.lo} AS BIGINT))"""
    hi = f"""c."ObsDT" + to_microseconds(CAST({window.hi} AS BIGINT))"""
    return lo, hi


def uni(*ids, seed) -> str:
    """SQL of the md5 uniform."""
    parts = ", ".join(f"COALESCE(CAST({i} AS VARCHAR), '')" for i in ids)
    return f"(CAST('0x' || substr(md5(concat_ws('|', {parts}, '{seed}')), 1, 8) AS BIGINT) / 4294967296)"


# ---------------------------------------------------------------- patients


def patients(spark, d) -> DataFrame:
    """customer as demographics."""
    c = F.col("c_custkey")
    return table(spark, d, "customer").select(
        c.alias("PatientID"),
        (c % 3 + 1).cast("int").alias("Gender"),
        (1940 + c % 75).cast("int").alias("YearOfBirth"),
        (c % 3 + 1).cast("double").alias("DiseaseType"),
        F.col("c_mktsegment").alias("MRSegmentID"),
        F.when(c % 7 == 0, F.lit(None)).otherwise(c % 5 * -60).cast("int").alias("UserTimeZoneOffset"),
    )


PAT = """pat AS (
  SELECT c_custkey AS "PatientID", CAST(c_custkey % 3 + 1 AS INTEGER) AS "Gender",
         CAST(1940 + c_custkey % 75 AS INTEGER) AS "YearOfBirth",
         CAST(c_custkey % 3 + 1 AS DOUBLE) AS "DiseaseType", c_mktsegment AS "MRSegmentID",
         CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE CAST(-60 * (c_custkey % 5) AS INTEGER) END AS "UserTimeZoneOffset"
  FROM customer)"""
