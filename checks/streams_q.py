"""Streaming queries: each stream runs over what its source holds and is read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from caseflow.config import BF24H
from caseflow.functions import timegrid as tg
from caseflow.operators import features as X
from caseflow.plans import timeline as TL
from caseflow.plans.spread import scratch_path
from caseflow.sources import readers as RD
from caseflow.streaming import streams as ST
from checks.base import CASES, LOCAL, PAT, human, patients, query, raw_events, record, table
from checks.cases_q import ZEROS, info_sql, with_zeros
from checks.records_q import _anchor_sql
from checks.sources_q import _GLUCOSE, _columnar


def _stream(spark, d, name="events"):
    """A given table as a file stream."""
    schema = table(spark, d, name).schema
    return spark.readStream.schema(schema).option("pathGlobFilter", f"{name}.parquet").parquet(d)


def _ts(df):
    return df.withColumn("ts", F.col("ts").cast("timestamp"))


def _run(spark, stream, name):
    path = scratch_path(spark, name)
    ST.run_to_table(stream, path, scratch_path(spark, f"{name}-state"))
    return spark.read.schema(stream.schema).parquet(path)


@query(
    "x1_stream_glucose_5min",
    f"""WITH {LOCAL} SELECT "PatientID", time_bucket(INTERVAL 5 MINUTE, dt) AS "DT_s", round(avg(value), 6) AS "BGValue"
        FROM loc WHERE event_type IN ('view', 'error') GROUP BY 1, 2""",
)
def x1(spark, d):
    e = raw_events(spark, d, _stream(spark, d)).where("event_type in ('view', 'error')").withColumnRenamed("value", "BGValue")
    stream = ST.stream_glucose_record(e, human(spark, d))
    path = scratch_path(spark, "x1")
    ST.run_updates(stream, path, scratch_path(spark, "x1-state"))
    out = ST.latest(spark.read.parquet(path), ["PatientID", "DT_s"])
    return out.select("PatientID", F.col("DT_s").cast("timestamp_ntz").alias("DT_s"), F.round("BGValue", 6).alias("BGValue"))


@query("x2_stream_dedupe", "SELECT DISTINCT user_id, time_bucket(INTERVAL 5 MINUTE, ts) AS slot, event_type FROM events")
def x2(spark, d):
    e = _ts(_stream(spark, d))
    e = e.select("user_id", "ts", F.date_trunc("minute", tg.floor_5min("ts").cast("timestamp")).alias("slot"), "event_type")
    out = _run(spark, ST.stream_dedupe(e, ["user_id", "slot", "event_type"], "ts"), "x2")
    return out.select("user_id", F.col("slot").cast("timestamp_ntz").alias("slot"), "event_type")


@query(
    "x3_stream_densify",
    f"""WITH RECURSIVE {_anchor_sql('events', 'user_id', 'ts')}
        SELECT e.user_id, epoch_us(e.ts) AS event_us, epoch_us(max(anc.a)) AS anchor_us
        FROM events e JOIN anc ON anc.k = e.user_id AND anc.a <= e.ts GROUP BY 1, 2""",
)
def x3(spark, d):
    e = _ts(_stream(spark, d)).select("user_id", "ts")
    return _run(spark, ST.stream_densify(e, "user_id", "ts"), "x3")


@query(
    "x4_stream_sliding_info",
    f"""WITH {CASES}, {ZEROS}, {info_sql(BF24H, '', 'a', 'zeros')} SELECT "PID", epoch_us("ObsDT") AS obs_us, "ModePercent", "ZeroPercent", "Geq400Percent",
        "Leq20Percent", "RecNum" FROM a""",
)
def x4(spark, d):
    path = scratch_path(spark, "readings")
    g = with_zeros(record(spark, d, X.CGM)).withColumn("DT_s", F.col("DT_s").cast("timestamp"))
    g.write.parquet(path)
    readings = spark.readStream.schema(g.schema).parquet(path)
    return _run(spark, ST.stream_sliding_info(readings, "PID", "DT_s", "BGValue"), "x4")


@query(
    "x5_stream_static_enrich",
    f"""WITH {PAT} SELECT event_id, user_id AS "PatientID", "Gender", "MRSegmentID" FROM events LEFT JOIN pat ON user_id = "PatientID" """,
)
def x5(spark, d):
    p = patients(spark, d).select("PatientID", "Gender", "MRSegmentID")
    e = _stream(spark, d).select("event_id", F.col("user_id").alias("PatientID"))
    return _run(spark, ST.stream_static_enrich(e, p, "PatientID"), "x5")


@query(
    "a8_stream_predictions",
    """WITH g AS (SELECT user_id AS "PID", time_bucket(INTERVAL 5 MINUTE, ts) AS t, CAST(ts AS DATE) AS day, ts FROM events WHERE event_type IN ('view', 'error'))
       SELECT "PID", max(t) AS "ObsDT", count(DISTINCT t) AS n, CASE WHEN count(DISTINCT t) >= 2 THEN 'Save' ELSE 'Default' END AS action
       FROM g GROUP BY "PID", day""",
)
def a8(spark, d):
    src, out = scratch_path(spark, "inbox"), scratch_path(spark, "answers")
    _columnar(spark, d).write.json(src)
    forms = spark.readStream.schema("form_id string, form string").json(src)

    def tables(batch):
        rows = RD.scan_columnar_json(batch, "form", "ElogBGEntry", _GLUCOSE, keep=["form_id"])
        rows = rows.withColumn("DT_s", tg.floor_5min(F.col("ObservationDateTime").cast("timestamp_ntz")))
        g = rows.groupBy("form_id", "DT_s").agg(F.avg("BGValue").alias("BGValue")).withColumnRenamed("form_id", "PID")
        return {X.CGM: g, "triggers": g.groupBy("PID").agg(F.max("DT_s").alias("ObsDT"))}

    def respond(c):
        n = F.col("`CGMInfoBf24h-RecNum`")
        return c.select("PID", "ObsDT", n.alias("n"), F.when(n >= 2, "Save").otherwise("Default").alias("action"))

    def answer(batch):
        return TL.answer_forms(batch, tables, ["CGMInfoBf24h", "CGMInfoAf2h"], respond)

    ST.stream_predictions(forms, answer, out, scratch_path(spark, "a8-state")).awaitTermination()
    done = spark.read.parquet(out).drop("batch")
    return done.withColumn("PID", F.substring_index("PID", "_", 1).cast("bigint"))
