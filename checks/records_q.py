"""Shaping, directory, record and token queries."""

from __future__ import annotations

from pyspark.sql import functions as F, types as T

from caseflow.functions import codes, timegrid as tg
from caseflow.operators import entities as H, records as R, shaping as S, tokens as K
from caseflow.operators.anchors import densify_anchor
from caseflow.plans.spread import rank_rows
from checks.base import LOCAL, PAT, RAW, REC, human, patients, query, raw_events, record, table
from caseflow.operators.features import CGM


def _case(col: str, mapping: dict, other: str = "NULL") -> str:
    arms = " ".join(f"WHEN {k!r} THEN {v!r}" for k, v in mapping.items())
    return f"CASE {col} {arms} ELSE {other} END"


# ---------------------------------------------------------------- R: shaping


@query("r1_rename_key", """SELECT c_custkey AS "PatientID", c_name, c_nationkey FROM customer""")
def r1(spark, d):
    c = table(spark, d, "customer").select("c_custkey", "c_name", "c_nationkey")
    return S.rename_key(c, {"c_custkey": "PatientID", "PatientId": "PatientID"})


@query(
    "r2_patient_outer_join",
    """SELECT "PatientID", seg, n_events FROM
       (SELECT c_custkey AS "PatientID", c_mktsegment AS seg FROM customer)
       FULL OUTER JOIN (SELECT user_id * 2 AS "PatientID", count(*) AS n_events FROM events GROUP BY 1)
       USING ("PatientID")""",
)
def r2(spark, d):
    c = table(spark, d, "customer")
    c = c.select(F.col("c_custkey").alias("PatientID"), F.col("c_mktsegment").alias("seg"))
    e = table(spark, d, "events").groupBy((F.col("user_id") * 2).alias("PatientID"))
    return S.patient_outer_join(c, e.agg(F.count(F.lit(1)).alias("n_events")))


@query(
    "r3_map_codes",
    "WITH " + RAW + f""" SELECT event_id, k, {_case('k', codes.MEAL_ACTIVITY)} AS "ActivityType",
       {_case('k % 4', codes.EXERCISE_INTENSITY)} AS "ExerciseIntensity",
       {_case('k', codes.EXERCISE_TYPE, 'CAST(k AS VARCHAR)')} AS "ExerciseType",
       {_case('k', codes.EXERCISE_ACTIVITY, 'CAST(k AS VARCHAR)')} AS "ExerciseActivity" FROM raw""",
)
def r3(spark, d):
    e = raw_events(spark, d).select("event_id", "k", (F.col("k") % 4).alias("i"))
    e = S.map_codes(e, "k", codes.MEAL_ACTIVITY, "ActivityType")
    e = S.map_codes(e, "i", codes.EXERCISE_INTENSITY, "ExerciseIntensity").drop("i")
    e = S.map_codes(e, "k", codes.EXERCISE_TYPE, "ExerciseType", keep_unmapped=True)
    return S.map_codes(e, "k", codes.EXERCISE_ACTIVITY, "ExerciseActivity", keep_unmapped=True)


MEAL = """meal AS (
  SELECT l_orderkey AS "CarbEntryID",
         string_agg(CAST(l_partkey AS VARCHAR), '; ' ORDER BY l_linenumber, l_partkey, l_suppkey, l_shipdate) AS "FoodName",
         round(sum(l_quantity), 4) AS "Carbs", round(sum(l_extendedprice), 4) AS "Calories",
         round(sum(l_discount), 4) AS "Fat"
  FROM lineitem GROUP BY 1)"""


def _meal(spark, d):
    food = table(spark, d, "lineitem").select(
        F.col("l_orderkey").alias("CarbEntryID"),
        F.col("l_partkey").cast("string").alias("FoodName"),
        "l_linenumber",
        "l_partkey",
        "l_suppkey",
        "l_shipdate",
        F.col("l_quantity").alias("Carbs"),
        F.col("l_extendedprice").alias("Calories"),
        F.col("l_discount").alias("Fat"),
    )
    sums = ["Carbs", "Calories", "Fat"]
    order = ["l_linenumber", "l_partkey", "l_suppkey", "l_shipdate"]
    m = S.meal_rollup(food, ["CarbEntryID"], "FoodName", order, sums)
    return m.select("CarbEntryID", "FoodName", *[F.round(c, 4).alias(c) for c in sums])


@query("r4_meal_rollup", f"WITH {MEAL} SELECT * FROM meal")
def r4(spark, d):
    return _meal(spark, d)


@query(
    "r5_diet_join",
    f"""WITH {MEAL} SELECT o_custkey AS "PatientID", o_orderkey AS "CarbEntryID",
        o_orderdate AS "ObservationDateTime", "FoodName", "Carbs", "Calories", "Fat"
        FROM orders JOIN meal ON o_orderkey = "CarbEntryID" """,
)
def r5(spark, d):
    carbs = table(spark, d, "orders").select(
        F.col("o_custkey").alias("PatientID"),
        F.col("o_orderkey").alias("CarbEntryID"),
        F.col("o_orderdate").alias("ObservationDateTime"),
    )
    return S.diet_join(carbs, _meal(spark, d), ["CarbEntryID"])


@query(
    "r6_conform",
    """SELECT CAST(c_custkey AS VARCHAR) AS "PatientID", CAST(NULL AS DOUBLE) AS "ActualBGValue",
       c_acctbal AS "c_acctbal" FROM customer""",
)
def r6(spark, d):
    schema = T.StructType(
        [
            T.StructField("PatientID", T.StringType()),
            T.StructField("ActualBGValue", T.DoubleType()),
            T.StructField("c_acctbal", T.DoubleType()),
        ]
    )
    return S.conform(table(spark, d, "customer").withColumnRenamed("c_custkey", "PatientID"), schema)


# Roles for event routing: event type as event name, campaign k % 7, content k % 5 (0 is missing).
_NAMES = {
    "click": "PreviewEvent",
    "purchase": "CampaignCopayAssistanceTap",
    "signup": "CampaignEducationalContentTap",
    "view": "CampaignSchedulePickup",
}


def _engagement(spark, d):
    e = raw_events(spark, d)
    name = codes.lookup(F.col("event_type"), _NAMES)
    return e.select(
        "event_id",
        F.coalesce(name, F.lit("Other")).alias("event_name"),
        F.nullif(F.col("k") % 7, F.lit(0)).alias("campaign_id"),
        F.nullif(F.col("k") % 5, F.lit(0)).alias("content_id"),
    )


ENG = RAW + f""", eng AS (
  SELECT event_id, {_case('event_type', _NAMES, "'Other'")} AS event_name,
         NULLIF(k % 7, 0) AS campaign_id, NULLIF(k % 5, 0) AS content_id FROM raw),
 routed AS (SELECT * FROM (SELECT *, {_case('event_name', codes.ENGAGEMENT_RECORD)} AS "RecName" FROM eng)
            WHERE "RecName" IS NOT NULL)"""
IDS_SQL = """ids AS (
  SELECT "RecName", 'campaign_id' AS id_type, COALESCE(CAST(campaign_id AS VARCHAR), 'nan') AS id FROM routed
  UNION SELECT "RecName", 'content_id', COALESCE(CAST(content_id AS VARCHAR), 'nan') FROM routed
  UNION SELECT "RecName", 'campaign_id-content_id', COALESCE(CAST(campaign_id AS VARCHAR), 'nan') || '-' ||
        COALESCE(CAST(content_id AS VARCHAR), 'nan') FROM routed)"""


def _routed(spark, d):
    return S.route_events(_engagement(spark, d), "event_name", codes.ENGAGEMENT_RECORD)


@query("r7_route_events", f"WITH {ENG} SELECT * FROM routed")
def r7(spark, d):
    return _routed(spark, d)


@query("r8_distinct_ids_by_type", f"WITH {ENG}, {IDS_SQL} SELECT * FROM ids")
def r8(spark, d):
    return S.distinct_ids_by_type(_routed(spark, d), "RecName", "campaign_id", "content_id")


@query(
    "r9_known_invitation_rx",
    """SELECT o_custkey AS rx_id, arg_min(o_totalprice, (o_orderdate, o_orderkey)) AS price,
       arg_min(status, (o_orderdate, o_orderkey)) FILTER (WHERE status IS NOT NULL) AS status
       FROM (SELECT *, NULLIF(o_orderstatus, 'O') AS status FROM orders)
       WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_nationkey % 2 = 0) GROUP BY 1""",
)
def r9(spark, d):
    rx = table(spark, d, "orders").select(
        F.col("o_custkey").alias("rx_id"),
        F.col("o_totalprice").alias("price"),
        F.nullif("o_orderstatus", F.lit("O")).alias("status"),
        "o_orderdate",
        "o_orderkey",
    )
    inv = table(spark, d, "customer").where("c_nationkey % 2 = 0").select(F.col("c_custkey").alias("rx_id"))
    out = S.known_invitation_rx(rx, inv, ["rx_id"], "rx_id", ["o_orderdate", "o_orderkey"])
    return out.select("rx_id", "price", "status")


@query(
    "r10_membership_flags",
    f"""WITH {ENG}, {IDS_SQL}, rx AS (
      SELECT event_id, CAST(NULLIF(k % 9, 0) AS VARCHAR) AS campaign_id, CAST(NULLIF(k % 4, 0) AS VARCHAR) AS content_id
      FROM raw), p AS (SELECT *, COALESCE(campaign_id, 'nan') || '-' || COALESCE(content_id, 'nan') AS pair FROM rx)
    SELECT event_id, campaign_id, content_id,
      CAST(pair IN (SELECT id FROM ids WHERE "RecName" = 'EgmSave' AND id_type = 'campaign_id-content_id' AND id <> 'nan-nan') AS INTEGER) AS "EgmSave",
      CAST(pair IN (SELECT id FROM ids WHERE "RecName" = 'EgmLearn' AND id_type = 'campaign_id-content_id' AND id <> 'nan-nan') AS INTEGER) AS "EgmLearn"
    FROM p""",
)
def r10(spark, d):
    ids = S.distinct_ids_by_type(_routed(spark, d), "RecName", "campaign_id", "content_id")
    rx = raw_events(spark, d).select(
        "event_id",
        F.nullif(F.col("k") % 9, F.lit(0)).cast("string").alias("campaign_id"),
        F.nullif(F.col("k") % 4, F.lit(0)).cast("string").alias("content_id"),
    )
    return S.membership_flags(rx, ids, ["EgmSave", "EgmLearn"], "RecName", "campaign_id", "content_id")


@query(
    "r11_split_patient_dim",
    """SELECT o_custkey AS patient_id_encoded,
       arg_min(prio, (o_orderdate, o_orderkey)) FILTER (WHERE prio IS NOT NULL) AS prio,
       split_part(arg_min(CAST(o_totalprice AS VARCHAR), (o_orderdate, o_orderkey)), '.', 1) AS zipcode3
       FROM (SELECT *, NULLIF(o_orderpriority, '5-LOW') AS prio FROM orders) GROUP BY 1""",
)
def r11(spark, d):
    rx = table(spark, d, "orders").select(
        F.col("o_custkey").alias("patient_id_encoded"),
        F.nullif("o_orderpriority", F.lit("5-LOW")).alias("prio"),
        F.col("o_totalprice").cast("decimal(20,2)").cast("string").alias("zipcode3"),
        "o_orderdate",
        "o_orderkey",
    )
    return S.split_patient_dim(
        rx, "patient_id_encoded", ["prio", "zipcode3"], ["o_orderdate", "o_orderkey"], ["zipcode3"]
    )


@query(
    "r12_zip_timezone",
    """SELECT lpad(CAST(c_nationkey + 3 AS VARCHAR), 3, '0') AS zipcode3, c_custkey, n_name AS timezone, r_name AS state
       FROM customer LEFT JOIN (nation JOIN region ON n_regionkey = r_regionkey) ON c_nationkey + 3 = n_nationkey""",
)
def r12(spark, d):
    z = lambda c: F.lpad(c.cast("string"), 3, "0").alias("zipcode3")
    geo = table(spark, d, "nation").join(
        table(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    ).select(z(F.col("n_nationkey")), F.col("n_name").alias("timezone"), F.col("r_name").alias("state"))
    c = table(spark, d, "customer").select(z(F.col("c_nationkey") + 3), "c_custkey")
    return S.zip_timezone(c, geo, ["timezone", "state"])


@query(
    "r16_age_buckets",
    """SELECT c_custkey, CAST(c_custkey % 95 AS INTEGER) AS age,
       CASE WHEN c_custkey % 95 < 18 THEN NULL WHEN c_custkey % 95 <= 30 THEN '18-30' WHEN c_custkey % 95 <= 40 THEN '31-40'
            WHEN c_custkey % 95 <= 50 THEN '41-50' WHEN c_custkey % 95 <= 60 THEN '51-60'
            WHEN c_custkey % 95 <= 70 THEN '61-70' WHEN c_custkey % 95 <= 80 THEN '71-80' ELSE '81+' END AS age_bucket,
       CAST(round_even((c_custkey % 95) / 5.0, 0) * 5 AS INTEGER) AS age_by5 FROM customer""",
)
def r16(spark, d):
    from caseflow.sources.forms import age_bucket, age_by5

    age = (F.col("c_custkey") % 95).cast("int")
    return table(spark, d, "customer").select(
        "c_custkey", age.alias("age"), age_bucket(age).alias("age_bucket"), age_by5(age).alias("age_by5")
    )


@query(
    "r17_xml_patient_meta",
    """SELECT url, COALESCE(NULLIF(regexp_extract(url, '/(\\d{4})/', 1), ''), 'unknown') AS year,
       CASE WHEN contains(url, '/test/') OR contains(url, '-testing') THEN 'test'
            WHEN contains(url, '/train/') OR contains(url, '-training') THEN 'train' ELSE 'unknown' END AS dataset_type,
       CAST(id AS VARCHAR) || CASE WHEN contains(url, '/test/') OR contains(url, '-testing') THEN '_test'
            WHEN contains(url, '/train/') OR contains(url, '-training') THEN '_train' ELSE '' END AS patient_id
       FROM (SELECT page_id AS id, url || '/' || CASE page_id % 3 WHEN 0 THEN 'test/' WHEN 1 THEN 'x-training' ELSE '' END
             || '/' || CAST(2018 + page_id % 5 AS VARCHAR) || '/p.xml' AS url FROM pages)""",
)
def r17(spark, d):
    i = F.col("page_id")
    part = F.when(i % 3 == 0, "test/").when(i % 3 == 1, "x-training").otherwise("")
    p = table(spark, d, "pages").select(
        i.alias("id"),
        F.concat("url", F.lit("/"), part, F.lit("/"), (2018 + i % 5).cast("string"), F.lit("/p.xml")).alias("url"),
    )
    return S.xml_patient_meta(p, "url", "id").drop("id")


@query(
    "r18_parse_ts",
    """SELECT event_id, CASE WHEN event_id % 11 = 0 THEN NULL ELSE date_trunc('second', ts) END AS ts FROM events""",
)
def r18(spark, d):
    e = table(spark, d, "events")
    text = F.when(F.col("event_id") % 11 == 0, F.lit("not a time")).otherwise(
        F.date_format("ts", "dd-MM-yyyy HH:mm:ss")
    )
    return S.parse_ts(e.select("event_id", text.alias("ts")), ["ts"])


@query(
    "r19_canonical_sections",
    """SELECT CAST(user_id AS VARCHAR) AS "PatientID", ts AS "ObservationDateTime", value AS "BGValue", 0 AS "TimezoneOffset",
       18 AS "ExternalSourceID", ts AS "EntryCreatedDateTime",
       row_number() OVER (ORDER BY lpad(CAST(user_id AS VARCHAR), 12, '0'), ts, value) - 1 AS "BGEntryID",
       CAST(NULL AS VARCHAR) AS "IsNormalIndicator", CAST(NULL AS VARCHAR) AS "ObservationEntryDateTime", CAST(NULL AS VARCHAR) AS "Timezone",
       CAST(NULL AS VARCHAR) AS "ActualBGValue", CAST(NULL AS VARCHAR) AS "UserObservationDateTime" FROM events""",
)
def r19(spark, d):
    e = table(spark, d, "events").select(
        F.lpad(F.col("user_id").cast("string"), 12, "0").alias("patient_id"), "ts", "value"
    )
    out = S.canonical_sections({"glucose_level": e})["ElogBGEntry"]
    return out.withColumn("PatientID", F.col("PatientID").cast("bigint").cast("string"))


# ---------------------------------------------------------------- H: directory

_RAWS = ["view", "click", "purchase", "signup", "error", "refund"]


def _raws(spark, d):
    e = raw_events(spark, d)
    return {n: e.where(F.col("event_type") == n) for n in _RAWS[:-1]}


CNT = """cnt AS (SELECT user_id AS "PatientID", event_type AS raw_name, count(*) AS n FROM events GROUP BY 1, 2)"""
WIDE = (
    CNT
    + """, wide AS (SELECT "PatientID", """
    + ", ".join(f"""CAST(sum(n) FILTER (WHERE raw_name = '{n}') AS DOUBLE) AS "{n}" """ for n in _RAWS[:-1])
    + """, CAST(0 AS DOUBLE) AS refund FROM cnt GROUP BY 1)"""
)


@query("h1_entity_counts", f"WITH {CNT} SELECT * FROM cnt")
def h1(spark, d):
    return H.entity_counts({**_raws(spark, d), "nation": table(spark, d, "nation")}, "PatientID")


def _wide(spark, d):
    return H.entity_pivot(H.entity_counts(_raws(spark, d), "PatientID"), "PatientID", _RAWS, _RAWS[:-1])


@query("h2_entity_pivot", f"WITH {WIDE} SELECT * FROM wide")
def h2(spark, d):
    return _wide(spark, d)


_TOTAL = "COALESCE(view, 0) + COALESCE(click, 0) + COALESCE(purchase, 0) + COALESCE(refund, 0)"


@query(
    "h3_entity_filter",
    f"""WITH {WIDE} SELECT *, {_TOTAL} AS "TotalRecNum" FROM wide WHERE {_TOTAL} > 0""",
)
def h3(spark, d):
    return H.entity_filter(_wide(spark, d), _RAWS, ["error", "signup"])


@query(
    "h4_entity_slice",
    """SELECT c_custkey, c_name FROM (SELECT *, row_number() OVER (ORDER BY c_custkey) AS r, count(*) OVER () AS n FROM customer)
       WHERE r > (n // 7) * 2 AND r <= (n // 7) * 3""",
)
def h4(spark, d):
    return H.entity_slice(table(spark, d, "customer").select("c_custkey", "c_name"), "c_custkey", "3/7")


@query(
    "h5_assign_entity_id",
    """SELECT c_name, CAST('7' || lpad(CAST(row_number() OVER (ORDER BY c_name) AS VARCHAR), 10, '0') AS BIGINT) AS "PID"
       FROM customer""",
)
def h5(spark, d):
    return H.assign_entity_id(table(spark, d, "customer").select("c_name"), "c_name", 7)


@query(
    "h6_attach_user_tz",
    f"""WITH {PAT} SELECT h."PatientID", p."UserTimeZoneOffset" AS user_tz
        FROM (SELECT DISTINCT o_custkey AS "PatientID" FROM orders) h LEFT JOIN pat p USING ("PatientID")""",
)
def h6(spark, d):
    h = table(spark, d, "orders").select(F.col("o_custkey").alias("PatientID")).distinct()
    return H.attach_user_tz(h, patients(spark, d), "PatientID", "UserTimeZoneOffset")


# ---------------------------------------------------------------- D: records


@query(
    "d1_eligible_entities",
    f"WITH {WIDE} SELECT * FROM wide WHERE purchase > 0 AND signup > 0",
)
def d1(spark, d):
    return R.eligible_entities(_wide(spark, d), ["purchase", "signup"])


@query(
    "d2_restrict_to_entities",
    """SELECT event_id, user_id AS "PatientID" FROM events WHERE user_id IN
       (SELECT c_custkey FROM customer WHERE c_mktsegment = 'HOUSEHOLD')""",
)
def d2(spark, d):
    h = table(spark, d, "customer").where("c_mktsegment = 'HOUSEHOLD'").select(F.col("c_custkey").alias("PatientID"))
    return R.restrict_to_entities(raw_events(spark, d).select("event_id", "PatientID"), h, "PatientID")


@query(
    "d3_merge_raws",
    """SELECT "PatientID", o_orderkey, c_mktsegment FROM (SELECT o_custkey AS "PatientID", o_orderkey FROM orders)
       FULL OUTER JOIN (SELECT c_custkey AS "PatientID", c_mktsegment FROM customer) USING ("PatientID")""",
)
def d3(spark, d):
    o = table(spark, d, "orders").select(F.col("o_custkey").alias("PatientID"), "o_orderkey")
    c = table(spark, d, "customer").select(F.col("c_custkey").alias("PatientID"), "c_mktsegment")
    return R.merge_raws([o, c], "PatientID")


@query(
    "d3b_merge_raws_busy",
    """SELECT "PatientID", event_id, o_orderkey
       FROM (SELECT CASE WHEN event_id % 100 = 0 THEN 7 WHEN event_id % 50 = 1 THEN NULL ELSE user_id + 20 END AS "PatientID", event_id FROM events)
       FULL OUTER JOIN (SELECT CASE WHEN o_orderkey % 100 = 0 THEN 7 WHEN o_orderkey % 50 = 1 THEN NULL ELSE o_custkey END AS "PatientID",
             o_orderkey FROM orders) USING ("PatientID")""",
)
def d3b(spark, d):
    """Many rows of a patient on both sides, one patient busier than all others, null ids without partner."""

    def busy(df, row, own):
        hot = F.when(F.col(row) % 100 == 0, 7).when(F.col(row) % 50 == 1, F.lit(None)).otherwise(own)
        return df.select(hot.cast("bigint").alias("PatientID"), row)

    e = busy(table(spark, d, "events"), "event_id", F.col("user_id") + 20)
    o = busy(table(spark, d, "orders"), "o_orderkey", F.col("o_custkey"))
    return R.merge_raws([e, o], "PatientID", cell=30)


@query(
    "d4_parse_mixed_ts",
    """SELECT event_id, CASE event_id % 4 WHEN 0 THEN ts WHEN 1 THEN date_trunc('second', ts)
       WHEN 2 THEN date_trunc('minute', ts) ELSE NULL END AS ts FROM events""",
)
def d4(spark, d):
    i = F.col("event_id") % 4
    text = (
        F.when(i == 0, F.col("ts").cast("string"))
        .when(i == 1, F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"))
        .when(i == 2, F.date_format("ts", "M/d/yyyy H:mm"))
        .otherwise("n/a")
    )
    return table(spark, d, "events").select("event_id", R.parse_mixed_ts(text).alias("ts"))


@query(
    "d5_resolve_tz",
    f"""WITH {RAW} SELECT event_id, CAST(COALESCE(NULLIF("TimezoneOffset", 0), user_tz) AS INTEGER) AS "DT_tz"
        FROM raw WHERE abs("TimezoneOffset") < 1000""",
)
def d5(spark, d):
    e = raw_events(spark, d).join(human(spark, d), "PatientID", "left")
    return R.resolve_tz(e, "TimezoneOffset").select("event_id", "DT_tz")


@query(
    "d6_localize",
    f"""WITH {LOCAL} SELECT event_id, "ObservationDateTime" + INTERVAL 10 MINUTE + to_minutes(CAST(tz AS BIGINT)) AS "DT_r",
        CASE WHEN k = 7 THEN "ObservationDateTime" + INTERVAL 10 MINUTE + to_minutes(CAST(tz AS BIGINT)) ELSE dt END AS "DT_s"
        FROM loc""",
)
def d6(spark, d):
    e = raw_events(spark, d).join(human(spark, d), "PatientID", "left")
    e = e.withColumn("entered", F.col("ObservationDateTime") + F.expr("interval 10 minutes"))
    unset = F.lit("2009-12-31 00:00:00").cast("timestamp_ntz")
    e = e.withColumn("observed", F.when(F.col("k") == 7, unset).otherwise(F.col("ObservationDateTime")))
    return R.localize(R.resolve_tz(e, "TimezoneOffset"), "observed", "entered").select("event_id", "DT_r", "DT_s")


@query("d7_floor_5min", "SELECT event_id, time_bucket(INTERVAL 5 MINUTE, ts) AS ts FROM events")
def d7(spark, d):
    return R.floor_5min(table(spark, d, "events").select("event_id", "ts"), ["ts"])


@query(
    "d8_drop_exact_duplicates",
    "SELECT DISTINCT user_id, time_bucket(INTERVAL 5 MINUTE, ts) AS ts, event_type FROM events",
)
def d8(spark, d):
    e = table(spark, d, "events").select("user_id", "ts", "event_type")
    return R.drop_exact_duplicates(R.floor_5min(e, ["ts"]))


@query(
    "d9_glucose_5min",
    f"""WITH {LOCAL} SELECT "PatientID", time_bucket(INTERVAL 5 MINUTE, dt) AS "DT_s", round(avg(value), 6) AS "BGValue"
        FROM loc WHERE event_type IN ('view', 'error') GROUP BY 1, 2""",
)
def d9(spark, d):
    g = raw_events(spark, d).where("event_type in ('view', 'error')").withColumnRenamed("value", "BGValue")
    return R.glucose_record(g, human(spark, d)).withColumn("BGValue", F.round("BGValue", 6))


def _anchor_sql(source: str, key: str, time: str, gap: str = "31 MINUTE") -> str:
    """Anchors of each key by the rule itself: the next anchor is the first time past the gap."""
    return f"""anc(k, a) AS (
      SELECT {key}, min({time}) FROM {source} GROUP BY 1
      UNION ALL
      SELECT anc.k, (SELECT min(s.{time}) FROM {source} s WHERE s.{key} = anc.k AND s.{time} > anc.a + INTERVAL {gap})
      FROM anc WHERE anc.a IS NOT NULL)"""


@query(
    "d10_densify_anchor",
    f"""WITH RECURSIVE {_anchor_sql('events', 'user_id', 'ts')}
        SELECT e.event_id, e.user_id AS "PatientID", epoch_us(max(anc.a)) AS anchor_us
        FROM events e JOIN anc ON anc.k = e.user_id AND anc.a <= e.ts GROUP BY 1, 2""",
)
def d10(spark, d):
    e = table(spark, d, "events").select(
        "event_id", F.col("user_id").alias("PatientID"), tg.micros("ts").alias("t")
    )
    return densify_anchor(e, ["PatientID"], "t").drop("t")


def _diet(spark, d):
    e = raw_events(spark, d).where("event_type = 'purchase'")
    return e.select(
        "PatientID",
        "ObservationDateTime",
        F.col("ObservationDateTime").alias("ObservationEntryDateTime"),
        "TimezoneOffset",
        F.concat(F.lit("k"), F.col("k").cast("string")).alias("FoodName"),
        F.col("value").alias("Carbs"),
        (F.col("value") / 2).alias("Fiber"),
        S.codes.lookup(F.col("k"), codes.MEAL_ACTIVITY).alias("ActivityType"),
    )


DIET_SQL = f"""{LOCAL}, src AS (SELECT *, "PatientID" AS pid FROM loc WHERE event_type = 'purchase' AND value > 0),
  {_anchor_sql('src', 'pid', 'dt')},
  an AS (SELECT s.event_id, max(anc.a) AS a FROM src s JOIN anc ON anc.k = s.pid AND anc.a <= s.dt GROUP BY 1),
  rows_ AS (SELECT s.*, time_bucket(INTERVAL 5 MINUTE, an.a) AS "DT_s" FROM src s JOIN an USING (event_id)),
  dietrec AS (
    SELECT pid AS "PatientID", "DT_s", time_bucket(INTERVAL 5 MINUTE, min(dt)) AS "DT_r",
      CAST(arg_min(tz, dt) AS INTEGER) AS "DT_tz",
      arg_min({_case('k', codes.MEAL_ACTIVITY)}, dt) FILTER (WHERE {_case('k', codes.MEAL_ACTIVITY)} IS NOT NULL) AS "ActivityType",
      string_agg('k' || CAST(k AS VARCHAR), '; ' ORDER BY dt, 'k' || CAST(k AS VARCHAR)) AS "FoodName",
      round(sum(value), 4) AS "Carbs", round(sum(value / 2), 4) AS "Fiber"
    FROM rows_ GROUP BY 1, 2)"""


@query(
    "d11_event_rollup",
    f"""WITH RECURSIVE {DIET_SQL} SELECT *, CAST(epoch_us("DT_s") - epoch_us(lag("DT_s") OVER
        (PARTITION BY "PatientID" ORDER BY "DT_s")) AS DOUBLE) / 300000000 AS time_to_last_entry FROM dietrec""",
)
def d11(spark, d):
    out = R.diet_record(_diet(spark, d), human(spark, d), ["Carbs", "Fiber"])
    return out.withColumns({c: F.round(c, 4) for c in ("Carbs", "Fiber")})


@query(
    "d12_time_to_last_entry",
    f"""WITH {REC} SELECT "PID", "DT_s", CAST(epoch_us("DT_s") - epoch_us(lag("DT_s") OVER
        (PARTITION BY "PID" ORDER BY "DT_s")) AS DOUBLE) / 300000000 AS time_to_last_entry FROM cgm""",
)
def d12(spark, d):
    return R.time_to_last_entry(record(spark, d, CGM).select("PID", "DT_s"), "PID")


EXE_SQL = f"""{LOCAL}, src AS (SELECT *, "PatientID" AS pid, CAST(k AS DOUBLE) AS dur FROM loc WHERE event_type = 'signup'),
  {_anchor_sql('src', 'pid', 'dt')},
  an AS (SELECT s.event_id, max(anc.a) AS a FROM src s JOIN anc ON anc.k = s.pid AND anc.a <= s.dt GROUP BY 1),
  exe_ AS (
    SELECT pid AS "PatientID", time_bucket(INTERVAL 5 MINUTE, an.a) AS "DT_s",
      time_bucket(INTERVAL 5 MINUTE, min(dt)) AS "DT_r", CAST(arg_min(tz, dt) AS INTEGER) AS "DT_tz",
      arg_min({_case('k % 4', codes.EXERCISE_INTENSITY)}, dt) FILTER (WHERE k % 4 <> 0) AS "ExerciseIntensity",
      string_agg({_case('k', codes.EXERCISE_TYPE, 'CAST(k AS VARCHAR)')}, '; '
                 ORDER BY dt, {_case('k', codes.EXERCISE_TYPE, 'CAST(k AS VARCHAR)')}) AS "ExerciseType",
      sum(dur) AS "ExerciseDuration", round(sum(value), 4) AS "CaloriesBurned"
    FROM src s JOIN an USING (event_id) GROUP BY 1, 2),
  exe2 AS (SELECT *, CAST(epoch_us("DT_s") - epoch_us(lag("DT_s") OVER (PARTITION BY "PatientID" ORDER BY "DT_s")) AS DOUBLE)
           / 300000000 AS time_to_last_entry FROM exe_)"""


def _exercise(spark, d):
    e = raw_events(spark, d).where("event_type = 'signup'").withColumn("i", F.col("k") % 4)
    e = S.map_codes(e, "i", codes.EXERCISE_INTENSITY, "ExerciseIntensity")
    e = S.map_codes(e, "k", codes.EXERCISE_TYPE, "ExerciseType", keep_unmapped=True)
    e = S.map_codes(e, "k", codes.EXERCISE_ACTIVITY, "ActivityType", keep_unmapped=True)
    return e.select(
        "PatientID",
        "ObservationDateTime",
        F.col("ObservationDateTime").alias("ObservationEntryDateTime"),
        "TimezoneOffset",
        "ExerciseType",
        "ExerciseIntensity",
        "ActivityType",
        F.col("k").cast("double").alias("ExerciseDuration"),
        F.col("value").alias("CaloriesBurned"),
        F.col("value").alias("DistanceInMeters"),
    )


@query("d13_exercise_range", f"""WITH RECURSIVE {EXE_SQL} SELECT * FROM exe2 WHERE "ExerciseDuration" BETWEEN 5 AND 120""")
def d13(spark, d):
    out = R.exercise_record(_exercise(spark, d), human(spark, d))
    return out.withColumn("CaloriesBurned", F.round("CaloriesBurned", 4)).drop("DistanceInMeters", "ActivityType")


@query(
    "d11b_medication_record",
    f"""WITH RECURSIVE {LOCAL}, src AS (SELECT *, "PatientID" AS pid FROM loc WHERE event_type = 'click'),
      {_anchor_sql('src', 'pid', 'dt')},
      an AS (SELECT s.event_id, max(anc.a) AS a FROM src s JOIN anc ON anc.k = s.pid AND anc.a <= s.dt GROUP BY 1),
      medrec AS (SELECT pid AS "PatientID", time_bucket(INTERVAL 5 MINUTE, an.a) AS "DT_s",
        time_bucket(INTERVAL 5 MINUTE, min(dt)) AS "DT_r", CAST(arg_min(tz, dt) AS INTEGER) AS "DT_tz",
        string_agg(CAST(k AS VARCHAR), '; ' ORDER BY dt, k) AS "MedicationID",
        string_agg(CAST(CAST(round(value) AS BIGINT) AS VARCHAR), '; ' ORDER BY dt, k) AS "Dose"
        FROM src s JOIN an USING (event_id) GROUP BY 1, 2)
      SELECT *, CAST(epoch_us("DT_s") - epoch_us(lag("DT_s") OVER (PARTITION BY "PatientID" ORDER BY "DT_s")) AS DOUBLE)
           / 300000000 AS time_to_last_entry FROM medrec""",
)
def d11b(spark, d):
    e = raw_events(spark, d).where("event_type = 'click'").select(
        "PatientID",
        F.col("ObservationDateTime").alias("AdministrationDate"),
        F.col("ObservationDateTime").alias("EntryDateTime"),
        F.col("TimezoneOffset").alias("AdministrationTimeZoneOffset"),
        F.col("k").alias("MedicationID"),
        F.round("value").cast("bigint").alias("Dose"),
    )
    return R.medication_record(e, human(spark, d))


@query(
    "d14_patient_record",
    f"""WITH {PAT} SELECT "PatientID", "Gender", "YearOfBirth", "MRSegmentID", printf('%.1f', "DiseaseType") AS "DiseaseType",
        COALESCE("UserTimeZoneOffset", 0) AS "UserTimeZoneOffset" FROM pat""",
)
def d14(spark, d):
    return R.patient_record(patients(spark, d))


def _directory(spark, d):
    return H.assign_entity_id(human(spark, d), "PatientID", 1)


DIR = """dir AS (SELECT uid, CAST('1' || lpad(CAST(row_number() OVER (ORDER BY uid) AS VARCHAR), 10, '0') AS BIGINT) AS "PID"
  FROM (SELECT DISTINCT user_id AS uid FROM events))"""


@query(
    "d15_attach_parent",
    f"""WITH {REC}, {DIR} SELECT cgm."PID" AS "PatientID", "DT_s", dir."PID" FROM cgm JOIN dir ON uid = cgm."PID" """,
)
def d15(spark, d):
    g = record(spark, d, CGM).select(F.col("PID").alias("PatientID"), "DT_s")
    return R.attach_parent(g, _directory(spark, d), "PatientID", ["PID"])


@query(
    "d16_assign_record_id",
    f"""WITH {REC}, {DIR} SELECT dir."PID", "DT_s", CAST(dir."PID" AS VARCHAR) || '-' ||
        lpad(CAST(row_number() OVER (PARTITION BY dir."PID" ORDER BY "DT_s") - 1 AS VARCHAR), 7, '0') AS "CGM5MinID"
        FROM cgm JOIN dir ON uid = cgm."PID" """,
)
def d16(spark, d):
    g = record(spark, d, CGM).select(F.col("PID").alias("PatientID"), "DT_s")
    g = R.attach_parent(g, _directory(spark, d), "PatientID", ["PID"]).drop("PatientID")
    return R.assign_record_id(g, "CGM5MinID")


@query(
    "d17_exercise_end",
    f"""WITH {RAW} SELECT event_id, "ObservationDateTime" + to_minutes(CAST(k AS BIGINT)) AS "DT_e" FROM raw""",
)
def d17(spark, d):
    e = raw_events(spark, d).select(
        "event_id", F.col("ObservationDateTime").alias("DT_s"), F.col("k").alias("ExerciseDuration")
    )
    return R.exercise_end(e).select("event_id", "DT_e")


@query(
    "d18_record_index",
    f"""WITH {REC}, r AS (SELECT *, row_number() OVER (ORDER BY "PID", "DT_s") - 1 AS row_ FROM cgm)
        SELECT "PID", min(row_) AS first_row, max(row_) AS last_row, count(*) AS n, min("DT_s") AS first_time,
        max("DT_s") AS last_time FROM r GROUP BY 1""",
)
def d18(spark, d):
    return R.record_index(record(spark, d, CGM))


@query(
    "d18b_record_dates",
    f"""WITH {REC} SELECT "PID", CAST(CAST("DT_s" AS DATE) AS VARCHAR) AS day,
        string_agg(strftime("DT_s", '%H:%M'), ',' ORDER BY "DT_s") AS times FROM cgm GROUP BY 1, 2""",
)
def d18b(spark, d):
    out = R.record_dates(record(spark, d, CGM))
    hhmm = F.transform("times", lambda t: F.date_format(t, "HH:mm"))
    return out.select("PID", F.col("day").cast("string").alias("day"), F.array_join(hhmm, ",").alias("times"))


@query(
    "d19_concat_groups",
    """SELECT user_id AS "PatientID", event_id FROM events""",
)
def d19(spark, d):
    e = raw_events(spark, d).select("PatientID", "event_id")
    return R.concat_groups([e.where(F.col("PatientID") % 3 == i) for i in range(3)])


@query(
    "d20_carry_activity_meta",
    f"""WITH RECURSIVE {DIET_SQL} SELECT "PatientID", "DT_s", "DT_r", "DT_tz", "ActivityType" FROM dietrec""",
)
def d20(spark, d):
    x = R.diet_record(_diet(spark, d), human(spark, d), ["Carbs"])
    return x.select("PatientID", "DT_s", "DT_r", "DT_tz", "ActivityType")


# ---------------------------------------------------------------- T: tokens

TOPS = """tops AS (SELECT * FROM (
  SELECT attr, value, n, row_number() OVER (PARTITION BY attr ORDER BY n DESC, value) AS place FROM (
    SELECT 'source' AS attr, source AS value, count(*) AS n FROM documents WHERE source IS NOT NULL GROUP BY 2
    UNION ALL SELECT 'lang', lang, count(*) FROM documents WHERE lang IS NOT NULL GROUP BY 2))
  WHERE place <= CASE attr WHEN 'lang' THEN 2 ELSE 5 END)"""


def _top(spark, d):
    return K.fit_top_values(table(spark, d, "documents"), ["source", "lang"], 5, {"lang": 2})


def _top_lists(spark, d):
    return K.top_as_lists(_top(spark, d), ["source", "lang"])


@query("t1_fit_top_values", f"WITH {TOPS} SELECT attr, value, n, CAST(place AS INTEGER) AS place FROM tops")
def t1(spark, d):
    return _top(spark, d)


CATE = TOPS + """, cate AS (SELECT doc_id,
   CASE WHEN source IN (SELECT value FROM tops WHERE attr = 'source') THEN 'source_' || source ELSE 'source_minor' END AS t1,
   CASE WHEN lang IN (SELECT value FROM tops WHERE attr = 'lang') THEN 'lang_' || lang ELSE 'lang_minor' END AS t2
   FROM documents)"""


@query("t2_tokenize_category", f"WITH {CATE} SELECT doc_id, t1 || ',' || t2 || ',nosuch_unk' AS tkn, '1,1,1' AS wgt FROM cate")
def t2(spark, d):
    top = {**_top_lists(spark, d), "nosuch": []}
    x = K.tokenize_category(table(spark, d, "documents").select("doc_id", "source", "lang"), top, "f")
    w = F.transform("f_wgt", lambda v: v.cast("int").cast("string"))
    return x.select("doc_id", F.array_join("f_tkn", ",").alias("tkn"), F.array_join(w, ",").alias("wgt"))


_BINS = {"v": (10, 100, 10)}


def _binned(spark, d):
    e = table(spark, d, "events").select(
        "event_id", F.when(F.col("event_id") % 13 == 0, F.lit(None)).otherwise(F.floor("value")).cast("double").alias("v")
    )
    return K.tokenize_numeric_bins(e, _BINS, "f")


BIN_SQL = """b AS (SELECT event_id, CASE WHEN event_id % 13 = 0 THEN NULL ELSE floor(value) END AS v FROM events),
  binned AS (SELECT event_id, v, CAST(floor(v / 10) * 10 AS BIGINT) AS lo,
    CASE WHEN v IS NULL THEN 'v:None' WHEN v = 100 THEN 'v:Equal100' WHEN v = 10 THEN 'v:Equal10'
         WHEN v > 100 THEN 'v:Above100' WHEN v < 10 THEN 'v:Below10'
         ELSE 'v:' || lpad(CAST(CAST(floor(v / 10) * 10 AS BIGINT) AS VARCHAR), 3, '0') || '~' ||
              lpad(CAST(CAST(floor(v / 10) * 10 + 10 AS BIGINT) AS VARCHAR), 3, '0') END AS t FROM b)"""


@query(
    "t3_tokenize_numeric_bins",
    f"""WITH {BIN_SQL} SELECT event_id, CASE WHEN contains(t, '~') THEN t || ',' || t || 'Itv' ELSE t END AS tkn,
        CASE WHEN contains(t, '~') THEN CAST(round((v - lo) * 1000) AS BIGINT) ELSE 10000 END AS last_wgt FROM binned""",
)
def t3(spark, d):
    w = F.round(F.element_at("f_wgt", -1) * 10000).cast("bigint")
    return _binned(spark, d).select("event_id", F.array_join("f_tkn", ",").alias("tkn"), w.alias("last_wgt"))


@query(
    "t4_tokenize_numeric",
    """SELECT event_id, CASE WHEN event_id % 13 = 0 THEN 'v_None' ELSE 'v' END AS tkn,
       CASE WHEN event_id % 13 = 0 THEN 1.0::DOUBLE ELSE value END AS wgt FROM events""",
)
def t4(spark, d):
    e = table(spark, d, "events").select(
        "event_id", F.when(F.col("event_id") % 13 != 0, F.col("value")).alias("v")
    )
    x = K.tokenize_numeric(e, ["v"], "f")
    return x.select("event_id", F.array_join("f_tkn", ",").alias("tkn"), F.element_at("f_wgt", 1).alias("wgt"))


@query(
    "t5_build_vocab",
    f"""WITH {TOPS}, voc AS (
          SELECT attr, -2 AS place, attr || '_unk' AS token FROM (SELECT DISTINCT attr FROM tops)
          UNION ALL SELECT attr, -1, attr || '_minor' FROM (SELECT DISTINCT attr FROM tops)
          UNION ALL SELECT attr, place, attr || '_' || value FROM tops),
        cate AS (SELECT CASE WHEN source IN (SELECT value FROM tops WHERE attr = 'source') THEN 'source_' || source ELSE 'source_minor' END AS token FROM documents
          UNION ALL SELECT CASE WHEN lang IN (SELECT value FROM tops WHERE attr = 'lang') THEN 'lang_' || lang ELSE 'lang_minor' END FROM documents)
        SELECT voc.token, CAST(row_number() OVER (ORDER BY CASE attr WHEN 'source' THEN 0 ELSE 1 END, place) - 1 AS INTEGER) AS tid,
        COALESCE(u.n, 0) AS uses FROM voc LEFT JOIN (SELECT token, count(*) AS n FROM cate GROUP BY 1) u USING (token)""",
)
def t5(spark, d):
    top = _top_lists(spark, d)
    vocab = K.build_vocab(spark, "category", top)
    x = K.tokenize_category(table(spark, d, "documents").select("source", "lang"), top, "f")
    uses = x.select(F.explode("f_tkn").alias("token")).groupBy("token").agg(F.count(F.lit(1)).alias("uses"))
    v = spark.createDataFrame([(t, i) for i, t in enumerate(vocab)], "token string, tid int")
    return v.join(uses, "token", "left").fillna(0, subset=["uses"])


BIN_TOKENS = sorted(
    ["v:None", "v:Equal10", "v:Equal100", "v:Above100", "v:Below10"]
    + [f"v:{x:03d}~{x + 10:03d}{s}" for x in range(10, 100, 10) for s in ("", "Itv")]
)


@query(
    "t6_tokens_to_ids",
    f"""WITH {BIN_SQL}, voc AS (SELECT unnest({BIN_TOKENS!r}) AS token, unnest(range({len(BIN_TOKENS)})) AS tid)
        SELECT event_id, CAST(a.tid AS VARCHAR) || CASE WHEN contains(t, '~') THEN ',' || CAST(b.tid AS VARCHAR) ELSE '' END AS tid
        FROM binned JOIN voc a ON a.token = t LEFT JOIN voc b ON b.token = t || 'Itv' """,
)
def t6(spark, d):
    vocab = K.build_vocab(spark, "bins", _BINS)
    x = K.tokens_to_ids(_binned(spark, d), "f", vocab, ["event_id"])
    return x.select("event_id", F.array_join(F.transform("f_tid", lambda v: v.cast("string")), ",").alias("tid"))


@query(
    "t6b_tokens_to_ids_table",
    """WITH voc AS (SELECT token, row_number() OVER (ORDER BY token) - 1 AS tid FROM
         (SELECT 'c' || c_custkey AS token FROM customer UNION SELECT 's' || o_orderstatus FROM orders))
       SELECT o_orderkey, a.tid || ',' || b.tid || ',' || a.tid AS tid
       FROM orders JOIN voc a ON a.token = 's' || o_orderstatus JOIN voc b ON b.token = 'c' || o_custkey""",
)
def t6b(spark, d):
    """A vocabulary that grows with the data, as a table."""
    o, c = table(spark, d, "orders"), table(spark, d, "customer")
    customer, status = (F.concat(F.lit(x), F.col(k).cast("string")) for x, k in (("c", "o_custkey"), ("s", "o_orderstatus")))
    known = c.select(F.concat(F.lit("c"), F.col("c_custkey").cast("string")).alias("token"))
    known = known.unionByName(o.select(status.alias("token"))).distinct()
    vocab = rank_rows(known, ["token"], "n").select("token", (F.col("n") - 1).cast("int").alias("tid"))
    x = o.select("o_orderkey", F.array(status, customer, status).alias("f_tkn"), F.array(F.lit(1.0)).alias("f_wgt"))
    x = K.tokens_to_ids(x, "f", vocab, ["o_orderkey"])
    return x.select("o_orderkey", F.array_join(F.transform("f_tid", lambda v: v.cast("string")), ",").alias("tid"))


def _describe_sql(attr: str, source: str) -> str:
    return f"""SELECT '{attr}' AS attr, count(*) AS count, round(avg({attr}), 2) AS mean, round(stddev_samp({attr}), 2) AS std,
       round(CAST(min({attr}) AS DOUBLE), 2) AS min, round(quantile_cont({attr}, 0.25), 2) AS q25, round(quantile_cont({attr}, 0.5), 2) AS q50,
       round(quantile_cont({attr}, 0.75), 2) AS q75, round(CAST(max({attr}) AS DOUBLE), 2) AS max FROM {source}"""


@query(
    "t7_describe_attrs",
    _describe_sql("l_quantity", "lineitem") + " UNION ALL " + _describe_sql("l_suppkey", "lineitem"),
)
def t7(spark, d):
    return K.describe_numeric(table(spark, d, "lineitem"), ["l_quantity", "l_suppkey"])


@query("t7c_describe_documents", _describe_sql("n_chars", "documents"))
def t7c(spark, d):
    return K.describe_numeric(table(spark, d, "documents"), ["n_chars"])


@query(
    "t7b_describe_category",
    """SELECT 'lang' AS attr, lang AS value, count(*) AS n FROM documents WHERE lang IS NOT NULL GROUP BY 2
       UNION ALL SELECT 'source', source, count(*) FROM documents WHERE source IS NOT NULL GROUP BY 2""",
)
def t7b(spark, d):
    return K.describe_category(table(spark, d, "documents"), ["lang", "source"])
