"""Source, sink, form and store queries.  Files are written from the given tables first."""

from __future__ import annotations

from pyspark.sql import functions as F, types as T

from caseflow.config import BF24H
from caseflow.functions.codes import MODEL_DRUGS
from caseflow.operators import cases as C, features as X, shaping as S
from caseflow.plans.spread import scratch_path
from caseflow.sources import forms as FM, readers as RD, store as ST
from checks.base import CASES, REC, cases, query, record, records, table
from checks.cases_q import IDS, info_sql

# ---------------------------------------------------------------- files


@query("s1_list_sources")
def s1(spark, d):
    files = RD.list_sources(spark, d, ["parquet"])
    return files.select(F.substring_index("path", "/", -1).alias("name"), "length")


@query(
    "s1b_source_names",
    "SELECT unnest(['benchmark', 'conversations', 'customer', 'documents', 'embeddings', 'events', 'labels', 'lineitem', 'nation', 'orders', 'pages', 'part', 'region', 'supplier']) || '.parquet' AS name, TRUE AS has_bytes",
)
def s1b(spark, d):
    files = RD.list_sources(spark, d, ["parquet"])
    return files.select(F.substring_index("path", "/", -1).alias("name"), (F.col("length") > 0).alias("has_bytes"))


@query(
    "s2_raw_name",
    """SELECT c_custkey, c_mktsegment AS last_part, c_name AS before_df, 'f' || CAST(c_custkey AS VARCHAR) AS after_form FROM customer""",
)
def s2(spark, d):
    c = table(spark, d, "customer")
    key = F.col("c_custkey").cast("string")
    a = F.concat(F.lit("/raw/x_"), key, F.lit("_"), F.col("c_mktsegment"), F.lit(".csv.gz"))
    b = F.concat(F.lit("/raw/"), F.col("c_name"), F.lit("_df_v1.parquet"))
    f = F.concat(F.lit("/raw/inference_form_f"), key, F.lit(".json"))
    return c.select(
        "c_custkey",
        RD.raw_name(a, "last_part").alias("last_part"),
        RD.raw_name(b, "before_df").alias("before_df"),
        RD.raw_name(f, "after_form").alias("after_form"),
    )


_ORDERS = T.StructType(
    [
        T.StructField("o_orderkey", T.LongType()),
        T.StructField("o_custkey", T.LongType()),
        T.StructField("o_orderstatus", T.StringType()),
        T.StructField("o_totalprice", T.DoubleType()),
    ]
)


@query("s3_scan_csv", "SELECT o_orderkey, o_totalprice FROM orders")
def s3(spark, d):
    path = scratch_path(spark, "csv")
    o = table(spark, d, "orders").select(*_ORDERS.fieldNames())
    o.write.option("header", "true").option("compression", "gzip").csv(path)
    return RD.scan_csv(spark, path, _ORDERS, ["o_orderkey", "o_totalprice"])


@query("s4_scan_parquet", "SELECT event_id, value FROM events")
def s4(spark, d):
    return RD.scan_parquet(spark, f"{d}/events.parquet", ["event_id", "value"])


def _xml(spark, d, path):
    """One patient element per patient and day; a day's gridded records are at most 288 a section."""
    kinds = {X.CGM: "glucose_level", X.DIET: "meal", X.EXERCISE: "exercise"}
    rows = None
    for kind, section in kinds.items():
        r = record(spark, d, kind).select(
            F.col("PID").alias("_id"),
            F.to_date("DT_s").alias("day"),
            F.lit(section).alias("section"),
            F.struct(
                F.date_format("DT_s", "dd-MM-yyyy HH:mm:ss").alias("_ts"),
                F.round("BGValue", 4).cast("string").alias("_value"),
            ).alias("e"),
        )
        rows = r if rows is None else rows.unionByName(r)
    days = rows.groupBy("_id", "day").pivot("section", list(kinds.values())).agg(F.collect_list("e"))
    sections = [
        F.when(F.size(s) > 0, F.struct(F.col(s).alias("event"))).alias(s) for s in kinds.values()
    ]
    out = days.select("_id", *sections)
    out.write.format("xml").option("rootTag", "patients").option("rowTag", "patient").save(path)


@query(
    "s5_scan_patient_xml",
    f"""WITH {REC} SELECT "PID" AS "PatientID", "DT_s" AS "ObservationDateTime", round("BGValue", 4) AS "BGValue",
        18 AS "ExternalSourceID" FROM cgm""",
)
def s5(spark, d):
    path = scratch_path(spark, "xml")
    _xml(spark, d, path)
    attrs = ["ts", "value"]
    sections = RD.scan_patient_xml(spark, path, {"glucose_level": attrs, "meal": attrs, "exercise": attrs})
    g = S.parse_ts(S.xml_patient_meta(sections["glucose_level"]), ["ts"])
    raw = S.canonical_sections({"glucose_level": g.drop("id", "file_path", "year", "dataset_type")})["ElogBGEntry"]
    return raw.select(
        F.col("PatientID").cast("bigint").alias("PatientID"),
        "ObservationDateTime",
        F.col("BGValue").cast("double").alias("BGValue"),
        "ExternalSourceID",
    )


def _columnar(spark, d):
    """One form per patient and day with the day's gridded readings (at most 288) as lists; the
    offset list is empty."""
    g = record(spark, d, X.CGM)
    rows = F.sort_array(
        F.collect_list(F.struct(F.date_format("DT_s", "yyyy-MM-dd HH:mm:ss").alias("t"), F.round("BGValue", 4).alias("v")))
    )
    days = g.groupBy("PID", F.to_date("DT_s").alias("day")).agg(rows.alias("r"))
    glucose = F.struct(
        F.transform("r", lambda x: F.col("PID")).alias("PatientID"),
        F.transform("r", lambda x: x["t"]).alias("ObservationDateTime"),
        F.transform("r", lambda x: x["v"]).alias("BGValue"),
        F.array().cast("array<int>").alias("TimezoneOffset"),
    )
    form_id = F.concat_ws("_", F.col("PID").cast("string"), F.col("day").cast("string"))
    return days.select(form_id.alias("form_id"), F.to_json(F.struct(glucose.alias("ElogBGEntry"))).alias("form"))


_GLUCOSE = {
    "PatientID": "bigint",
    "ObservationDateTime": "string",
    "BGValue": "double",
    "TimezoneOffset": "int",
    "ActualBGValue": "double",
}


@query(
    "s6_scan_columnar_json",
    f"""WITH {REC} SELECT "PID" AS "PatientID", "DT_s" AS "ObservationDateTime", round("BGValue", 4) AS "BGValue",
        CAST(NULL AS INTEGER) AS "TimezoneOffset", CAST(NULL AS DOUBLE) AS "ActualBGValue" FROM cgm""",
)
def s6(spark, d):
    path = scratch_path(spark, "forms")
    _columnar(spark, d).write.json(path)
    texts = spark.read.schema("form_id string, form string").json(path)
    x = RD.scan_columnar_json(texts, "form", "ElogBGEntry", _GLUCOSE)
    return x.withColumn("ObservationDateTime", F.col("ObservationDateTime").cast("timestamp_ntz"))


def _invitations(spark, d):
    """One invitation form per order line: the customer is the patient, the line one prescription
    or two; an order without lines has none.  Forms of even orders carry an earlier invitation.

    Rows are spread by line before the JSON work, which costs far more than the shuffle."""
    o = table(spark, d, "orders").join(
        table(spark, d, "lineitem"), F.col("o_orderkey") == F.col("l_orderkey"), "left"
    )
    o = o.repartition("o_orderkey", "l_partkey", "l_suppkey")
    inv_id = F.concat_ws("-", "o_orderkey", "l_linenumber", "l_partkey", "l_suppkey")

    def rx(suffix, extra):
        return F.struct(
            F.concat(inv_id, F.lit(suffix)).alias("prescriptionId"),
            F.struct(F.col("l_suppkey").cast("string").alias("npi")).alias("doctor"),
            F.struct(
                F.col("l_suppkey").cast("string").alias("ncpdpid"),
                F.struct(F.lpad((F.col("l_partkey") % 90000).cast("string"), 5, "0").alias("zipCode")).alias("address"),
            ).alias("pharmacy"),
            F.struct(
                F.col("l_partkey").cast("string").alias("ndc"),
                F.when(F.col("l_partkey") % 3 == 0, "Jardiance").otherwise("Quviviq").alias("drugName"),
            ).alias("medication"),
            (F.col("l_quantity") + extra).alias("quantity"),
            F.col("l_linenumber").alias("daysSupply"),
        )

    one = F.array(rx("a", 0))
    rxs = F.when(F.col("l_partkey") % 2 == 0, F.concat(one, F.array(rx("b", 1)))).when(
        F.col("l_partkey").isNotNull(), one
    )
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    who = F.col("o_custkey").cast("string")
    patient = F.struct(
        F.concat((1940 + F.col("o_custkey") % 75).cast("string"), F.lit("-06-01")).alias("dateOfBirth"),
        F.when(F.col("o_custkey") % 2 == 0, "F").otherwise("M").alias("gender"),
        F.struct(F.lpad(who, 5, "0").alias("zipCode")).alias("address"),
    )
    earlier = F.struct(
        F.concat(F.lit("p"), inv_id).alias("invitationId"),
        who.alias("patientId"),
        day.alias("invitationDate"),
        patient.alias("patient"),
        F.when(F.col("l_partkey").isNotNull(), one).alias("prescriptions"),
    )
    form = F.struct(
        F.array(F.when(F.col("o_orderkey") % 4 == 0, "quviviq").otherwise("jardiance")).alias("models"),
        F.struct(
            inv_id.alias("invitationId"),
            who.alias("patientId"),
            day.alias("invitationDate"),
            day.alias("createdDate"),
            F.col("o_orderstatus").alias("state"),
        ).alias("invitation"),
        patient.alias("patient"),
        F.struct(F.col("o_orderpriority").alias("group")).alias("eligibility"),
        rxs.alias("prescriptions"),
        F.when(F.col("o_orderkey") % 2 == 0, F.array(F.struct(earlier.alias("invitation")))).alias("previous_invitations"),
    )
    return o.select(inv_id.alias("inv_id"), F.to_json(form).alias("form"))


FORMS = """fm AS (SELECT concat_ws('-', o_orderkey, l_linenumber, l_partkey, l_suppkey) AS inv_id,
    strftime(o_orderdate, '%Y-%m-%d') AS day, CAST(o_custkey AS VARCHAR) AS who, *
  FROM orders LEFT JOIN lineitem ON o_orderkey = l_orderkey),
 inv AS (SELECT FALSE AS old, inv_id AS id, * FROM fm UNION ALL SELECT TRUE, 'p' || inv_id, * FROM fm WHERE o_orderkey % 2 = 0),
 rx AS (SELECT 'a' AS sfx, 0 AS extra, * FROM inv UNION ALL SELECT 'b', 1, * FROM inv WHERE NOT old AND l_partkey % 2 = 0)"""


@query(
    "s7_scan_invitation_json",
    f"""WITH {FORMS} SELECT who AS patient_id_encoded, id AS invitation_id_encoded, day AS invitation_date,
        CASE WHEN NOT old THEN o_orderstatus END AS invitation_state FROM inv""",
)
def s7(spark, d):
    path = scratch_path(spark, "invites")
    # Plain JSON lines, compressed; files stay small as a compressed file is read by one task.
    forms = _invitations(spark, d).select("form")
    forms.write.option("compression", "gzip").option("maxRecordsPerFile", 200_000).text(path)
    return FM.scan_invitation_json(spark.read.text(path), "value")["invitation"].select(
        "patient_id_encoded", "invitation_id_encoded", "invitation_date", "invitation_state"
    )


@query(
    "s7b_invitation_patients",
    """SELECT CAST(o_custkey AS VARCHAR) AS patient_id_encoded, CASE WHEN o_custkey % 2 = 0 THEN 'F' ELSE 'M' END AS patient_gender,
       lpad(CAST(o_custkey AS VARCHAR), 5, '0')[1:3] AS zipcode3, lpad(CAST(o_custkey AS VARCHAR), 5, '0') AS zipcode5,
       CAST(year(min(o_orderdate)) - (1940 + o_custkey % 75) AS INTEGER) AS patient_age, any_value(n_name) AS state_code,
       any_value('Zone ' || n_regionkey) AS timezone, CAST(any_value(-60 * n_regionkey) AS INTEGER) AS "UserTimeZoneOffset"
       FROM orders LEFT JOIN nation ON lpad(CAST(n_nationkey AS VARCHAR), 3, '0') = lpad(CAST(o_custkey AS VARCHAR), 5, '0')[1:3]
       GROUP BY o_custkey""",
)
def s7b(spark, d):
    geo = table(spark, d, "nation").select(
        F.lpad(F.col("n_nationkey").cast("string"), 3, "0").alias("zipcode3"),
        F.col("n_name").alias("state"),
        F.concat(F.lit("Zone "), F.col("n_regionkey").cast("string")).alias("timezone"),
        (F.col("n_regionkey") * -60).cast("int").alias("UserTimeZoneOffset"),
    )
    p = FM.scan_invitation_json(_invitations(spark, d), "form", geo)["Ptt"]
    return p.select(
        "patient_id_encoded", "patient_gender", "zipcode3", "zipcode5", "patient_age", "state_code", "timezone",
        "UserTimeZoneOffset",
    )


@query(
    "s8_lookup_table",
    "SELECT c_custkey, n_name FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey",
)
def s8(spark, d):
    n = RD.lookup_table(spark, f"{d}/nation.parquet", ["n_nationkey", "n_name"])
    c = table(spark, d, "customer")
    return c.join(n, c["c_nationkey"] == n["n_nationkey"], "left").select("c_custkey", "n_name")


@query(
    "s9_load_or_compute",
    f"""WITH {REC} SELECT "PID", "DT_s", round("BGValue", 6) AS "BGValue" FROM cgm""",
)
def s9(spark, d):
    path = scratch_path(spark, "record")
    ST.load_or_compute(spark, path, lambda: record(spark, d, X.CGM))

    def never():
        raise AssertionError("a stored record must not be computed again")

    return ST.load_or_compute(spark, path, never).withColumn("BGValue", F.round("BGValue", 6))


@query(
    "s10_load_missing",
    f"""WITH {CASES}, {info_sql(BF24H, 'CGMInfoBf24h', 'a')} SELECT * FROM a""",
)
def s10(spark, d):
    folder = scratch_path(spark, "features")
    c, recs = cases(spark, d).select(*IDS), records(spark, d)
    fns = {"CGMInfoBf24h": lambda ids: X.attach_features(ids, recs, ["CGMInfoBf24h"])}
    ST.load_missing(spark, c.where(F.col("PID") % 2 == 0), IDS, folder, fns)
    return ST.load_missing(spark, c, IDS, folder, fns)


@query("s11_raw_catalog_manifest", "SELECT o_orderkey, o_orderstatus FROM orders")
def s11(spark, d):
    where = scratch_path(spark, "manifest")
    RD.save_manifest(spark, {"orders": f"{d}/orders.parquet", "customer": f"{d}/customer.parquet"}, d, where)
    return spark.read.parquet(RD.load_manifest(spark, where, d)["orders"]).select("o_orderkey", "o_orderstatus")


@query("s12_union_datasets", "SELECT c_custkey, c_name FROM customer")
def s12(spark, d):
    c = table(spark, d, "customer").select("c_custkey", "c_name")
    odd = c.where("c_custkey % 2 = 1").select("c_name", "c_custkey")
    return ST.union_datasets([c.where("c_custkey % 2 = 0"), odd])


@query("s13_write_tables", "SELECT c_custkey, c_acctbal FROM customer UNION ALL SELECT s_suppkey, s_acctbal FROM supplier")
def s13(spark, d):
    root = scratch_path(spark, "tables")
    c = table(spark, d, "customer").select("c_custkey", "c_acctbal")
    s = table(spark, d, "supplier").select("s_suppkey", "s_acctbal")
    a = RD.write_tables({"customer": c}, root)["customer"]
    b = RD.write_tables({"supplier": s}, root, "csv")["supplier"]
    return spark.read.parquet(a).union(RD.scan_csv(spark, b, s.schema))


@query("s14_check_inputs", "SELECT event_id FROM events WHERE event_type = 'view'")
def s14(spark, d):
    e = table(spark, d, "events").select("event_id", "event_type")
    catalog = {"view": e.where("event_type = 'view'"), "none": e.where("event_type = 'nosuch'"), "gone": None}
    good = RD.check_inputs(catalog)
    assert sorted(good) == ["view"]
    return good["view"].select("event_id")


# ---------------------------------------------------------------- forms


@query(
    "r13_fill_template",
    f"""WITH {FORMS} SELECT inv_id, CASE WHEN l_partkey % 2 = 0 THEN 2 ELSE 1 END AS n_rx, o_orderpriority AS grp,
        CAST(NULL AS VARCHAR) AS rx_bin FROM fm""",
)
def r13(spark, d):
    paths = ["prescriptions.prescriptionId", "eligibility.group", "eligibility.rxBin"]
    f = FM.parse_forms(_invitations(spark, d), "form", ["inv_id"], paths)
    return f.select(
        "inv_id",
        F.size("prescriptions").alias("n_rx"),
        F.col("eligibility.group").alias("grp"),
        F.col("eligibility.rxBin").alias("rx_bin"),
    )


@query(
    "r14_null_to_empty_list",
    f"""WITH {FORMS} SELECT inv_id, CASE WHEN l_partkey IS NULL THEN 0 WHEN l_partkey % 2 = 0 THEN 2 ELSE 1 END AS n_rx FROM fm""",
)
def r14(spark, d):
    form = FM.only(FM.FORM, ["models", "prescriptions.prescriptionId"])
    f = _invitations(spark, d).select("inv_id", F.from_json("form", form).alias("f"))
    f = f.select("inv_id", FM.null_to_empty_list(F.col("f"), form).alias("f"))
    return f.select("inv_id", F.size("f.prescriptions").alias("n_rx"))


_DRUG = "CASE WHEN l_partkey % 3 = 0 THEN 'Jardiance' ELSE 'Quviviq' END"


@query(
    "r15_flatten_prescriptions",
    f"""WITH {FORMS} SELECT who AS patient_id_encoded, id AS invitation_id_encoded,
        CASE WHEN l_partkey IS NOT NULL THEN inv_id || sfx END AS prescription_id_encoded, CAST(l_suppkey AS VARCHAR) AS prescriber_npi,
        lpad(CAST(l_partkey % 90000 AS VARCHAR), 5, '0')[1:3] AS pharmacy_zip_code_3,
        CASE WHEN l_partkey IS NOT NULL THEN {_DRUG} END AS drug_name, l_quantity + extra AS quantity,
        CAST(l_linenumber AS INTEGER) AS days_supply, CASE WHEN NOT old THEN o_orderpriority END AS group_id FROM rx""",
)
def r15(spark, d):
    columns = [
        "patient_id_encoded",
        "invitation_id_encoded",
        "prescription_id_encoded",
        "prescriber_npi",
        "pharmacy_zip_code_3",
        "drug_name",
        "quantity",
        "days_supply",
        "group_id",
    ]
    return FM.scan_invitation_json(_invitations(spark, d), "form", rx=columns)["Rx"]


@query(
    "c5_trigger_from_form",
    f"""WITH {FORMS} SELECT who AS patient_id_encoded, inv_id AS invitation_id_encoded, inv_id || sfx AS prescription_id_encoded,
        day AS "DT" FROM rx WHERE NOT old AND l_partkey IS NOT NULL
        AND {_DRUG} = CASE WHEN o_orderkey % 4 = 0 THEN 'Quviviq' ELSE 'Jardiance' END""",
)
def c5(spark, d):
    paths = ["models", "invitation", "prescriptions.prescriptionId", "prescriptions.medication.drugName"]
    return C.trigger_from_form(FM.parse_forms(_invitations(spark, d), "form", paths=paths), MODEL_DRUGS)


@query(
    "c5b_trigger_from_invitation",
    f"""WITH {FORMS} SELECT who AS patient_id_encoded, inv_id AS invitation_id_encoded, day AS "DT" FROM fm""",
)
def c5b(spark, d):
    return C.trigger_from_form(FM.parse_forms(_invitations(spark, d), "form", paths=["invitation"]))
