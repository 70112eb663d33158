"""Patient XML by byte ranges: against a plain parser, and malformed files."""

import random
import xml.etree.ElementTree as ET

import pytest
from pyspark.sql import functions as F

from caseflow.sources import patient_xml, readers as RD

SECTIONS = {"glucose_level": ["ts", "value"], "meal": ["ts", "carbs", "note"]}


def plain(paths):
    """(id, section, attributes) of every event, by the standard parser."""
    found, patients = [], []
    for p in paths:
        root = ET.parse(p).getroot()
        for patient in [root] if root.tag == "patient" else root.findall("patient"):
            patients.append(patient.get("id"))
            for name, attrs in SECTIONS.items():
                for e in patient.findall(f"{name}/event"):
                    found.append((patient.get("id"), name, *[e.get(a) for a in attrs]))
    return sorted(patients, key=str), sorted(found, key=str)


def scanned(spark, folder):
    got = RD.scan_patient_xml(spark, str(folder), SECTIONS)
    found = [(r["id"], s, *[r[a] for a in SECTIONS[s]]) for s in SECTIONS for r in got[s].collect()]
    return sorted((r["id"] for r in got["patient_info"].collect()), key=str), sorted(found, key=str)


ODD = """<?xml version="1.0"?>
<!-- <patient id="no"><meal><event ts="x"/></meal></patient> -->
<patients>
<patient id='1 &amp; 2' weight="99">
  <glucose_level><event ts="a>b" value="&lt;5&#233;&#x1F600;"/><event
     value='6 "x"'   ts = "t2" ></event><note><event ts="deep"/></note></glucose_level>
  <glucose_level/>
  <meal><!-- a < b <event ts="hidden"/> --><event ts="m" carbs="3" note="/&gt;"></event></meal>
  <event ts="stray"/><other><event ts="other"/></other><meal/>
</patient>
<patient id="3"><meal><event note="it's"/></meal></patient><patient/>
</patients>
"""


def test_odd_files_equal_the_standard_parser(spark, tmp_path):
    (tmp_path / "a").mkdir()
    (tmp_path / "a" / "odd.xml").write_text(ODD)
    (tmp_path / "one.xml").write_text('<patient id="9"><meal><event ts="1" carbs="2"/></meal></patient>')
    (tmp_path / "bom.xml").write_bytes("﻿<patient id='8'/>".encode())
    want = plain([tmp_path / "a" / "odd.xml", tmp_path / "one.xml", tmp_path / "bom.xml"])
    assert scanned(spark, tmp_path) == want and len(want[1]) == 5


def test_a_large_file_is_read_by_many_tasks_once(spark, tmp_path):
    rnd = random.Random(2)
    parts = ["<patients>"]
    for p in range(4):
        parts.append(f'<patient id="{p}">')
        for s in ("meal", "glucose_level", "other"):
            n = 4000 if p == 2 else 50  # one patient holds most
            parts.append(f"<{s}>" + "".join(f'<event ts="{rnd.random()}" value="{i}"/>\n' for i in range(n)) + f"</{s}>")
            parts.append("<!-- " + "<event ts='no'/> " * 300 + "-->")
        parts.append("</patient>")
    (tmp_path / "big.xml").write_text("".join([*parts, "</patients>"]))
    spark.conf.set("spark.sql.files.maxPartitionBytes", 16_000)
    spark.conf.set("spark.sql.files.openCostInBytes", 1)
    try:
        rows = patient_xml._rows(spark, str(tmp_path))
        assert rows.rdd.getNumPartitions() > 20
        sizes = [r["count"] for r in rows.groupBy("_block").count().collect()]
        assert len(sizes) > 20 and max(sizes) < 2000
        assert scanned(spark, tmp_path) == plain([tmp_path / "big.xml"])
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    got = RD.scan_patient_xml(spark, str(tmp_path), SECTIONS)
    plan = got["meal"]._jdf.queryExecution().executedPlan().toString()
    assert "Scan text" not in plan and plan.count("FileScan") == 1  # sections read what the one pass left


def test_tasks_get_stretches_of_a_file_whatever_its_size(spark, tmp_path, monkeypatch):
    """One file of one block: 40 times the rows are dealt to 40 times the tasks, each with a few stretches."""
    monkeypatch.setattr(patient_xml, "_CHUNK_BITS", 4)
    monkeypatch.setattr(patient_xml, "_TASK_ROWS", 250)
    dealt, keep = [], patient_xml.stored

    def seen(df, name):
        if name == "xml-levels":
            sizes = df.groupBy(F.spark_partition_id()).count().collect()
            dealt.append((len(sizes), max(r["count"] for r in sizes)))
        return keep(df, name)

    monkeypatch.setattr(patient_xml, "stored", seen)
    for n in (100, 4000):
        (tmp_path / str(n)).mkdir()
        events = "".join(f'<event ts="{i}" value="v"></event>' for i in range(n))
        (tmp_path / str(n) / "one.xml").write_text(f'<patient id="1"><meal>{events}</meal><glucose_level>{events}</glucose_level></patient>')
        assert scanned(spark, tmp_path / str(n)) == plain([tmp_path / str(n) / "one.xml"])
    assert dealt[0][0] <= 2 and dealt[1][0] > 50 and max(most for _, most in dealt) < 1000


@pytest.mark.parametrize(
    "text",
    [
        '<patient id="1"><meal></patient>',
        '<patient id="1"><meal></patient></meal>',
        '<patient id="1"><meal><event ts="1"/></meal>',
        '<patient id="1"></patient></patient>',
        '<patient id="1"><meal><event ts=1/></meal></patient>',
        '<patient id="1"><meal><event ts="1/></meal></patient>',
        '<a></b><b></a>',
        '<patient id="1"',
    ],
)
def test_malformed_files_are_errors(spark, tmp_path, text):
    (tmp_path / "x.xml").write_text(text)
    with pytest.raises(ValueError, match="x.xml"):
        RD.scan_patient_xml(spark, str(tmp_path), SECTIONS)


def test_running_and_carried_values_of_long_groups(spark):
    from caseflow.plans import spread as SP

    df = spark.range(500).select(F.lit("g").alias("g"), F.col("id").alias("k"), F.when(F.col("id") % 7 == 0, F.col("id")).alias("x"))
    for width in (500, 40, 3):
        got = SP.carried(df, ["k"], {"seen": F.col("x")}, ["g"], F.floor(F.col("k") / width)).collect()
        assert {r["k"]: r["seen"] for r in got} == {k: None if k == 0 else (k - 1) // 7 * 7 for k in range(500)}
