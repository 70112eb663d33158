"""Forms: only the parts asked for are parsed, with the results of the whole form; odd lists; scratch size."""

import json
import os

from pyspark.sql import functions as F

from caseflow.sources import forms as FM
from checks import sources_q as S

RX = {"prescriptionId": "r1", "doctor": {"npi": "9"}, "medication": {"drugName": "X"}, "quantity": 2.5}
INV = {"invitationId": "i", "patientId": "p", "invitationDate": "2024-01-01"}


def test_tables_of_odd_forms(spark):
    forms = [
        {"invitation": INV, "prescriptions": [RX, None], "eligibility": {"group": "g"}},
        {"invitation": INV, "prescriptions": []},
        {"invitation": INV, "previous_invitations": [{"invitation": {"invitationId": "old", "prescriptions": [RX]}}, None]},
        {},
    ]
    texts = spark.createDataFrame([(json.dumps(f),) for f in forms] + [("no json",), (None,)], "t string")
    wanted = ["drug_name", "quantity", "pharmacy_zip_code_3", "group_id", "prescription_id_encoded"]
    tables = FM.scan_invitation_json(texts, "t")
    whole = sorted(map(str, (tuple(r) for r in tables["Rx"].select(*wanted).collect())))
    part = FM.scan_invitation_json(texts, "t", rx=wanted)["Rx"]
    assert part.columns == wanted
    assert sorted(map(str, (tuple(r) for r in part.collect()))) == whole
    empty = str((None,) * 5)
    assert whole.count(empty) == 5 and len(whole) == 8
    assert tables["invitation"].count() == 8


def test_only_named_parts_are_parsed(spark):
    texts = spark.createDataFrame([(json.dumps({"invitation": INV}),)], "t string")
    paths = ["models", "prescriptions.medication.drugName"]
    got = FM.parse_forms(texts, "t", paths=paths)
    assert got.columns == ["models", "prescriptions"]
    assert got.collect()[0].asDict(True) == {"models": None, "prescriptions": [{"medication": {"drugName": None}}]}
    plan = FM.scan_invitation_json(texts, "t")["invitation"].select("invitation_state")
    plan = plan._jdf.queryExecution().optimizedPlan().toString()
    assert "from_json" in plan and "drugDescription" not in plan


def test_scanned_forms_take_less_disk_than_their_text(spark, data):
    from caseflow.plans import spread

    text = S._invitations(spark, data).agg(F.sum(F.length("form"))).first()[0]
    S.s7(spark, data)
    path = next(p for p in reversed(spread._made) if "/invites-" in p)
    used = sum(os.path.getsize(os.path.join(path, f)) for f in os.listdir(path))
    assert used < text / 4
