"""Invitation forms: nested JSON to invitation, prescription and patient tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from caseflow.operators.shaping import zip_timezone

# The parts of a form, as named by the sender.  A type name is a
# leaf, a dict a struct, a one-element list a list of that element.
_ADDRESS = {"zipCode": "string"}
_MEDICATION = dict.fromkeys(
    "ndc drugName drugDescription form top200BrandedDrugs top50GenericDrugs brandingSource "
    "suppliers legendStatus therapeuticEquivalenceId therEqHierarchyName therEqParentName "
    "therEqUltParentName therEqUltChildInd therEqUltParentEtcId therEqHierarchyLevel strength "
    "totalPackageStrength strengthUnits genericId dispensedPackageQuantity".split(),
    "string",
)
_SETTINGS = dict.fromkeys(
    "showREMSCampaigns showCouponCampaigns showEducationalCampaigns showInternalCampaigns "
    "showTargetCampaigns showExperimentalCampaigns sendRefillReminderMessages "
    "sendRenewalReminderMessages supportsHippoPrices supportsHippoPrices65 "
    "supportsHippoPricesMedicare supportsCopayPrices".split(),
    "string",
)
_PRESCRIPTION = {
    "prescriptionId": "string",
    "doctor": {"npi": "string"},
    "pharmacy": {"ncpdpid": "string", "storeName": "string", "address": _ADDRESS},
    "medication": _MEDICATION,
    "settings": _SETTINGS,
    "prescriptionType": "string",
    "directions": "string",
    "deliveryType": "string",
    "quantity": "double",
    "daysSupply": "int",
    "fillNumber": "int",
    "quantityUnit": "string",
    "refills": "int",
    "sourceId": "string",
    "customer": {"type": "string"},
    "organization": {"type": "string"},
}
_INVITATION = dict.fromkeys(
    "invitationId patientId invitationDate createdDate state workflowStep invitationType".split(),
    "string",
)
_PARTS = {
    "patient": {"dateOfBirth": "string", "gender": "string", "address": _ADDRESS},
    "eligibility": dict.fromkeys(["group", "rxBin", "rxPcn", "planName"], "string"),
    "prescriptions": [_PRESCRIPTION],
}

_LEAF = {"string": T.StringType(), "double": T.DoubleType(), "int": T.IntegerType()}


def schema_of(spec) -> T.DataType:
    """Spark type of a nested description."""
    if isinstance(spec, dict):
        return T.StructType([T.StructField(k, schema_of(v)) for k, v in spec.items()])
    if isinstance(spec, list):
        return T.ArrayType(schema_of(spec[0]))
    return _LEAF[spec]


FORM = schema_of(
    {
        "models": ["string"],
        "invitation": _INVITATION,
        **_PARTS,
        "previous_invitations": [{"invitation": {**_INVITATION, **_PARTS}}],
    }
)


def _empty(dt: T.StructType) -> Column:
    """A struct with every leaf null (lists of structs hold one such struct)."""
    return F.struct(*[_fill(F.lit(None).cast(f.dataType), f.dataType).alias(f.name) for f in dt])


def _fill(value: Column, dt: T.DataType) -> Column:
    if isinstance(dt, T.StructType):
        return F.struct(*[_fill(value[f.name], f.dataType).alias(f.name) for f in dt])
    if isinstance(dt, T.ArrayType) and isinstance(dt.elementType, T.StructType):
        return F.coalesce(
            F.transform(value, lambda x: _fill(x, dt.elementType)), F.array(_empty(dt.elementType))
        )
    return value


def fill_template(value: Column, dt: T.DataType) -> Column:
    """Every key of the template present: missing leaves null, a missing list of structs
    one empty struct."""
    return _fill(value, dt)


def null_to_empty_list(value: Column, dt: T.DataType) -> Column:
    """Null lists become empty lists, at any depth of structs."""
    if isinstance(dt, T.StructType):
        return F.struct(*[null_to_empty_list(value[f.name], f.dataType).alias(f.name) for f in dt])
    if isinstance(dt, T.ArrayType):
        return F.coalesce(value, F.array().cast(dt))
    return value


def only(dt: T.DataType, paths: list[str]) -> T.DataType:
    """The part of a nested type that the dotted paths name; a path to a struct names all of it."""
    if isinstance(dt, T.ArrayType):
        return T.ArrayType(only(dt.elementType, paths))
    below: dict[str, list[str]] = {}
    for p in paths:
        name, _, rest = p.partition(".")
        below.setdefault(name, []).append(rest)
    if unknown := set(below) - set(dt.names):
        raise KeyError(f"not in a form: {sorted(unknown)}")
    part = lambda f: f.dataType if "" in below[f.name] else only(f.dataType, below[f.name])
    return T.StructType([T.StructField(f.name, part(f)) for f in dt if f.name in below])


def parse_forms(
    texts: DataFrame, text: str, keep: list[str] | None = None, paths: list[str] | None = None
) -> DataFrame:
    """Forms parsed and completed; columns are those of :data:`FORM` plus ``keep``.

    With ``paths`` (dotted, as in ``prescriptions.medication.drugName``) only those parts are
    parsed and completed.  The list of earlier invitations is optional: absent means none.
    """
    form = FORM if paths is None else only(FORM, paths)
    raw = texts.select(*(keep or []), F.from_json(text, form).alias("_f"))
    top = [
        fill_template(F.col("_f")[f.name], f.dataType).alias(f.name)
        if f.name != "previous_invitations"
        else F.coalesce(F.col("_f")[f.name], F.array().cast(f.dataType)).alias(f.name)
        for f in form
    ]
    return raw.select(*(keep or []), *top)


def invitation_rows(texts: DataFrame, text: str, paths: list[str]) -> DataFrame:
    """One row per invitation, current and earlier; of its patient, eligibility and prescriptions
    only what ``paths`` name is parsed.  A missing list is null here."""
    held = [*[f.name for f in FORM["invitation"].dataType], *paths]
    form = only(FORM, ["invitation", *paths, *[f"previous_invitations.invitation.{p}" for p in held]])
    parsed = texts.select(F.from_json(text, form).alias("_f"))
    parts = [f.name for f in form if f.name in _PARTS]
    now = F.struct(
        *[F.col("_f.invitation")[f.name].alias(f.name) for f in FORM["invitation"].dataType],
        *[F.col("_f")[p].alias(p) for p in parts],
    )
    before = F.transform("_f.previous_invitations", lambda x: x["invitation"])
    all_ = F.concat(F.array(now), F.coalesce(before, F.array().cast(T.ArrayType(form["previous_invitations"].dataType.elementType["invitation"].dataType))))
    # Outer explode: Spark adds no emptiness test, which would parse the JSON again below it.
    return parsed.select(F.explode_outer(all_).alias("i")).select("i.*")


def invitation_table(inv: DataFrame) -> DataFrame:
    """The invitation raw table."""
    return inv.select(
        F.col("patientId").alias("patient_id_encoded"),
        F.col("invitationId").alias("invitation_id_encoded"),
        F.col("invitationDate").alias("invitation_date"),
        F.col("createdDate").alias("created_date"),
        F.col("state").alias("invitation_state"),
        F.col("workflowStep").alias("workflow_step"),
        F.col("invitationType").alias("invitation_type"),
        F.lit("None").alias("partner_id"),
        F.lit("None").alias("message_id"),
    )


# Output column of a prescription and where in the form it comes from.
_RX_SOURCE = {
    "prescriber_npi": "doctor.npi",
    "ncpdp_id": "pharmacy.ncpdpid",
    "pharmacy_zip_code": "pharmacy.address.zipCode",
    "pharmacy_name_rx": "pharmacy.storeName",
    "prescription_type": "prescriptionType",
    "directions": "directions",
    "delivery_type": "deliveryType",
    "quantity": "quantity",
    "days_supply": "daysSupply",
    "fill_number": "fillNumber",
    "quantity_unit": "quantityUnit",
    "refills_available": "refills",
    "package_size": "medication.dispensedPackageQuantity",
    "ndc_id": "medication.ndc",
    "drug_name": "medication.drugName",
    "drug_description": "medication.drugDescription",
    "form": "medication.form",
    "top_200_branded_drugs": "medication.top200BrandedDrugs",
    "top_50_generic_drugs": "medication.top50GenericDrugs",
    "brand_source": "medication.brandingSource",
    "suppliers": "medication.suppliers",
    "legend_status": "medication.legendStatus",
    "therapeutic_equivalence_id": "medication.therapeuticEquivalenceId",
    "ther_eq_hierarchy_name": "medication.therEqHierarchyName",
    "ther_eq_parent_name": "medication.therEqParentName",
    "ther_eq_ult_parent_name": "medication.therEqUltParentName",
    "ther_eq_ult_child_ind": "medication.therEqUltChildInd",
    "ther_eq_ult_parent_etc_id": "medication.therEqUltParentEtcId",
    "ther_eq_hierarchy_level": "medication.therEqHierarchyLevel",
    "strength": "medication.strength",
    "total_package_strength": "medication.totalPackageStrength",
    "strength_units": "medication.strengthUnits",
    "generic_id": "medication.genericId",
    "show_rems_campaigns": "settings.showREMSCampaigns",
    "show_coupon_campaigns": "settings.showCouponCampaigns",
    "show_educational_campaigns": "settings.showEducationalCampaigns",
    "show_internal_campaigns": "settings.showInternalCampaigns",
    "show_target_campaigns": "settings.showTargetCampaigns",
    "show_experimental_campaigns": "settings.showExperimentalCampaigns",
    "send_refill_reminder_messages": "settings.sendRefillReminderMessages",
    "send_renewal_reminder_messages": "settings.sendRenewalReminderMessages",
    "supports_hippo_prices": "settings.supportsHippoPrices",
    "supports_hippo_prices65": "settings.supportsHippoPrices65",
    "supports_hippo_prices_medicare": "settings.supportsHippoPricesMedicare",
    "supports_copay_prices": "settings.supportsCopayPrices",
    "source_id": "sourceId",
    "customer_type": "customer.type",
    "organization_type": "organization.type",
}

# Prescription columns the forms never carry.
_RX_NULL = [
    "simple_pharmacy_name_rx",
    "specialty_pharmacy",
    "legal_business_name",
    "controlled_substance_code",
    "package_units",
    "primary_dispenser_type",
    "primary_dispenser_type_code",
    "dispenser_class_code",
    "dispenser_class",
    "secondary_dispenser_type_code",
    "tertiary_dispenser_type_code",
    "record_locator_encoded",
    "start_date",
    "campaign_content_id",
    "insurance_start_date",
    "content_id",
    "campaign_id",
]


def prescription_paths(columns: list[str] | None = None) -> list[str]:
    """What a form's prescription table reads of a form; ``columns`` names the output columns wanted."""
    wanted = [src for out, src in _RX_SOURCE.items() if columns is None or out in columns]
    return ["eligibility", *[f"prescriptions.{p}" for p in ("prescriptionId", "pharmacy.address.zipCode", *wanted)]]


def flatten_prescriptions(inv: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """One flat row per prescription of each invitation: all columns, or those named.

    A missing list, or a null entry of a list, is one prescription without values."""
    held = inv.schema["prescriptions"].dataType.elementType
    one = F.lit(None).cast(held)
    # Wrapped, so that an entry without values is told from an empty list without building it anew.
    entries = F.transform(F.coalesce("prescriptions", F.array(one)), lambda x: F.struct(x.alias("r")))
    rx = inv.select("patientId", "invitationId", "invitationDate", "eligibility", F.explode_outer(entries).alias("e"))
    rx = rx.where(F.col("e").isNotNull()).select("*", "e.r")
    made = {
        "patient_id_encoded": F.col("patientId"),
        "invitation_id_encoded": F.col("invitationId"),
        "prescription_id_encoded": F.col("r.prescriptionId"),
        "invitation_date": F.col("invitationDate"),
        **{out: F.col(f"r.{src}") for out, src in _RX_SOURCE.items() if columns is None or out in columns},
        "pharmacy_zip_code_3": F.substring("r.pharmacy.address.zipCode", 1, 3),
        "group_id": F.col("eligibility.group"),
        "rx_bin": F.col("eligibility.rxBin"),
        "rx_pcn": F.col("eligibility.rxPcn"),
        "plan_name": F.col("eligibility.planName"),
        **{c: F.lit(None).cast("string") for c in _RX_NULL},
        **{c: F.lit(0) for c in ("CmpRmd", "CmpLearn", "CmpSave")},
    }
    return rx.select(*[made[c].alias(c) for c in columns or made])


def age_bucket(age: Column) -> Column:
    """Ten-year age band; below 18 null."""
    return (
        F.when(age < 18, F.lit(None).cast("string"))
        .when(age <= 30, "18-30")
        .when(age <= 40, "31-40")
        .when(age <= 50, "41-50")
        .when(age <= 60, "51-60")
        .when(age <= 70, "61-70")
        .when(age <= 80, "71-80")
        .when(age > 80, "81+")
    )


def age_by5(age: Column) -> Column:
    """Age to the nearest five, halves to even."""
    return (F.bround(age / F.lit(5.0), 0) * 5).cast("int")


#: What a zip code tells of a patient's place.
PLACE = ["state", "timezone", "UserTimeZoneOffset"]


def patient_table(inv: DataFrame) -> DataFrame:
    """One row per patient: first non-null value of each attribute over the invitations by date."""
    zip_code = F.col("patient.address.zipCode")
    age = F.year(F.to_date("invitationDate")) - F.year(F.to_date("patient.dateOfBirth"))
    rows = inv.select(
        F.col("patientId").alias("patient_id_encoded"),
        F.struct("invitationDate", "invitationId").alias("_at"),
        F.col("patient.gender").alias("patient_gender"),
        age_bucket(age).alias("patient_age_bucket"),
        age_by5(age).alias("patient_age_by5"),
        F.substring(zip_code, 1, 3).alias("zipcode3"),
        F.substring(zip_code, 1, 5).alias("zipcode5"),
        age.alias("patient_age"),
    )
    cols = [c for c in rows.columns if c not in ("patient_id_encoded", "_at")]
    return rows.groupBy("patient_id_encoded").agg(
        *[F.min_by(c, F.when(F.col(c).isNotNull(), F.col("_at"))).alias(c) for c in cols]
    )


def scan_invitation_json(
    texts: DataFrame, text: str, geo: DataFrame | None = None, rx: list[str] | None = None
) -> dict[str, DataFrame]:
    """Invitation, prescription and patient tables of a set of forms.

    Each table parses only the parts of a form it reads; ``rx`` names the prescription
    columns wanted, if not all.  ``geo`` gives state, timezone and UserTimeZoneOffset by
    zipcode3 or zipcode5; without it the patients' place is null.
    """
    patients = patient_table(invitation_rows(texts, text, ["patient"]))
    if geo is None:
        patients = patients.withColumns({c: F.lit(None).cast("string") for c in PLACE})
    else:
        patients = zip_timezone(patients, geo, PLACE)
    return {
        "invitation": invitation_table(invitation_rows(texts, text, [])),
        "Rx": flatten_prescriptions(invitation_rows(texts, text, prescription_paths(rx)), rx),
        "Ptt": patients.withColumnRenamed("state", "state_code"),
    }
